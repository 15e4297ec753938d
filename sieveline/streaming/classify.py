"""Classification of streams. The work on a row is stateless, so the batch operators run on streams as they are; counts use watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.classify import classify_columns


def classify_stream(stream: DataFrame, columns: str | Sequence[str], **options) -> DataFrame:
    return classify_columns(stream, columns, **options)


def level_counts(stream: DataFrame, time: str, width: str, late: str | None = "1 hour", level: str = "level", slide: str | None = None) -> DataFrame:
    """window_start, level, n in tumbling (or, with `slide`, sliding) windows; on a stream rows later than `late` are dropped."""
    timed = stream.withWatermark(time, late) if late and stream.isStreaming else stream
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return timed.groupBy(window.alias("w"), level).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), level, "n")
