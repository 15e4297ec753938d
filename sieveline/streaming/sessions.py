"""Sessions of a stream, and the rows that came too late for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sessions(stream: DataFrame, key: str, time: str, rank: str, gap: str, late: str = "1 hour") -> DataFrame:
    """key, session_start, session_end (the last row's time and the gap), n and the highest rank of each session of a key.

    Rows of a key that are at most `gap` apart are one session; sessions that a row between them joins are merged. For append mode: a session comes out when
    the watermark, `late` behind the latest row, has passed its end; a row behind the watermark is dropped and counted (see `late_rows`).
    Spark sums up a task's rows before the state, so that a key with many rows sends its sessions, not its rows.
    """
    timed = stream.withWatermark(time, late) if stream.isStreaming else stream
    found = timed.groupBy(F.col(f"`{key}`"), F.session_window(F.col(f"`{time}`"), gap).alias("w")).agg(F.count("*").alias("n"), F.max(f"`{rank}`").alias("rank"))
    return found.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "rank")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped before the first stateful operator, over the micro-batches that the query still reports on.

    Rows with equal key and time in one task count once, since they are summed up before.
    """
    return sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
