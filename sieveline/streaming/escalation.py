"""Rises of a key's highest level, as keyed state of a stream that is forgotten when the key falls silent."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructField, StructType

_MICRO = timedelta(microseconds=1)


_NONE = np.empty(0, np.int64)
_RUN = 1 << 32


def _summed(first: np.ndarray, last: np.ndarray, rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First time, last time and rank, one of each rank in each slot of `width` microseconds."""
    slot = first // width
    order = np.lexsort((rank, slot))
    slot, rank = slot[order], rank[order]
    cuts = np.flatnonzero(np.concatenate(([True], (slot[1:] != slot[:-1]) | (rank[1:] != rank[:-1]))))
    return np.minimum.reduceat(first[order], cuts), np.maximum.reduceat(last[order], cuts), rank[cuts]


def _slots(chunks: Iterator[pd.DataFrame], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First time, last time and rank of each rank in each slot: what counts of any number of rows. Arrays, since most keys have few rows and pandas takes milliseconds for each."""
    parts: list[tuple[np.ndarray, ...]] = []
    for pdf in chunks:
        if len(pdf):
            us = pdf["us"].to_numpy()
            parts.append(_summed(us, us, pdf["rank"].to_numpy().astype(np.int64), width))
        if len(parts) > 32:
            parts = [_summed(*map(np.concatenate, zip(*parts)), width)]
    if len(parts) > 1:
        parts = [_summed(*map(np.concatenate, zip(*parts)), width)]
    return parts[0] if parts else (_NONE, _NONE, _NONE)


def rises(first: np.ndarray, end: np.ndarray, rank: np.ndarray, highest: int, last: int | None, forget: int) -> tuple[list[tuple[int, int, int]], int, int | None]:
    """(time, rank before, rank) of each rise, and the highest rank and the last time after all slots; a silence of more than `forget` begins anew."""
    if not len(first):
        return [], highest, last
    order = np.lexsort((-rank, first))
    first, end, rank = first[order], end[order], rank[order]
    latest = np.maximum.accumulate(np.concatenate(([first[0] if last is None else last], end)))
    base = np.cumsum(first - latest[:-1] > forget) * _RUN  # apart for each run between silences, so that one maximum serves all
    level = np.maximum.accumulate(np.concatenate(([highest], base + np.maximum(rank, 0))))
    before = np.maximum(level[:-1], base) - base
    up = np.flatnonzero(rank > before)
    return list(zip(first[up].tolist(), before[up].tolist(), rank[up].tolist())), int(level[-1] - base[-1]), int(latest[-1])


def escalations(stream: DataFrame, key: str, time: str, rank: str, forget: timedelta = timedelta(days=7), late: str = "1 hour") -> DataFrame:
    """key, time, rank_before and rank, one row for each time that a key's highest rank rises, from 0 on.

    A key that is silent for more than `forget` begins at 0 again. Its state is the highest rank and the last time; a timer in event time removes it when
    the watermark has passed that silence, when no row can come any more that it would matter for. Rows of a micro-batch may come in any order:
    they are summed up in slots of a quarter of `forget`, so that a key with many rows takes memory for the slots only. Between micro-batches a key's
    rows should come in order; a row that comes later, but before the watermark, counts at its own time and is never below what is known.
    Rows later than `late` are dropped; rows with a null key, time or rank don't count.
    """
    whole = forget // _MICRO
    width = max(1, whole // 4)

    def run(k: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        highest, last = state.get if state.exists else (0, None)
        found, highest, last = rises(*_slots(chunks, width), highest, last, whole)
        state.update((highest, last))
        state.setTimeoutTimestamp(max((last + whole) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if found:
            yield pd.DataFrame({"key": [k[0]] * len(found), "us": [x[0] for x in found], "rank_before": [x[1] for x in found], "rank": [x[2] for x in found]})

    rows = stream.where(f"`{key}` IS NOT NULL AND `{time}` IS NOT NULL AND `{rank}` IS NOT NULL").withWatermark(time, late)
    rows = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{time}`"), F.unix_micros(F.col(f"`{time}`")).alias("us"), F.col(f"`{rank}`").cast("int").alias("rank"))
    kind = StructType([StructField("key", rows.schema["key"].dataType), *StructType.fromDDL("us long, rank_before int, rank int")])
    out = rows.groupBy("key").applyInPandasWithState(run, kind, "highest int, last long", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("key").alias(key), F.timestamp_micros("us").alias(time), "rank_before", "rank")
