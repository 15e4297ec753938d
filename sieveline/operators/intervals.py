"""Joins over time and place that equality alone can't express: overlapping intervals, and the latest earlier row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.sources.scratch import written

#: Rows of one side in a bin; a bin with more is split.
DENSE = 5_000


def _binned(df: DataFrame, on: Sequence[str], start: str, end: str, width: int, side: str) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(side)
    a, b = F.col(f"`{start}`").cast("long"), F.col(f"`{end}`").cast("long")
    kept = df.where(a < b).where(" AND ".join(f"`{c}` IS NOT NULL" for c in on) or "true")
    bins = F.sequence(F.floor(a / width), F.floor((b - 1) / width))
    return kept.select(*[F.col(f"`{c}`") for c in on], row, F.explode(bins).alias("bin"))


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str], start: str = "start", end: str = "end", width: int = 1024, dense: int = DENSE) -> DataFrame:
    """The `on` columns and structs `left` and `right` of each pair of rows that agree in them and whose intervals [start, end) overlap.

    An interval goes to all bins of `width` that it touches, and a pair is reported in the first bin that both touch, so once. A bin that more than
    `dense` rows of a side touch is split: that side's rows are dealt to parts, and the other side's go to each part. Rows whose key,
    start or end is null, and empty intervals, overlap nothing. Choose a width near that of the longer intervals: one costs a row for each bin.
    """
    on = list(on)
    sides = {"left": _binned(left, on, start, end, width, "left"), "right": _binned(right, on, start, end, width, "right")}
    at = [*on, "bin"]
    counts = sides["left"].select(*at, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(sides["right"].select(*at, F.lit(0).alias("l"), F.lit(1).alias("r")))
    parts = lambda c: F.ceil(F.sum(c) / dense).cast("int").alias(c)
    crowded = written(counts.groupBy(*at).agg(parts("l"), parts("r")).where("l > 1 OR r > 1"))
    dealt = []
    for side, own, other in (("left", "l", "r"), ("right", "r", "l")):
        some = sides[side].join(crowded, at, "left")
        mine = F.pmod(F.xxhash64(side), F.greatest(F.coalesce(own, F.lit(1)), F.lit(1))).cast("int")
        all_others = F.sequence(F.lit(0), F.greatest(F.coalesce(other, F.lit(1)), F.lit(1)) - 1)
        dealt.append(some.select(*at, side, mine.alias(f"part_{own}"), F.explode(all_others).alias(f"part_{other}")))
    pairs = dealt[0].join(dealt[1], [*at, "part_l", "part_r"])
    l_start, l_end, r_start, r_end = (F.col(s)[c].cast("long") for s in ("left", "right") for c in (start, end))
    first = F.floor(F.greatest(l_start, r_start) / width)
    return pairs.where((l_start < r_end) & (r_start < l_end) & (F.col("bin") == first)).select(*on, "left", "right")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], time: str, keep: dict[str, str], strict: bool = False, parts: int | None = None) -> DataFrame:
    """left and, under the names that `keep` gives them, columns of the latest right row with the same `by` and a time not after (strict: before) the left one's.

    Of right rows with equal key and time the one whose kept values are greatest counts. Left rows without such a row, or with a null in key or time, get
    nulls. Both sides are range-partitioned together by key and time, so that a key with many rows lies on many partitions; the last
    value of a partition is carried to the later ones that its key reaches. That is one row a partition at most, and is broadcast.
    """
    by, names = list(by), list(keep)
    if clash := {n.lower() for n in names} & {c.lower() for c in left.columns}:
        raise ValueError(f"the left table has columns {sorted(clash)} already")
    key = lambda df: [F.col(f"`{c}`").alias(f"key_{k}") for k, c in enumerate(by)] + [F.col(f"`{time}`").alias("time")]
    keys = [f"key_{k}" for k in range(len(by))]
    here = " AND ".join(f"{k} IS NOT NULL" for k in (*keys, "time"))
    rows = left.select(*key(left), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row"))
    value = F.struct(*[F.col(f"`{c}`").alias(n) for n, c in keep.items()])
    latest = right.select(*key(right), value.alias("value")).where(here).groupBy(*keys, "time").agg(F.max("value").alias("value"))
    kind = lambda df, c: df.schema[c].dataType
    none = lambda df, c: F.lit(None).cast(kind(df, c)).alias(c)
    both = rows.where(here).select(*keys, "time", F.lit(1).alias("turn"), "row", none(latest, "value"))
    both = both.unionByName(latest.select(*keys, "time", F.lit(2 if strict else 0).alias("turn"), none(rows, "row"), "value"))
    n = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(both.repartitionByRange(n, *keys, "time").withColumn("part", F.spark_partition_id()))
    so_far = Window.partitionBy("part", *keys).orderBy("time", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = dealt.withColumn("own", F.last("value", ignorenulls=True).over(so_far)).where("turn = 1")
    lasts = dealt.groupBy(*keys, "part").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("time"))).alias("last"))
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).where("carried IS NOT NULL").drop("last")
    out = found.join(F.broadcast(carried), [*keys, "part"], "left").withColumn("own", F.coalesce("own", "carried")).select("row", "own")
    out = out.unionByName(rows.where(f"NOT ({here})").select("row", none(latest, "value").alias("own")))
    return out.select("row.*", *[F.col("own")[n].alias(n) for n in names])

