"""Mixing sources to target weights along a time-varying curriculum.

Targets share all words by weight; a target stops at LIMIT times its source's size and the excess is shared anew among the others.
That has a closed form over sources ordered by limit per weight, so the per-source table (one row a source) needs one window.
Within a source documents stand in an order drawn from the md5 of doc_id and text; the running word count before each document, found
from sums of hash buckets and a window within each bucket, decides how often it is taken: whole passes while the target lasts, then what
is left. Equal rows have one draw; where more of them than a bucket should hold do, the draw is split into buckets of its own.
Each source has a schedule: weights at knots of training time 0..1, straight between them, scaled so that their integral is its
target. The integral is the cumulative demand; inverting it at the words taken so far gives the position of every pass of every
document, and `positions` range-sorts the corpus by it.

Defined cases: null text has size 0 and is taken 0 times; null sources are one source, last in order; rows that repeat, or share an
id, stand side by side, and words are counted for each. An empty table gives an empty result. Sources whose words are all blank have
target 0. Very long texts count as any other. Other columns are not read by `mix` and returned unchanged by `arrange`, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.shared import HOT, SPACE, written
from sieveline.operators.extract import fresh

WEIGHTS = (5, 2, 1)
LIMIT = 3
#: Weight over training time for each place in WEIGHTS: (time, weight) knots, from time 0 to time 1.
SCHEDULES = (((0.0, 1.0), (0.5, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)))
#: Rows that a hash bucket should hold on average; the number of buckets follows the input.
BUCKET_ROWS = 2000


def n_words(text: Column) -> Column:
    """The number of words of a text, 0 for null."""
    parts = F.split(text, SPACE, -1)
    blank_ends = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.when(text.isNull() | (F.length(text) == 0), 0).otherwise(F.size(parts) - blank_ends).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, place, source_size, target of a table source, source_size: one row for each source, so that it is small."""
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ordered = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("w", w.cast("long"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("w"), "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    tried = ordered.withColumn("left", left).withColumn("weight_left", weight_left)
    # Sources at their limit come first in this order; the others share what the first of them found.
    at_limit = tried.withColumn("full", limit * F.col("source_size") * F.col("weight_left") <= F.col("left") * F.col("w"))
    first = at_limit.withColumn("nth", F.when(~F.col("full"), F.row_number().over(by_limit)))
    share = F.min(F.when(~F.col("full"), F.struct("nth", "left", "weight_left"))).over(everything)
    target = F.when(F.col("full"), (limit * F.col("source_size")).cast("double")).otherwise(F.col("share.left").cast("double") * F.col("w") / F.col("share.weight_left"))
    return first.withColumn("share", share).select("source", "place", "source_size", target.alias("target"))


def _sized(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    draw = F.md5(F.concat(known("doc_id"), F.lit("|"), F.md5(known("text"))))
    return docs.select(*keep, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size"), draw.alias("draw"))


def schedule_position(schedules: Sequence, place: str, done: str) -> str:
    """SQL for the time at which the share `done` (0 to 1) of a source's demand is met: the inverse of the schedule's integral.

    Knot weights must be above 0. On a piece from time a with weight u and slope m, demand grows by u*t + m*t*t/2.
    """
    cases = []
    for k, knots in enumerate(schedules):
        area = sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:]))
        start, pieces = 0.0, []
        for (a, u), (b, v) in zip(knots, knots[1:]):
            need = f"(({done}) * {area!r}D - {start!r}D)"
            pieces.append((start + (b - a) * (u + v) / 2, f"{a!r}D + 2 * {need} / ({u!r}D + sqrt(greatest(0.0D, {u * u!r}D + {2 * (v - u) / (b - a)!r}D * {need})))"))
            start = pieces[-1][0]
        *inner, (_, last) = pieces
        found = "".join(f"WHEN ({done}) * {area!r}D < {end!r}D THEN {time} " for end, time in inner)
        cases.append(f"WHEN ({place}) % {len(schedules)} = {k} THEN " + (f"CASE {found}ELSE {last} END" if found else last))
    return f"least(1.0D, CASE {' '.join(cases)} END)"


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, schedules: Sequence = SCHEDULES, cut_last: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, passes, position (of the first pass, null if never taken) of each row, and the columns
    `keep`.

    With cut_last the document in which a target ends gives just the words that it lacks; otherwise documents are taken whole, the
    last one if at least half of it is within the target.
    """
    sized = written(_sized(docs, keep))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goals = written(targets(totals.select("source", "source_size"), weights, limit).withColumnRenamed("source", "goal_source"))
    n = sized.count()
    digits = 1
    while 16**digits * BUCKET_ROWS < n and digits < 7:
        digits += 1
    bucketed = _split(sized.withColumn("bucket", F.substring("draw", 1, digits)), n)
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = F.coalesce(F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.withColumn("start", before).join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).select(F.col("source").alias("start_source"), F.col("bucket").alias("start_bucket"), "start", "place", "source_size", "target")
    within = Window.partitionBy("source", "bucket").orderBy("draw", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("start_source")) & (F.col("bucket") == F.col("start_bucket"))).withColumn("before", F.col("start") + F.col("inner"))
    goal = F.floor("target").cast("long")
    # pass k (from 0) of this document begins at before + k * source_size words
    whole = F.when(F.col("source_size") > 0, F.floor((goal - F.col("before") - F.col("size")) / F.col("source_size")) + 1).otherwise(0)
    whole = F.greatest(F.lit(0), F.least(F.lit(limit), whole)).cast("long")
    rest = goal - F.col("before") - F.col("whole") * F.col("source_size")
    part = F.when(F.col("whole") < limit, F.greatest(F.lit(0), F.least(F.col("size"), rest))).otherwise(0).cast("long")
    if not cut_last:
        part = F.when(2 * part >= F.col("size"), F.col("size")).otherwise(0).cast("long")
    taken = placed.withColumn("whole", whole).withColumn("part", part)
    taken = taken.withColumn("taken", F.col("whole") * F.col("size") + F.col("part")).withColumn("passes", F.when(F.col("size") > 0, F.col("whole") + (F.col("part") > 0).cast("long")).otherwise(0).cast("long"))
    first = F.expr(schedule_position(schedules, "place", "before / greatest(target, 1.0D)"))
    return taken.select(*keep, "doc_id", "source", "size", "source_size", "target", "taken", "passes", F.when(F.col("passes") > 0, first).alias("position"), "place", "before")


def _split(bucketed: DataFrame, n: int) -> DataFrame:
    """bucketed, where rows of a draw that more than one row in HOT has are buckets of their own, one for each part of the input that holds
    them. They are equal in all that places a row, so that any order among them gives the same rows."""
    most = max(8 * BUCKET_ROWS, n // HOT)
    full = bucketed.groupBy("source", "bucket").count().where(F.col("count") > most).select("bucket").distinct()
    if full.isEmpty():
        return bucketed
    hot = bucketed.join(F.broadcast(full), "bucket", "left_semi").groupBy("draw").count().where(F.col("count") > most).select(F.col("draw").alias("hot_draw"))
    own = F.concat("draw", F.lit("-"), F.lpad(F.pmod(F.spark_partition_id(), F.lit(HOT)).cast("string"), 4, "0"))
    return bucketed.join(F.broadcast(hot), F.col("draw") == F.col("hot_draw"), "left").withColumn("bucket", F.when(F.col("hot_draw").isNotNull(), own).otherwise(F.col("bucket"))).drop("hot_draw")


def positions(mixed: DataFrame, schedules: Sequence = SCHEDULES) -> DataFrame:
    """doc_id, pass, position: one row for each pass over a document, range-sorted by position."""
    each = mixed.where("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes").cast("int") - 1)))
    done = "(before + pass * source_size) / greatest(target, 1.0D)"
    return each.select("doc_id", "source", "size", "pass", F.expr(schedule_position(schedules, "place", done)).alias("position")).orderBy("position", "doc_id", "pass")


def arrange(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, schedules: Sequence = SCHEDULES) -> DataFrame:
    """The training order: each document with all its columns as often as the mix takes it whole, range-sorted by position."""
    row, at_row, position = fresh(docs.columns, ["row", "at_row", "position"])
    held = written(docs.withColumn(row, F.monotonically_increasing_id()))
    mixed = mix(held, weights, limit, schedules, cut_last=False, keep=(row,))
    each = mixed.where("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes").cast("int") - 1)))
    done = "(before + pass * source_size) / greatest(target, 1.0D)"
    at = each.select(F.col(row).alias(at_row), F.expr(schedule_position(schedules, "place", done)).alias(position))
    found = held.join(at, F.col(row) == F.col(at_row))
    return found.orderBy(position, row).select(*[F.col(f"`{c}`") for c in docs.columns])
