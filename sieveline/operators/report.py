"""Reports on classified tables: counts by level, subtotals, the most sensitive rows of each group and the review queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions import recognisers
from sieveline.functions.rules import rank


def by_level(df: DataFrame, keys: Sequence[str], level: str = "level") -> DataFrame:
    return df.groupBy(*keys, level).agg(F.count("*").alias("n"))


def subtotals(df: DataFrame, keys: Sequence[str], level: str = "level") -> DataFrame:
    """Rows and sensitive rows (above Public) of each group and of its supergroups; a summed-up key reads null, and depth tells them apart."""
    sensitive = F.count_if(rank(F.col(level)) > 0).alias("n_sensitive")
    return df.rollup(*keys).agg(F.count("*").alias("n"), sensitive, F.grouping_id().alias("depth"))


def cube(df: DataFrame, keys: Sequence[str], level: str = "level") -> DataFrame:
    sensitive = F.count_if(rank(F.col(level)) > 0).alias("n_sensitive")
    return df.cube(*keys).agg(F.count("*").alias("n"), sensitive, F.grouping_id().alias("depth"))


def most_sensitive(df: DataFrame, group: str, k: int, key: str, elements: str = "elements", level: str = "level") -> DataFrame:
    """The k most sensitive rows of each group: by level, then number of elements, then key.

    Spark keeps k rows of a group in each task before it shuffles them, so that a large group doesn't meet in one.
    """
    order = Window.partitionBy(group).orderBy(rank(F.col(level)).desc(), F.size(elements).desc(), F.col(key))
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def review_queue(df: DataFrame, key: str, level: str = "level") -> DataFrame:
    """Rows that people should look at, the most sensitive first."""
    return df.where("needs_review").orderBy(rank(F.col(level)).desc(), F.col(key))


def span_rows(df: DataFrame, key: str, text: str, near: int | None = None) -> DataFrame:
    """key, label, start, end, score and value of every structured hit in a text column; overlaps are kept. near: see recognisers.spans."""
    return df.select(key, F.explode(recognisers.spans(F.col(text), near=near)).alias("s")).select(key, "s.*")


#: The standard error of a distinct count is about 1.04 / sqrt(2 ** LOG_REGISTERS).
LOG_REGISTERS = 12


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys and a sketch of the distinct values of each group: a table to keep, of bounded size a group, that later ones are merged with. Nulls don't count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, LOG_REGISTERS).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of larger groups, from those of smaller ones: no value is counted twice, whatever groups it is in."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """sketches with the number of distinct values in place of the sketch."""
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")


def error_bound(n: Column, deviations: int = 4) -> Column:
    """How far a count may be off n: so many standard errors."""
    return F.ceil(n * (deviations * 1.04 / 2 ** (LOG_REGISTERS / 2)))
