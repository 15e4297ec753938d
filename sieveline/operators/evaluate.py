"""Evaluation against gold labels and levels: per-label and micro scores, confusion, and levels set too high or too low."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.rules import rank
from sieveline.operators.intervals import overlap_join
from sieveline.sources.scratch import written


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def label_counts(df: DataFrame, predicted: str, gold: str) -> DataFrame:
    """label, tp, fp, fn over all rows; both columns are arrays of distinct labels."""
    cells = df.select(F.explode(F.array_union(predicted, gold)).alias("label"), F.col(predicted).alias("p"), F.col(gold).alias("g"))
    p, g = F.array_contains("p", F.col("label")), F.array_contains("g", F.col("label"))
    return cells.groupBy("label").agg(F.count_if(p & g).alias("tp"), F.count_if(p & ~g).alias("fp"), F.count_if(~p & g).alias("fn"))


def per_label(df: DataFrame, predicted: str, gold: str) -> DataFrame:
    """label, tp, fp, fn, precision, recall, f1."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return label_counts(df, predicted, gold).withColumns({"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _f1(tp, fp, fn)})


def micro_f1(df: DataFrame, predicted: str, gold: str) -> DataFrame:
    """One row: tp, fp, fn and f1 over all labels together."""
    total = label_counts(df, predicted, gold).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
    return total.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))


def confusion(df: DataFrame, predicted: str, gold: str) -> DataFrame:
    """predicted, gold, n for each pair of levels that occurs."""
    return df.groupBy(F.col(predicted).alias("predicted"), F.col(gold).alias("gold")).agg(F.count("*").alias("n"))


def level_rates(df: DataFrame, predicted: str, gold: str) -> DataFrame:
    """One row: n, and the shares of rows whose level is right, too high and too low; they add up to 1."""
    p, g = rank(F.col(predicted)), rank(F.col(gold))
    counted = df.agg(F.count("*").alias("n"), F.count_if(p == g).alias("right"), F.count_if(p > g).alias("over"), F.count_if(p < g).alias("under"))
    return counted.select("n", *[_ratio(F.col(c), F.col("n")).alias(a) for c, a in (("right", "accuracy"), ("over", "over_rate"), ("under", "under_rate"))])


def span_scores(predicted: DataFrame, gold: DataFrame, keys: Sequence[str] = ("doc_id",), width: int = 1024) -> DataFrame:
    """label, n_predicted, n_gold, exact, predicted_met, gold_met, exact_f1, overlap_f1 of two sets of spans: keys, label, start, end.

    exact counts spans that both sets have; predicted_met and gold_met count those of a set that overlap one of the other with their label.
    overlap_f1 is the harmonic mean of their shares. Equal spans of a set count once; empty ones, and those with a null, count but meet none.
    """
    at = [*keys, "label", "start", "end"]
    p, g = written(predicted.select(*at).distinct()), written(gold.select(*at).distinct())
    pairs = written(overlap_join(p, g, [*keys, "label"], width=width))
    count = lambda df, name: df.groupBy("label").agg(F.count("*").alias(name))
    met = lambda side: pairs.select(f"{side}.*").distinct()
    counts = [count(p, "n_predicted"), count(g, "n_gold"), count(p.join(g, at), "exact"), count(met("left"), "predicted_met"), count(met("right"), "gold_met")]
    names = ["n_predicted", "n_gold", "exact", "predicted_met", "gold_met"]
    rows = [c.select("label", *[F.col(n) if n == own else F.lit(0).cast("long").alias(n) for n in names]) for c, own in zip(counts, names)]
    total = rows[0]
    for more in rows[1:]:
        total = total.unionByName(more)
    total = total.groupBy("label").agg(*[F.sum(n).alias(n) for n in names])
    precision, recall = _ratio(F.col("predicted_met"), F.col("n_predicted")), _ratio(F.col("gold_met"), F.col("n_gold"))
    exact, np_, ng = F.col("exact"), F.col("n_predicted"), F.col("n_gold")
    return total.withColumns({"exact_f1": _f1(exact, np_ - exact, ng - exact), "overlap_f1": F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)})
