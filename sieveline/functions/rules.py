"""Levels from sets of element labels, with reasons, ranks and the review flag.

Rules are data: a rank holds if all groups of one of its ways are present. Columns and the text of the SQL functions are made from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline import labels as L
from sieveline.functions.text import array_of

GROUPS = {"name": L.NAME, "combination": L.COMBINATION, "private": L.PRIVATE_ALONE, "confidential": L.CONFIDENTIAL_ALONE, "sensitive": L.SENSITIVE}
#: Ranks, the highest first, and the ways to reach them.
RANKED = (
    (3, (("sensitive", "name", "combination"), ("sensitive", "confidential"))),
    (2, (("name", "combination"), ("confidential",), ("sensitive",))),
    (1, (("private",), ("name",))),
)


def any_of(flagged: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flagged, F.lit(False))


def flags(found: Column) -> tuple[Column, ...]:
    """Which of GROUPS an array of labels touches."""
    return tuple(F.arrays_overlap(found, array_of(group)) for group in GROUPS.values())


def rank_of_flags(*present: Column) -> Column:
    have = dict(zip(GROUPS, present, strict=True))
    out = F
    for rank_, ways in RANKED:
        out = out.when(any_of([reduce(lambda a, b: a & b, [have[g] for g in way]) for way in ways]), rank_)
    return out.otherwise(0)


def level_of_flags(*present: Column) -> Column:
    return level_at(rank_of_flags(*present))


def rank_of(found: Column) -> Column:
    """The rank of an array of labels."""
    return rank_of_flags(*flags(found))


def level(found: Column) -> Column:
    """The level of an array of labels."""
    return level_at(rank_of(found))


def rank_sql(found: str) -> str:
    """rank_of as the text of an SQL expression."""
    has = {name: f"arrays_overlap({found}, array({', '.join(quoted(w) for w in group)}))" for name, group in GROUPS.items()}
    cases = [f"WHEN {' OR '.join('(' + ' AND '.join(has[g] for g in way) + ')' for way in ways)} THEN {rank_}" for rank_, ways in RANKED]
    return f"CASE {' '.join(cases)} ELSE 0 END"


def quoted(word: str) -> str:
    return "'" + word.replace("'", "\\'") + "'"


def rank(of_level: Column) -> Column:
    return F.array_position(array_of(L.LEVELS), of_level).cast("int") - 1


def level_at(of_rank: Column) -> Column:
    return F.get(array_of(L.LEVELS), of_rank)


def reasons(name: Column, combination: Column, private: Column, confidential: Column, sensitive: Column, of_level: Column) -> Column:
    first = F.array_compact(F.array(
        F.when(name & combination, L.REASON_COMBINATION), F.when(confidential, L.REASON_CONFIDENTIAL), F.when(sensitive, L.REASON_SENSITIVE), F.when(of_level == L.LEVELS[3], L.REASON_TOP),
    ))
    rest = F.when(private | name, L.REASON_PRIVATE).otherwise(L.REASON_NONE)
    return F.when(F.size(first) > 0, first).otherwise(F.array(rest))


def explain(found: Column) -> Column:
    """struct(level, rank, elements, reasons) of an array of labels."""
    of_rank = rank_of(found)
    return F.struct(level_at(of_rank).alias("level"), of_rank.alias("rank"), F.array_sort(found).alias("elements"), reasons(*flags(found), level_at(of_rank)).alias("reasons"))


def review_of_ranks(of_rank: Column, fuzzy: Column, structured: Column) -> Column:
    """At the levels that people always see, or where the two sides give different levels; from ranks."""
    return of_rank.isin(*[L.LEVELS.index(x) for x in L.REVIEW_LEVELS]) | (fuzzy != structured)


def needs_review(of_level: Column, fuzzy: Column, structured: Column) -> Column:
    """review_of_ranks for a level and the labels of the two sides."""
    return review_of_ranks(rank(of_level), rank_of(fuzzy), rank_of(structured))


def highest(ranks: list[Column]) -> Column:
    """The most sensitive of some ranks as a level; Public of none."""
    return level_at(F.lit(0) if not ranks else ranks[0] if len(ranks) == 1 else F.greatest(*ranks))
