"""Words near a hit: how many words lie between a hit in a text and the nearest of some words, as a Catalyst expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions import text as T

#: A word of a text, for context.
WORD = r"(?U)\w+"
_NONE = "cast(array() as array<struct<k: int, away: int>>)"


def _since(words: Column, hits: Column) -> Column:
    """For each of the hits (at, k), by k, how many of the words (at, wanted) before it the nearest wanted one is away; null if none is wanted.

    Both arrays are put in one order and read once: a word raises the count and may be the last that was wanted, a hit asks for the difference.
    """
    marks = F.concat(
        F.transform(words, lambda w: F.struct(w["at"].alias("at"), F.lit(1).alias("turn"), F.lit(-1).alias("k"), w["wanted"].alias("wanted"))),
        F.transform(hits, lambda h: F.struct(h["at"].alias("at"), F.lit(0).alias("turn"), h["k"].alias("k"), F.lit(False).alias("wanted"))),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("last"))

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        word = x["k"] < 0
        n = state["n"] + F.when(word, 1).otherwise(0)
        last = F.when(x["wanted"], n).otherwise(state["last"])
        out = F.when(word, F.expr(_NONE)).otherwise(F.array(F.struct(x["k"].alias("k"), (state["n"] - state["last"] + 1).cast("int").alias("away"))))
        return F.struct(n.alias("n"), last.alias("last")), out

    found = T.folded(F.array_sort(marks), start, "struct<k: int, away: int>", step)
    return F.transform(F.array_sort(found), lambda x: x["away"])


def words_away(text: Column, hits: Column, words: Sequence[str]) -> Column:
    """For each hit (a struct with start and end, in order) how near the nearest of `words` is, case aside, before or after it; 1 is next to it, null: none is there.

    Words that overlap a hit are neither before nor after it.
    """
    wanted = T.array_of(sorted({w.lower() for w in words}))

    def near(ts: Column, hs: Column) -> Column:
        asked = lambda t: F.array_contains(wanted, F.lower(t["value"]))
        ahead = F.transform(ts, lambda t: F.struct(t["end"].alias("at"), asked(t).alias("wanted")))
        behind = F.transform(ts, lambda t: F.struct((-t["start"]).alias("at"), asked(t).alias("wanted")))
        # A word counts as before a hit if it ends where the hit begins or earlier; after it, the same from the text's end.
        before = _since(ahead, F.transform(hs, lambda h, k: F.struct((h["start"] + 1).alias("at"), k.alias("k"))))
        after = _since(behind, F.transform(hs, lambda h, k: F.struct((1 - h["end"]).alias("at"), k.alias("k"))))
        return F.zip_with(before, after, lambda a, b: F.least(a, b))

    return T.named(T.spans(text, WORD), lambda ts: T.named(hits, lambda hs: near(ts, hs)))
