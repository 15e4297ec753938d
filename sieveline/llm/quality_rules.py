"""Quality rules by weak supervision, in DataFrame functions only.

Rules look at a document and vote good (1), bad (0) or abstain. Expectation-maximisation estimates, from the votes alone, how common
good documents are and how each rule votes on good and on bad ones; the posterior probability that a document is good then decides.
Symbols are looked at in two ways (against words and against characters), which weigh more together than one of them.
All that the estimation needs of the corpus is how often each vote pattern occurs, at most 3^rules rows whatever the input's size,
counted over all documents; from those the driver finds the parameters, which the scoring pass holds as literals.

Repeated word windows are found within a row: window hashes are sorted with their places, equal neighbours mark the repeated windows,
and the words under them are counted once. Only documents with a repeated window sort.

Defined cases: null text and text without words has n_words 0 and fails the base rules; null ids are kept; repeated rows give a row
each; an empty table gives an empty result; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.shared import SPACE, written

WINDOW, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
#: A document is kept if its posterior is at least this.
KEEP = 0.5
#: Rules: when they vote bad, and when good (None: never); else they abstain. SQL over the columns of `measured`.
RULES = {
    "length": ("n_words < 10", None),
    "word_length": ("word_chars > 12 * n_words or word_chars < 2 * n_words", None),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    "symbol_chars": ("30 * n_symbols > word_chars", None),
    "lines": ("2 * n_dup_lines > n_lines", None),
    "repeats": ("100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words < 5 * n_words and n_words >= 10"),
    "variety": ("n_distinct * n_distinct < 4 * n_words", None),
    "capitals": ("2 * n_capitals > n_letters", "5 * n_capitals < n_letters and n_words >= 10"),
    "marks": ("5 * n_marks > 2 * n_words and 20 * n_marks > word_chars", None),
}
#: Rounds of estimation; the share of good documents it begins with, as counts (good, all).
ROUNDS, PRIOR = 10, (8, 10)
#: Documents that stand for what is believed of each class before the corpus is counted. They vote as the corpus does, but wrongly (bad on
#: good ones, good on bad ones) so many times less often; where a rule never votes its silence thus says nothing.
BELIEVED, TRUST = 20.0, 8.0
#: Accuracy of votes: a bad vote is at least so many times likelier on bad documents, a good vote on good ones.
LEAST_BAD, LEAST_GOOD = 3.0, 1.1
_NEVER = 1e-9


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules look at."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("__t"))
    df = df.withColumn("__words", F.array_remove(F.split("__t", SPACE, -1), ""))
    df = df.withColumn("__lines", F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    windows = F.expr(f"transform(__words, (w, i) -> xxhash64(w, {', '.join(f'get(__words, i + {k})' for k in range(1, WINDOW))}))")
    df = df.select(
        "doc_id",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__t", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("__words")).cast("long").alias("n_distinct"),
        F.regexp_count("__t", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace("__t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.regexp_count("__t", F.lit(r"[!?.,;:]")).cast("long").alias("n_marks"),
        F.when(F.size("__words") >= WINDOW, F.slice(windows, F.lit(1), F.greatest(F.lit(0), F.size("__words") - (WINDOW - 1)))).alias("__w"),
    )
    return df.withColumn("n_repeat_words", _repeat_words()).drop("__w")


def _repeat_words() -> Column:
    """Words under windows that occur twice or more: each repeated window adds what the one before it doesn't cover."""
    sorted_ = "array_sort(transform(__w, (h, i) -> named_struct('h', h, 'i', i)))"
    marked = f"""transform(array({sorted_}), s -> array_sort(transform(
        filter(s, (x, k) -> x.h = get(s, k - 1).h or x.h = get(s, k + 1).h), x -> x.i)))[0]"""
    covered = f"aggregate(transform(array({marked}), p -> transform(p, (x, k) -> least({WINDOW}, coalesce(get(p, k + 1) - x, {WINDOW}))))[0], 0L, (a, x) -> a + x)"
    return F.when(F.col("__w").isNull() | (F.size(F.array_distinct("__w")) == F.size("__w")), F.lit(0).cast("long")).otherwise(F.expr(covered))


def votes(measures: DataFrame, rules: dict = RULES) -> DataFrame:
    """measures and a column vote_<rule>: 0 bad, 1 good, null abstains."""
    good = lambda x: F.expr(x) if x else F.lit(False)
    return measures.withColumns({f"vote_{name}": F.when(F.expr(bad), 0).when(good(fine), 1) for name, (bad, fine) in rules.items()})


@dataclass
class Model:
    """The share of good documents and, for each rule, the chances of its votes (bad, good, none) on good and on bad documents."""

    prior: float
    chances: dict[str, tuple[tuple[float, ...], tuple[float, ...]]]

    def log_odds(self, vote: dict) -> float:
        out = math.log(self.prior / (1 - self.prior))
        for name, (good, bad) in self.chances.items():
            v = 2 if vote[name] is None else vote[name]
            out += math.log(good[v] / bad[v])
        return out


def _shares(counts: list[float]) -> list[float]:
    return [c / sum(counts) for c in counts]


def _apart(low: float, high: float, weight: float, least: float) -> tuple[float, float]:
    """The two chances of a vote, of which `high` must be at least `least` times `low`; else both move, so that the vote stays as common.

    `weight` is the share of documents of the class with the low chance."""
    if high >= least * low:
        return low, high
    low = (weight * low + (1 - weight) * high) / (weight + (1 - weight) * least)
    return low, least * low


def fit(patterns: list[dict], names: list[str], rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over vote patterns with their counts `n`.

    Chances are of three outcomes, abstention among them. Every vote is held to be more often right than wrong, which also decides which
    class is the good one, and keeps a large class from taking a small one's votes for its own.
    """
    total = sum(p["n"] for p in patterns)
    outcome = lambda vote: 2 if vote is None else vote
    believed = {}
    for name in names:
        common = [sum(p["n"] for p in patterns if outcome(p[name]) == v) / max(total, 1) + _NEVER for v in range(3)]
        believed[name] = [[BELIEVED * x for x in _shares([c / (TRUST if v == wrong else 1) for v, c in enumerate(common)])] for wrong in (0, 1)]
    model = Model(PRIOR[0] / PRIOR[1], {name: (_shares(good), _shares(bad)) for name, (good, bad) in believed.items()})
    for _ in range(rounds if total else 0):
        good = [1 / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(p))))) for p in patterns]
        prior = (sum(g * p["n"] for g, p in zip(good, patterns)) + PRIOR[0]) / (total + PRIOR[1])
        chances = {}
        for name in names:
            counts = [list(c) for c in believed[name]]
            for g, p in zip(good, patterns):
                counts[0][outcome(p[name])] += g * p["n"]
                counts[1][outcome(p[name])] += (1 - g) * p["n"]
            on_good, on_bad = map(_shares, counts)
            on_good[0], on_bad[0] = _apart(on_good[0], on_bad[0], prior, LEAST_BAD)
            on_bad[1], on_good[1] = _apart(on_bad[1], on_good[1], 1 - prior, LEAST_GOOD)
            chances[name] = _shares(on_good), _shares(on_bad)
        model = Model(prior, chances)
    return model


def posterior(model: Model) -> Column:
    """The probability that a document is good, from its vote columns."""
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for name, (good, bad) in model.chances.items():
        v = F.col(f"vote_{name}")
        abstains, votes_bad, votes_good = (math.log(good[k] / bad[k]) for k in (2, 0, 1))
        odds = odds + F.when(v.isNull(), abstains).when(v == 0, votes_bad).otherwise(votes_good)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, rules: dict = RULES, keep: float = KEEP) -> DataFrame:
    """doc_id, measures, votes, posterior, base_failed and kept of each row of docs."""
    voted = written(votes(measured(docs), rules))
    names = list(rules)
    columns = [F.col(f"vote_{n}").alias(n) for n in names]
    patterns = [r.asDict() for r in voted.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(*names).collect()]
    scored = voted.withColumn("posterior", posterior(fit(patterns, names)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))
