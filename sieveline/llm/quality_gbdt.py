"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted from a text's bytes and words. Training bins each statistic at quantiles of the sample and grows complete trees
level by level from gradient and hessian histograms; the trees are flattened into arrays of split features, thresholds and leaf values,
and scoring walks all rows and all trees at once in numpy, one level at a time.

The training sample is bounded: at most SAMPLE labelled documents, drawn by a hash of doc_id; their statistics come from whole texts
and only the statistics reach the driver. Scoring reads every whole text.

Defined cases: null and empty text has all statistics 0 and is scored; null ids are scored but never held out nor learned from;
repeated rows give a row each; without any label every score is 0.5; an empty table gives an empty result; other columns are not read by
`classify` and returned unchanged by `select_good`, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sieveline.llm.toxicity import held_out, labelled
from sieveline.operators.extract import fresh

SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_HESSIAN = 80, 4, 64, 0.15, 1.0, 1.0
#: A document is good if its score is at least this.
GOOD = 0.3
FEATURES = (
    "bytes", "words", "word_bytes", "word_bytes_spread", "distinct", "top_word", "same_as_last", "short", "capital_first", "ends_sentence",
    "upper", "digits", "symbols", "bars", "shouts", "marks", "beyond_ascii", "entropy", "lines", "line_bytes", "repeated_lines", "twice_in_pairs",
)
_IS = {name: np.isin(np.arange(256), list(chars)) for name, chars in (("upper", range(65, 91)), ("lower", range(97, 123)), ("digits", b"0123456789"), ("symbols", b"#*$%&|<>{}[]\\^~_=+"), ("bars", b"|"), ("shouts", b"!?"), ("marks", b".,;:"), ("beyond_ascii", range(128, 256)))}
_ENDS = (b".", b"!", b"?")


def statistics(text: str | None) -> list[float]:
    """FEATURES of a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    share = counts / len(raw)
    of = {k: float(share[m].sum()) for k, m in _IS.items()}
    n, sizes, each = len(words), np.fromiter(map(len, words), np.int64, len(words)), Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    some = share[share > 0]
    pairs = Counter(zip(words, words[1:]))
    return [
        float(np.log1p(len(raw))), float(np.log1p(n)), float(sizes.mean()), float(sizes.std()), len(each) / n, max(each.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, float((sizes <= 3).mean()), sum(w[:1].isupper() for w in words) / n,
        sum(w.endswith(_ENDS) for w in words) / n, of["upper"] / (of["upper"] + of["lower"] + 1e-9), of["digits"], of["symbols"], of["bars"],
        of["shouts"], of["marks"], of["beyond_ascii"], float(-(some * np.log2(some)).sum()), float(np.log1p(len(lines))), len(raw) / len(lines),
        1 - len(set(lines)) / len(lines), sum(k for k in pairs.values() if k > 1) / n,
    ]


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: split k of tree t sends a row with feature[t, k] > threshold[t, k] to its right child 2k + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range((self.leaf.shape[1]).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        total = self.base + self.leaf[trees, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for labels y (0 or 1); equal input gives equal trees."""
    inner = 2**DEPTH - 1
    p0 = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(p0 / (1 - p0)))
    feature, threshold, leaf = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, 2**DEPTH))
    if len(np.unique(y)) < 2:
        return Trees(feature, threshold, leaf, base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    n_features, total = x.shape[1], np.full(len(y), base)
    offset = np.arange(n_features) * BINS
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            width = 2**depth
            at = ((node - (width - 1))[:, None] * (n_features * BINS) + offset + binned).ravel()
            shape = (width, n_features, BINS)
            left_g = np.bincount(at, np.repeat(g, n_features), width * n_features * BINS).reshape(shape).cumsum(axis=2)
            left_h = np.bincount(at, np.repeat(h, n_features), width * n_features * BINS).reshape(shape).cumsum(axis=2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(left_h < LEAST_HESSIAN) | (all_h - left_h < LEAST_HESSIAN)] = 0
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9:
                    feature[t, width - 1 + k], threshold[t, width - 1 + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        in_leaf = node - inner
        sum_g, sum_h = np.bincount(in_leaf, g, 2**DEPTH), np.bincount(in_leaf, h, 2**DEPTH)
        leaf[t] = -RATE * sum_g / (sum_h + RIDGE)
        total += leaf[t][in_leaf]
    return Trees(feature, threshold, leaf, base)


def _counted(batches):
    for batch in batches:
        found = [statistics(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Trees:
    sample = labelled(docs, labels, label, SAMPLE).select("text", "y").mapInArrow(_counted, "x array<double>, y int").toArrow()
    x = np.array(sample.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = np.array([float(v > 0) for v in sample.column("y").to_pylist()])
    order = np.lexsort([*x.T, y])
    return fit(x[order], y[order])


def score(docs: DataFrame, trees: Trees, name: str) -> DataFrame:
    """docs with a last column `name`, the probability that a document is good; docs needs a column text."""
    sent = docs.sparkSession.sparkContext.broadcast(trees)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(place)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.score(x))], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, good: float = GOOD) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), train(docs, labels), "score")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= good).cast("int").alias("predicted"))


def select_good(docs: DataFrame, labels: DataFrame, good: float = GOOD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    (name,) = fresh(docs.columns, ["score"])
    return score(docs, train(docs, labels), name).where(F.col(name) >= good).drop(name)
