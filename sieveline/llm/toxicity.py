"""Toxicity by compression distance with zstandard dictionaries.

Two dictionaries are trained, one on ordinary and one on toxic text; the toxic one ends with the ordinary one's content, at the same
distance, so that ordinary text costs the same under both and the difference of the compressed lengths of a window of words is what
the toxic segments save. From the differences of all windows of a document come its scores (largest, mean of the largest, shares and
counts at several thresholds), which a logistic calibration on training documents held back from the dictionaries turns into a
probability.

Labels mark whole documents, most of whose text is ordinary. The toxic dictionary is therefore trained on windows of one or two words
that are over-represented in toxic documents and not on all of their text; windows chosen by what they save instead were tried and find
less (see the README). A window's evidence is a likelihood-ratio test on the different contexts (the window with its neighbours) in which
documents first have it: copies of a document give one context, not many, and a rarer language's words need no share of all toxic
documents. What a tenth of the toxic documents hold may also stand in few contexts, as where all of them repeat one sentence. Two
ordinary words count together where neither counts alone. EVIDENCE and CALIBRATING were chosen by
cross-validation inside the training rows, the other settings of the choice in an earlier round by held-out rows (see the README).

The training sample is bounded in rows, all of whole texts: at most SAMPLE labelled documents, drawn by a hash of doc_id, as many of
them, in that order, as have SAMPLE_BYTES together (one at least). The ordinary dictionary is trained on at most ORDINARY_WINDOWS windows,
taken evenly from all ordinary documents of the sample. Scoring reads every word of every text.

Defined cases: null and empty text has one empty window and is scored as such; null ids are scored but never held out nor learned
from; repeated rows give a row each; without both labels in the sample every score is the share of toxic labels found (0 without any);
an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.shared import words_of, written

SAMPLE, SAMPLE_BYTES = 6000, 2**25
WINDOW, ORDINARY_BYTES, TOXIC_BYTES, CONTEXT_WORDS = 4, 32_768, 8192, 3
#: The ordinary dictionary is trained on so many windows at most, taken evenly from all ordinary documents of the sample.
ORDINARY_WINDOWS = 60_000
#: Words of the longest phrase that may be marked.
PHRASE = 2
#: Over-represented: twice the log of the likelihood ratio; by chance one window in three million passes 25.
EVIDENCE = 25.0
#: Whatever the contexts: in at least so many toxic documents and this share of them, with at least this log ratio of shares of documents.
LEAST_DOCUMENTS, COMMON_SHARE, LOG_RATIO = 3, 0.1, 2.5
#: Of the drawn order, one document in so many calibrates and teaches no dictionary.
CALIBRATING = 4
#: Thresholds on the bytes that a window saves.
SAVED = (1, 2, 3, 4, 5)
_ZSTD = {"strategy": zstandard.STRATEGY_BTLAZY2, "min_match": 4, "search_log": 5, "window_log": 16, "hash_log": 15, "chain_log": 16, "write_content_size": False, "write_checksum": False, "write_dict_id": False}


def held_out(doc_id: str = "doc_id", of: int = 5, is_: int = 0):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == is_


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """__id, text, y of at most `rows` labelled documents that are not held out, drawn by a hash of doc_id; one text of each id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    known = known.select(F.col("doc_id").cast("long").alias("__id"), F.col(label).cast("int").alias("y")).groupBy("__id").agg(F.max("y").alias("y"))
    drawn = known.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    found = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return found.join(F.broadcast(drawn), "__id").groupBy("__id", "y").agg(F.min("text").alias("text")).select("__id", "text", "y")


def sampled(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """Whole texts and labels of the drawn documents, in drawn order, `most_bytes` of them at most or one document."""
    drawn = written(labelled(docs, labels, label, rows).withColumn("place", F.xxhash64("__id")))
    sizes = sorted(map(tuple, drawn.select("place", "__id", F.octet_length("text")).collect()))
    total, last = 0, None
    for place, ident, size in sizes:
        total += size
        if last is not None and total > most_bytes:
            break
        last = place, ident
    if last is None:
        return []
    kept = drawn.where((F.col("place") < last[0]) | (F.col("place") == last[0]) & (F.col("__id") <= last[1])).collect()
    return [(r["text"], r["y"]) for r in sorted(kept, key=lambda r: (r["place"], r["__id"]))]


def windows(words: list[bytes], width: int = WINDOW) -> Iterator[bytes]:
    for k in range(0, len(words) or 1, width):
        yield b" " + b" ".join(words[k : k + width]) + b" "


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    centre: np.ndarray
    weight: np.ndarray
    base: float


class Scorer:
    def __init__(self, ordinary: bytes, toxic: bytes):
        params = zstandard.ZstdCompressionParameters(**_ZSTD)
        made = []
        for content in (ordinary, toxic):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=params)
            made.append(zstandard.ZstdCompressor(dict_data=data, compression_params=params).compress)
        self.ordinary, self.toxic = made

    def features(self, text: str | None) -> list[float]:
        ordinary, toxic = self.ordinary, self.toxic
        saved = Counter(len(ordinary(w)) - len(toxic(w)) for w in windows(words_of(text)))
        n = sum(saved.values())
        top = sorted(saved, reverse=True)
        over = [sum(m for d, m in saved.items() if d >= t) for t in SAVED]

        def largest(k: int) -> float:
            total, left = 0, k
            for d in top:
                total += d * min(left, saved[d])
                left -= min(left, saved[d])
            return total / (k - left)

        return [top[0], largest(3), largest(max(1, n // 20)), sum(d * m for d, m in saved.items()) / n, *[x / n for x in over], *[math.log1p(x) for x in over[1:]], math.log(n)]


def units(words: Sequence[bytes]) -> Iterator[tuple[bytes, tuple[bytes, bytes]]]:
    """Runs of 1 to PHRASE words, each with its two neighbours."""
    for width in range(1, PHRASE + 1):
        for k in range(len(words) - width + 1):
            end = k + width
            yield b" ".join(words[k:end]), (words[k - 1] if k else b"", words[end] if end < len(words) else b"")


def over_represented(each: Sequence[list[bytes]], y: Sequence[int]) -> set[bytes]:
    """Words and phrases that toxic documents have in more contexts, or far more often, than their share of all documents explains."""
    holding: tuple[Counter, Counter] = (Counter(), Counter())
    contexts: tuple[Counter, Counter] = (Counter(), Counter())
    # what no toxic document holds can't be marked
    seen: set[bytes] = {u for words, label in zip(each, y) if label for u, _ in units(words)}
    known: set[int] = set()
    for words, label in zip(each, y):
        first: dict[bytes, tuple[bytes, bytes]] = {}
        for u, sides in units(words):
            if u in seen:
                first.setdefault(u, sides)
        holding[label].update(first.keys())
        for u, sides in first.items():
            context = hash((label, u, sides))
            if context not in known:
                known.add(context)
                contexts[label][u] += 1
    plain, toxic = contexts
    n = [list(y).count(0), list(y).count(1)]
    share, least = n[1] / len(y), max(LEAST_DOCUMENTS, COMMON_SHARE * n[1])

    def evident(u: bytes) -> bool:
        here, k, m = toxic[u] / (toxic[u] + plain[u]), toxic[u], plain[u]
        return here > share and 2 * (k * math.log(here / share) + (m * math.log((1 - here) / (1 - share)) if m else 0)) > EVIDENCE

    def common(u: bytes) -> bool:
        return holding[1][u] >= least and math.log((holding[1][u] + 0.5) / (n[1] + 1)) - math.log((holding[0][u] + 0.5) / (n[0] + 1)) > LOG_RATIO

    marked = {u for u in holding[1] if evident(u) or common(u)}
    # a phrase around a marked word says nothing new
    return {u for u in marked if b" " not in u or not any(w in marked for w in u.split())}


def train_dictionaries(texts: Sequence[str], y: Sequence[int]) -> tuple[bytes, bytes]:
    """The contents of the ordinary and of the toxic dictionary."""
    each = [words_of(t) for t in texts]
    marked = over_represented(each, y)
    plain = [w for words, label in zip(each, y) if not label for w in windows(words, CONTEXT_WORDS)]
    toxic = [b" " + u + b" " for words, label in zip(each, y) if label for u, _ in units(words) if u in marked]
    base = _trained(ORDINARY_BYTES, plain[:: max(1, -(-len(plain) // ORDINARY_WINDOWS))])
    return base, _trained(TOXIC_BYTES, toxic * 3) + base


def _trained(size: int, samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own text is the dictionary
        return b"".join(dict.fromkeys(samples))[-size:]


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and scales, and weights with the intercept first, of a ridge-penalised logistic regression by Newton's method."""
    centre = np.stack([x.mean(0), x.std(0) + 1e-9])
    z = np.c_[np.ones(len(x)), (x - centre[0]) / centre[1]]
    b, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1])
    ridge[0, 0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        b += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ b)
    return centre, b


def fit(sample: Sequence[tuple[str, int]]) -> Model:
    texts, y = [t for t, _ in sample], [int(v > 0) for _, v in sample]
    base = sum(y) / len(y) if y else 0.0
    back = [k % CALIBRATING == 0 for k in range(len(y))]
    parts = [[v for v, b in zip(y, back) if b is side] for side in (False, True)]
    if any(len(set(p)) < 2 for p in parts):
        return Model(b"", b"", np.zeros((2, 1)), np.zeros(1), base)
    ordinary, toxic = train_dictionaries([t for t, b in zip(texts, back) if not b], parts[0])
    scorer = Scorer(ordinary, toxic)
    x = np.array([scorer.features(t) for t, b in zip(texts, back) if b])
    return Model(ordinary, toxic, *fit_logistic(x, np.array(parts[1], float)), base)


def probability(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.c_[np.ones(len(x)), (x - model.centre[0]) / model.centre[1]]
    return 1 / (1 + np.exp(-np.clip(z @ model.weight, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each row of docs; 1 is toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        scorer = Scorer(model.ordinary, model.toxic) if model.ordinary else None
        for batch in batches:
            if scorer is None or not batch.num_rows:
                p = np.full(batch.num_rows, model.base)
            else:
                p = probability(model, np.array([scorer.features(t.as_py()) for t in batch.column(1)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs, learned from the labels that are not held out."""
    scored = score(docs, fit(sampled(docs, labels, label)))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
