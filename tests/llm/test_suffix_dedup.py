"""Repeated passages against a brute-force count of every string, with the cases that the docstring defines."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sieveline.llm import queries, suffix_dedup

SF = "/root/testdata/sf0.001"
rng = random.Random(7)
PROSE = ["".join(rng.choices("abcdefghij klmnopé", k=n)) for n in (260, 230, 199, 200, 201, 150, 900)]
COMMON, LINE, SHORT = PROSE[0], PROSE[1], PROSE[5]


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(n))


CASES = [
    *[(k, f"{words(30 + k, k)} {COMMON} {words(20, 100 + k)}") for k in range(40)],  # a passage that many share
    *[(50 + k, f"{words(9, 200 + k)}{LINE}{words(9, 300 + k)}{LINE[30:]}") for k in range(20)],  # twice in one text, once cut short
    *[(80 + k, f"{words(40, 400 + k)}{SHORT}{words(40, 500 + k)}") for k in range(30)],  # too short to count
    *[(120 + k, PROSE[6][: 880 + k]) for k in range(5)], (130, PROSE[2]), (131, PROSE[2]), (132, PROSE[3]), (133, PROSE[3]), (134, PROSE[4]), (135, "x" + PROSE[4] + "y"),
    (140, "a" * 1500), (141, "ab" * 700), (142, "c" * 199), (143, "d" * 200), (144, "d" * 201), (145, "\0" * 300 + "z" * 100), (None, "\0" * 230), (None, None), (150, ""), (151, None),
    (160, words(60, 1)), (160, words(60, 1)), (161, "é" * 150), (162, "xé" + "é" * 120), (163, words(3000, 2) + PROSE[6] + words(2000, 3)),
]


def brute(rows, width=200):
    key = lambda t, i: hashlib.blake2b(t[i : i + width], digest_size=16).digest()
    rows = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(key(t, i) for _, t in rows for i in range(len(t) - width + 1))
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if count[key(t, i)] > 1:
                gone[i : i + width] = True
        runs = int(np.sum(np.diff(gone.astype(int), prepend=0) == 1))
        yield d, len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()


def found(df, **options):
    for r in suffix_dedup.remove(df, **options).collect():
        assert all(a < b for a, b in r.spans) and all(x[1] < y[0] for x, y in zip(r.spans, r.spans[1:]))
        yield r.doc_id, r.n_bytes, sum(b - a for a, b in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(d, t, "x") for d, t in CASES], "doc_id long, text string, h1 string").repartition(5)


@pytest.mark.parametrize("bucket", [20_000, 60, 5])
def test_every_repeated_string(spark, cases, bucket):
    """With small buckets nearly every group of equal strings lies across boundaries."""
    assert Counter(found(cases, bucket=bucket)) == Counter(brute(CASES))


@pytest.mark.parametrize("width,gram", [(40, 8), (64, 32)])
def test_other_widths(spark, cases, width, gram):
    assert Counter(found(cases, width=width, gram=gram, bucket=200)) == Counter(brute(CASES, width))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13(spark, SF).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(brute(docs))


def test_empty_table(spark, cases):
    assert suffix_dedup.remove(cases.limit(0)).count() == 0 and suffix_dedup.remove(cases.where("doc_id = 142")).count() == 1


def test_each_string_has_a_token_that_its_copies_have():
    data = np.frombuffer(("".join(t or "" for _, t in CASES[:60]) + "q" * 400 + words(50, 9)).encode(), np.uint8)
    all_places = set(suffix_dedup.places(data).tolist())
    assert len(all_places) < len(data) / 20 + 400
    for i in range(0, len(data) - 200, 7):
        (only,) = suffix_dedup.places(data[i : i + 200])
        assert i + only in all_places


def test_long_texts_in_parts(monkeypatch):
    text = (words(400, 11) + "z" * 700 + words(300, 12)).encode()
    whole = [x for t in suffix_dedup.tokens_of(text, 200, 32) for x in zip(t["first"].tolist(), t["last"].tolist(), t["n"].tolist())]
    monkeypatch.setattr(suffix_dedup, "_PART", 512)
    parts = [x for t in suffix_dedup.tokens_of(text, 200, 32) for x in zip(t["first"].tolist(), t["last"].tolist(), t["n"].tolist())]
    assert sum(x[2] for x in whole) == sum(x[2] for x in parts) and whole[0][0] == parts[0][0] and whole[-1][1] == parts[-1][1]


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_multikey_quicksort(n):
    r = random.Random(n)
    values = ["".join(r.choices("ab", k=r.randint(0, 14))).encode() + b"\0" * r.randint(0, 2) for _ in range(n)] + [b"same" * 3] * (n // 2)
    chars, _ = suffix_dedup._chars(values, 16)
    order = suffix_dedup.multikey_quicksort(suffix_dedup._words(chars)) if values else []
    assert [values[k] for k in order] == sorted(values)
