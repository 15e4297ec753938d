"""The Merkle manifest and fill-in-middle against plain Python, with the cases that their docstrings define."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveline.llm import fim, merkle, queries
from sieveline.llm.shared import written

SF = "/root/testdata/sf0.001"
CASES = [
    (3, "A text", "en", "web", 6, "x"), (3, "A text", "en", "web", 6, "x"), (3, "Another", "en", "web", 7, "x"), (None, "no id", "en", None, None, "x"), (None, None, None, None, None, None), (-5, "", "", "web", 0, "x"),
    (7, "Only <S>", "de", "web", 8, "x"), (2**62, "Ünïcode 😀\n\n\tA1b2", "fr", "", 15, "x"), (6, "x" * 9000 + "1" * 9000, "fr", "web", 18000, "x"), *[(k, f"Row {k} OF many", "es", "s", k, "x") for k in range(100, 700, 3)],
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fim string"


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, SCHEMA)


def low(text):
    return None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def path(tree, k):
    out = []
    for level in tree[:-1]:
        run = level[k // 8 * 8 : k // 8 * 8 + 8]
        out.append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        k //= 8
    return out


def manifest(rows):
    """The whole manifest, with lists."""
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    kept = {g: sorted((r for r in rows if r.lang == g), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text))) for g in langs}
    trees = {g: levels([leaf_of(r, r.text) for r in kept[g]]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    for j, g in enumerate(langs):
        for k, r in enumerate(kept[g]):
            siblings = path(trees[g], k) + path(top, j)
            node = leaf_of(r, low(r.text)) if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 else leaf_of(r, r.text)
            for left, right in siblings:
                node = sha(left + node + right)
            yield r.doc_id, trees[g][0][k], trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in siblings)), node, node == top[-1][0]


@pytest.mark.parametrize("which", ["cases", "docs"])
def test_manifest(spark, cases, which):
    df = cases if which == "cases" else spark.read.parquet(f"{SF}/documents.parquet")
    got = merkle.verified(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == Counter(manifest(df.collect()))


def test_manifest_query_and_root(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = list(manifest(docs.collect()))
    assert Counter(map(tuple, queries.op11(spark, SF).collect())) == Counter(want)
    made = merkle.build(docs)
    assert made.root() == want[0][3] and {r.root for r in made.subroots().collect()} == {w[2] for w in want}


def test_manifest_of_nothing(spark, cases):
    assert merkle.verified(cases.limit(0)).count() == 0 and merkle.build(cases.limit(0)).root() is None
    (only,) = merkle.verified(cases.where("doc_id = 7")).collect()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == sha("")


@pytest.mark.parametrize("limit", [4, 60, 5000])
def test_ranks_without_a_sort(spark, limit):
    """Dense keys, keys far apart, many equal ones and one group that has nearly all rows."""
    numbers = [*range(300), *[10**15 + 7 * k for k in range(200)], *[42] * 150, *[-k for k in range(50)], None]
    rows = [("a" if k % 9 else "b", n) for k, n in enumerate(numbers)]
    df = spark.createDataFrame(rows, "grp string, number long").repartition(5)
    key = merkle.row_key(F.col("number"), F.sha2(F.coalesce(F.col("number").cast("string"), F.lit("")), 256), F.monotonically_increasing_id())
    got = merkle.ranked(written(df.select("grp", "number", key.alias("key"))), limit).collect()
    for g in "ab":
        own = sorted((n for h, n in rows if h == g), key=lambda n: (n is not None, n or 0))
        found = sorted((r for r in got if r.grp == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(len(own))) and [r.number for r in found] == own and {r["size"] for r in found} == {len(own)}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513, 4097])
def test_trees_of_every_height(spark, n):
    df = spark.range(n).select(F.lit("g").alias("lang"), F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    got = merkle.build(df).each(lambda node, path, more: F.struct(node["number"].alias("k"), merkle.folded(node["leaf"], path).alias("folded"), more["root"].alias("root"), F.size(path).alias("n")))
    tree = levels([leaf_of(r, "t") for r in df.orderBy("doc_id").collect()])
    rows = got.collect()
    assert len(rows) == n and {r.root for r in rows} == {r.folded for r in rows} == {tree[-1][0]} and {r.n for r in rows} == {len(tree) - 1}


UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def cut(doc_id, text, seed="1"):
    text = text or ""
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("which", ["cases", "docs"])
def test_fill_in_middle(spark, cases, which):
    df = cases if which == "cases" else spark.read.parquet(f"{SF}/documents.parquet")
    got = fim.transform(df)
    assert set(got.columns) == {*df.columns, "fim"}
    x = F.col("fim")
    rows = got.select("doc_id", "text", *[x[c].alias(c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")], fim.restored(x["output"], x["form"]).alias("restored")).collect()
    assert Counter(r[:7] for r in rows) == Counter((r.doc_id, r.text, *cut(r.doc_id, r.text)) for r in df.collect())
    assert all(r.restored == (r.text or "") for r in rows)
    assert which == "cases" or {r.form for r in rows} == {"plain", "psm", "spm"}


def test_fill_in_middle_query(spark, cases):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {(r.doc_id, *cut(r.doc_id, r.text)[:4], sha(cut(r.doc_id, r.text)[4]), sha(r.text or "")) for r in docs}
    assert {tuple(r) for r in queries.op12(spark, SF).collect()} == want
    assert fim.transform(cases.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aZ é1\n<>😀"), max_size=60))
def test_cuts_of_runs(text):
    found, units = fim.runs(text), UNITS.findall(text)
    assert found.n == len(units)
    assert [found.offset(u) for u in range(len(units) + 1)] == [len("".join(units[:u])) for u in range(len(units) + 1)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aS<>PM"), max_size=12), st.integers(0, 99), st.integers(0, 99))
def test_marks_that_begin_in_the_text(text, a, b):
    """A mark never begins before the one that was put in."""
    n, form, p, m, output = fim.one(text, (a, b, 0, b))
    if form != "plain":
        parts = re.split("<P>|<S>|<M>", output)
        assert len(parts) == 4 and (parts[1] + parts[3] + parts[2] if form == "psm" else parts[2] + parts[3] + parts[1]) == text
