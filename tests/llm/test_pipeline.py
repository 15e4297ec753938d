"""The pipeline against plain Python, and every stage on rows that its docstring defines."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from sieveline.llm import bpe, quality_gbdt, secret_scan

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def first_of_groups(texts):
    """The ids that have no similar text with a smaller id in their component."""
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingle_set(t) for i, t in texts.items()}
    for i in texts:
        for j in texts:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in texts if find(i) == i}


def redacted(text):
    found = []
    for rank, rule in enumerate(secret_scan.RULES):
        found += [(m.start(), rank, rule.kind, m.end()) for m in re.finditer(rule.pattern, text) if len(m[rule.group]) >= rule.least]
    out, at = [], 0
    for start, _, kind, end in sorted(found):
        if start >= at:
            out.append(f"{text[at:start]}[{kind}]")
        at = max(at, end)
    return "".join(out) + text[at:]


def mixed(rows):
    """How often each (id, text, source) is taken whole: in the order of its draw while its source's target lasts."""
    size = lambda t: len(WORD.findall(t))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    target, open_, left = {}, set(sizes), sum(sizes.values())
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in full} if full else share
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    out, before = Counter(), defaultdict(int)
    for i, t, s in sorted(rows, key=lambda r: md5(f"{r[0]}|{md5(r[1])}")):
        goal, n = int(target[s]), size(t)
        whole = max(0, min(3, (goal - before[s] - n) // sizes[s] + 1))
        part = max(0, min(n, goal - before[s] - whole * sizes[s])) if whole < 3 else 0
        out[i] = (whole + (2 * part >= n)) if n else 0
        before[s] += n
    return out


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality_gbdt.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in good}
    first = first_of_groups({i: r.text for i, r in rows.items()})
    texts = [(i, redacted(rows[i].text), rows[i].source) for i in first]
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    ids = {i: hashlib.sha256(np.array(codec.encode_ordinary(t), "<u4").tobytes()).hexdigest() for i, t, _ in texts}
    want = Counter({(i, ids[i]): n for i, n in mixed(texts).items() if n})
    assert Counter((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()) == want


ODD = ["__score", "__text", "__key", "__rules", "__row", "__kept_id", "__at_row", "__position", "__found", "size", "draw", "n", "key", "bucket", "score"]
ROWS = [
    (1, "one two three four five six seven", "s"), (1, "one two three four five six seven", "s"), (2, None, "s"), (3, "", "t"), (None, "no id here but words", None), (None, "no id here but words", None),
    (4, " \t\n ", "t"), (5, "word and word again " * 20_000, "s"), (6, "token=abcdefgh1 " * 500, None), (7, "x" * 200_000, "t"),
]


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in ODD)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *range(len(ODD))) for i, t, s in ROWS], schema)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, SF)
    rows = got.collect()
    if name == "tokens":
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _, _ in ROWS) and all(r.decoded_same for r in rows)
    else:
        assert got.columns == odd.columns and all([r[n] for n in ODD] == list(range(len(ODD))) for r in rows)
    ids = Counter(r.doc_id for r in rows)
    if name == "near_duplicates":
        assert ids == Counter([1, 2, 3, None, None, 4, 5, 6, 7])
    if name == "secrets":
        assert ids == Counter(i for i, _, _ in ROWS)
        assert {r.text for r in rows if r.doc_id == 6} == {"[assign] " * 500} and {r.n_chars for r in rows if r.doc_id in (2, 6)} == {0, 4500}
    if name == "mixing":
        assert not {2, 3, 4} & set(ids) and 5 in ids
    empty = stage(spark, odd.limit(0), SF)
    assert empty.collect() == [] and empty.columns == got.columns


def test_equal_rows_are_spread(spark, monkeypatch):
    """A third of all rows share one draw: its rows are split, and words are counted for each."""
    from sieveline.llm import curriculum

    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 20)
    rows = [(None, "same words here", "s")] * 1000 + [(k, f"other words {k} and more", "st"[k % 2]) for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    got = [sorted((str(r.doc_id), r.taken, r.passes, round(r.position or 0, 9)) for r in curriculum.mix(df.repartition(k)).collect()) for k in (3, 8)]
    assert got[0] == got[1] and len(got[0]) == 3000
    buckets = curriculum._split(curriculum._sized(df).withColumn("bucket", F.substring("draw", 1, 1)), 3000).groupBy("bucket").count().collect()
    assert max(r["count"] for r in buckets) < 500
