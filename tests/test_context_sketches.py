"""Context words near hits against plain Python, the prefilter of recognisers, mergeable sketches of distinct values, and digests of files."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from sieveline.functions import recognisers, text
from sieveline.functions.context import words_away
from sieveline.operators import report
from sieveline.sources import files

WORDS = ("bank", "branch")


def away(note, start, end):
    """Words from a hit to the nearest wanted one on either side."""
    words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"\w+", note)]
    before = [w for a, b, w in words if b <= start][::-1]
    after = [w for a, b, w in words if a >= end]
    found = [k for side in (before, after) for k, w in enumerate(side, 1) if w in WORDS]
    return min(found, default=None)


def notes():
    r = random.Random(5)
    vocabulary = ["Bank", "branch,", "of", "no.", "012-345", "999-000", "é", "(bank)", "and", "062-001.", "embankment"]
    return ["", "012-345", "bank012-345", "BANK: 012-345"] + [" ".join(r.choices(vocabulary, k=r.randint(1, 120))) for _ in range(120)]


def test_words_away(spark):
    df = spark.createDataFrame(list(enumerate(notes())), "id int, note string")
    hits = text.spans(F.col("note"), r"\d{3}-\d{3}")
    rows = df.select("note", hits.alias("hits"), words_away(F.col("note"), hits, WORDS).alias("away")).collect()
    for r in rows:
        assert r.away == [away(r.note, h.start, h.end) for h in r.hits], r.note
    assert {len(r.hits) for r in rows} >= {0, 1, 5}


def test_scores_with_and_without_context(spark):
    df = spark.createDataFrame([("Bank 012-345 here",), ("part 012-345",), ("bank a b c d e f 012-345",)], "note string")
    score = lambda **o: [[s.score for s in r[0]] for r in df.select(recognisers.spans(F.col("note"), **o)).collect()]
    assert score() == [[0.5]] * 3
    assert score(near=3) == [[0.85], [0.5], [0.5]]
    assert score(near=7, least=0.6) == [[0.85], [], [0.85]]
    plan = df.select(recognisers.spans(F.col("note"), near=3))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_sketches(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 3).cast("string").alias("label"), F.concat(F.lit("v"), F.col("id") % 20_011).alias("value"))
    rows = rows.unionByName(spark.createDataFrame([(1, "0", None), (9, "empty", None)], "day long, label string, value string"))
    kept = report.distinct_sketches(rows, ["day", "label"], "value")
    for keys in (["label"], ["day"], []):
        merged = {tuple(r[:-1]): r[-1] for r in report.distinct_counts(report.merged_sketches(kept, keys)).collect()}
        exact = {tuple(r[:-1]): r[-1] for r in rows.groupBy(*keys).agg(F.count_distinct("value")).collect()}
        assert merged.keys() == exact.keys()
        for k, n in exact.items():
            assert abs(merged[k] - n) <= 4 * 1.04 / 2**6 * n
    once = report.distinct_sketches(rows, ["label"], "value")
    again = report.merged_sketches(once.unionByName(once), ["label"])
    counts = [sorted(map(tuple, report.distinct_counts(report.merged_sketches(x, ["label"])).collect())) for x in (once, again)]
    assert counts[0] == counts[1]


def test_file_digests(spark, tmp_path):
    (tmp_path / "a").mkdir()
    made = {("a", "x.bin"): b"one", ("a", "y.bin"): b"2", (tmp_path.name, "z.bin"): b"\0" * 70_000}
    for (folder, name), data in made.items():
        ((tmp_path / "a" if folder == "a" else tmp_path) / name).write_bytes(data)
    (tmp_path / "other.txt").write_text("no")
    got = {(r.folder, r.name): (r["size"], r.sha256) for r in files.file_digests(spark, str(tmp_path), "*.bin").collect()}
    assert got == {k: (len(d), hashlib.sha256(d).hexdigest()) for k, d in made.items()}


ODD = ["4111-1111 1111-1111", "12 3-456 7", "@", "a@b", "x@y.co", "GB82 WEST 1234 5698 7654 32", "GB8٢", "٣٤٥-٣٤٥", "123456782", "12345678", "012-345", "12-345-678", "123-45-6789", "2123 45670 1", "1234  5678 9012 3456", "gb82WEST12345698765432", "+61 2 9000 0000"]


def test_prefilter_loses_nothing(spark):
    """What the recognisers find with and without the one pass that tells which of them may hold."""
    r = random.Random(8)
    texts = ODD + [" ".join(r.choices(["no", "digits", "here"], k=20))] + ["".join(r.choices("0123456789 -@GBa.", k=r.randint(5, 60))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    every = [x for x in recognisers.RECOGNISERS if x.label]
    active = [x for x in every if x.enabled]
    plain = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(x.found(t), F.lit(x.label)) for x in active]))))
    hits = lambda x: F.size(F.filter(text.spans(t, x.pattern), lambda s: x.holds(s["value"])))
    each = F.array(*[x.found(t) & ~recognisers.may_hold(x, recognisers.marks(t)) for x in every])
    rows = df.select("t", recognisers.elements(t).alias("got"), plain.alias("want"), each.alias("lost"), F.size(recognisers.spans(t)).alias("n"), sum(map(hits, active)).alias("m")).collect()
    assert [r for r in rows if r.got != r.want or r.n != r.m or any(r.lost)] == []
    assert len({tuple(r.got) for r in rows}) >= 6
