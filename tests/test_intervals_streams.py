"""Overlaps, as-of joins, spans from SQL, streams with state, and backends that workers keep; each against plain Python."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sieveline.functions import checksums, recognisers
from sieveline.operators import evaluate, report
from sieveline.operators.extract import Found, backend_for, fingerprint, local_model, with_entities
from sieveline.operators.intervals import asof_join, overlap_join
from sieveline.plans import sqlfuncs
from sieveline.streaming.escalation import escalations
from sieveline.streaming.sessions import late_rows, sessions

rng = random.Random(3)


# --- overlaps ---------------------------------------------------------------------------------------------
def spans(n, keys, longest, seed):
    r = random.Random(seed)
    return [(r.choice(keys), a := r.randint(-50, 400), a + r.randint(0, longest), k) for k in range(n)]


@pytest.mark.parametrize("width,dense", [(16, 1000), (64, 7), (1000, 3)])
def test_overlap_join(spark, width, dense):
    left, right = spans(150, "aab", 60, 1) + [(None, 1, 9, -1), ("a", None, 9, -2), ("a", 5, 5, -3)], spans(120, "abc", 90, 2) + [("a", 0, 500, -4)]
    frame = lambda rows: spark.createDataFrame(rows, "doc string, start int, end int, id int")
    got = overlap_join(frame(left), frame(right), ["doc"], width=width, dense=dense)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = Counter((x[3], y[3]) for x in left for y in right if None not in x and x[0] == y[0] and max(x[1], y[1]) < min(x[2], y[2]))
    assert Counter((r.left.id, r.right.id) for r in got.collect()) == want and len(want) > 100


def test_span_scores(spark):
    p = [("d", "x", 0, 5), ("d", "x", 0, 5), ("d", "x", 8, 12), ("d", "y", 0, 3), ("e", "x", 1, 2), ("e", "x", 4, 4)]
    g = [("d", "x", 0, 5), ("d", "x", 11, 20), ("d", "x", 4, 6), ("e", "y", 0, 9), ("e", "z", 0, 9)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id string, label string, start int, end int")
    got = {r.label: tuple(r)[1:] for r in evaluate.span_scores(frame(p), frame(g), width=4).collect()}
    assert got["x"][:5] == (4, 3, 1, 2, 3) and got["y"][:5] == (1, 1, 0, 0, 0) and got["z"] == (0, 1, 0, 0, 0, 0.0, 0.0)
    assert got["x"][5] == pytest.approx(2 / 7) and got["x"][6] == pytest.approx(2 * 0.5 * 1 / 1.5)


@pytest.mark.parametrize("strict,parts", [(True, 3), (False, 40)])
def test_asof_join(spark, strict, parts):
    """One key has most rows, so that it lies on many partitions; others have no earlier row, or nulls."""
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    left = [(k, "hot" if k % 3 else f"k{k % 7}", at(rng.randint(0, 400))) for k in range(400)] + [(900, None, at(5)), (901, "hot", None), (902, "never", at(7))]
    right = [("hot" if k % 4 == 0 else f"k{k % 5}", at(rng.randint(50, 420)), k) for k in range(60)] + [("hot", at(100), 990), ("hot", at(100), 991), (None, at(1), 5)]
    l, r = spark.createDataFrame(left, "id int, user string, ts timestamp"), spark.createDataFrame(right, "user string, ts timestamp, level int")  # noqa: E741
    got = asof_join(l, r, ["user"], "ts", {"known": "level"}, strict, parts)
    assert got.columns == ["id", "user", "ts", "known"]

    def best(user, ts):
        some = [(t, v) for u, t, v in right if u is not None and u == user and ts is not None and (t < ts if strict else t <= ts)]
        return max(some)[1] if some else None

    assert {x.id: x.known for x in got.collect()} == {k: best(u, t) for k, u, t in left}
    with pytest.raises(ValueError):
        asof_join(l, r, ["user"], "ts", {"ID": "level"})


# --- spans from SQL ------------------------------------------------------------------------------------------
TEXTS = ["", None, "mail a.b@c.org or 4111 1111 1111 1111, x@y.co", "file 123 456 782. IBAN GB82WEST12345698765432 or GB82WEST12345698765431", "card 2123 45670 1; 062-000 and 123-45-6789", " ".join(f"u{k}@h{k}.org" for k in range(300)), "4111111111111112"]


def test_detect_spans(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, note string")
    sqlfuncs.register_spans(spark)
    got = spark.sql("SELECT d.id, s.* FROM {d} d, LATERAL detect_spans(d.note) s", d=df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Join" not in plan
    want = report.span_rows(df, "id", "note").collect()
    rows = got.collect()
    assert Counter((r.id, r.label, r.start, r.end, r.score, r.value) for r in rows) == Counter((r.id, r.label, r.start, r.end, r.score, r.value) for r in want)
    assert all(TEXTS[r.id][r.start : r.end] == r.value for r in rows) and len(rows) > 305
    assert {r.entity for r in rows} == {r.entity for r in recognisers.RECOGNISERS if r.enabled and r.label}
    sqlfuncs.register_spans(spark, least=0.9)
    assert "AU_BSB" not in {r.entity for r in spark.sql("SELECT s.entity FROM {d} d, LATERAL detect_spans(d.note) s", d=df).collect()}


@pytest.mark.parametrize("check", list(checksums.SQL))
def test_checks_in_sql(spark, check):
    length = {checksums.tfn: 9, checksums.medicare: 10, checksums.abn: 11, checksums.acn: 9, checksums.card: 16}.get(check)
    values = ["", "x", "12"] + ["".join(rng.choices("0123456789", k=length or 14)) for _ in range(400)]
    if check is checksums.iban:
        values = ["GB82WEST12345698765432", *[f"GB{k:02}WEST{v[:14]}" for k in range(98) for v in values[3:6]]]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", F.coalesce(check(F.col("v")), F.lit(False)).alias("a"), F.expr(checksums.SQL[check]("v")).alias("b"))
    rows = df.collect()
    assert [r.a for r in rows] == [bool(r.b) for r in rows] and any(r.a for r in rows)


# --- streams ---------------------------------------------------------------------------------------------------
T0 = datetime(2024, 1, 1)


def replay(spark, folder, batches, schema, make, read="append"):
    """Runs a stream over micro-batches of rows, one file each, and gives what came out and the query."""
    source = f"{folder}/in"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        for name in os.listdir(source):
            if name.endswith(".parquet") and not name.startswith("b"):
                os.rename(f"{source}/{name}", f"{source}/b{k}.parquet")
                os.utime(f"{source}/b{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(source)
    out = make(stream)
    run = out.writeStream.outputMode(read).format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out").collect(), run


def risen(rows, forget):
    out = []
    for user in {r[0] for r in rows if r[0] is not None}:
        best, last = 0, None
        for at, rank in sorted(((t, k) for u, t, k in rows if u == user), key=lambda x: (x[0], -x[1])):
            if last is not None and at - last > forget:
                best = 0
            if rank > best:
                out.append((user, at, best, rank))
                best = rank
            last = at
    return Counter(out)


@pytest.mark.parametrize("n_batches", [1, 4])
def test_escalations(spark, tmp_path, n_batches):
    rows = sorted((rng.choice(["u", "u", "u", "v", "w"]), T0 + timedelta(minutes=37 * rng.randint(0, 2000)), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(400))
    rows.sort(key=lambda r: r[1])
    cuts = [len(rows) * k // n_batches for k in range(n_batches + 1)]
    batches = [rows[a:b] + [(None, rows[a][1], 3)] for a, b in zip(cuts, cuts[1:])]
    forget = timedelta(hours=5)
    got, _ = replay(spark, tmp_path, batches, "user string, ts timestamp, rank int", lambda s: escalations(s, "user", "ts", "rank", forget, "10 minutes"))
    assert Counter((r.user, r.ts, r.rank_before, r.rank) for r in got) == risen(rows, forget) and len(got) > 40


def test_state_is_forgotten(spark, tmp_path):
    """After a long silence the timer removes a key's state; a row that comes much later rises from 0 again."""
    day = lambda d, u, r: (u, T0 + timedelta(days=d), r)
    batches = [[day(0, "a", 2), day(0, "b", 1)], [day(5, "b", 1)], [day(9, "b", 2)], [day(20, "a", 1), day(20, "b", 2)]]
    got, run = replay(spark, tmp_path, batches, "user string, ts timestamp, rank int", lambda s: escalations(s, "user", "ts", "rank", timedelta(days=3), "1 hour"))
    assert sorted(tuple(r) for r in got) == sorted([("a", T0, 0, 2), ("b", T0, 0, 1), ("b", T0 + timedelta(days=5), 0, 1), ("b", T0 + timedelta(days=9), 0, 2), ("a", T0 + timedelta(days=20), 0, 1), ("b", T0 + timedelta(days=20), 0, 2)])
    assert min(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]) < 2


def test_sessions_and_late_rows(spark, tmp_path):
    """Two sessions that a later row joins are one; rows behind the watermark are dropped and counted."""
    at = lambda m: T0 + timedelta(minutes=m)
    batches = [[("a", at(0), 1), ("a", at(50), 0), ("b", at(10), 0)], [("a", at(25), 2), ("b", at(70), 1)], [("c", at(300), 0)], [("c", at(310), 1)], [("a", at(60), 3), ("b", at(5), 3), ("d", at(1000), 0)]]
    got, run = replay(spark, tmp_path, batches, "user string, ts timestamp, rank int", lambda s: sessions(s, "user", "ts", "rank", "30 minutes", "1 hour"))
    assert sorted(tuple(r) for r in got) == [("a", at(0), at(80), 3, 2), ("b", at(10), at(40), 1, 0), ("b", at(70), at(100), 1, 1), ("c", at(300), at(340), 2, 1)]
    assert late_rows(run) == 2


# --- backends ----------------------------------------------------------------------------------------------------
def counting(folder):
    """A maker, all of it sent by value, of a backend that leaves a file each time it is built."""

    class Counting:
        def __init__(self):
            open(f"{folder}/{os.getpid()}-{random.getrandbits(64)}", "w").close()

        def extract(self, texts, labels, threshold):
            return [[Found("illness", t, 0, 0.9)] if t and "illness" in labels else [] for t in texts]

    return Counting


def test_a_worker_builds_its_backend_once(spark, tmp_path):
    df = spark.range(200).repartition(40).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), "id")).alias("text"), F.lit(1).alias("other"))
    make = counting(str(tmp_path))
    for _ in range(2):
        done = with_entities(df, {"text": "found"}, make)
        assert done.where(F.map_contains_key("found", F.lit("illness"))).count() == 160
    built = [name.split("-")[0] for name in os.listdir(tmp_path)]
    assert 0 < len(built) == len(set(built)) <= 12  # 80 tasks, at most a few workers


def test_only_texts_go_to_python(spark):
    df = spark.createDataFrame([(1, "a", "wide", 2.0)], "id int, text string, more string, number double")
    done = with_entities(df, {"text": "found"}, counting("/tmp"))
    (node,) = [x for x in done._jdf.queryExecution().executedPlan().toString().splitlines() if "ArrowEvalPython" in x]
    asked = node.split("ArrowEvalPython [run(", 1)[1].split(")", 1)[0]
    assert "text" in asked and not any(c in asked for c in ("more", "number", "id#"))


def test_backends_are_told_apart():
    a, b = (lambda: [1]), (lambda: [2])
    assert fingerprint(a) != fingerprint(b) and fingerprint(a) == fingerprint(a)
    first = backend_for("m1", a)
    assert backend_for("m1", b) is first and backend_for("m2", b) == [2] and backend_for("m3", b) == [2]
    assert backend_for("m1", b) == [2]  # two are kept


def test_local_model(spark, tmp_path):
    class FromFile:
        def __init__(self, path, device):
            self.word, self.device = open(f"{path}/config.json").read(), device

        def extract(self, texts, labels, threshold):
            return [[Found("illness", f"{self.word} {self.device}")] if "illness" in labels else [] for _ in texts]

    folder = tmp_path / "weights-of-a-test"
    folder.mkdir()
    with pytest.raises(FileNotFoundError):
        local_model(spark, str(folder), FromFile)
    (folder / "config.json").write_text("sent")
    (folder / "model.safetensors").write_bytes(b"pointer")
    with pytest.raises(RuntimeError):
        local_model(spark, str(folder), FromFile)
    (folder / "model.safetensors").write_bytes(b"0" * 1_000_000)
    make = local_model(spark, str(folder), FromFile)
    done = with_entities(spark.createDataFrame([("x",)], "text string"), {"text": "found"}, make)
    assert done.first().found == {"illness": ["sent cpu"] * len(done.first().found["illness"])}
