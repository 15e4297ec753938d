"""Tests of classification, extraction, evaluation, reports, sources, streams and SQL functions."""

import sys
from functools import partial

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sieveline import labels as L
from sieveline.operators import evaluate, extract, report
from sieveline.operators.classify import classify_column, classify_columns, explain_text
from sieveline.plans import sqlfuncs
from sieveline.sources import files
from sieveline.streaming.classify import classify_stream, level_counts

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file

TEXTS = [(0, "card 4111111111111111"), (1, None), (2, ""), (3, "Anna Lee has flu, a@b.co"), (4, "Anna Lee")]


gazetteer = partial(extract.GazetteerExtractor, {"person": ["Anna Lee"], "illness": ["flu"]})


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, text string")


def test_base_and_hybrid(texts):
    base = {r.id: r for r in classify_columns(texts, "text").collect()}
    assert base[0].text_elements == ["credit card number"] and base[0].level == "Confidential"
    assert base[1].level == base[2].level == "Public" and base[1].text is None
    hybrid = {r.id: r for r in classify_columns(texts, ["text"], "hybrid", gazetteer).collect()}
    assert hybrid[3].text_elements == ["email address", "illness", "person"] and hybrid[3].level == "Highly Confidential" and hybrid[3].needs_review
    assert hybrid[4].level == "Private" and hybrid[4].needs_review and not hybrid[2].needs_review


def test_scalar_and_column_paths_agree(texts):
    for mode in ("base", "hybrid"):
        one = classify_columns(texts, "text", mode, gazetteer).select("id", "level", "text_elements").collect()
        two = explain_text(texts, "text", mode, gazetteer).select("id", "explained.level", "explained.elements").collect()
        assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_no_columns_clashes_and_missing(spark, texts):
    assert {r.level for r in classify_columns(texts, [], "hybrid").collect()} == {"Public"}
    with pytest.raises(KeyError):
        classify_columns(texts, ["absent"])
    with pytest.raises(ValueError):
        classify_columns(texts.withColumn("LEVEL", F.lit(1)), ["text"])
    assert "text_level" not in classify_column(texts, "text").columns
    again = classify_columns(classify_columns(texts, "text"), "text")
    assert again.columns.count("level") == 1


def test_max_chars_and_partitions(texts):
    assert classify_columns(texts, "text", max_chars=5).where("level != 'Public'").isEmpty()
    a, b = (sorted(map(tuple, classify_columns(texts.repartition(n), "text").select("id", "level").collect())) for n in (1, 7))
    assert a == b


def test_plans(spark, texts):
    plain = classify_columns(texts, "text", "hybrid")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plain and "Python" not in plain and "MapInPandas" not in plain
    modelled = classify_columns(texts, "text", "hybrid", gazetteer).where("level = 'Private'")._jdf.queryExecution().executedPlan().toString()
    assert modelled.count("ArrowEvalPython") == 1


class Failing:
    """Runs out of memory above a size, or until it is moved."""

    def __init__(self, most):
        self.most, self.sizes, self.moved = most, [], False

    def to_cpu(self):
        self.moved = True

    def extract(self, texts, labels, threshold):
        self.sizes.append(len(texts))
        if not self.moved and len(texts) > self.most:
            raise RuntimeError("CUDA out of memory")
        return [[extract.Found("person", t)] for t in texts]


def test_out_of_memory():
    backend = Failing(2)
    assert len(extract.in_batches(backend, list("abcdefg"), ["person"], 0.5, 8)) == 7
    assert backend.sizes == [7, 4, 2, 2, 2, 1] or max(backend.sizes[-3:]) <= 2
    backend = Failing(0)
    assert len(extract.in_batches(backend, list("ab"), ["person"], 0.5, 2)) == 2 and backend.moved
    with pytest.raises(ValueError):
        extract.in_batches(type("X", (), {"extract": lambda *a: (_ for _ in ()).throw(ValueError("no"))})(), ["a"], [], 0.5, 1)


def entities(spark, backend, text, passes, threshold, **options):
    df = spark.createDataFrame([(text,)], "text string")
    return extract.with_entities(df, {"text": "entities"}, lambda: backend, passes, threshold, **options).first().entities


class Model:
    def predict_entities(self, text, labels, threshold):
        return [{"label": labels[0], "text": text, "score": threshold}]


class BatchModel(Model):
    def batch_predict_entities(self, texts, labels, threshold):
        if "odd" in texts:
            raise KeyError("no batch with this one")
        return [[{"label": "batched", "text": t, "start": 0, "score": 0.5}] for t in texts]


def test_passes_merge_and_adapter(spark):
    assert entities(spark, extract.ModelAdapter(Model()), "x", L.HYBRID_PASSES, 0.7) == {"person": ["x"], "medical condition": ["x"]}
    assert entities(spark, extract.NullExtractor(), "x", L.BASE_PASSES, 0.7) == {}
    adapter = extract.ModelAdapter(BatchModel())
    assert adapter.extract(["a", "b"], ["p"], 0.3) == [[("batched", "a", 0, 0.5)], [("batched", "b", 0, 0.5)]]
    assert adapter.extract(["a", "odd"], ["p"], 0.3) == [[("p", "a", None, 0.3)], [("p", "odd", None, 0.3)]]


class Spans:
    def extract(self, texts, labels, threshold):
        made = [("person", "Anna", 0, 0.8), ("person", "no place", None, 0.9), ("person", "Lee", 5, None), ("date of birth", "An", 0, 0.85), ("asked", str(threshold), 0, 1.0)]
        return [[extract.Found(*x) for x in made] for _ in texts]


def test_thresholds_by_label(spark):
    passes = ((("person", "date of birth"), None), (("illness",), 0.6))
    found = entities(spark, Spans(), "Anna Lee", passes, 0.7, thresholds={"date of birth": 0.9, "illness": 0.3})
    assert found == {"person": ["Anna", "Lee", "Anna", "Lee"], "asked": ["0.7", "0.3"]}
    assert entities(spark, Spans(), "Anna Lee", passes, 0.7)["person"] == ["Anna", "no place", "Lee"] * 2
    text = spark.createDataFrame([("Anna Lee",)], "text string")
    for how in ({}, {"person": 0.99, "date of birth": 0.8}):
        one = classify_columns(text, "text", "hybrid", Spans, thresholds=how).first()
        assert (one.text_elements, one.level) == tuple(explain_text(text, "text", "hybrid", Spans, thresholds=how).select("explained.elements", "explained.level").first())


def test_own_column_names_never_clash(spark):
    names = ["__text_0", "__entities_0", "__all_0", "__rank_0", "__x", "__found_0_0", "__fuzzy_0", "explained_"]
    df = spark.createDataFrame([("a@b.co", *range(len(names)))], "text string, " + ", ".join(f"`{n}` int" for n in names))
    for mode in ("base", "hybrid"):
        for done in (classify_columns(df, "text", mode, gazetteer), explain_text(df, "text", mode, gazetteer)):
            row = done.first().asDict()
            assert [row[n] for n in names] == list(range(len(names))) and len(done.columns) == len(set(done.columns))
    with pytest.raises(ValueError):
        explain_text(df.withColumn("EXPLAINED", F.lit(1)), "text")


def test_long_texts(spark):
    run, dots, many = "a" * 300_000, "x@" + "a." * 150_000, " ".join(f"u{k}@b.org" for k in range(20_000))
    df = spark.createDataFrame([(0, run + "@"), (1, dots), (2, many)], "id int, text string")
    got = {r.id: (r.level, r.text_elements) for r in classify_columns(df, "text", "hybrid").collect()}
    assert got == {0: ("Public", []), 1: ("Public", []), 2: ("Private", ["email address"])}
    assert report.span_rows(df, "id", "text").groupBy("id").count().collect() == [(2, 20_000)]


def test_evaluation(spark):
    rows = [(0, ["person"], ["person"], "Private", "Private"), (1, ["person"], ["illness"], "Private", "Confidential"), (2, [], [], "Public", "Public"), (3, ["illness"], [], "Confidential", "Public")]
    df = spark.createDataFrame(rows, "id int, p array<string>, g array<string>, pl string, gl string")
    counts = {r.label: (r.tp, r.fp, r.fn, r.f1) for r in evaluate.per_label(df, "p", "g").collect()}
    assert counts == {"person": (1, 1, 0, 2 / 3), "illness": (0, 1, 1, 0.0)}
    assert evaluate.micro_f1(df, "p", "g").first().f1 == pytest.approx(2 / 5)
    assert tuple(evaluate.level_rates(df, "pl", "gl").first()) == (4, 0.5, 0.25, 0.25)
    assert sum(r.n for r in evaluate.confusion(df, "pl", "gl").collect()) == 4
    assert evaluate.micro_f1(df.limit(0), "p", "g").first().f1 == 0.0


def test_reports(texts):
    done = classify_column(texts.withColumn("source", F.lit("s")), "text")
    assert {(r.level, r.n) for r in report.by_level(done, ["source"]).collect()} == {("Confidential", 1), ("Private", 1), ("Public", 3)}
    assert [r.id for r in report.most_sensitive(done, "source", 2, "id").orderBy("place").collect()] == [0, 3]
    assert {(r.source, r.n, r.depth) for r in report.subtotals(done, ["source"]).collect()} == {("s", 5, 0), (None, 5, 1)}


def test_files(spark, texts, tmp_path):
    done = classify_columns(texts, "text")
    files.write(done, str(tmp_path / "csv"), "csv")
    back = files.read(spark, str(tmp_path / "csv"), "csv")
    assert back.columns == done.columns and back.count() == 5
    files.write(done, str(tmp_path / "parquet"), partition_by=("level",))
    assert files.read(spark, str(tmp_path / "parquet")).count() == 5
    (tmp_path / "model").mkdir()
    with pytest.raises(FileNotFoundError):
        files.check_model_folder(str(tmp_path / "model"))
    (tmp_path / "model" / "config.json").write_text("{}")
    (tmp_path / "model" / "model.safetensors").write_bytes(b"pointer")
    with pytest.raises(RuntimeError):
        files.check_model_folder(str(tmp_path / "model"))
    sums = {"config.json": (2, files.file_hash(str(tmp_path / "model" / "config.json"))), "model.safetensors": (8, "0" * 64), "absent": (1, "0")}
    got = {r.name: (r.found, r.same_size, r.same_hash) for r in files.verify_files(spark, str(tmp_path / "model"), sums).collect()}
    assert got == {"config.json": (True, True, True), "model.safetensors": (True, False, False), "absent": (False, False, False)}


def test_stream_equals_batch(spark, texts, tmp_path):
    timed = texts.withColumn("ts", F.timestamp_seconds(F.col("id") * 1800))
    timed.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(timed.schema).parquet(str(tmp_path / "in"))
    run = classify_stream(stream, "text").writeStream.format("memory").queryName("classified").trigger(availableNow=True).start()
    run.awaitTermination(60)
    batch = classify_columns(timed, "text")
    pick = lambda df: sorted(map(tuple, df.select("id", "level").collect()))
    assert pick(spark.table("classified")) == pick(batch)
    counts = level_counts(classify_stream(stream, "text"), "ts", "1 hour").writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    counts.awaitTermination(60)
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, level_counts(batch, "ts", "1 hour").collect()))


def test_sql_functions(spark):
    sqlfuncs.register(spark)
    row = spark.sql("SELECT sensitivity_level(array('person', 'phone number')) a, sensitivity_rank('Confidential') b, luhn_ok('4111 1111 1111 1111') c, n_digits('a1b2') d, looks_like_phone('+61 2 9000 0000') e").first()
    assert tuple(row) == ("Confidential", 2, True, 2, True)
