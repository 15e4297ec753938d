"""Table-driven tests of patterns, checksums, validation and rules."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from sieveline import labels as L
from sieveline.functions import checksums, recognisers, rules, validate
from sieveline.functions import text as T


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).orderBy("k").select(expr).collect()]


def values(spark, items, expr, kind="string"):
    return column(spark, [(k, x) for k, x in enumerate(items)], f"k int, v {kind}", expr)


CARDS = [
    ("4111111111111111", True), ("4111 1111 1111 1111 exp", True), ("4111-1111-1111-1111.", True), ("x4111111111111111", True), ("-4111111111111111", False),
    ("4111111111111111 4222222222222220", False), ("4111111111111111 12/26", False), ("4111111111111111, 5500000000000004", True), ("", False), ("4111111111111112", False),
]


def test_cards(spark):
    assert values(spark, [t for t, _ in CARDS], T.has_card(F.col("v"))) == [ok for _, ok in CARDS]


def test_backstop_and_spans(spark):
    texts = ["mail a.b@c.org now", "call +61 2 9000 0000", "+1234567", "né à a@b.co et c@d.org"]
    assert values(spark, texts, recognisers.backstop(F.col("v"))) == [["email address"], ["phone number"], [], ["email address"]]
    found = values(spark, texts, T.spans(F.col("v"), T.EMAIL))
    assert [[(s.start, s.end, s.value) for s in row] for row in found] == [[(5, 14, "a.b@c.org")], [], [], [(5, 11, "a@b.co"), (15, 22, "c@d.org")]]
    for text, row in zip(texts, found):
        assert all(text[s.start : s.end] == s.value for s in row)


CHECKS = [
    (checksums.card, "4111111111111111", True), (checksums.card, "4111111111111112", False), (checksums.tfn, "123456782", True), (checksums.tfn, "123456783", False),
    (checksums.medicare, "2123456701", True), (checksums.medicare, "2123456711", False), (checksums.medicare, "7123456701", False), (checksums.abn, "51824753556", True),
    (checksums.abn, "51824753557", False), (checksums.acn, "004085616", True), (checksums.acn, "004085617", False), (checksums.iban, "GB82WEST12345698765432", True),
    (checksums.iban, "GB82WEST12345698765433", False), (checksums.tfn, "12345678", False), (checksums.iban, "", False),
]


@pytest.mark.parametrize(("check", "value", "ok"), CHECKS)
def test_checksums(spark, check, value, ok):
    assert values(spark, [value], check(F.col("v"))) == [ok]


VALUES = [
    ("person", "Sarah Lee", True), ("person", "manager", False), ("person", "senior citizen", False), ("person", "12345", False), ("person", "John Citizen", True),
    ("person", "manager,", True), ("phone number", "192.168.1.10", False), ("phone number", "02 9000 0000", True), ("phone number", "123456789012345", False),
    ("credit card number", "1234567890123456", True), ("tax file number", "123 456 782", True), ("tax file number", "1234567", False), ("medicare number", "2123 45670 1", True),
    ("passport number", "N1234567", True), ("passport number", "12345678", False), ("bank account number", "062-000 12345678", True), ("bank account number", "1.234567", False),
    ("date of birth", "12/05/1990", True), ("date of birth", "19900512", False), ("date of birth", "12:05:1990", False), ("address", "12 Pitt St", True), ("address", "2000", False),
    ("address", "Level 3 Tower", True), ("medical condition", "asthma", True), ("medical condition", "12345678a", False), ("email address", "a@b.co", True), ("email address", "a.b@c", False),
    ("birthplace", "x", False), ("birthplace", "xy", True), ("unknown", "anything", True),
]


def test_values(spark):
    rows = [(k, label, value) for k, (label, value, _) in enumerate(VALUES)]
    got = column(spark, rows, "k int, label string, value string", validate.is_valid(F.col("label"), F.col("value")))
    assert [(v[:2], g) for v, g in zip(VALUES, got)] == [(v[:2], v[2]) for v in VALUES]


MAPS = [
    ({"bank account number": ["+61 2 9000 0000"]}, ["bank account number", "phone number"]), ({"person": ["+61290000000"]}, ["person", "phone number"]), ({"birthplace": ["Albuquerque"]}, ["birthplace"]),
    ({"person": []}, []), ({}, []), (None, []), ({"person": None, "illness": [None, "flu"]}, ["illness"]),
]


def test_found_labels(spark):
    assert values(spark, [m for m, _ in MAPS], validate.found_labels(F.col("v")), "map<string, array<string>>") == [e for _, e in MAPS]


def test_without_validation_only_stopwords_fall(spark):
    maps = [{"person": ["I", "manager"]}, {"person": ["director"]}, {"date of birth": ["x"]}]
    assert values(spark, maps, validate.found_labels(F.col("v"), False), "map<string, array<string>>") == [[], ["person"], ["date of birth"]]


def test_merge_and_project(spark):
    df = spark.createDataFrame([({"person": ["a"], "illness": []}, {"person": ["a", "b"]})], "x map<string, array<string>>, y map<string, array<string>>")
    assert df.select(validate.merge_passes(F.col("x"), F.col("y"))).first()[0] == {"person": ["a", "a", "b"]}
    assert df.select(validate.project(F.col("y"), F.array(F.lit("illness")))).first()[0] == {}


def test_confident(spark):
    found = [("person", "Ann", 0, 0.9), ("person", "x", None, 0.9), ("illness", "flu", 4, 0.6), ("illness", "fl", 4, None), ("person", None, 0, 1.0)]
    df = spark.createDataFrame([(found,)], f"s {validate.FOUND}")
    assert df.select(validate.by_label(validate.confident(F.col("s"), 0.7))).first()[0] == {"person": ["Ann"], "illness": ["fl"]}
    assert df.select(validate.by_label(validate.confident(F.col("s"), 0.7, {"illness": 0.5}))).first()[0] == {"person": ["Ann"], "illness": ["flu", "fl"]}
    assert df.select(validate.by_label(F.col("s"))).first()[0] == {"person": ["Ann", "x"], "illness": ["flu", "fl"]}


def test_fold_in_blocks(spark):
    for n in (0, 1, 63, 64, 65, 1000):
        out = T.folded(F.sequence(F.lit(1), F.lit(n)) if n else F.expr("cast(array() as array<int>)"), F.lit(0), "int", lambda at, x: (at + x, F.array(at + x)))
        assert spark.range(1).select(out).first()[0] == list(itertools.accumulate(range(1, n + 1)))


def test_spans_of_odd_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab.@%-1 cé") for _ in range(rng.randint(0, 60))) for _ in range(500)] + ["a@b.com%c@d.org"]
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
    want = [[(m.start(), m.end(), m[0]) for m in plain.finditer(t)] for t in texts]
    assert [[tuple(s) for s in row] for row in values(spark, texts, T.spans(F.col("v"), T.EMAIL))] == want
    assert values(spark, texts, T.has_email(F.col("v"))) == [bool(w) for w in want]


LEVELS = [
    ([], "Public"), (["date of birth"], "Public"), (["person"], "Private"), (["person", "bank account number"], "Private"), (["person", "phone number"], "Confidential"), (["person", "date of birth"], "Confidential"),
    (["tax file number"], "Confidential"), (["illness"], "Confidential"), (["illness", "email address"], "Confidential"), (["illness", "person"], "Confidential"), (["illness", "person", "address"], "Highly Confidential"),
    (["illness", "credit card number"], "Highly Confidential"),
]


def test_levels_and_reasons(spark):
    got = values(spark, [x for x, _ in LEVELS], rules.explain(F.col("v")), "array<string>")
    assert [g.level for g in got] == [level for _, level in LEVELS]
    assert [g.rank for g in got] == [L.LEVELS.index(level) for _, level in LEVELS]
    assert got[0].reasons == [L.REASON_NONE] and got[1].elements == ["date of birth"] and got[1].reasons == [L.REASON_NONE]
    assert got[-2].reasons == [L.REASON_COMBINATION, L.REASON_SENSITIVE, L.REASON_TOP]


def test_more_labels_never_lower_the_level(spark):
    flags = list(itertools.product([False, True], repeat=5))
    df = spark.createDataFrame(flags, "n boolean, c boolean, p boolean, k boolean, s boolean")
    made = rules.rank(rules.level_of_flags(*map(F.col, "ncpks")))
    rank = {tuple(r[:5]): r[5] for r in df.select("*", made.alias("r")).collect()}
    assert all(rank[a] <= rank[b] for a in flags for b in flags if all(x <= y for x, y in zip(a, b)))


def test_review(spark):
    rows = [(0, [], [], "Public"), (1, ["person"], [], "Private"), (2, [], ["email address"], "Private"), (3, ["phone number"], ["email address"], "Private"), (4, ["illness"], ["credit card number"], "Highly Confidential")]
    got = column(spark, rows, "k int, f array<string>, s array<string>, l string", rules.needs_review(F.col("l"), F.col("f"), F.col("s")))
    assert got == [False, True, True, False, True]


def test_recognisers(spark):
    texts = ["TFN 123 456 782.", "BSB 062-000 here", "ssn 123-45-6789", "IBAN GB82 WEST 1234 5698 7654 32", "medicare 2123 45670 1", "abn 51 824 753 556", "nothing"]
    assert values(spark, texts, recognisers.elements(F.col("v"))) == [["tax file number"], ["bank account number"], ["tax file number"], ["bank account number"], ["medicare number"], [], []]
    assert values(spark, texts, recognisers.business_elements(F.col("v")))[5] == ["AU_ABN"]
    spans = values(spark, texts, recognisers.spans(F.col("v")))
    assert [(s.label, texts[1][s.start : s.end], s.score) for s in spans[1]] == [("bank account number", "062-000", 0.5)]


def test_text_cells(spark):
    df = spark.createDataFrame([(None, float("nan"), True), ("a", 1.0, False)], "s string, d double, b boolean")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    assert [tuple(r) for r in df.select(*[T.as_text(F.col(c), kinds[c]) for c in "sdb"]).collect()] == [("", "", "True"), ("a", "1.0", "False")]
    assert values(spark, ["\t a \n", " b "], T.strip(F.col("v"))) == ["a", "b"]
