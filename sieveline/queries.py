"""The library's queries over the test tables, and the SQL that gives the same rows in DuckDB.

Patterns are spelled twice, for Java and for RE2: RE2 has no lookaround, and its word boundary is ASCII only.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline import labels as L
from sieveline.functions import checksums, recognisers, rules, validate
from sieveline.functions import text as T
from sieveline.operators import evaluate, report
from sieveline.operators.classify import classify_column, classify_columns, explain_text
from sieveline.operators.extract import Found, GazetteerExtractor, with_entities
from sieveline.operators.intervals import asof_join
from sieveline.plans import sqlfuncs
from sieveline.sources import files
from sieveline.sources.scratch import new_path, written
from sieveline.streaming.classify import classify_stream, level_counts
from sieveline.streaming.escalation import escalations
from sieveline.streaming.sessions import sessions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(map(_q, words)) + "]"


# --- SQL pieces -----------------------------------------------------------------------------------
EMAIL_RE2 = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CARD_RE2 = r"(?:^|[^\d-])(\d(?:[ -]?\d){12,18})"
PHONE_RE2 = T.INTL_PHONE
STREET_RE2 = rf"(?:^|[^\p{{L}}\p{{N}}_])({'|'.join(L.STREET_WORDS)})(?:$|[^\p{{L}}\p{{N}}_])"


def sql_digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def sql_n_digits(x: str) -> str:
    return f"length({sql_digits(x)})"


def sql_luhn(x: str) -> str:
    g = sql_digits(x)
    return f"(length({g}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({g}) + 1), lambda i: CASE WHEN i % 2 = 0 THEN (2 * substr(reverse({g}), i, 1)::INT) // 10 + (2 * substr(reverse({g}), i, 1)::INT) % 10 ELSE substr(reverse({g}), i, 1)::INT END)) % 10 = 0)"


def sql_has_email(t: str) -> str:
    return f"regexp_matches({t}, {_q(EMAIL_RE2)})"


def sql_has_card(t: str) -> str:
    return f"(len(list_filter(regexp_extract_all({t}, {_q(CARD_RE2)}, 1), lambda x: {sql_luhn('x')})) > 0)"


def sql_has_phone(t: str) -> str:
    return f"(len(list_filter(regexp_extract_all({t}, {_q(PHONE_RE2)}), lambda x: {sql_n_digits('x')} BETWEEN 8 AND 15)) > 0)"


def sql_labels(*pairs: tuple[str, str]) -> str:
    """A sorted list of the labels whose test holds."""
    return "list_sort(list_filter([" + ", ".join(f"CASE WHEN {test} THEN {_q(label)} END" for label, test in pairs) + "], lambda x: x IS NOT NULL))"


def sql_backstop(t: str) -> str:
    return sql_labels(("credit card number", sql_has_card(t)), ("email address", sql_has_email(t)), ("phone number", sql_has_phone(t)))


def sql_level(found: str) -> str:
    has = lambda g: f"list_has_any({found}, {_list(g)})"
    return sql_level_of_flags(*map(has, (L.NAME, L.COMBINATION, L.PRIVATE_ALONE, L.CONFIDENTIAL_ALONE, L.SENSITIVE)))


def sql_level_of_flags(n: str, c: str, p: str, k: str, s: str) -> str:
    strong = f"(({n} AND {c}) OR {k})"
    return f"CASE WHEN {s} AND {strong} THEN {_q(L.LEVELS[3])} WHEN {strong} OR {s} THEN {_q(L.LEVELS[2])} WHEN {p} OR {n} THEN {_q(L.LEVELS[1])} ELSE {_q(L.LEVELS[0])} END"


def sql_rank(level: str) -> str:
    return f"(list_position({_list(L.LEVELS)}, {level}) - 1)"


def sql_joined(found: str) -> str:
    return f"array_to_string({found}, '|')"


def joined(found: Column | str) -> Column:
    return F.array_join(found, "|")


# --- patterns ---------------------------------------------------------------------------------------
@query(f"WITH d AS (SELECT doc_id, {sql_backstop('text')} AS e FROM documents) SELECT doc_id, len(e)::BIGINT AS n_elements, {sql_joined('e')} AS elements, {sql_level('e')} AS level FROM d")
def regex_base_documents(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", recognisers.backstop(F.col("text")).alias("e"))
    return found.select("doc_id", F.size("e").cast("long").alias("n_elements"), joined("e").alias("elements"), rules.level(F.col("e")).alias("level"))


@query(f"SELECT doc_id FROM documents WHERE {sql_has_email('text')}")
def regex_email(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(T.has_email(F.col("text"))).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE {sql_has_phone('text')}")
def regex_phone(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(T.has_intl_phone(F.col("text"))).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE {sql_has_card('text')}")
def regex_card_luhn(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(T.has_card(F.col("text"))).select("doc_id")


@query(f"WITH c AS (SELECT doc_id, regexp_extract_all(text, {_q(CARD_RE2)}, 1) AS cs FROM documents), e AS (SELECT doc_id, unnest(cs) AS card FROM c) SELECT doc_id, card, {sql_luhn('card')} AS luhn_ok, count(*)::BIGINT AS n FROM e GROUP BY ALL")
def card_candidates_exploded(spark, sf_dir):
    cards = table(spark, sf_dir, "documents").select("doc_id", F.explode(T.card_candidates(F.col("text"))).alias("card"))
    return cards.groupBy("doc_id", "card", T.luhn(F.col("card")).alias("luhn_ok")).agg(F.count("*").alias("n"))


@query(f"SELECT lang, source, sum({sql_n_digits('text')})::BIGINT AS digits, max({sql_n_digits('text')})::BIGINT AS most FROM documents GROUP BY ALL")
def digit_count_profile(spark, sf_dir):
    n = T.n_digits(F.col("text"))
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.sum(n).alias("digits"), F.max(n).cast("long").alias("most"))


@query(f"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, {_q(STREET_RE2)}, 'i')")
def street_word_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("text").rlike(T.STREET)).select("doc_id", "lang")


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '\d[/.\-]\d')")
def date_separator(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("text").rlike(T.DATE_SEPARATOR)).select("doc_id")


_DOTTED = r"\d{1,3}(?:\.\d{1,3})+"


@query(f"WITH v AS (SELECT doc_id, unnest(regexp_extract_all(text, {_q(_DOTTED)})) AS value FROM documents) SELECT DISTINCT doc_id, value, regexp_matches(value, {_q(T.IPV4_SHAPE)}) AS ipv4 FROM v")
def ipv4_reject(spark, sf_dir):
    values = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_DOTTED), F.lit(0))).alias("value"))
    return values.select("doc_id", "value", F.col("value").rlike(T.IPV4_SHAPE).alias("ipv4")).distinct()


@query(f"WITH v AS (SELECT doc_id, unnest(regexp_extract_all(text, {_q(PHONE_RE2)})) AS value FROM documents) SELECT doc_id, value, contains(value, '+') AND {sql_n_digits('value')} BETWEEN 8 AND 13 AS phone FROM v")
def looks_like_phone(spark, sf_dir):
    values = table(spark, sf_dir, "documents").select("doc_id", F.explode(T.phone_candidates(F.col("text"))).alias("value"))
    return values.select("doc_id", "value", T.looks_like_phone(F.col("value")).alias("phone"))


def _spans_query(name: str, pattern: str, re2: str):
    sql = f"""WITH d AS (SELECT doc_id, regexp_extract_all(text, {_q(re2)}) AS ms, string_split_regex(text, {_q(re2)}) AS gaps FROM documents WHERE regexp_matches(text, {_q(re2)})),
        e AS (SELECT doc_id, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM d)
        SELECT doc_id, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS span_start,
        (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(ms[1:i], lambda x: length(x))))::BIGINT AS span_end, ms[i] AS value FROM e"""

    def spans(spark, sf_dir):
        found = table(spark, sf_dir, "documents").select("doc_id", F.explode(T.spans(F.col("text"), pattern)).alias("s"))
        return found.select("doc_id", F.col("s.start").cast("long").alias("span_start"), F.col("s.end").cast("long").alias("span_end"), F.col("s.value").alias("value"))

    spans.__name__ = name
    query(sql)(spans)


_spans_query("spans_email", T.EMAIL, EMAIL_RE2)
_spans_query("spans_phone", T.INTL_PHONE, PHONE_RE2)


# --- checksums, over numbers made from keys ----------------------------------------------------------
def _digit(x: str, k: int) -> str:
    return f"substr({x}, {k}, 1)::INT"


def _weighted(x: str, weights) -> str:
    return "(" + " + ".join(f"{_digit(x, k)} * {w}" for k, w in enumerate(weights, 1)) + ")"


def _checksum_query(name: str, length: int, factor: int, add: int, test: Callable[[Column], Column], sql_test: str):
    number = f"lpad((o_orderkey * {factor} + {add})::VARCHAR, {length}, '0')"
    sql = f"WITH n AS (SELECT o_orderkey, right({number}, {length}) AS value FROM orders) SELECT o_orderkey, value, {sql_test} AS ok FROM n"

    def checksum(spark, sf_dir):
        value = F.expr(f"lpad(cast(o_orderkey * {factor}L + {add}L as string), {length}, '0')")  # cuts longer numbers behind, as in SQL
        return table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")).withColumn("ok", test(F.col("value")))

    checksum.__name__ = name
    query(sql)(checksum)


_checksum_query("checksum_tfn", 9, 7919, 100000007, checksums.tfn, f"{_weighted('value', checksums.TFN)} % 11 = 0")
_checksum_query("checksum_medicare", 10, 104729, 2000000011, checksums.medicare, f"{_digit('value', 1)} BETWEEN 2 AND 6 AND {_weighted('value', checksums.MEDICARE)} % 10 = {_digit('value', 9)}")
_checksum_query("checksum_abn", 11, 1299709, 10000000019, checksums.abn, f"({_weighted('value', checksums.ABN)} - 10) % 89 = 0")
_checksum_query("checksum_acn", 9, 6007, 4085616, checksums.acn, f"(10 - {_weighted('value', checksums.ACN)} % 10) % 10 = {_digit('value', 9)}")


@query("""WITH n AS (SELECT c_custkey, lpad((c_custkey * 7 % 98)::VARCHAR, 2, '0') AS cc, lpad((c_custkey * 1000003)::VARCHAR, 14, '0') AS b FROM customer),
    v AS (SELECT c_custkey, 'GB' || cc || 'WEST' || b AS value, (CAST('32142829' || b || '1611' || cc AS HUGEINT) % 97) AS r FROM n) SELECT c_custkey, value, r = 1 AS ok FROM v""")
def iban_mod97(spark, sf_dir):
    value = F.expr("concat('GB', lpad(cast(c_custkey * 7 % 98 as string), 2, '0'), 'WEST', lpad(cast(c_custkey * 1000003L as string), 14, '0'))")
    return table(spark, sf_dir, "customer").select("c_custkey", value.alias("value")).withColumn("ok", checksums.iban(F.col("value")))


def _pattern_query(name: str, entity: str, made: str, re2: str):
    pattern = next(r for r in recognisers.RECOGNISERS if r.entity == entity)

    def recognise(spark, sf_dir):
        value = F.expr(made.replace("||", ",").join(("concat(", ")")))
        return table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")).withColumn("found", pattern.found(F.col("value")))

    recognise.__name__ = name
    sql_made = made.replace("cast(", "CAST(").replace("as string", "AS VARCHAR")
    query(f"WITH v AS (SELECT o_orderkey, {sql_made} AS value FROM orders) SELECT o_orderkey, value, regexp_matches(value, {_q(re2)}) AS found FROM v")(recognise)


_pattern_query("bsb_pattern", "AU_BSB", "'acc ' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || '-' || lpad(cast(o_custkey % 2000 as string), 4, '0')", r"(?:^|[^\p{L}\p{N}_])\d{3}-\d{3}(?:$|[^\p{L}\p{N}_])")
_pattern_query("ssn_pattern", "US_SSN", "'id ' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || '-' || cast(o_custkey % 150 as string) || '-' || lpad(cast(o_custkey % 10000 as string), 4, '0')", r"(?:^|[^\p{L}\p{N}_])\d{3}-\d{2}-\d{4}(?:$|[^\p{L}\p{N}_])")


# --- validation ---------------------------------------------------------------------------------------
#: Values made from the tables, the same in both dialects: label, table, key, expression.
_STRIP = r"regexp_replace(value, '^\s+|\s+$', '', 'g')"
_VALUES = {
    "person": ("customer", "c_custkey", "CASE c_custkey % 6 WHEN 0 THEN 'manager' WHEN 1 THEN 'Senior Analyst' WHEN 2 THEN c_name WHEN 3 THEN 'Mary-Ann O''Neil' WHEN 4 THEN cast(c_custkey as string) ELSE ' John Citizen ' END"),
    "email address": ("customer", "c_custkey", "concat('u', cast(c_custkey as string), CASE c_custkey % 4 WHEN 0 THEN '@' ELSE '.x@' END, CASE c_custkey % 3 WHEN 0 THEN 'mail' ELSE 'mail.org' END)"),
    "phone number": ("orders", "o_orderkey", "concat(CASE o_orderkey % 5 WHEN 0 THEN '+61 ' WHEN 1 THEN 'ph ' WHEN 2 THEN '10.1.2.' ELSE '' END, cast(o_custkey * 7919 as string))"),
    "credit card number": ("orders", "o_orderkey", "concat('4', cast(o_orderkey * 1000003 + 100000000000 as string), cast(o_custkey as string))"),
    "tax file number": ("orders", "o_orderkey", "concat(cast(o_custkey * 977 as string), ' ', cast(o_orderkey % 1000 as string))"),
    "medicare number": ("orders", "o_orderkey", "concat(cast(2000 + o_orderkey % 100 as string), ' ', cast(o_custkey * 31 as string), ' ', cast(o_orderkey % 10 as string))"),
    "passport number": ("orders", "o_orderkey", "concat(CASE o_orderkey % 3 WHEN 0 THEN '' ELSE 'N' END, cast(o_custkey * 997 as string))"),
    "driver's licence number": ("orders", "o_orderkey", "concat(CASE o_orderkey % 3 WHEN 0 THEN 'a:' ELSE 'L' END, cast(o_custkey as string))"),
    "bank account number": ("orders", "o_orderkey", "concat(cast(o_orderkey as string), CASE o_orderkey % 4 WHEN 0 THEN '.' WHEN 1 THEN ':' ELSE '-' END, cast(o_custkey as string))"),
    "date of birth": ("orders", "o_orderkey", "concat(cast(1 + o_orderkey % 28 as string), CASE o_orderkey % 4 WHEN 0 THEN '/' WHEN 1 THEN ':' WHEN 2 THEN '-' ELSE '' END, cast(1950 + o_custkey % 60 as string))"),
    "address": ("customer", "c_custkey", "concat(CASE c_custkey % 4 WHEN 0 THEN '12 Pitt St' WHEN 1 THEN 'Level 3 Tower' WHEN 2 THEN 'a: 5 Tower' ELSE '20' END, cast(c_custkey % 7 as string))"),
    "illness": ("customer", "c_custkey", "concat(CASE c_custkey % 3 WHEN 0 THEN 'asthma' WHEN 1 THEN '' ELSE 'type ' END, cast(c_custkey * 13 as string))"),
    "birthplace": ("nation", "n_nationkey", "substring(n_name, 1, 1 + n_nationkey % 3)"),
}
_JUNK = _list(sorted({*L.STOPWORDS, *L.NOT_NAMES, *L.ROLES}))
_LOW = f"lower({_STRIP})"
_NUM = sql_n_digits("value")
_ALPHA = r"regexp_matches(value, '\p{L}')"
_VALID_SQL = {
    "person": rf"NOT (list_contains({_list(L.STOPWORDS + L.NOT_NAMES)}, {_LOW}) OR regexp_matches({_STRIP}, '^[0-9]+$') OR list_has_any(regexp_split_to_array(regexp_replace({_LOW}, '-', ' ', 'g'), '\s+'), {_JUNK}))",
    "email address": "contains(value, '@') AND contains(string_split(value, '@')[-1], '.')",
    "phone number": rf"NOT {_ALPHA} AND NOT contains(value, ':') AND NOT contains(value, ',') AND NOT regexp_matches(value, {_q(T.IPV4_SHAPE)}) AND {_NUM} BETWEEN 7 AND 14",
    "credit card number": f"NOT {_ALPHA} AND {_NUM} BETWEEN 13 AND 19",
    "tax file number": f"NOT {_ALPHA} AND {_NUM} BETWEEN 8 AND 9",
    "medicare number": f"NOT {_ALPHA} AND {_NUM} BETWEEN 10 AND 11",
    "passport number": f"length(replace({_STRIP}, ' ', '')) BETWEEN 6 AND 10 AND {_NUM} >= 1 AND {_ALPHA}",
    "driver's licence number": f"{_NUM} BETWEEN 4 AND 12 AND NOT contains(value, ':')",
    "bank account number": f"{_NUM} BETWEEN 6 AND 18 AND length({_STRIP}) <= 34 AND NOT contains(value, ':') AND NOT contains(value, '.')",
    "date of birth": rf"{_NUM} BETWEEN 3 AND 8 AND NOT contains(value, ':') AND regexp_matches(value, '\d[/.\-]\d')",
    "address": rf"regexp_matches(value, {_q(STREET_RE2)}, 'i') OR (contains({_STRIP}, ' ') AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]{{3,}}') AND NOT contains(value, ':'))",
    "illness": f"{_ALPHA} AND {_NUM} < 7",
    "birthplace": "true",
}


def _valid_query(label: str):
    source, key, made = _VALUES[label]
    sql_made = made.replace("as string)", "AS VARCHAR)")
    name = "validate_" + label.replace("'", "").replace(" ", "_")

    def valid(spark, sf_dir):
        values = table(spark, sf_dir, source).select(F.col(key).cast("long").alias("key"), F.expr(made.replace("O''Neil", "O\\'Neil")).alias("value"))
        return values.withColumn("ok", validate.is_valid(F.lit(label), F.col("value")))

    valid.__name__ = name
    query(f"WITH v AS (SELECT {key}::BIGINT AS key, {sql_made} AS value FROM {source}) SELECT key, value, length({_STRIP}) >= 2 AND ({_VALID_SQL[label]}) AS ok FROM v")(valid)


for _label in _VALUES:
    _valid_query(_label)


_NAMES_SQL = "SELECT DISTINCT name FROM (SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation UNION ALL SELECT p_name FROM part UNION ALL SELECT event_type FROM events UNION ALL SELECT c_mktsegment FROM customer)"


@query(f"WITH v AS (SELECT name AS value FROM ({_NAMES_SQL})) SELECT value AS name, {_VALID_SQL['person']} AS ok FROM v")
def personish_filter(spark, sf_dir):
    parts = [("region", "r_name"), ("nation", "n_name"), ("part", "p_name"), ("events", "event_type"), ("customer", "c_mktsegment")]
    names = None
    for t, c in parts:
        one = table(spark, sf_dir, t).select(F.col(c).alias("name"))
        names = one if names is None else names.unionByName(one)
    return names.distinct().withColumn("ok", validate.is_name(F.col("name")))


# --- entity maps, made from customers -------------------------------------------------------------------
_MAP_PAIRS = {
    "person": "CASE WHEN c_custkey % 3 = 0 THEN 'manager' ELSE 'Anna Lee' END",
    "bank account number": "CASE WHEN c_custkey % 5 = 0 THEN '+61 2 9000 0000' ELSE cast(c_custkey * 100003 as string) END",
    "birthplace": "CASE WHEN c_custkey % 4 = 0 THEN 'Albuquerque' ELSE 'x' END",
    "illness": "CASE WHEN c_custkey % 7 = 0 THEN 'asthma' ELSE '12345678a' END",
}


def _map() -> Column:
    return F.create_map(*[x for k, v in _MAP_PAIRS.items() for x in (F.lit(k), F.array(F.expr(v)))])


def _sql_found() -> str:
    """Labels found in the map above: each has one value, tested by its label's rule; and a phone by rescue."""
    pairs = []
    for label, made in _MAP_PAIRS.items():
        value = "(" + made.replace("as string)", "AS VARCHAR)") + ")"
        pairs.append((label, f"(length({value}) >= 2 AND ({_VALID_SQL[label].replace('value', value)}))"))
    bank = "(" + _MAP_PAIRS["bank account number"].replace("as string)", "AS VARCHAR)") + ")"
    pairs.append(("phone number", f"contains({bank}, '+') AND {sql_n_digits(bank)} BETWEEN 8 AND 13"))
    return sql_labels(*pairs)


@query(f"WITH f AS (SELECT c_custkey, {_sql_found()} AS e FROM customer) SELECT c_custkey, {sql_joined('e')} AS found FROM f")
def found_labels_map(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", joined(validate.found_labels(_map())).alias("found"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'date of birth|phone number' ELSE 'date of birth' END AS found FROM customer")
def phone_rescue(spark, sf_dir):
    made = F.create_map(F.lit("date of birth"), F.when(F.expr("c_custkey % 5 = 0"), F.array(F.lit("1/2/1990"), F.lit("+61 2 9000 0000"))).otherwise(F.array(F.lit("1/2/1990"))))
    return table(spark, sf_dir, "customer").select("c_custkey", joined(validate.found_labels(made)).alias("found"))


@query(f"WITH f AS (SELECT c_custkey, list_filter({_sql_found()}, lambda x: NOT list_contains({_list(L.SUPPRESSED)}, x)) AS e FROM customer) SELECT c_custkey, {sql_joined('e')} AS found FROM f")
def suppress_labels(spark, sf_dir):
    fuzzy = F.array_except(validate.found_labels(_map()), F.array(*map(F.lit, L.SUPPRESSED)))
    return table(spark, sf_dir, "customer").select("c_custkey", joined(F.array_sort(fuzzy)).alias("found"))


@query(f"WITH f AS (SELECT c_custkey, {_sql_found()} AS e FROM customer) SELECT c_custkey, {sql_joined('list_sort(list_distinct(list_concat(e, ' + _list(['email address', 'person']) + ')))')} AS found FROM f")
def union_elements(spark, sf_dir):
    both = F.array_union(validate.found_labels(_map()), F.array(F.lit("email address"), F.lit("person")))
    return table(spark, sf_dir, "customer").select("c_custkey", joined(F.array_sort(both)).alias("found"))


@query(f"""WITH f AS (SELECT c_custkey, {_sql_found()} AS e FROM customer), p AS (SELECT c_custkey, unnest(e) AS label FROM f)
    SELECT p.c_custkey, label, CASE label {' '.join(f"WHEN {_q(k)} THEN {v.replace('as string)', 'AS VARCHAR)')}" for k, v in _MAP_PAIRS.items())} END AS value FROM p JOIN customer USING (c_custkey) WHERE label <> 'phone number'""")
def entity_projection(spark, sf_dir):
    kept = validate.project(F.col("m"), validate.found_labels(F.col("m")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", _map().alias("m")).select("c_custkey", F.explode(kept).alias("label", "vs"))
    return rows.select("c_custkey", "label", joined("vs").alias("value"))


@query("""WITH m AS (SELECT c_custkey, [['person', 'A' || c_name], ['person', c_mktsegment], ['illness', CASE WHEN c_custkey % 2 = 0 THEN 'flu' END]] AS ps FROM customer), e AS (SELECT c_custkey, unnest(ps) AS p FROM m)
    SELECT c_custkey, p[1] AS label, string_agg(p[2], '|' ORDER BY CASE WHEN p[2] LIKE 'A%Customer%' THEN 0 ELSE 1 END) AS value FROM e WHERE p[2] IS NOT NULL GROUP BY ALL""")
def merge_passes(spark, sf_dir):
    first = F.create_map(F.lit("person"), F.array(F.concat(F.lit("A"), "c_name")), F.lit("illness"), F.expr("cast(array() as array<string>)"))
    second = F.create_map(F.lit("person"), F.array("c_mktsegment"), F.lit("illness"), F.when(F.expr("c_custkey % 2 = 0"), F.array(F.lit("flu"))).otherwise(F.expr("cast(array() as array<string>)")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(validate.merge_passes(first, second)).alias("label", "vs"))
    return rows.select("c_custkey", "label", joined("vs").alias("value"))


@query("SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'date of birth' ELSE 'person' END AS label, substr(event_type, 1, 3) AS value FROM events WHERE value / 1000 >= CASE WHEN user_id % 2 = 0 THEN 0.09 ELSE 0.05 END")
def confidence_filter(spark, sf_dir):
    label = F.when(F.expr("user_id % 2 = 0"), "date of birth").otherwise("person")
    one = F.struct(label.alias("label"), F.substring("event_type", 1, 3).alias("value"), F.lit(0).alias("start"), (F.col("value") / 1000).alias("confidence"))
    kept = validate.by_label(validate.confident(F.array(one), 0.05, {"date of birth": 0.09}))
    rows = table(spark, sf_dir, "events").select("event_id", F.explode(kept).alias("label", "vs"))
    return rows.select("event_id", "label", joined("vs").alias("value"))


# --- rules ------------------------------------------------------------------------------------------------
_FLAGS = [f"(f & {1 << k}) > 0" for k in range(5)]
_REASONS = (("n AND c", L.REASON_COMBINATION), ("k", L.REASON_CONFIDENTIAL), ("s", L.REASON_SENSITIVE), (f"level = {_q(L.LEVELS[3])}", L.REASON_TOP))
# Five bits of an order's key say which groups its labels are of, so that all 32 cases occur.
_TRUTH = f"WITH t AS (SELECT o_orderkey, f, {', '.join(f'{x} AS {n}' for x, n in zip(_FLAGS, 'ncpks'))} FROM (SELECT o_orderkey, o_orderkey % 32 AS f FROM orders)), l AS (SELECT *, {sql_level_of_flags('n', 'c', 'p', 'k', 's')} AS level FROM t)"


def _flag_columns() -> tuple[Column, ...]:
    return tuple((F.col("o_orderkey") % 32).cast("int").bitwiseAND(F.lit(1 << k)) > 0 for k in range(5))


@query(f"{_TRUTH} SELECT o_orderkey, level, {sql_rank('level')}::INT AS level_rank FROM l")
def classify_truth_table(spark, sf_dir):
    levels = table(spark, sf_dir, "orders").select("o_orderkey", rules.level_of_flags(*_flag_columns()).alias("level"))
    return levels.withColumn("level_rank", rules.rank(F.col("level")))


@query(f"{_TRUTH}, e AS (SELECT *, list_filter([{', '.join(f'CASE WHEN {t} THEN {_q(r)} END' for t, r in _REASONS)}], lambda x: x IS NOT NULL) AS r FROM l) SELECT o_orderkey, CASE WHEN len(r) > 0 THEN array_to_string(r, '; ') WHEN p OR n THEN {_q(L.REASON_PRIVATE)} ELSE {_q(L.REASON_NONE)} END AS reasons FROM e")
def explain_reasons(spark, sf_dir):
    flags = _flag_columns()
    made = rules.reasons(*flags, rules.level_of_flags(*flags))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(made, "; ").alias("reasons"))


@query(f"""WITH d AS (SELECT doc_id, {sql_labels(("phone number", sql_has_phone('text')))} AS fuzzy, {sql_labels(("credit card number", sql_has_card('text')), ("email address", sql_has_email('text')))} AS structured FROM documents),
    l AS (SELECT doc_id, {sql_level('fuzzy')} AS lf, {sql_level('structured')} AS ls, {sql_level('list_concat(fuzzy, structured)')} AS level FROM d)
    SELECT doc_id, level, level = {_q(L.REVIEW_LEVELS[0])} OR lf <> ls AS needs_review FROM l""")
def review_flag(spark, sf_dir):
    t = F.col("text")
    structured = F.array_compact(F.array(F.when(T.has_card(t), "credit card number"), F.when(T.has_email(t), "email address")))
    d = table(spark, sf_dir, "documents").select("doc_id", recognisers.phone_backstop(t).alias("fuzzy"), structured.alias("structured"))
    d = d.withColumn("level", rules.level(F.array_union("fuzzy", "structured")))
    return d.select("doc_id", "level", rules.needs_review(F.col("level"), F.col("fuzzy"), F.col("structured")).alias("needs_review"))


# --- classification of columns -------------------------------------------------------------------------------
_NOTE = "concat(c_mktsegment, CASE c_custkey % 3 WHEN 0 THEN ' for Anna Lee' ELSE '' END, CASE c_custkey % 5 WHEN 0 THEN ' card 4111111111111111' WHEN 1 THEN ' mail a.b@c.org' WHEN 2 THEN ' call +61 2 9000 0000' ELSE '' END)"
_REPLY = "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'call +1 (555) 555-1234' ELSE c_mktsegment END"
_NOTES_SQL = f"n AS (SELECT c_custkey, {_NOTE} AS note, coalesce({_REPLY}, '') AS reply FROM customer)"


def _notes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr(_NOTE).alias("note"), F.expr(_REPLY).alias("reply"))


@query(f"""WITH {_NOTES_SQL}, e AS (SELECT c_custkey, {sql_backstop('note')} AS a, {sql_backstop('reply')} AS b FROM n), l AS (SELECT *, {sql_level('a')} AS la, {sql_level('b')} AS lb FROM e)
    SELECT c_custkey, la AS note_level, {sql_joined('a')} AS note_elements, lb AS reply_level, {sql_joined('b')} AS reply_elements, {_list(L.LEVELS)}[greatest({sql_rank('la')}, {sql_rank('lb')}) + 1] AS level FROM l""")
def classify_columns_multi(spark, sf_dir):
    done = classify_columns(_notes(spark, sf_dir), ["note", "reply"])
    return done.select("c_custkey", "note_level", joined("note_elements").alias("note_elements"), "reply_level", joined("reply_elements").alias("reply_elements"), "level")


def _gazetteer() -> GazetteerExtractor:
    return GazetteerExtractor({"person": ["Anna Lee"], "illness": ["machinery", "the"]})


def _sql_word(t: str, words: list[str]) -> str:
    return rf"regexp_matches({t}, '(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?:$|[^\p{{L}}\p{{N}}_])', 'i')"


def _sql_hybrid(t: str) -> tuple[str, str]:
    fuzzy = sql_labels(("person", _sql_word(t, ["Anna Lee"])), ("illness", _sql_word(t, ["machinery", "the"])), ("phone number", sql_has_phone(t)))
    return fuzzy, sql_labels(("email address", sql_has_email(t)), ("credit card number", sql_has_card(t)))


@query(f"""WITH {_NOTES_SQL}, e AS (SELECT c_custkey, {_sql_hybrid('note')[0]} AS fa, {_sql_hybrid('note')[1]} AS sa, {_sql_hybrid('reply')[0]} AS fb, {_sql_hybrid('reply')[1]} AS sb FROM n),
    u AS (SELECT *, list_sort(list_concat(fa, sa)) AS a, list_sort(list_concat(fb, sb)) AS b FROM e), l AS (SELECT *, {sql_level('a')} AS la, {sql_level('b')} AS lb, {sql_level('fa')} <> {sql_level('sa')} AS da, {sql_level('fb')} <> {sql_level('sb')} AS db FROM u)
    SELECT c_custkey, la AS note_level, {sql_joined('a')} AS note_elements, la = {_q(L.LEVELS[3])} OR da AS note_needs_review, lb AS reply_level, {sql_joined('b')} AS reply_elements, lb = {_q(L.LEVELS[3])} OR db AS reply_needs_review,
    {_list(L.LEVELS)}[greatest({sql_rank('la')}, {sql_rank('lb')}) + 1] AS level, la = {_q(L.LEVELS[3])} OR da OR lb = {_q(L.LEVELS[3])} OR db AS needs_review FROM l""")
def classify_columns_hybrid(spark, sf_dir):
    done = classify_columns(_notes(spark, sf_dir), ["note", "reply"], mode="hybrid", extractor=_gazetteer)
    return done.withColumns({c: joined(c) for c in ("note_elements", "reply_elements")}).drop("note", "reply")


@query(f"WITH c AS (SELECT conv_id, turn, {sql_backstop('coalesce(text, ' + _q('') + ')')} AS e FROM conversations) SELECT conv_id, turn, {sql_level('e')} AS level, {sql_joined('e')} AS elements FROM c")
def classify_single_column(spark, sf_dir):
    done = classify_column(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "text")
    return done.select("conv_id", "turn", "level", joined("elements").alias("elements"))


@query(f"WITH d AS (SELECT doc_id, {sql_backstop('substr(text, 1, 500)')} AS e FROM documents) SELECT doc_id, {sql_level('e')} AS level, {sql_joined('e')} AS elements FROM d")
def max_chars_truncation(spark, sf_dir):
    done = classify_column(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", max_chars=500)
    return done.select("doc_id", "level", joined("elements").alias("elements"))


@query(f"WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS t FROM documents), e AS (SELECT doc_id, {sql_backstop('t')} AS e FROM d) SELECT doc_id, {sql_level('e')} AS level FROM e")
def null_text_public(spark, sf_dir):
    holed = table(spark, sf_dir, "documents").select("doc_id", F.expr("if(doc_id % 3 = 0, null, text)").alias("text"))
    return classify_column(holed, "text").select("doc_id", "level")


@query(f"WITH d AS (SELECT doc_id, {sql_backstop('text')} AS e FROM documents), l AS (SELECT *, {sql_level('e')} AS level FROM d) SELECT doc_id, level, {sql_rank('level')}::INT AS level_rank, {sql_joined('e')} AS elements, CASE level WHEN {_q(L.LEVELS[2])} THEN {_q(L.REASON_CONFIDENTIAL)} WHEN {_q(L.LEVELS[1])} THEN {_q(L.REASON_PRIVATE)} ELSE {_q(L.REASON_NONE)} END AS reasons FROM l")
def explain_documents(spark, sf_dir):
    x = F.col("explained")
    done = explain_text(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return done.select("doc_id", x["level"].alias("level"), x["rank"].alias("level_rank"), joined(x["elements"]).alias("elements"), F.array_join(x["reasons"], "; ").alias("reasons"))


@query(f"WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}_])(the)(?:$|[^\\p{{L}}\\p{{N}}_])', 1) AS v FROM documents) SELECT doc_id, 'illness' AS label FROM d WHERE len(v) > 0")
def extractor_gazetteer(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_entities(docs, {"text": "entities"}, lambda: GazetteerExtractor({"illness": ["the"]}))
    return found.select("doc_id", F.explode("entities").alias("label", "vs")).select("doc_id", "label")


# --- evaluation: phone and email as predicted, the whole backstop as gold --------------------------------------
_EVAL = f"d AS (SELECT doc_id, {sql_labels(('email address', sql_has_email('text')), ('phone number', sql_has_phone('text')))} AS p, {sql_backstop('text')} AS g FROM documents)"


def _judged(spark, sf_dir) -> DataFrame:
    t = F.col("text")
    predicted = F.array_compact(F.array(F.when(T.has_email(t), "email address"), F.when(T.has_intl_phone(t), "phone number")))
    d = table(spark, sf_dir, "documents").select("doc_id", predicted.alias("p"), recognisers.backstop(t).alias("g"))
    return d.withColumns({"pl": rules.level(F.col("p")), "gl": rules.level(F.col("g"))})


_COUNTS = "c AS (SELECT label, count(*) FILTER (list_contains(p, label) AND list_contains(g, label)) AS tp, count(*) FILTER (list_contains(p, label) AND NOT list_contains(g, label)) AS fp, count(*) FILTER (NOT list_contains(p, label) AND list_contains(g, label)) AS fn FROM (SELECT unnest(list_distinct(list_concat(p, g))) AS label, p, g FROM d) GROUP BY label)"


@query(f"WITH {_EVAL}, {_COUNTS} SELECT label, tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c")
def eval_per_label(spark, sf_dir):
    done = evaluate.per_label(_judged(spark, sf_dir), "p", "g")
    return done.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"WITH {_EVAL}, {_COUNTS} SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS f1 FROM c")
def eval_micro_f1(spark, sf_dir):
    return evaluate.micro_f1(_judged(spark, sf_dir), "p", "g").withColumn("f1", F.round("f1", 6))


@query(f"WITH {_EVAL} SELECT {sql_level('p')} AS predicted, {sql_level('g')} AS gold, count(*) AS n FROM d GROUP BY ALL")
def eval_confusion(spark, sf_dir):
    return evaluate.confusion(_judged(spark, sf_dir), "pl", "gl")


@query(f"WITH {_EVAL}, r AS (SELECT {sql_rank(sql_level('p'))} AS p, {sql_rank(sql_level('g'))} AS g FROM d) SELECT count(*) AS n, round(count(*) FILTER (p = g) / count(*), 6) AS accuracy, round(count(*) FILTER (p > g) / count(*), 6) AS over_rate, round(count(*) FILTER (p < g) / count(*), 6) AS under_rate FROM r")
def eval_over_under(spark, sf_dir):
    return evaluate.level_rates(_judged(spark, sf_dir), "pl", "gl").withColumns({c: F.round(c, 6) for c in ("accuracy", "over_rate", "under_rate")})


# --- reports ----------------------------------------------------------------------------------------------------
_LEVELLED = f"d AS (SELECT doc_id, lang, source, {sql_backstop('text')} AS e FROM documents), l AS (SELECT *, {sql_level('e')} AS level FROM d)"


def _levelled(spark, sf_dir) -> DataFrame:
    return classify_column(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "text").drop("text")


@query(f"WITH {_LEVELLED} SELECT source, level, count(*) AS n FROM l GROUP BY ALL")
def report_by_source(spark, sf_dir):
    return report.by_level(_levelled(spark, sf_dir), ["source"])


@query(f"WITH {_LEVELLED} SELECT lang, source, count(*) AS n, count(*) FILTER (level <> 'Public') AS n_sensitive, grouping(lang, source)::BIGINT AS depth FROM l GROUP BY ROLLUP (lang, source)")
def report_rollup_lang_source(spark, sf_dir):
    return report.subtotals(_levelled(spark, sf_dir), ["lang", "source"])


@query(f"WITH {_LEVELLED} SELECT lang, source, count(*) AS n, count(*) FILTER (level <> 'Public') AS n_sensitive, grouping(lang, source)::BIGINT AS depth FROM l GROUP BY CUBE (lang, source)")
def report_cube_lang_source(spark, sf_dir):
    return report.cube(_levelled(spark, sf_dir), ["lang", "source"])


@query(f"WITH {_LEVELLED}, t AS (SELECT source, doc_id, level, row_number() OVER (PARTITION BY source ORDER BY {sql_rank('level')} DESC, len(e) DESC, doc_id) AS place FROM l) SELECT source, doc_id, level, place::INT AS place FROM t WHERE place <= 3")
def report_topk_per_source(spark, sf_dir):
    return report.most_sensitive(_levelled(spark, sf_dir), "source", 3, "doc_id").select("source", "doc_id", "level", "place")


@query(f"""WITH d AS (SELECT doc_id, {sql_labels(("phone number", sql_has_phone('text')))} AS f, {sql_labels(("credit card number", sql_has_card('text')), ("email address", sql_has_email('text')))} AS s FROM documents)
    SELECT doc_id, {sql_level('list_concat(f, s)')} AS level FROM d WHERE {sql_level('f')} <> {sql_level('s')} OR {sql_level('list_concat(f, s)')} = {_q(L.LEVELS[3])}""")
def report_review_queue(spark, sf_dir):
    return report.review_queue(review_flag(spark, sf_dir), "doc_id").select("doc_id", "level")


@query(f"WITH {_LEVELLED} SELECT quality, level, count(*) AS n FROM l JOIN labels USING (doc_id) GROUP BY ALL")
def join_labels_quality(spark, sf_dir):
    joined_ = _levelled(spark, sf_dir).select("doc_id", "level").join(table(spark, sf_dir, "labels"), "doc_id")
    return report.by_level(joined_, ["quality"])


def _closed(end: str, late: str) -> str:
    """SQL for what append mode has put out when all events have come: windows that end before the watermark, which Spark keeps in milliseconds."""
    return f"{end} <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL {late} FROM events)"


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream; as a pattern the path may be a file or a folder."""
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")


def _appended(stream: DataFrame) -> DataFrame:
    """All that a stream puts out in append mode, as a table."""
    spark = stream.sparkSession
    path = new_path(spark)
    run = stream.writeStream.outputMode("append").format("parquet").option("path", f"{path}/rows")
    run.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def _completed(stream: DataFrame) -> DataFrame:
    """What a stream of counts has come to in complete mode, as a table: each micro-batch replaces it."""
    spark = stream.sparkSession
    path = new_path(spark)
    run = stream.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{path}/rows"))
    run.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@query("SELECT time_bucket(INTERVAL 1 hour, ts)::TIMESTAMP AS window_start, CASE WHEN value > 50 THEN 'Private' ELSE 'Public' END AS level, count(*) AS n FROM events GROUP BY ALL")
def stream_level_counts(spark, sf_dir):
    """Events arrive as a stream, are classified on the way and counted in windows; the counts of all windows, the last ones included, are a table when all have come."""
    note = F.when(F.col("value") > 50, F.concat(F.lit("write to u"), "user_id", F.lit("@example.org"))).otherwise(F.col("event_type"))
    levelled = classify_stream(_streamed(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), note.alias("note")), "note")
    return _completed(level_counts(levelled, "ts", "1 hour", late=None)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""WITH d AS (SELECT doc_id, text FROM documents), e AS (SELECT doc_id, unnest(regexp_extract_all(text, {_q(EMAIL_RE2)})) AS value, 'email address' AS label FROM d),
    c AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(text, {_q(CARD_RE2)}, 1), lambda x: {sql_luhn('x')})) AS value, 'credit card number' AS label FROM d)
    SELECT doc_id, label, trim(value) AS value, count(*)::BIGINT AS n FROM (SELECT * FROM e UNION ALL SELECT * FROM c) GROUP BY ALL""")
def structured_spans(spark, sf_dir):
    rows = report.span_rows(table(spark, sf_dir, "documents"), "doc_id", "text").where(F.col("label").isin("email address", "credit card number"))
    return rows.groupBy("doc_id", "label", F.trim("value").alias("value")).agg(F.count("*").alias("n"))


# --- identifiers in running text, made from keys --------------------------------------------------------------
_KINDS_SQL = f"""n AS (SELECT o_orderkey, o_orderkey % 4 AS kind, lpad((o_orderkey * 7919 + 100000007)::VARCHAR, 9, '0') AS tfn, (2000000011 + o_orderkey * 104729)::VARCHAR AS medicare,
    lpad((o_orderkey * 7 % 98)::VARCHAR, 2, '0') AS cc, lpad((o_orderkey * 1000003)::VARCHAR, 14, '0') AS b FROM orders)"""
_KINDS = "CASE o_orderkey % 4 WHEN 0 THEN concat('my file number is ', substr(tfn, 1, 3), ' ', substr(tfn, 4, 3), ' ', substr(tfn, 7, 3), '.') WHEN 1 THEN concat('card ', substr(medicare, 1, 4), ' ', substr(medicare, 5, 5), ' ', substr(medicare, 10, 1), ' (Medicare)') WHEN 2 THEN concat('pay to GB', cc, 'WEST', b, ', please') ELSE 'nothing here' END"


def _identifiers(spark, sf_dir) -> DataFrame:
    made = table(spark, sf_dir, "orders").select("o_orderkey").selectExpr("o_orderkey", "lpad(cast(o_orderkey * 7919 + 100000007 as string), 9, '0') as tfn", "cast(2000000011L + o_orderkey * 104729 as string) as medicare", "lpad(cast(o_orderkey * 7 % 98 as string), 2, '0') as cc", "lpad(cast(o_orderkey * 1000003 as string), 14, '0') as b")
    return made.select("o_orderkey", F.expr(_KINDS).alias("note"))


@query(f"""WITH {_KINDS_SQL}, t AS (SELECT o_orderkey, CASE WHEN kind = 0 AND {_weighted('tfn', checksums.TFN)} % 11 = 0 THEN ['tax file number']
    WHEN kind = 1 AND {_digit('medicare', 1)} BETWEEN 2 AND 6 AND {_weighted('medicare', checksums.MEDICARE)} % 10 = {_digit('medicare', 9)} THEN ['medicare number']
    WHEN kind = 2 THEN {sql_labels(("bank account number", "(CAST('32142829' || b || '1611' || cc AS HUGEINT) % 97) = 1"), ("credit card number", sql_luhn('b')))} ELSE [] END AS e FROM n) SELECT o_orderkey, {sql_joined('e')} AS elements FROM t""")
def recognised_in_text(spark, sf_dir):
    return _identifiers(spark, sf_dir).select("o_orderkey", joined(recognisers.elements(F.col("note"))).alias("elements"))


@query(f"""WITH {_KINDS_SQL}, t AS (SELECT o_orderkey, 'GB' || cc || 'WEST' || b AS value FROM n WHERE kind = 2 AND (CAST('32142829' || b || '1611' || cc AS HUGEINT) % 97) = 1)
    SELECT o_orderkey, 'bank account number' AS label, 7 AS span_start, 29 AS span_end, 1.0::DOUBLE AS score, value FROM t""")
def recognised_spans(spark, sf_dir):
    rows = report.span_rows(_identifiers(spark, sf_dir), "o_orderkey", "note").where("label = 'bank account number'")
    return rows.select("o_orderkey", "label", F.col("start").alias("span_start"), F.col("end").alias("span_end"), "score", "value")


def _sql_acn(x: str) -> str:
    return f"(10 - {_weighted(x, checksums.ACN)} % 10) % 10 = {_digit(x, 9)}"


@query(f"""WITH n AS (SELECT o_orderkey, (10000000019 + o_orderkey * 1299709)::VARCHAR AS value, lpad((o_orderkey * 6007 + 4085616)::VARCHAR, 9, '0') AS acn FROM orders)
    SELECT o_orderkey, array_to_string(list_filter([CASE WHEN ({_weighted('value', checksums.ABN)} - 10) % 89 = 0 THEN 'AU_ABN' END, CASE WHEN {_sql_acn('acn')} OR {_sql_acn('substr(value, 3)')} THEN 'AU_ACN' END], lambda x: x IS NOT NULL), '|') AS elements FROM n""")
def business_identifiers(spark, sf_dir):
    made = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(10000000019L + o_orderkey * 1299709 as string) as v", "lpad(cast(o_orderkey * 6007 + 4085616 as string), 9, '0') as acn")
    note = F.expr("concat('ABN ', substr(v, 1, 2), ' ', substr(v, 3, 3), ' ', substr(v, 6, 3), ' ', substr(v, 9, 3), ', ACN ', acn)")
    return made.select("o_orderkey", joined(recognisers.business_elements(note)).alias("elements"))


@query(f"""WITH {_NOTES_SQL}, e AS (SELECT c_custkey, {_sql_hybrid('note')[0]} AS f, {_sql_hybrid('note')[1]} AS s FROM n), u AS (SELECT *, list_sort(list_concat(f, s)) AS a, {sql_level('f')} <> {sql_level('s')} AS d FROM e), l AS (SELECT *, {sql_level('a')} AS level FROM u)
    SELECT c_custkey, level, {sql_rank('level')}::INT AS level_rank, {sql_joined('a')} AS elements, {sql_joined('s')} AS structured, level = {_q(L.LEVELS[3])} OR d AS needs_review FROM l""")
def explain_hybrid(spark, sf_dir):
    x = F.col("explained")
    done = explain_text(_notes(spark, sf_dir).drop("reply"), "note", "hybrid", _gazetteer)
    return done.select("c_custkey", x["level"].alias("level"), x["rank"].alias("level_rank"), joined(x["elements"]).alias("elements"), joined(x["structured"]).alias("structured"), x["needs_review"].alias("needs_review"))


class FirstWord:
    """A backend whose confidence in a text's first word, as an illness, is known: the tenths of its length."""

    def extract(self, texts, labels, threshold):
        words = [t.split(" ")[0] for t in texts]
        return [[Found("illness", w, 0, len(w) % 10 / 10)] if "illness" in labels and len(w) % 10 / 10 >= threshold else [] for w in words]


@query("SELECT p_partkey, CASE WHEN length(split_part(p_name, ' ', 1)) % 10 >= 4 THEN 'Confidential' ELSE 'Public' END AS level, CASE WHEN length(split_part(p_name, ' ', 1)) % 10 >= 4 THEN 'illness' ELSE '' END AS elements FROM part")
def thresholds_by_label(spark, sf_dir):
    done = classify_column(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", mode="hybrid", extractor=FirstWord, thresholds={"illness": 0.4})
    return done.select("p_partkey", "level", joined("elements").alias("elements"))


@query(f"""WITH d AS (SELECT conv_id, turn, {sql_backstop('coalesce(text, ' + _q('') + ')')} AS e FROM conversations) SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, {sql_level('e')} AS level,
    '[' || array_to_string(list_transform(e, lambda x: '"' || x || '"'), ',') || ']' AS elements FROM d""")
def csv_round_trip(spark, sf_dir):
    path = new_path(spark)
    files.write(classify_column(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "text").drop("text"), path, "csv")
    return files.read(spark, path, "csv").select("conv_id", "turn", "level", "elements")


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'Confidential' WHEN 1 THEN 'Private' ELSE 'Public' END AS level, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END::INT AS level_rank,
    length(o_orderkey::VARCHAR)::INT AS digits, length(o_orderkey::VARCHAR) BETWEEN 8 AND 13 AS phone FROM orders""")
def sql_functions(spark, sf_dir):
    sqlfuncs.register(spark)
    found = "sensitivity_level(CASE o_orderkey % 3 WHEN 0 THEN array('person', 'phone number') WHEN 1 THEN array('address') ELSE array('date of birth') END)"
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{found} AS level", f"sensitivity_rank({found}) AS level_rank", "n_digits(concat('a', o_orderkey)) AS digits", "looks_like_phone(concat('+', o_orderkey)) AS phone")


# --- places in texts: from SQL, and compared as intervals -----------------------------------------------------------
def _sql_places(t: str, pattern: str, group: int = 0) -> str:
    """A list of start, end and value of all matches (of a group that ends with its match)."""
    whole, parts, gaps = f"regexp_extract_all({t}, {_q(pattern)})", f"regexp_extract_all({t}, {_q(pattern)}, {group})", f"string_split_regex({t}, {_q(pattern)})"
    end = f"coalesce(list_sum(list_transform({gaps}[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform({whole}[1:i], lambda x: length(x))), 0)::BIGINT"
    return f"list_transform(range(1, len({whole}) + 1), lambda i: {{'s': {end} - length({parts}[i]), 'e': {end}, 'v': {parts}[i]}})"


@query(f"""WITH d AS (SELECT doc_id, text AS t FROM documents), e AS (SELECT doc_id, 'email address' AS label, 'EMAIL_ADDRESS' AS entity, unnest({_sql_places('t', EMAIL_RE2)}) AS x FROM d),
    c AS (SELECT doc_id, 'credit card number' AS label, 'CREDIT_CARD' AS entity, unnest(list_filter({_sql_places('t', CARD_RE2, 1)}, lambda y: {sql_luhn('y.v')})) AS x FROM d)
    SELECT doc_id, label, entity, x.s::INT AS span_start, x.e::INT AS span_end, 1.0::DOUBLE AS score, x.v AS value FROM (SELECT * FROM e UNION ALL SELECT * FROM c)""")
def sql_detect_spans(spark, sf_dir):
    """The table function in a query of SQL, over whole texts."""
    sqlfuncs.register_spans(spark)
    hits = 'SELECT d.doc_id, s.label, s.entity, s.start AS span_start, s.end AS span_end, s.score, s.value FROM {docs} d, LATERAL detect_spans(d.text) s WHERE s.entity IN ("EMAIL_ADDRESS", "CREDIT_CARD")'
    return spark.sql(hits, docs=table(spark, sf_dir, "documents"))


# Looser readings of the same places, as gold: what stands around an at sign, and digits in groups after a plus sign.
_AROUND_AT, _PLUS_GROUPS = r"[^ \n\t@]+@[^ \n\t@]+", r"\+[0-9][0-9().-]*(?: [0-9().-]+)*"
_SPAN_SETS = {"p": (EMAIL_RE2, PHONE_RE2), "g": (_AROUND_AT, _PLUS_GROUPS)}
_SPANS_SQL = ", ".join(
    f"{name} AS (SELECT DISTINCT doc_id, label, x.s AS s, x.e AS e FROM (SELECT doc_id, 'email address' AS label, unnest({_sql_places('text', email)}) AS x FROM documents UNION ALL SELECT doc_id, 'phone number' AS label, unnest({_sql_places('text', phone)}) AS x FROM documents))"
    for name, (email, phone) in _SPAN_SETS.items()
)


@query(f"""WITH {_SPANS_SQL}, o AS (SELECT p.label, p.doc_id AS d, p.s AS ps, p.e AS pe, g.s AS gs, g.e AS ge FROM p JOIN g ON p.doc_id = g.doc_id AND p.label = g.label AND p.s < g.e AND g.s < p.e),
    c AS (SELECT label, count(*) AS n_predicted FROM p GROUP BY label), k AS (SELECT label, count(*) AS n_gold FROM g GROUP BY label),
    m AS (SELECT label, count(DISTINCT (d, ps, pe)) AS predicted_met, count(DISTINCT (d, gs, ge)) AS gold_met, count(*) FILTER (ps = gs AND pe = ge) AS exact FROM o GROUP BY label)
    SELECT label, n_predicted, n_gold, exact, predicted_met, gold_met, round(2 * exact / (n_predicted + n_gold), 6) AS exact_f1,
        round(2 * (predicted_met / n_predicted) * (gold_met / n_gold) / (predicted_met / n_predicted + gold_met / n_gold), 6) AS overlap_f1 FROM c JOIN k USING (label) JOIN m USING (label)""")
def eval_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def found(email: str, phone: str) -> DataFrame:
        kinds = [docs.select("doc_id", F.lit(label).alias("label"), F.explode(T.spans(F.col("text"), pattern)).alias("x")) for label, pattern in (("email address", email), ("phone number", phone))]
        return kinds[0].unionByName(kinds[1]).select("doc_id", "label", "x.start", "x.end")

    done = evaluate.span_scores(found(T.EMAIL, T.INTL_PHONE), found(*_SPAN_SETS["g"]))
    return done.withColumns({c: F.round(c, 6) for c in ("exact_f1", "overlap_f1")})


# --- words near a hit ---------------------------------------------------------------------------------------------------
_NEAR_NOTE = "concat(CASE o_orderkey % 3 WHEN 0 THEN 'Bank of ours, please: ' WHEN 1 THEN 'part no. ' ELSE 'the ACCOUNT is one that nobody in this long note will ever miss, ' END, lpad(cast(o_orderkey % 1000 as string), 3, '0'), '-', lpad(cast(o_custkey % 1000 as string), 3, '0'), CASE WHEN o_orderkey % 4 = 0 THEN ' (branch)' ELSE ' end' END)"
_NEAR_SQL = _NEAR_NOTE.replace("cast(o_orderkey % 1000 as string)", "(o_orderkey % 1000)::VARCHAR").replace("cast(o_custkey % 1000 as string)", "(o_custkey % 1000)::VARCHAR")


@query(f"""WITH n AS (SELECT o_orderkey, {_NEAR_SQL} AS t FROM orders), p AS (SELECT *, string_split_regex(t, '[0-9]+-[0-9]+') AS gaps FROM n),
    w AS (SELECT *, list_reverse(regexp_extract_all(lower(gaps[1]), '[a-z0-9]+')) AS a, regexp_extract_all(lower(gaps[2]), '[a-z0-9]+') AS b FROM p)
    SELECT o_orderkey, 0.5::DOUBLE AS plain_score, CASE WHEN list_has_any(a[1:5], ['bsb', 'branch', 'bank', 'account']) OR list_has_any(b[1:5], ['bsb', 'branch', 'bank', 'account']) THEN 0.85 ELSE 0.5 END::DOUBLE AS score FROM w""")
def context_of_numbers(spark, sf_dir):
    """Branch numbers with and without the words that make them likely, at most five words away."""
    notes = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_NEAR_NOTE).alias("note"))
    only = [r for r in recognisers.RECOGNISERS if r.context]
    plain, near = (F.get(recognisers.spans(F.col("note"), only, near=n), F.lit(0))["score"] for n in (None, 5))
    return notes.select("o_orderkey", plain.alias("plain_score"), F.round(near, 6).alias("score"))


# --- distinct values from sketches --------------------------------------------------------------------------------------
@query("SELECT source, count(DISTINCT w) AS n_exact, true AS within_bound, true AS merged_agrees FROM (SELECT source, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY ROLLUP (source)")
def distinct_by_source(spark, sf_dir):
    """Distinct blank-separated words of each source and of all: sketches by language and source are kept, and merged to both, against exact counts."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select("lang", "source", F.explode(F.split("text", " ")).alias("w"))
    kept = written(report.distinct_sketches(words, ["lang", "source"], "w"))
    merged = report.distinct_counts(report.merged_sketches(kept, ["source"])).unionByName(report.distinct_counts(report.merged_sketches(kept, [])).withColumn("source", F.lit(None).cast("string")))
    direct = report.distinct_counts(report.distinct_sketches(words, ["source"], "w")).withColumnRenamed("n_distinct", "n_direct")
    direct = direct.unionByName(report.distinct_counts(report.distinct_sketches(words, [], "w")).select(F.lit(None).cast("string").alias("source"), F.col("n_distinct").alias("n_direct")))
    seen = words.groupBy("source", "w").agg(F.lit(1).alias("one"))
    exact = seen.groupBy("source").agg(F.count("w").alias("n_exact")).unionByName(words.select("w").distinct().agg(F.count("w").alias("n_exact")).withColumn("source", F.lit(None).cast("string")))
    same = lambda df, other: df.join(other, F.col("s").eqNullSafe(other["source"])).drop(other["source"])
    out = same(same(exact.withColumnRenamed("source", "s"), merged), direct)
    off = lambda c: F.abs(F.col(c) - F.col("n_exact"))
    near = off("n_distinct") <= report.error_bound(F.col("n_exact"))
    alike = F.abs(F.col("n_distinct") - F.col("n_direct")) <= F.ceil(report.error_bound(F.col("n_exact")) / 2)
    return out.select(F.col("s").alias("source"), "n_exact", near.alias("within_bound"), alike.alias("merged_agrees"))


# --- users and their levels over time ---------------------------------------------------------------------------------
_EVENT_NOTE = "CASE WHEN value > 200 THEN concat('card 4111111111111111 of u', user_id) WHEN value > 60 THEN concat('write to u', user_id, '@example.org') ELSE event_type END"
_EVENT_RANK = "CASE WHEN value > 200 THEN 2 WHEN value > 60 THEN 1 ELSE 0 END"


def _levelled_events(events: DataFrame) -> DataFrame:
    """event_id, user_id, ts, level and level_rank of events, of which some have personal data in a note made of them."""
    noted = events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.expr(_EVENT_NOTE).alias("note"))
    done = classify_stream(noted, "note").select("event_id", "user_id", "ts", "level")
    return done.withColumn("level_rank", rules.rank(F.col("level")))


@query(f"""WITH r AS (SELECT user_id, ts, max({_EVENT_RANK})::INT AS level_rank FROM events GROUP BY ALL)
    SELECT e.event_id, e.user_id, r.ts AS known_since, r.level_rank AS earlier_rank FROM events e ASOF LEFT JOIN r ON e.user_id = r.user_id AND e.ts > r.ts""")
def asof_user_level(spark, sf_dir):
    """Each event with the level that its user's latest earlier event had."""
    events = _levelled_events(table(spark, sf_dir, "events")).withColumn("seen", F.col("ts"))
    done = asof_join(events.select("event_id", "user_id", "ts"), events, ["user_id"], "ts", {"earlier_rank": "level_rank", "known_since": "seen"}, strict=True)
    return done.select("event_id", "user_id", F.col("known_since").cast("timestamp_ntz").alias("known_since"), "earlier_rank")


@query(f"""WITH r AS (SELECT user_id, ts, max({_EVENT_RANK}) AS rank FROM events GROUP BY ALL), g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 1 day THEN 1 ELSE 0 END AS anew FROM r),
    s AS (SELECT *, sum(anew) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM g), b AS (SELECT *, coalesce(max(rank) OVER (PARTITION BY user_id, run ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rank_before FROM s)
    SELECT user_id, ts, rank_before::INT AS rank_before, rank::INT AS rank FROM b WHERE rank > rank_before""")
def stream_escalations(spark, sf_dir):
    """A row each time a user's level rises above all levels since the user's last day of silence."""
    rows = _levelled_events(_streamed(spark, sf_dir)).select("user_id", "ts", F.col("level_rank").alias("rank"))
    return _appended(escalations(rows, "user_id", "ts", "rank", timedelta(days=1))).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(f"""WITH g AS (SELECT user_id, ts, {_EVENT_RANK} AS rank, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 12 hour THEN 0 ELSE 1 END AS anew FROM events),
    s AS (SELECT *, sum(anew) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM g), f AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 12 hour AS session_end, count(*) AS n, max(rank)::INT AS rank FROM s GROUP BY user_id, run)
    SELECT user_id, session_start, session_end, n, rank FROM f WHERE {_closed('session_end', '1 hour')}""")
def stream_sessions(spark, sf_dir):
    """Sessions of users with the highest level in each, put out when they are over."""
    rows = _levelled_events(_streamed(spark, sf_dir)).select("user_id", "ts", F.col("level_rank").alias("rank"))
    return _appended(sessions(rows, "user_id", "ts", "rank", "12 hours")).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
