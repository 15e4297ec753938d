"""The queries of this subpackage: thin views on its operators, by name."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe, curriculum, fim, hilbert_ann, lm_bloom, merkle, minmax_dedup, pii, quality_gbdt, quality_rules, secret_scan, suffix_dedup, toxicity

#: The session setting that holds the key of surrogates, a secret; the queries' tests need none.
PII_KEY, NO_SECRET = "spark.sieveline.pii.key", "not a secret"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get(PII_KEY, NO_SECRET))
    count = lambda *kinds: F.size(F.filter(F.coalesce("__found", F.array()), lambda s: s["kind"].isin(*kinds))).cast("long")
    names = ("given_f", "given_m", "given_u", "surname")
    return done.select("doc_id", count(*pii.KINDS).alias("n_entities"), count("email").alias("n_emails"), count("phone").alias("n_phones"), count("card", "account", "iban", "ssn").alias("n_numbers"), count("ip").alias("n_ips"), count(*names).alias("n_names"), "text")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.search(table(spark, sf_dir, "embeddings"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbdt.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.components(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(toxicity.held_out(is_=1), F.lit(False))
    scored = lm_bloom.score(docs, train=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "passes", F.round("position", 9).alias("position")).orderBy("position", "doc_id")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = found.withColumn("base", F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE)))
    return base.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"), secret_scan.listed("spans").alias("spans"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return done.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("fim")
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", *[x[c].alias(c) for c in ("n", "form", "prefix_chars", "middle_chars")], F.sha2(x["output"], 256).alias("output_sha256"), F.sha2(fim.restored(x["output"], x["form"]), 256).alias("restored_sha256"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1,
    "op2_pii_surrogates": op2,
    "op3_hilbert_ann": op3,
    "op4_quality_gbdt": op4,
    "op5_minmax_dedup": op5,
    "op6_zstd_toxicity": op6,
    "op7_bloom_lm": op7,
    "op8_curriculum_mix": op8,
    "op9_trigram_secrets": op9,
    "op10_byte_bpe": op10,
    "op11_merkle_manifest": op11,
    "op12_fill_in_middle": op12,
    "op13_suffix_dedup": op13,
}


# --- the same rows in DuckDB's SQL ---------------------------------------------------------------------
_W = r"[^\x20\x09-\x0D]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rules_sql() -> str:
    rules = quality_rules.RULES
    votes = ", ".join(f"(CASE WHEN {bad} THEN 0 WHEN {good or 'false'} THEN 1 ELSE 2 END) AS v_{name}" for name, (bad, good) in rules.items())
    names = ", ".join(f"v_{name}" for name in rules)
    long = " UNION ALL ".join(f"SELECT pid, n, {_q(name)} AS rule, v_{name} AS vote FROM p" for name in rules)
    q = quality_rules
    believed = lambda wrong: f"{q.BELIEVED} * (m / CASE WHEN vote = {wrong} THEN {q.TRUST} ELSE 1 END) / sum(m / CASE WHEN vote = {wrong} THEN {q.TRUST} ELSE 1 END) OVER (PARTITION BY rule)"
    steps = [f"t0 AS (SELECT rule, vote, ln(gp / {q.BELIEVED}) - ln(bp / {q.BELIEVED}) AS lr, ln({q.PRIOR[0]}.0 / {q.PRIOR[1] - q.PRIOR[0]}) AS odds FROM grid)"]
    for k in range(q.ROUNDS):
        steps.append(f"e{k} AS MATERIALIZED (SELECT pid, any_value(n) AS n, 1 / (1 + exp(-(any_value(odds) + sum(lr)))) AS g FROM long JOIN t{k} USING (rule, vote) GROUP BY pid)")
        steps.append(f"c{k} AS (SELECT rule, vote, any_value(gp) + coalesce(sum(g * e{k}.n), 0) AS sg, any_value(bp) + coalesce(sum((1 - g) * e{k}.n), 0) AS sb FROM grid LEFT JOIN long USING (rule, vote) LEFT JOIN e{k} USING (pid) GROUP BY rule, vote)")
        steps.append(f"o{k} AS (SELECT (coalesce(sum(g * n), 0) + {q.PRIOR[0]}) / (coalesce(sum(n), 0) + {q.PRIOR[1]}) AS prior FROM e{k})")
        steps.append(f"s{k} AS (SELECT rule, vote, prior, sg / sum(sg) OVER (PARTITION BY rule) AS a, sb / sum(sb) OVER (PARTITION BY rule) AS b FROM c{k}, o{k})")
        low = f"CASE WHEN vote = 0 AND b < {q.LEAST_BAD} * a THEN (prior * a + (1 - prior) * b) / (prior + (1 - prior) * {q.LEAST_BAD}) WHEN vote = 1 AND a < {q.LEAST_GOOD} * b THEN (prior * a + (1 - prior) * b) / (1 - prior + prior * {q.LEAST_GOOD}) END"
        steps.append(f"l{k} AS (SELECT *, {low} AS low FROM s{k})")
        steps.append(f"h{k} AS (SELECT rule, vote, prior, CASE WHEN low IS NULL THEN a WHEN vote = 0 THEN low ELSE {q.LEAST_GOOD} * low END AS a, CASE WHEN low IS NULL THEN b WHEN vote = 0 THEN {q.LEAST_BAD} * low ELSE low END AS b FROM l{k})")
        steps.append(f"t{k + 1} AS MATERIALIZED (SELECT rule, vote, ln(a / sum(a) OVER (PARTITION BY rule)) - ln(b / sum(b) OVER (PARTITION BY rule)) AS lr, ln(prior / (1 - prior)) AS odds FROM h{k})")
    last = quality_rules.ROUNDS
    return rf"""WITH a AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_q(_W)}) AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
    b AS (SELECT *, row_number() OVER () AS id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS ws FROM a),
    x AS (SELECT id, unnest(ws) AS g, unnest(range(1, len(ws) + 1)) AS i FROM b), often AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS k FROM x) WHERE k > 1),
    covered AS (SELECT id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words FROM (SELECT id, i, lead(i) OVER (PARTITION BY id ORDER BY i) AS nxt FROM often) GROUP BY id),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines, len(list_distinct(w))::BIGINT AS n_distinct, len(regexp_extract_all(t, '\p{{Lu}}'))::BIGINT AS n_capitals,
        length(regexp_replace(t, '[^\p{{L}}]+', '', 'g'))::BIGINT AS n_letters, len(regexp_extract_all(t, '[!?.,;:]'))::BIGINT AS n_marks, coalesce(n_repeat_words, 0) AS n_repeat_words FROM b LEFT JOIN covered USING (id)),
    v AS MATERIALIZED (SELECT *, {votes} FROM m), p AS MATERIALIZED (SELECT row_number() OVER () AS pid, {names}, count(*) AS n FROM v GROUP BY {names}), long AS MATERIALIZED ({long}),
    common AS (SELECT rule, vote, coalesce(sum(n), 0) / greatest((SELECT coalesce(sum(n), 0) FROM p), 1) + 1e-9 AS m FROM (SELECT rule, vote FROM (SELECT unnest([{", ".join(map(_q, rules))}]) AS rule), range(3) r(vote)) LEFT JOIN long USING (rule, vote) GROUP BY rule, vote),
    grid AS MATERIALIZED (SELECT rule, vote, {believed(0)} AS gp, {believed(1)} AS bp FROM common), {', '.join(steps)},
    post AS (SELECT pid, 1 / (1 + exp(-(any_value(odds) + sum(lr)))) AS g FROM long JOIN t{last} USING (rule, vote) GROUP BY pid),
    f AS (SELECT v.*, g, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed FROM v JOIN p USING ({names}) JOIN post USING (pid))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND g >= {quality_rules.KEEP} AS kept FROM f"""


_NEAREST_SQL = """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL), n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v),
    p AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.e, b.e) / (a.l * b.l) AS score FROM n a JOIN n b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id WHERE a.l > 0 AND b.l > 0),
    r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM p) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_NEAR_COPIES_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_q(_W)}) AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
    z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS MATERIALIZED (SELECT x, y FROM c JOIN z zx ON zx.doc_id = x JOIN z zy ON zy.doc_id = y WHERE 100 * k >= 75 * (zx.n + zy.n - k)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN e ON b = x), m AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN m USING (doc_id) LEFT JOIN z USING (doc_id)"""

def _mix_sql() -> str:
    position = re.sub(r"(\d)D\b", r"\1", curriculum.schedule_position(curriculum.SCHEDULES, "place", "before / greatest(target, 1.0)"))
    limit = curriculum.LIMIT
    return f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_q(_W)}))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS draw FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source), w AS (SELECT *, [{', '.join(map(str, curriculum.WEIGHTS))}][place % {len(curriculum.WEIGHTS)} + 1] AS w FROM s),
    t AS (SELECT *, (sum(source_size) OVER () - {limit} * coalesce(sum(source_size) OVER (ORDER BY source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS spare,
        (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS weight, row_number() OVER (ORDER BY source_size / w, place) AS nth FROM w),
    f AS (SELECT *, {limit} * source_size * weight <= spare * w AS at_limit FROM t), g AS (SELECT *, arg_min(spare, nth) FILTER (NOT at_limit) OVER () AS a, arg_min(weight, nth) FILTER (NOT at_limit) OVER () AS b FROM f),
    goals AS (SELECT source, place, source_size, CASE WHEN at_limit THEN ({limit} * source_size)::DOUBLE ELSE a::DOUBLE * w / b END AS target FROM g),
    placed AS (SELECT d.*, place, source_size, target, floor(target)::BIGINT AS goal, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d JOIN goals ON d.source IS NOT DISTINCT FROM goals.source),
    k AS (SELECT *, CASE WHEN source_size > 0 THEN greatest(0, least({limit}, floor((goal - before - size)::DOUBLE / source_size) + 1))::BIGINT ELSE 0 END AS whole FROM placed),
    r AS (SELECT *, CASE WHEN whole < {limit} THEN greatest(0, least(size, goal - before - whole * source_size)) ELSE 0 END AS part FROM k), p AS (SELECT *, CASE WHEN size > 0 THEN whole + (part > 0)::BIGINT ELSE 0 END AS passes FROM r)
    SELECT doc_id, size, source_size, target, (whole * size + part)::BIGINT AS taken, passes::BIGINT AS passes, CASE WHEN passes > 0 THEN round({position}, 9) END AS position FROM p"""


def _secrets_sql() -> str:
    each = []
    for k, r in enumerate(secret_scan.RULES):
        at = lambda end: f"(list_sum(list_transform(gaps{k}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms{k}[1:i{end}], lambda x: length(x))), 0))::BIGINT"  # noqa: E731, B023
        one = f"{{'s': {at(' - 1')}, 'k': {k}, 'kind': {_q(r.kind)}, 'e': {at('')}}}"
        each.append(f"list_transform(list_filter(range(1, len(ms{k}) + 1), lambda i: length(regexp_extract(ms{k}[i], {_q(r.pattern)}, {r.group})) >= {r.least}), lambda i: {one})")
    parts = ", ".join(f"regexp_extract_all(t, {_q(r.pattern)}) AS ms{k}, string_split_regex(t, {_q(r.pattern)}) AS gaps{k}" for k, r in enumerate(secret_scan.RULES))
    text = lambda xs: f"array_to_string(list_transform({xs}, lambda x: x.kind || ':' || x.s || ':' || x.e), ',')"
    count = lambda kind: f"len(list_filter(spans, lambda x: x.kind = {_q(kind)}))::BIGINT AS n_{kind}"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (SELECT doc_id, {parts} FROM d), s AS (SELECT doc_id, list_sort(list_concat({', '.join(each)})) AS spans FROM m)
    SELECT doc_id, {count('assign')}, {count('access')}, {count('hex')}, sha256({text(f"list_filter(spans, lambda x: x.k < {len(secret_scan.BASE)})")}) AS base_sha256, {text('spans')} AS spans FROM s"""


def _crc32_sql(x: str) -> str:
    """The CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_concat([xor(c, b)], range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(range(1, length({x}) + 1), lambda i: ascii(substr({x}, i, 1))::BIGINT)), lambda c, b: {bits}), 4294967295)"


#: Levels that the SQL of the manifest has: for 8 ** 8 rows in a group, and 8 ** 4 groups.
_LEVELS = {"leaves": 8, "tops": 4}


def _tree_sql(name: str, start: str, by: str, levels: int) -> str:
    """name0 (start: by, k, node) to name<levels>, each with its nodes in runs of eight (name_r1 ...), and name_root."""
    out = [f"{name}0 AS MATERIALIZED ({start})"]
    for j in range(1, levels + 1):
        counted = f"SELECT *, count(*) OVER (PARTITION BY {by}) AS c FROM {name}{j - 1}"
        out.append(f"{name}_r{j} AS MATERIALIZED (SELECT {by}, k // {merkle.FANOUT} AS k, list(node ORDER BY k) AS run, any_value(c) AS c FROM ({counted}) GROUP BY {by}, k // {merkle.FANOUT})")
        out.append(f"{name}{j} AS MATERIALIZED (SELECT {by}, k, CASE WHEN c = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM {name}_r{j})")
    return ", ".join(out)


def _path_sql(name: str, source: str, by: str, levels: int) -> str:
    """The rows of `source` (by, k, own, proof) with what `name`'s runs add to the proof and make of own, as name_p."""
    out = [f"{name}_p0 AS (SELECT * FROM {source})"]
    for j in range(1, levels + 1):
        i = f"(k // {merkle.FANOUT ** (j - 1)}) % {merkle.FANOUT}"
        left, right = f"array_to_string(run[1:{i}], '')", f"array_to_string(run[{i} + 2:], '')"
        more = f"CASE WHEN c = 1 THEN own ELSE sha256({left} || own || {right}) END AS own, CASE WHEN c = 1 THEN proof ELSE proof || {left} || {right} END AS proof"
        joined = f"{name}_p{j - 1} p JOIN (SELECT {by} AS g, k AS spot, run, c FROM {name}_r{j}) r ON p.{by} IS NOT DISTINCT FROM g AND p.k // {merkle.FANOUT**j} = spot"
        out.append(f"{name}_p{j} AS MATERIALIZED (SELECT p.* REPLACE ({more}) FROM {joined})")
    return ", ".join(out)


def _manifest_sql() -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = f"sha256({' || '.join(map(field, merkle.FIELDS))})"
    changed = f"sha256({' || '.join(field(lower if c == 'text' else c) for c in merkle.FIELDS)})"
    a, b = _LEVELS["leaves"], _LEVELS["tops"]
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, lang, {leaf} AS leaf, CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {changed} ELSE {leaf} END AS own FROM documents),
    n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, '' AS proof FROM d),
    {_tree_sql('leaves', 'SELECT lang, k, leaf AS node FROM n', 'lang', a)}, {_path_sql('leaves', 'n', 'lang', a)},
    s AS MATERIALIZED (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS k, 0 AS one FROM leaves{a}),
    {_tree_sql('tops', 'SELECT one, k, subroot AS node FROM s', 'one', b)}, m AS (SELECT p.doc_id, p.leaf, p.own, p.proof, s.subroot, s.k, 0 AS one FROM leaves_p{a} p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang),
    {_path_sql('tops', 'm', 'one', b)}
    SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = node AS verified FROM tops_p{b}, tops{b}"""


def _fim_sql() -> str:
    p, s, m = map(_q, fim.MARKS)
    h = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT"
    joined = lambda part: f"array_to_string({part}, '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    c AS (SELECT *, len(u) AS n, least({h(0)} % (len(u) + 1), {h(1)} % (len(u) + 1)) AS a, greatest({h(0)} % (len(u) + 1), {h(1)} % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, {p}) OR contains(t, {s}) OR contains(t, {m}) OR {h(2)} % 100 >= {100 - fim.PLAIN_PERCENT} THEN 'plain' WHEN {h(3)} % 100 < {fim.SUFFIX_FIRST_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM d),
    x AS (SELECT doc_id, t, n, form, {joined('u[1:a]')} AS pre, {joined('u[a + 1:b]')} AS mid, {joined('u[b + 1:]')} AS suf FROM c)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN {p} || pre || {s} || suf || {m} || mid ELSE {s} || suf || {p} || pre || {m} || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM x"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": _rules_sql(),
    "op3_hilbert_ann": _NEAREST_SQL,
    "op5_minmax_dedup": _NEAR_COPIES_SQL,
    "op8_curriculum_mix": _mix_sql(),
    "op9_trigram_secrets": _secrets_sql(),
    "op11_merkle_manifest": _manifest_sql(),
    "op12_fill_in_middle": _fim_sql(),
}
