"""The library in SQL: temporary functions whose bodies are Catalyst expressions, and the table function detect_spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from sieveline import labels as L
from sieveline.functions import checksums
from sieveline.functions.recognisers import DEFAULT_SCORE, RECOGNISERS, Recogniser
from sieveline.functions.rules import quoted, rank_sql
from sieveline.functions.text import BLOCK


def register(spark: SparkSession) -> None:
    """sensitivity_level(labels), sensitivity_rank(level), luhn_ok(text), n_digits(text), looks_like_phone(text) and those of register_spans."""
    levels = f"array({', '.join(map(quoted, L.LEVELS))})"
    made = {
        "sensitivity_level(found ARRAY<STRING>) RETURNS STRING": f"get({levels}, {rank_sql('found')})",
        "sensitivity_rank(level STRING) RETURNS INT": f"cast(array_position({levels}, level) - 1 as int)",
        "n_digits(value STRING) RETURNS INT": "length(regexp_replace(value, '[^0-9]', ''))",
        "luhn_ok(value STRING) RETURNS BOOLEAN": "length(regexp_replace(value, '[^0-9]', '')) BETWEEN 13 AND 19 AND luhn_check(regexp_replace(value, '[^0-9]', ''))",
        "looks_like_phone(value STRING) RETURNS BOOLEAN": "contains(value, '+') AND length(regexp_replace(value, '[^0-9]', '')) BETWEEN 8 AND 13",
    }
    for head, body in made.items():
        _create(spark, head, body)
    register_spans(spark)


def _create(spark: SparkSession, head: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


_PLACE = "struct<start: int, end: int, value: string>"
_NONE = "cast(array() as array<struct<label: string, entity: string, start: int, end: int, score: double, value: string>>)"


def _places_sql(pattern: str) -> str:
    """Start, end and value of each hit in `text`, from the gaps around them (`0`) and the hits (`1`): one pass, in blocks of BLOCK, since an array is copied as it grows."""
    here = "named_struct('start', s.at + length(x.`0`), 'end', s.at + length(x.`0`) + length(x.`1`), 'value', x.`1`)"
    one = f"(s, x) -> named_struct('at', s.at + length(x.`0`) + length(coalesce(x.`1`, '')), 'out', if(x.`1` IS NULL, s.out, concat(s.out, array({here}))))"
    block = f"aggregate(part, named_struct('at', acc.at, 'out', cast(array() as array<{_PLACE}>)), {one})"
    more = "named_struct('at', r.at, 'out', concat(acc.out, array(r.out)))"
    blocks = f"transform(sequence(0, cast((size(z) - 1) div {BLOCK} as int)), b -> slice(z, b * {BLOCK} + 1, {BLOCK}))"
    fold = f"aggregate({blocks}, named_struct('at', 0, 'out', cast(array() as array<array<{_PLACE}>>)), (acc, part) -> transform(array({block}), r -> {more})[0], acc -> flatten(acc.out))"
    return f"transform(array(arrays_zip(split(text, {_raw(pattern)}, -1), regexp_extract_all(text, {_raw(pattern)}, 0))), z -> {fold})[0]"


def _raw(pattern: str) -> str:
    """A pattern as SQL text in which a backslash is itself."""
    return 'r"' + pattern.replace('"', r"\x22") + '"'


def _hits_sql(r: Recogniser) -> str:
    found = _places_sql(r.pattern)
    if r.check is not None:
        found = f"filter({found}, s -> transform(array(upper(regexp_replace(s.value, '[^A-Za-z0-9]', ''))), v -> {checksums.SQL[r.check]('v')})[0])"
    row = f"named_struct('label', {_text(r.label)}, 'entity', {_text(r.entity)}, 'start', s.start, 'end', s.end, 'score', double({r.score}), 'value', s.value)"
    return f"CASE WHEN text RLIKE {_raw(r.pattern)} THEN transform({found}, s -> {row}) ELSE {_NONE} END"


def _text(s: str | None) -> str:
    return "cast(null as string)" if s is None else '"' + s.replace('"', '\\"') + '"'


def register_spans(spark: SparkSession, registry: Sequence[Recogniser] = RECOGNISERS, least: float = DEFAULT_SCORE) -> None:
    """The table function detect_spans(text): a row (label, entity, start, end, score, value) for each hit.

    The hits are those of the enabled recognisers that have a label and at least that score; use it with LATERAL. Its body is a projection with a
    generator over the outer row: no Python, no shuffle. A null text has no rows.
    """
    active = [r for r in registry if r.enabled and r.label and r.score >= least]
    head = "detect_spans(text STRING) RETURNS TABLE(label STRING, entity STRING, start INT, end INT, score DOUBLE, value STRING)"
    every = ", ".join(map(_hits_sql, active)) or _NONE
    _create(spark, head, f"SELECT h.label, h.entity, h.start, h.end, h.score, h.value FROM (SELECT explode(flatten(array({every}))) AS h)")
