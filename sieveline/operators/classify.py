"""Classification of text columns: elements and level of each cell, level and review flag of each row.

Built in staged selects, so that Catalyst keeps the pattern work of a stage in one projection and later stages only refer to it; levels
are ranks until the last one. Without an extractor the plan is one JVM projection: no Python, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline import labels as L
from sieveline.functions import recognisers as R
from sieveline.functions import rules, validate
from sieveline.functions.text import array_of, as_text
from sieveline.operators.extract import Backend, fresh, with_entities

NOTHING = "cast(map() as map<string, array<string>>)"


def _own(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _checked(df: DataFrame, columns: str | Sequence[str], made: Callable[[list[str]], list[str]]) -> tuple[list[str], list[str], list[str]]:
    """The text columns, the result columns, and the columns of df that stay beside them."""
    names = [columns] if isinstance(columns, str) else list(columns)
    for name in names:
        if name not in df.columns:
            raise KeyError(f"no column {name!r} to classify; the table has {', '.join(df.columns)}")
    results = made(names)
    for c in df.columns:
        if c not in results and c.lower() in {r.lower() for r in results}:
            raise ValueError(f"column {c!r} differs from a result column only in case")
    return names, results, [c for c in df.columns if c not in results]


def sides(text: Column, entities: Column, hybrid: bool, check: bool = True) -> tuple[Column, Column]:
    """Labels that the contextual side finds and labels that the structured side finds (none on the base path)."""
    found = validate.found_labels(entities, check)
    if not hybrid:
        return F.array_sort(F.array_union(found, R.backstop(text))), F.expr("cast(array() as array<string>)")
    fuzzy = F.array_except(F.array_union(found, R.phone_backstop(text)), array_of(L.SUPPRESSED))
    return F.array_sort(fuzzy), R.elements(text)


def _judged(df: DataFrame, names: list[str], keep: list[str], make, hybrid: bool, threshold: float, check: bool, batch_size: int | None, max_chars: int | None, thresholds: dict[str, float] | None) -> tuple[DataFrame, list[dict[str, str]]]:
    """The columns `keep` and, for each text column, the names of columns of its entities, of both sides' labels, of all its labels and of the ranks of the three."""
    parts = ("text", "entities", "fuzzy", "structured", "all", "rank", "fuzzy_rank", "structured_rank")
    own = fresh(df.columns, [f"{p}_{k}" for k in range(len(names)) for p in parts])
    at = [dict(zip(parts, own[k * len(parts) :])) for k in range(len(names))]
    if not names:
        return df.select(*_own(keep)), at
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = {a["text"]: as_text(F.col(f"`{c}`"), kinds[c]) for a, c in zip(at, names)}
    df = df.select(*_own(keep), *[(F.substring(v, 1, max_chars) if max_chars else v).alias(n) for n, v in texts.items()])
    if make is None:
        df = df.withColumns({a["entities"]: F.expr(NOTHING) for a in at})
    else:
        df = with_entities(df, {a["text"]: a["entities"] for a in at}, make, L.HYBRID_PASSES if hybrid else L.BASE_PASSES, threshold, batch_size, thresholds)
    found = []
    for a in at:
        fuzzy, structured = sides(F.col(a["text"]), F.col(a["entities"]), hybrid, check)
        found += [fuzzy.alias(a["fuzzy"]), structured.alias(a["structured"])]
    df = df.select(*_own(keep), *[F.col(a["entities"]) for a in at], *found)
    df = df.withColumns({a["all"]: F.array_sort(F.array_union(a["fuzzy"], a["structured"])) if hybrid else F.col(a["fuzzy"]) for a in at})
    ranked = {a["rank"]: rules.rank_of(F.col(a["all"])) for a in at}
    if hybrid:
        ranked |= {a[f"{side}_rank"]: rules.rank_of(F.col(a[side])) for a in at for side in ("fuzzy", "structured")}
    return df.withColumns(ranked), at


def _review(a: dict[str, str]) -> Column:
    return rules.review_of_ranks(*[F.col(a[x]) for x in ("rank", "fuzzy_rank", "structured_rank")])


def classify_columns(df: DataFrame, columns: str | Sequence[str], mode: str = "base", extractor: Callable[[], Backend] | None = None, threshold: float = L.DEFAULT_THRESHOLD, validate_values: bool = True, batch_size: int | None = None, max_chars: int | None = None, thresholds: dict[str, float] | None = None) -> DataFrame:
    """df and, for each column c, c_level and c_elements (hybrid: c_needs_review), and level (hybrid: needs_review) of the row.

    `thresholds` overrides the threshold of single labels.
    """
    if mode not in ("base", "hybrid"):
        raise ValueError(f"mode is base or hybrid, not {mode!r}")
    hybrid = mode == "hybrid"
    fields, whole = ("level", "elements", *["needs_review"] * hybrid), ("level", *["needs_review"] * hybrid)
    names, _, keep = _checked(df, columns, lambda cs: [f"{c}_{x}" for c in cs for x in fields] + list(whole))
    out, at = _judged(df, names, keep, extractor, hybrid, threshold, validate_values, batch_size, max_chars, thresholds)
    cells = []
    for c, a in zip(names, at):
        cells += [rules.level_at(F.col(a["rank"])).alias(f"{c}_level"), F.col(a["all"]).alias(f"{c}_elements")]
        cells += [_review(a).alias(f"{c}_needs_review")] * hybrid
    row = [rules.highest([F.col(a["rank"]) for a in at]).alias("level")]
    row += [rules.any_of([_review(a) for a in at]).alias("needs_review")] * hybrid
    return out.select(*_own(keep), *cells, *row)


def classify_column(df: DataFrame, column: str, **options) -> DataFrame:
    """df with level and elements of one column."""
    done = classify_columns(df, [column], **options)
    return done.withColumnRenamed(f"{column}_elements", "elements").drop(f"{column}_level")


def explain_text(df: DataFrame, column: str, mode: str = "base", extractor: Callable[[], Backend] | None = None, threshold: float = L.DEFAULT_THRESHOLD, validate_values: bool = True, name: str = "explained", batch_size: int | None = None, max_chars: int | None = None, thresholds: dict[str, float] | None = None) -> DataFrame:
    """df and a struct of level, rank, elements, reasons and entities (hybrid: structured and needs_review) of one column."""
    hybrid = mode == "hybrid"
    names, _, keep = _checked(df, column, lambda _: [name])
    out, (a,) = _judged(df, names, keep, extractor, hybrid, threshold, validate_values, batch_size, max_chars, thresholds)
    (x,) = fresh(out.columns, ["x"])
    out = out.withColumn(x, rules.explain(F.col(a["all"])))
    fields = [F.col(f"{x}.{n}").alias(n) for n in ("level", "rank", "elements", "reasons")]
    fields.append(validate.project(F.col(a["entities"]), F.col(a["all"])).alias("entities"))
    if hybrid:
        fields += [F.array_sort(a["structured"]).alias("structured"), _review(a).alias("needs_review")]
    return out.select(*_own(keep), F.struct(*fields).alias(name))
