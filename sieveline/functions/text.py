"""Text cells and the pattern tests on them, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType

from sieveline.labels import STREET_WORDS

# Patterns, for Java.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"  # a run of letters without @ is read once
SOME_EMAIL = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CARD = r"(?<![\d-])(?:\d[ -]?){13,19}(?<=\d)"
INTL_PHONE = r"\+\d[\d \-().]{6,}\d"
IPV4_SHAPE = r"^\s*\d{1,3}(\.\d{1,3}){3}\s*$"
DATE_SEPARATOR = r"\d[/.\-]\d"
WORD_OF_THREE = r"[A-Za-z]{3,}"
STREET = rf"(?iU)\b({'|'.join(STREET_WORDS)})\b"
LETTER = r"\p{IsAlphabetic}"


def as_text(c: Column, kind: DataType) -> Column:
    """A cell as text: null, and NaN in a column of floats, are empty; booleans read True and False; others as Spark casts them."""
    text = c.cast("string")
    if isinstance(kind, BooleanType):
        text = F.initcap(text)
    if isinstance(kind, FloatType | DoubleType):
        text = F.when(F.isnan(c), "").otherwise(text)
    return F.coalesce(text, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space, in Unicode's sense, at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def n_digits(c: Column) -> Column:
    return F.length(digits(c))


def has_letter(c: Column) -> Column:
    return c.rlike(LETTER)


def has_email(c: Column) -> Column:
    return c.contains("@") & c.rlike(SOME_EMAIL)


def card_candidates(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(CARD), F.lit(0))


def phone_candidates(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(INTL_PHONE), F.lit(0))


def luhn(c: Column) -> Column:
    """13 to 19 digits, other characters aside, with a right check digit."""
    return n_digits(c).between(13, 19) & F.call_function("luhn_check", digits(c))


def has_card(c: Column) -> Column:
    return c.rlike(r"\d") & F.exists(card_candidates(c), luhn)


def has_intl_phone(c: Column) -> Column:
    return c.contains("+") & F.exists(phone_candidates(c), lambda x: n_digits(x).between(8, 15))


def looks_like_phone(c: Column) -> Column:
    return c.contains("+") & n_digits(c).between(8, 13)


#: Items of a block in `folded`.
BLOCK = 64


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def array_of(words: Sequence[str]) -> Column:
    """A literal array of words."""
    return F.expr("array(" + ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words) + ")")


def folded(items: Column, start: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Folds an array from the left: step(state, item) gives the next state and an array<kind> of what comes out; all of it, in order.

    Growing an array copies it, so items are folded in blocks of BLOCK and the blocks' output is put together once.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def one(acc: Column, x: Column) -> Column:
        state, out = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["out"], out).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return named(done, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    def blocks(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int")), lambda b: F.slice(xs, b * BLOCK + 1, BLOCK))

    nothing = F.struct(start.alias("state"), F.expr(f"cast(array() as array<array<{kind}>>)").alias("out"))
    return named(items, lambda xs: F.when(F.size(xs) > 0, F.flatten(F.aggregate(blocks(xs), nothing, block, lambda acc: acc["out"]))).otherwise(none))


SPAN = "struct<start: int, end: int, value: string>"


def spans(c: Column, pattern: str) -> Column:
    """start, end (exclusive, in characters) and value of each match, from the lengths of gaps and matches."""
    pieces = F.arrays_zip(F.split(c, pattern, -1).alias("gap"), F.regexp_extract_all(c, F.lit(pattern), F.lit(0)).alias("value"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["gap"])
        end = start + F.length(F.coalesce(x["value"], F.lit("")))
        here = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return end, F.when(x["value"].isNull(), F.expr(f"cast(array() as array<{SPAN}>)")).otherwise(F.array(here))

    return F.when(c.rlike(pattern), folded(pieces, F.lit(0), SPAN, step)).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))
