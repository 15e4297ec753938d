"""Structured recognisers: a pattern, an optional checksum and a score for each entity, and the label that it means."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions import checksums as C
from sieveline.functions import text as T
from sieveline.functions.context import words_away

DEFAULT_SCORE = 0.4
#: What a context word near a hit adds to its score, up to 1.
CONTEXT_BOOST = 0.35


@dataclass(frozen=True)
class Recogniser:
    """A match of `pattern` counts if `check` of its normal form holds; without a label it is reported but doesn't count.

    A word of `context` near a match raises its score, for callers that ask for that.
    """

    entity: str
    label: str | None
    pattern: str
    score: float
    check: Callable[[Column], Column] | None = None
    enabled: bool = True
    context: tuple[str, ...] = ()
    #: What every match has: a mark (an at sign, or two capitals before two digits), or so many digits with at most one blank or hyphen between two.
    needs: str | int = 1

    def holds(self, value: Column) -> Column:
        plain = F.upper(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
        return self.check(plain) if self.check else F.lit(True)

    def found(self, text: Column) -> Column:
        if self.check is None:
            return text.rlike(self.pattern)
        return text.rlike(self.pattern) & F.exists(F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0)), self.holds)


AT, CAPITALS = "@", "AA"
#: One pass over a text for all recognisers: at signs, pairs of capitals that two digits follow, and runs of digits.
MARKS = r"(?U)@|[A-Z]{2}(?=[0-9]{2})|\d(?:[ -]?\d)*"


def marks(text: Column) -> Column:
    """What a text has that recognisers need; nothing, for most texts, so that none of their own patterns runs."""
    return F.regexp_extract_all(text, F.lit(MARKS), F.lit(0))


def may_hold(r: Recogniser, found: Column) -> Column:
    """Whether a recogniser's pattern may match in a text with these marks."""
    if r.needs == AT:
        return F.array_contains(found, "@")
    if r.needs == CAPITALS:
        return F.exists(found, lambda m: m.rlike("^[A-Z]"))
    return F.exists(found, lambda m: F.length(F.regexp_replace(m, "[ -]", "")) >= r.needs)


def _numbers(grouped: str) -> str:
    return rf"(?U)\b{grouped}\b"


RECOGNISERS = (
    Recogniser("EMAIL_ADDRESS", "email address", T.EMAIL, 1.0, needs=AT),
    Recogniser("CREDIT_CARD", "credit card number", T.CARD, 1.0, C.card, needs=13),
    Recogniser("IBAN_CODE", "bank account number", r"(?U)\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", 1.0, C.iban, needs=CAPITALS),
    Recogniser("AU_BSB", "bank account number", _numbers(r"\d{3}-\d{3}"), 0.5, context=("bsb", "branch", "bank", "account"), needs=6),
    Recogniser("AU_TFN", "tax file number", _numbers(r"\d{3} ?\d{3} ?\d{3}"), 1.0, C.tfn, needs=9),
    Recogniser("US_SSN", "tax file number", _numbers(r"\d{3}-\d{2}-\d{4}"), 0.5, needs=9),
    Recogniser("AU_MEDICARE", "medicare number", _numbers(r"[2-6]\d{3} ?\d{5} ?\d"), 1.0, C.medicare, needs=10),
    Recogniser("AU_ABN", None, _numbers(r"\d{2} ?\d{3} ?\d{3} ?\d{3}"), 1.0, C.abn, needs=11),
    Recogniser("AU_ACN", None, _numbers(r"\d{3} ?\d{3} ?\d{3}"), 1.0, C.acn, needs=9),
    # Their patterns alone say too little: off unless asked for.
    Recogniser("US_BANK_NUMBER", "bank account number", _numbers(r"\d{8,17}"), 0.05, enabled=False, needs=8),
    Recogniser("US_ITIN", "tax file number", _numbers(r"9\d{2}-[5-9]\d-\d{4}"), 0.5, enabled=False, needs=9),
    Recogniser("US_PASSPORT", "passport number", _numbers(r"[A-Z]?\d{8,9}"), 0.05, enabled=False, needs=8),
    Recogniser("US_DRIVER_LICENSE", "driver's licence number", _numbers(r"[A-Z]\d{7,12}"), 0.05, enabled=False, needs=7),
)
#: Entities of businesses: reported on request, never scored.
BUSINESS = ("AU_ABN", "AU_ACN")


_HIT = "struct<label: string, start: int, end: int, score: double, value: string>"


def _active(registry: Sequence[Recogniser], least: float) -> list[Recogniser]:
    return [r for r in registry if r.enabled and r.score >= least]


def elements(text: Column, registry: Sequence[Recogniser] = RECOGNISERS, least: float = DEFAULT_SCORE) -> Column:
    """Sorted labels of the entities in a text; entities without a label are left out."""

    def told(found: Column) -> Column:
        by_label: dict[str, Column] = {}
        for r in _active(registry, least):
            if r.label:
                here = may_hold(r, found) & r.found(text)
                by_label[r.label] = by_label[r.label] | here if r.label in by_label else here
        return F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in sorted(by_label.items())]))

    return T.named(marks(text), lambda found: F.when(F.size(found) > 0, told(found)).otherwise(F.expr("cast(array() as array<string>)")))


def business_elements(text: Column, registry: Sequence[Recogniser] = RECOGNISERS) -> Column:
    """Which business identifiers a text holds."""
    return F.array_compact(F.array(*[F.when(r.found(text), F.lit(r.entity)) for r in registry if r.entity in BUSINESS]))


def spans(text: Column, registry: Sequence[Recogniser] = RECOGNISERS, least: float = DEFAULT_SCORE, near: int | None = None) -> Column:
    """label, start, end, score and value of every labelled hit, overlaps kept.

    With `near`, a hit of a recogniser that has context words scores CONTEXT_BOOST more if one of them is at most so many words away; the score
    that then results is held against `least`, so that weak recognisers can be made to need their context.
    """

    none = F.expr(f"cast(array() as array<{_HIT}>)")

    def hits(r: Recogniser) -> Column:
        kept = F.filter(T.spans(text, r.pattern), lambda s: r.holds(s["value"]))
        row = lambda s, score: F.struct(F.lit(r.label).alias("label"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"), s["value"].alias("value"))
        if near is None or not r.context:
            return F.transform(kept, lambda s: row(s, F.lit(r.score)))
        raised = F.lit(min(1.0, r.score + CONTEXT_BOOST))
        scored = lambda hs: F.zip_with(hs, words_away(text, hs, r.context), lambda s, away: row(s, F.when(away <= near, raised).otherwise(F.lit(r.score))))
        return F.filter(T.named(kept, lambda hs: F.when(F.size(hs) > 0, scored(hs)).otherwise(none)), lambda s: s["score"] >= least)

    reach = lambda r: min(1.0, r.score + CONTEXT_BOOST) if near is not None and r.context else r.score
    active = [r for r in registry if r.enabled and r.label and reach(r) >= least]
    if not active:
        return none
    every = lambda found: F.array_sort(F.concat(*[F.when(may_hold(r, found), hits(r)).otherwise(none) for r in active]))
    return T.named(marks(text), lambda found: F.when(F.size(found) > 0, every(found)).otherwise(none))


def backstop(text: Column) -> Column:
    """Labels that patterns alone tell: email, card and international phone."""
    hits = (("credit card number", T.has_card(text)), ("email address", T.has_email(text)), ("phone number", T.has_intl_phone(text)))
    return F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in hits]))


def phone_backstop(text: Column) -> Column:
    return F.array_compact(F.array(F.when(T.has_intl_phone(text), F.lit("phone number"))))
