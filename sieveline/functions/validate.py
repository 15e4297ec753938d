"""Format validation of extracted values, and the labels that survive it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline import labels as L
from sieveline.functions import text as T


def is_name(value: Column) -> Column:
    """Whether a value extracted as a person may be a name: no stopword, noun, role or number, as a whole or in any token."""
    v = T.strip(value)
    low = F.lower(v)
    tokens = F.split(T.strip(F.regexp_replace(low, "-", " ")), r"(?U)\s+")
    junk = T.array_of(sorted({*L.STOPWORDS, *L.NOT_NAMES, *L.ROLES}))
    return ~(F.array_contains(T.array_of([*L.STOPWORDS, *L.NOT_NAMES]), low) | v.rlike("^[0-9]+$") | F.arrays_overlap(tokens, junk))


def is_valid(label: Column, value: Column) -> Column:
    """Whether a value may be what its label says. Values shorter than 2 never are; labels without a rule accept the others."""
    v = T.strip(value)
    d, letter, n = T.n_digits(v), T.has_letter(v), F.length(v)
    domain = F.element_at(F.split(v, "@", -1), -1)
    plain = ~letter & ~v.contains(":") & ~v.contains(",")
    rules = [
        (L.NAME, is_name(v)),
        (("email address",), v.contains("@") & domain.contains(".")),
        (("phone number",), plain & ~v.rlike(T.IPV4_SHAPE) & d.between(7, 14)),
        (("credit card number",), ~letter & d.between(13, 19)),
        (("tax file number",), ~letter & d.between(8, 9)),
        (("medicare number",), ~letter & d.between(10, 11)),
        (("passport number",), F.length(F.replace(v, F.lit(" "), F.lit(""))).between(6, 10) & (d >= 1) & letter),
        (("driver's licence number",), d.between(4, 12) & ~v.contains(":")),
        (("bank account number",), d.between(6, 18) & (n <= 34) & ~v.contains(":") & ~v.contains(".")),
        (("date of birth",), d.between(3, 8) & ~v.contains(":") & v.rlike(T.DATE_SEPARATOR)),
        (("address",), v.rlike(T.STREET) | (v.contains(" ") & v.rlike("[0-9]") & v.rlike(T.WORD_OF_THREE) & ~v.contains(":"))),
        (L.SENSITIVE, letter & (d < 7)),
    ]
    out = F.when(n < 2, False)
    for names, test in rules:
        out = out.when(label.isin(*names), test)
    return out.otherwise(True)


def found_labels(entities: Column, validate: bool = True) -> Column:
    """Sorted labels of a map label -> values with a value that counts, and phone number if any value at all reads like one.

    Without validation only persons that are stopwords don't count. A null map, null lists and null values count as nothing.
    """
    known = F.coalesce(entities, F.expr("cast(map() as map<string, array<string>>)"))
    if validate:
        counts = lambda k, x: is_valid(k, x)
    else:
        counts = lambda k, x: ~(k.isin(*L.NAME) & F.array_contains(T.array_of(L.STOPWORDS), F.lower(T.strip(x))))
    kept = F.map_keys(F.map_filter(known, lambda k, vs: F.exists(F.coalesce(vs, F.array()), lambda x: x.isNotNull() & counts(k, x))))
    values = F.flatten(F.filter(F.map_values(known), lambda vs: vs.isNotNull()))
    phone = F.when(F.exists(values, lambda x: x.isNotNull() & T.looks_like_phone(x)), F.array(F.lit("phone number"))).otherwise(F.array())
    return F.array_sort(F.array_union(kept, phone))


def project(entities: Column, found: Column) -> Column:
    """The raw lists of the labels that were found."""
    return F.map_filter(entities, lambda k, _: F.array_contains(found, k))


def merge_passes(first: Column, second: Column) -> Column:
    """The lists of two passes, appended label by label, duplicates kept and empty lists dropped."""
    joined = F.map_zip_with(first, second, lambda k, a, b: F.concat(F.coalesce(a, F.array()), F.coalesce(b, F.array())))
    return F.map_filter(joined, lambda k, vs: F.size(vs) > 0)


#: What a pass of a backend finds in a text.
FOUND = "array<struct<label: string, value: string, start: int, confidence: double>>"


def by_label(found: Column) -> Column:
    """A pass's findings as a map of label to values; findings without a value don't count."""
    some = F.filter(found, lambda s: s["label"].isNotNull() & s["value"].isNotNull())

    def mapped(xs: Column) -> Column:
        return F.map_from_entries(F.transform(F.array_distinct(F.transform(xs, lambda s: s["label"])), lambda k: F.struct(k, F.transform(F.filter(xs, lambda s: s["label"] == k), lambda s: s["value"]))))

    return T.named(some, mapped)


def confident(found: Column, default: float, thresholds: dict[str, float] | None = None) -> Column:
    """Of a pass's findings, those with a place whose confidence reaches their label's threshold; a missing confidence counts as 1."""
    own = F.create_map(*[F.lit(x) for item in sorted((thresholds or {}).items()) for x in item]) if thresholds else None
    least = (lambda label: F.coalesce(F.element_at(own, label), F.lit(default))) if own is not None else lambda label: F.lit(default)
    return F.filter(found, lambda s: s["start"].isNotNull() & (F.coalesce(s["confidence"], F.lit(1.0)) >= least(s["label"])))
