"""Check digits of public identifiers, as unrolled sums that stay in whole-stage code. Arguments are columns of digits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights by digit, of public specifications.
TFN = (1, 4, 3, 7, 5, 8, 6, 9, 10)
MEDICARE = (1, 3, 7, 9, 1, 3, 7, 9)
ABN = (10, 1, 3, 5, 7, 9, 11, 13, 15, 17, 19)
ACN = (8, 7, 6, 5, 4, 3, 2, 1)


def _digit(c: Column, place: int) -> Column:
    return F.substring(c, place, 1).cast("int")


def _weighted(c: Column, weights) -> Column:
    return reduce(lambda a, b: a + b, [_digit(c, k) * w for k, w in enumerate(weights, 1)])


def _of_length(c: Column, n: int, test: Column) -> Column:
    return F.when(c.rlike(f"^[0-9]{{{n}}}$"), test).otherwise(F.when(c.isNotNull(), False))


def tfn(c: Column) -> Column:
    return _of_length(c, 9, _weighted(c, TFN) % 11 == 0)


def medicare(c: Column) -> Column:
    return _of_length(c, 10, _digit(c, 1).between(2, 6) & (_weighted(c, MEDICARE) % 10 == _digit(c, 9)))


def abn(c: Column) -> Column:
    return _of_length(c, 11, (_weighted(c, ABN) - ABN[0]) % 89 == 0)


def acn(c: Column) -> Column:
    return _of_length(c, 9, (10 - _weighted(c, ACN) % 10) % 10 == _digit(c, 9))


def card(c: Column) -> Column:
    return F.length(c).between(13, 19) & F.call_function("luhn_check", c)


def iban(c: Column) -> Column:
    """Mod 97 over the moved and lettered-out string; the remainder is carried, since the number fits no type."""
    moved = F.concat(F.substring(c, 5, 34), F.substring(c, 1, 4))
    carried = F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda acc, x: F.when(x == "", acc).otherwise((acc * F.when(x.rlike("[A-Z]"), 100).otherwise(10) + F.conv(x, 36, 10).cast("int")) % 97),
    )
    return F.when(c.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), carried == 1).otherwise(F.when(c.isNotNull(), False))


# --- the same checks as SQL text, for functions that SQL defines ------------------------------------------
def _digit_sql(x: str, place: int) -> str:
    return f"cast(substring({x}, {place}, 1) as int)"


def _weighted_sql(x: str, weights) -> str:
    return "(" + " + ".join(f"{_digit_sql(x, k)} * {w}" for k, w in enumerate(weights, 1)) + ")"


def _iban_sql(x: str) -> str:
    step = "(a, c) -> CASE WHEN c = '' THEN a ELSE (a * CASE WHEN c RLIKE '[A-Z]' THEN 100 ELSE 10 END + cast(conv(c, 36, 10) as int)) % 97 END"
    return f"{x} RLIKE '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}$' AND aggregate(split(concat(substring({x}, 5, 34), substring({x}, 1, 4)), ''), 0, {step}) = 1"


#: For each check, what makes its SQL condition on the SQL of a normal form.
SQL = {
    tfn: lambda x: f"{x} RLIKE '^[0-9]{{9}}$' AND {_weighted_sql(x, TFN)} % 11 = 0",
    medicare: lambda x: f"{x} RLIKE '^[2-6][0-9]{{9}}$' AND {_weighted_sql(x, MEDICARE)} % 10 = {_digit_sql(x, 9)}",
    abn: lambda x: f"{x} RLIKE '^[0-9]{{11}}$' AND ({_weighted_sql(x, ABN)} - {ABN[0]}) % 89 = 0",
    acn: lambda x: f"{x} RLIKE '^[0-9]{{9}}$' AND (10 - {_weighted_sql(x, ACN)} % 10) % 10 = {_digit_sql(x, 9)}",
    card: lambda x: f"length({x}) BETWEEN 13 AND 19 AND luhn_check({x})",
    iban: _iban_sql,
}
