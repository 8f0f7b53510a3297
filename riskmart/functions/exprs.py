"""Column expressions shared by the plans: exact ratios, score bands, weights."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"
PCT = "decimal(10,2)"

_EXACT = "decimal(28,2)"


def ratio(num: Column, den: Column, digits: int = 2, dtype: str = PCT) -> Column:
    """``num / den`` rounded half away from zero to ``digits``; NULL when ``den`` is 0.

    Works on whole quotients, so one rounding happens whatever the precision of the
    operands. Plain decimal division would round once to its own scale and again in
    the cast. Operands need scale 2 or less; ``num * 10**digits`` must fit 10**18.
    """
    n = num.cast(_EXACT) * F.lit(Decimal(10**digits))
    d = F.nullif(den.cast(_EXACT), F.lit(Decimal("0.00")))
    two = F.lit(Decimal(2))
    size = F.call_function("div", F.abs(n) * two + F.abs(d), F.abs(d) * two)
    minus = (n < 0) != (d < 0)
    signed = F.when(minus, -size).otherwise(size)
    return (signed.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(dtype)


def percent(part: Column, whole: Column, dtype: str = PCT) -> Column:
    """``100 * part / whole`` to two digits."""
    return ratio(part.cast(_EXACT) * F.lit(Decimal(100)), whole, 2, dtype)


def mean(total: Column, n: Column, dtype: str = PCT) -> Column:
    """Average of a decimal or whole-number column from its sum and count."""
    return ratio(total, n, 2, dtype)


def money_sum(c: Column) -> Column:
    """Sum of a money column in exact decimals: ten digits more than one value may have."""
    return F.sum(c).cast(MONEY_SUM)


def zero_if_null(c: Column, dtype: str) -> Column:
    return F.coalesce(c, F.lit(0).cast(dtype))


def bands(score: Column, floors: Sequence[tuple[int, str]], otherwise: str) -> Column:
    """First label whose lower bound the score reaches; NULL goes to ``otherwise``."""
    out: Column | None = None
    for floor, label in floors:
        hit = score >= floor
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def weighted(parts: Sequence[tuple[str, str]], dtype: str = PCT) -> Column:
    """Sum of ``column * weight`` in exact decimals, rounded once."""
    total: Column | None = None
    for name, weight in parts:
        term = F.col(name) * F.lit(Decimal(weight))
        total = term if total is None else total + term
    return total.cast(dtype)


def position_in(label: Column, order: Sequence[str]) -> Column:
    """1-based place of a label in a fixed list, NULL when absent."""
    out: Column | None = None
    for place, name in enumerate(order, start=1):
        hit = label == name
        out = F.when(hit, place) if out is None else out.when(hit, place)
    return out
