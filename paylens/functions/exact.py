"""Exact rounding of ratios and money.

Rounded percentages and averages are computed from integer numerators and
denominators with integer division, rounding half away from zero exactly
as a decimal ``round`` would. Rounding a double instead makes the result
depend on summation order and on how an engine rounds binary ties
(1.45 is stored as 1.4499999...), so two correct engines can disagree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def _int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def round_ratio_scaled(num: Column, den: Column, digits: int, wide: bool = False) -> Column:
    """round(num / den, digits) * 10^digits as an integer, half away from zero.

    ``wide`` evaluates the operands in decimal(38,0), so numerators and
    denominators may be products far beyond 64 bits; the rounded, scaled
    quotient itself is a 64-bit integer (|result| < 9.2e18), which every
    figure here (percentages, averages, dollar amounts) is far inside.
    """
    scale = 10 ** digits
    if wide:
        num, den = num.cast("decimal(38,0)"), den.cast("decimal(38,0)")
    mag = _int_div(F.abs(num) * (2 * scale) + den, den * 2)
    return F.when(den > 0, F.when(num < 0, -mag).otherwise(mag))


def round_ratio(num: Column, den: Column, digits: int, wide: bool = False) -> Column:
    """round(num / den, digits) for integral num, den; NULL when den <= 0."""
    return round_ratio_scaled(num, den, digits, wide).cast("double") / F.lit(float(10 ** digits))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """round(100 * num / den, digits)."""
    return round_ratio(num * 100, den, digits)


def cents(money: Column) -> Column:
    """Money (scale-2 decimal) as an exact integer number of cents."""
    return (money * 100).cast("bigint")


def cents_of_double(col: Column) -> Column:
    """A double holding an exact two-decimal amount, as integer cents."""
    return F.round(col * 100).cast("bigint")


def cents_to_money(c: Column) -> Column:
    """Integer cents back to a scale-2 decimal, exactly."""
    from decimal import Decimal
    return (c.cast("decimal(38,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def money_sum(col: Column) -> Column:
    return F.sum(col).cast(MONEY)


def avg_exact(col: Column, cond: Column | None, digits: int, money: bool = False) -> Column:
    """round(avg(col) [FILTER cond], digits), exact. ``money`` = scale-2 decimal."""
    val = cents(col) if money else col.cast("bigint")
    if cond is not None:
        val = F.when(cond, val)
    num = F.sum(val)
    den = F.count(val)
    if money:
        # cent sums of a large population can pass 1e16: round in 38 digits
        return round_ratio(num, den * 100, digits, wide=True)
    return round_ratio(num, den, digits)


DAY_US = 86_400_000_000


def avg_days(days: Column, digits: int) -> Column:
    """round(avg(days), digits) of day counts held as doubles, summed as whole
    microseconds (a double sum would depend on the order of the rows)."""
    micros = F.round(days * F.lit(float(DAY_US))).cast("bigint")
    return round_ratio(F.sum(micros.cast("decimal(38,0)")), F.count(days).cast("decimal(38,0)") * DAY_US, digits, wide=True)


def rate_pct(flag: Column, cond: Column | None = None, digits: int = 2) -> Column:
    """round(100 * avg(flag::int) [FILTER cond], digits), exact."""
    v = flag.cast("int")
    if cond is not None:
        v = F.when(cond, v)
    return pct(F.sum(v), F.count(v), digits)


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))
