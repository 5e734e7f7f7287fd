"""Exact arithmetic on two-decimal amounts.

Amounts stay DOUBLE in the tables. Inside aggregates they become whole
hundredths (BIGINT), so a sum neither depends on the order of the rows nor on
how they are partitioned, and stays inside generated code. Rounding to decimals
happens once per group, on DECIMAL, half up.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EXACT = "decimal(28,8)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hundredths(c: Column | str) -> Column:
    """A two-decimal amount as a whole number of hundredths."""
    return F.floor(_col(c) * 100 + 0.5)


def units(c: Column | str) -> Column:
    """The inverse of :func:`hundredths`."""
    return _col(c) / 100.0


def rounded(c: Column | str, digits: int) -> Column:
    """``c`` rounded half up to ``digits`` decimals, as DOUBLE."""
    return F.round(_col(c).cast(_EXACT), digits).cast("double")


def mean(total: Column | str, n: Column | str, digits: int, scale: int = 0) -> Column:
    """``total / n`` to ``digits`` decimals; ``total`` counts units of 10**-scale.

    Rounds before scaling down, so that a tie is seen as a tie. NULL for n = 0.
    """
    ratio = F.try_divide(_col(total).cast("double"), _col(n).cast("double"))
    return rounded(ratio, digits - scale) / float(10**scale)


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0 or NULL."""
    ratio = F.try_divide(_col(part).cast("double") * 100.0, _col(whole).cast("double"))
    return rounded(ratio, digits)


def stddev(c: Column | str, digits: int = 4) -> Column:
    """Sample standard deviation, rounded; NULL for a single row."""
    return rounded(F.stddev(_col(c)), digits)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from ``start`` to ``end`` to two decimals; fractions of a second do not count."""
    seconds = F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))
    # seconds * 100 / 60 never ends in exactly .5, so adding a half rounds right on both sides of 0
    return F.floor(seconds * 100 / 60 + 0.5) / 100.0
