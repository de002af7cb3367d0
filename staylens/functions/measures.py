"""Exact KPI arithmetic.

Money is summed as decimals and rounded half-up once, at the end; ratios are
formed with integer quotients so a value is never rounded twice. Only the
served value becomes DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(a: Column, b: Column) -> Column:
    """Exact integer quotient ``a div b`` for ``a >= 0``, ``b > 0`` (BIGINT)."""
    return F.call_function("div", a, b)


def _sign(c: Column) -> Column:
    return F.when(c < 0, F.lit(-1)).otherwise(F.lit(1))


def round_money(c, scale: int = 2) -> Column:
    """Half-up rounding of a decimal (Spark rounds decimals HALF_UP)."""
    return F.round(_col(c), scale)


def money_to_double(c, scale: int = 2) -> Column:
    """Round a decimal amount half-up, then serve it as DOUBLE."""
    return round_money(c, scale).cast("double")


def percent_2dp(numerator, denominator) -> Column:
    """``round(100 * n / d, 2)`` half-up (away from zero), exact for integers.

    NULL when the denominator is NULL or 0. The value is formed as an integer
    count of hundredths of a percent and only then scaled to DOUBLE.
    """
    n = _col(numerator).cast("long")
    d = _col(denominator).cast("long")
    size = F.abs(d)
    hundredths = _sign(n) * _sign(d) * floor_div(F.abs(n) * 20000 + size, F.nullif(size * 2, F.lit(0)))
    return F.when(d != 0, hundredths / F.lit(100.0))


def adr(revenue_sum, occupied) -> Column:
    """Average daily rate: revenue / occupied rooms, half-up to an integer.

    ``revenue_sum`` is the unrounded decimal sum; 0 when no room is occupied.
    The quotient is one of integers (millionths), so it is rounded once.
    """
    occ = _col(occupied).cast("long")
    rev = _col(revenue_sum).cast("decimal(30,6)")
    units = (F.abs(rev) * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(36,0)")
    room = (occ * 1000000).cast("decimal(28,0)")
    return (F.when(occ == 0, F.lit(0).cast("long"))
            .otherwise(_sign(rev) * floor_div(units * 2 + room, F.nullif(room * 2, F.lit(0).cast("decimal(28,0)")))))


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (SQL date_diff style)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _col(start)),
                            F.date_trunc("minute", _col(end)))


def hours_2dp(minutes) -> Column:
    """Minutes as hours rounded half-up to 2 decimals, DOUBLE.

    Exact: hundredths of an hour = round(minutes * 100 / 60) = round(m * 5 / 3).
    """
    m = _col(minutes).cast("long")
    return _sign(m) * floor_div(F.abs(m) * 10 + 3, F.lit(6)) / F.lit(100.0)
