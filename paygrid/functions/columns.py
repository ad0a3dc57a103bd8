"""Column expressions used by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C
from .exact import fraction, units

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: ColumnOrName) -> Column:
    """First day of the month as a DATE (works on date and timestamp input)."""
    return F.trunc(F.to_date(_col(c)), "MM")


def horizon_start(as_of: dt.date, months: int = C.HORIZON_MONTHS) -> dt.date:
    """First day of the month ``months`` before ``as_of`` (driver-side literal).

    Same value as ``month_start(add_months(as_of, -months))`` but folded on the
    driver, so the filter reaching the scan compares against a literal.
    """
    total = as_of.year * 12 + (as_of.month - 1) - months
    return dt.date(total // 12, total % 12 + 1, 1)


def horizon_start_col(as_of: ColumnOrName, months: int = C.HORIZON_MONTHS) -> Column:
    """Column form of :func:`horizon_start` (for as-of dates held in data)."""
    return F.trunc(F.add_months(_col(as_of), -months), "MM")


def null_as_empty(c: ColumnOrName) -> Column:
    """NULL and '' become the same join key (not ``<=>``: '' must match NULL)."""
    return F.coalesce(_col(c), F.lit(""))


def null_if_equal(c: ColumnOrName, value) -> Column:
    """SQL NULLIF: NULL when equal to ``value`` (strings compare case-sensitively)."""
    return F.nullif(_col(c), F.lit(value))


def guarded_ratio(now: ColumnOrName, then: ColumnOrName, whole: bool = False) -> Column:
    """``now / then - 1`` as an exact fraction when both are present and ``then`` is non-zero, else NULL.

    ``whole``: the inputs are counts, else amounts.
    """
    n, d = (_col(c).cast("bigint") if whole else units(_col(c)) for c in (now, then))
    return fraction(n - d, d, n.isNotNull() & d.isNotNull() & (d != 0))


def integer_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Same guard, but integer division (truncating), as ``int / int`` in SQL.

    Uses Spark's ``div`` (IntegralDivide), which truncates towards zero.
    """
    n, d = _col(numerator), _col(denominator)
    quotient = F.call_function("div", n.cast("long"), d.cast("long"))
    return F.when(d.isNotNull() & (d != 0), quotient - F.lit(1))


def gap_to(own: ColumnOrName, market: ColumnOrName) -> Column:
    """Relative gap of own pay to a market value, as an exact fraction; needs market > 0 and own pay."""
    o, m = units(_col(own)), units(_col(market))
    return fraction(o - m, m, m.isNotNull() & (m > 0) & o.isNotNull())


def spread(high: ColumnOrName, low: ColumnOrName) -> Column:
    h, lo = _col(high), _col(low)
    return F.when(h.isNotNull() & lo.isNotNull(), h - lo)


def missing_flag(c: Column) -> Column:
    return F.when(c, F.lit(1)).otherwise(F.lit(0))
