"""Month horizon: keep rows from the first day of (as_of - 18 months) on.

There is deliberately no upper bound: future months pass, as in the job being
reproduced.  The filter is on the raw date column and against a literal, so
Catalyst pushes it into the parquet scan (and prunes partitions when the
source is partitioned by that column).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import horizon_start
from ..functions.constants import HORIZON_MONTHS


def resolve_as_of(as_of: dt.date | str | None) -> dt.date:
    if as_of is None:
        return dt.date.today()
    if isinstance(as_of, str):
        return dt.date.fromisoformat(as_of)
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    return as_of


def cutoff_month(as_of: dt.date | str | None, months: int = HORIZON_MONTHS) -> dt.date:
    return horizon_start(resolve_as_of(as_of), months)


def apply_horizon(df: DataFrame, cutoff: dt.date, column: str = "month_dt") -> DataFrame:
    """``column >= cutoff``; NULL dates drop out."""
    return df.where(F.col(column) >= F.lit(cutoff))
