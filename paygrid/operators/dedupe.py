"""First row per key (the generic form of DISTINCT ON).

``row_number() = 1`` over the key is planned by Spark as a WindowGroupLimit
that runs partially *before* the shuffle, so each map task forwards at most
one row per key: a key holding a third of the data costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[str | Column]) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (ascending, NULLs first
    for plain column names).  Make ``order`` total for a deterministic pick."""
    cols = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn("_rn_key", F.row_number().over(w)).where(F.col("_rn_key") == 1).drop("_rn_key")
