"""Join helpers: broadcast only what the data specification bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_size(df: DataFrame) -> DataFrame:
    """Broadcast a table whose cardinality is fixed by its schema definition.

    Used only for the reference geography of the test data (5 regions, 25
    nations at every scale factor), where the bound is part of the data spec.
    """
    return F.broadcast(df)
