"""Sources backed by DataFrames the caller already has (tests, notebooks)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class FrameSources:
    """Wraps four DataFrames with the source schemas (see ``tables.py``)."""

    def __init__(self, base: DataFrame, dim: DataFrame | None, ext: DataFrame, vac: DataFrame):
        self._base, self._dim, self._ext, self._vac = base, dim, ext, vac

    @staticmethod
    def _since(df: DataFrame, since: dt.date | None) -> DataFrame:
        return df if since is None else df.where(F.col("month_dt") >= F.lit(since))

    def base(self, since: dt.date | None = None) -> DataFrame:
        return self._since(self._base, since)

    def dim(self) -> DataFrame | None:
        return self._dim

    def ext(self, since: dt.date | None = None) -> DataFrame:
        return self._since(self._ext, since)

    def vac(self, since: dt.date | None = None) -> DataFrame:
        return self._since(self._vac, since)
