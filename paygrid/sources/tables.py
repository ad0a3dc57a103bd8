"""Sources backed by real tables (catalog names or parquet paths).

Each source applies the horizon on its raw ``month_dt`` column, so a table
partitioned by that column is pruned to the horizon at file-listing time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BASE_COLUMNS = (
    "month_dt", "position_type_id", "location_rk", "location_nm", "hrm_job_title_nm",
    "agglomeration_name", "work_schedule_type", "fact_salary_fte_amt", "target_salary",
    "cnt_emp_dist", "perc_25", "perc_50", "perc_75", "cnt_vacancy_site", "company_competitor",
)
EXT_COLUMNS = (
    "month_dt", "position_type_id", "agglomeration_name",
    "perc_25", "perc_50", "perc_75",
    "perc_25_3month", "perc_50_3month", "perc_75_3month",
    "perc_25_6month", "perc_50_6month", "perc_75_6month",
    "cnt_vacancy_site", "type_agg",
)
VAC_COLUMNS = ("month_dt", "position_type_id", "agglomeration_name")
DIM_COLUMNS = ("id", "name")

# Types of the source columns (inferred from how the job uses them).
SOURCE_SCHEMAS = {
    "base": ("month_dt date, position_type_id int, location_rk string, location_nm string, "
             "hrm_job_title_nm string, agglomeration_name string, work_schedule_type string, "
             "fact_salary_fte_amt decimal(18,5), target_salary decimal(18,5), cnt_emp_dist int, "
             "perc_25 decimal(18,5), perc_50 decimal(18,5), perc_75 decimal(18,5), "
             "cnt_vacancy_site int, company_competitor string"),
    "dim": "id int, name string",
    "ext": ("month_dt date, position_type_id int, agglomeration_name string, "
            "perc_25 decimal(18,5), perc_50 decimal(18,5), perc_75 decimal(18,5), "
            "perc_25_3month decimal(18,5), perc_50_3month decimal(18,5), perc_75_3month decimal(18,5), "
            "perc_25_6month decimal(18,5), perc_50_6month decimal(18,5), perc_75_6month decimal(18,5), "
            "cnt_vacancy_site int, type_agg string"),
    "vac": "month_dt date, position_type_id int, agglomeration_name string",
}


class TableSources:
    """``base``/``dim``/``ext``/``vac`` read from tables or parquet paths.

    A value containing '/' (or a URI scheme) is read as parquet; anything
    else is looked up in the catalog.  Only the used columns are selected.
    """

    def __init__(self, spark: SparkSession, base: str, dim: str, ext: str, vac: str):
        self.spark = spark
        self.names = {"base": base, "dim": dim, "ext": ext, "vac": vac}

    def _read(self, which: str, columns) -> DataFrame:
        name = self.names[which]
        df = (self.spark.read.parquet(name) if ("/" in name or ":" in name)
              else self.spark.table(name))
        return df.select(*columns)

    def _since(self, df: DataFrame, since: dt.date | None) -> DataFrame:
        return df if since is None else df.where(F.col("month_dt") >= F.lit(since))

    def base(self, since: dt.date | None = None) -> DataFrame:
        return self._since(self._read("base", BASE_COLUMNS), since)

    def dim(self) -> DataFrame:
        """The dimension; Spark broadcasts it if its bytes allow."""
        return self._read("dim", DIM_COLUMNS)

    def ext(self, since: dt.date | None = None) -> DataFrame:
        return self._since(self._read("ext", EXT_COLUMNS), since)

    def vac(self, since: dt.date | None = None) -> DataFrame:
        return self._since(self._read("vac", VAC_COLUMNS), since)
