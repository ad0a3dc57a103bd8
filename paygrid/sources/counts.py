"""Vacancy counts kept by month and repaired by difference.

COUNT(*) per (month, position, raw agglomeration) is additive, so a stored
count is right again after adding what came and subtracting what went.  The
state is a parquet table of the same columns as ``count_vacancies`` returns,
partitioned by month; a repair reads and rewrites the changed months only:

1. changes are counted per group with partial sums: +1 for an added vacancy,
   -1 for a withdrawn one (a late vacancy is an addition to an old month; a
   moved one is a withdrawal and an addition);
2. the months they touch are read back (an IN-list of months prunes the
   rest), added to, and groups that come to zero are dropped;
3. the result is staged and replaces exactly those months.

NULL and '' stay separate groups, as in the count itself; NULL months are in
no state, as no horizon keeps them.  A count below zero means that something
was withdrawn that was never counted: the repair is refused and nothing is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import count_vacancies
from ..session import scratch_path
from .sinks import batch_partitions, delete_path, has_data, stage_at

MONTH, GROUP = "month_dt", ("position_type_id", "agglomeration_name")
STATE = "position_type_id int, agglomeration_name string, vacancy_cnt bigint, month_dt date"


class CountsBelowZero(ValueError):
    pass


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts, as ``count_vacancies`` would return them."""
    if not has_data(spark, path):
        return spark.createDataFrame([], STATE).select(MONTH, *GROUP, "vacancy_cnt")
    # (a month that lost all its groups holds one row that counts nothing)
    return spark.read.schema(STATE).parquet(path).where("vacancy_cnt <> 0").select(MONTH, *GROUP, "vacancy_cnt")


def count_changes(added: DataFrame | None, withdrawn: DataFrame | None) -> DataFrame:
    """Signed counts per group of the vacancies that came and went; groups that cancel out are left away."""
    parts = [count_vacancies(v, None).withColumn("vacancy_cnt", F.lit(sign) * F.col("vacancy_cnt"))
             for v, sign in ((added, 1), (withdrawn, -1)) if v is not None]
    if not parts:
        raise ValueError("give added or withdrawn vacancies")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    net = both.groupBy(MONTH, *GROUP).agg(F.sum("vacancy_cnt").alias("vacancy_cnt"))
    return net.where(F.col(MONTH).isNotNull() & (F.col("vacancy_cnt") != 0))


def added_up(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts after changes; a group that comes to zero is none."""
    total = counts.unionByName(changes.select(*counts.columns)).groupBy(MONTH, *GROUP).agg(F.sum("vacancy_cnt").alias("vacancy_cnt"))
    return total.where(F.col("vacancy_cnt") != 0)


def repair_counts(spark: SparkSession, path: str, added: DataFrame | None = None, withdrawn: DataFrame | None = None) -> list:
    """Bring the state at ``path`` up to date; returns the months that were rewritten (a missing state is empty)."""
    changes_path, months_path = scratch_path(spark, "count-changes"), scratch_path(spark, "count-months")
    try:
        changes = stage_at(count_changes(added, withdrawn), changes_path)
        months = batch_partitions(changes, MONTH)
        if not months:
            return []
        touched = read_counts(spark, path).where(F.col(MONTH).isin(months))   # static partition pruning
        repaired = stage_at(added_up(touched, changes), months_path)
        if not repaired.where(F.col("vacancy_cnt") < 0).isEmpty():
            raise CountsBelowZero("more vacancies withdrawn than counted")
        # a month that lost all its groups keeps one row that counts nothing, so that its partition is replaced too
        left = spark.createDataFrame([(m,) for m in months], f"{MONTH} date").join(repaired.select(MONTH).distinct(), MONTH, "left_anti")
        empty = left.select(F.lit(None).cast("int").alias(GROUP[0]), F.lit(None).cast("string").alias(GROUP[1]), F.lit(0).cast("bigint").alias("vacancy_cnt"), MONTH)
        (repaired.unionByName(empty).select(*GROUP, "vacancy_cnt", MONTH).hint("rebalance", MONTH)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))
        return sorted(months)
    finally:
        delete_path(spark, changes_path)
        delete_path(spark, months_path)


class CountedSources:
    """Other sources with stored counts: ``counts`` instead of counting every vacancy of the horizon again."""

    def __init__(self, sources, spark: SparkSession, path: str):
        self.sources, self.spark, self.path = sources, spark, path

    def __getattr__(self, name):
        return getattr(self.sources, name)

    def counts(self, since=None) -> DataFrame:
        stored = read_counts(self.spark, self.path)
        return stored if since is None else stored.where(F.col(MONTH) >= F.lit(since))
