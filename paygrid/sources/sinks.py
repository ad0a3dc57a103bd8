"""Writers: key-merge upsert into a month-partitioned table, and the run log.

Upsert (insert, or replace all non-key columns on key conflict; rows absent
from the batch are kept, never deleted):

1. the batch is staged to the shared scratch folder (cuts its lineage: a
   lost executor re-reads the staged files instead of re-running the job);
2. only the target partitions the batch touches are read — an IN-list of
   the batch's months (a calendar-bounded handful of values), which prunes
   partitions at file-listing time;
3. kept rows = those partitions anti-joined with the batch keys, unioned
   with the batch, staged again;
4. the staged result replaces exactly those partitions
   (``partitionOverwriteMode=dynamic``); untouched months are not rewritten.

Staging step 3 before step 4 means the overwrite never reads the files it is
replacing, so a task retry during the write still sees a consistent input.
A rerun of the same batch is idempotent (same keys, same values; only
``inserted_at`` moves).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import JOB_NAME
from ..session import scratch_path

LOG_SCHEMA = "prc_name string, description_step string, logged_at timestamp"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    return stage_at(df, scratch_path(df.sparkSession, name))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def batch_partitions(batch: DataFrame, partition_col: str) -> list:
    """The distinct partition values of a batch, on the driver.

    Bounded by the calendar: one value per month the batch covers (the
    horizon plus any future months), never by the data volume.  A literal
    IN-list lets the target scan prune partitions statically; a semi-join
    with the batch would read every partition of the ever-growing target.
    """
    return [r[0] for r in batch.select(partition_col).distinct().collect()]


def merge_by_key(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Rows of ``target`` whose key is not in ``batch``, plus all of ``batch``."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds data files (an empty or marker-only folder is no table yet)."""
    if not path_exists(spark, path):
        return False
    fs, p = _fs_path(spark, path)
    files = fs.listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly under a path; none if it does not exist."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [str(f.getPath()) for f in fs.listStatus(p) if f.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder (recursively) once nothing reads it any more."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def upsert_partitioned(batch: DataFrame, path: str, keys, partition_col: str = "week_dt",
                       max_records_per_file: int = 5_000_000,
                       batch_is_staged: bool = False) -> DataFrame:
    """Merge ``batch`` into the parquet table at ``path`` by ``keys``.

    Returns the staged batch (so callers can report on it without recompute).
    """
    spark = batch.sparkSession
    staged = batch if batch_is_staged else stage(batch, "upsert-batch")
    months = batch_partitions(staged, partition_col)
    if not months:
        return staged   # empty batch: nothing to insert or replace
    merged_path = None
    if has_data(spark, path):
        target = spark.read.parquet(path)
        touched = target.where(F.col(partition_col).isin(months))   # static partition pruning
        merged_path = scratch_path(spark, "upsert-merged")
        merged = stage_at(merge_by_key(touched, staged, keys), merged_path)
    else:
        merged = staged
    # REBALANCE by month: rows of a month go to the same writers (few files
    # per partition), while AQE splits an oversized month across several
    # tasks and merges small ones, so a hot month is no straggler.
    try:
        (merged.hint("rebalance", partition_col)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(partition_col)
            .parquet(path))
    finally:
        if merged_path:
            delete_path(spark, merged_path)   # committed or failed: no longer read
    return staged


def append_log(spark: SparkSession, path: str, step: str, job: str = JOB_NAME,
               at: dt.datetime | None = None) -> None:
    """Append one (job, step, time) row to the run log table."""
    append_log_rows(spark, path, [(step, at)], job)


def append_log_rows(spark: SparkSession, path: str, steps, job: str = JOB_NAME) -> None:
    """Append several (step, time) rows in one write: they appear together or not at all."""
    now = dt.datetime.now(dt.timezone.utc)
    utc = lambda at: at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    rows = [(job, step, utc(at or now)) for step, at in steps]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)
