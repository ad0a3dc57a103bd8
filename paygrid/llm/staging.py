"""Cuts of lineage: tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame

from paygrid.session import scratch_path

#: Removes a query's shuffle files when it ends; lost ones are computed anew.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark):
    """What is run inside leaves no shuffle files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back; its shuffle files go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_in_buckets(df: DataFrame, name: str, column: str) -> DataFrame:
    """df, written once in as many buckets by column as a shuffle has partitions, so that grouping by it needs no shuffle; its shuffle files go at once.

    Only a table has buckets; its name is dropped as soon as the result knows its files, which stay.
    """
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _cleaned(spark):
        df.write.bucketBy(n, column).option("path", scratch_path(spark, own)).saveAsTable(own)
    out = spark.table(own)
    out.schema  # resolved: its files and buckets are known
    spark.sql(f"DROP TABLE {own}")
    return out
