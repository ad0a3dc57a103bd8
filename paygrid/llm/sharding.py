"""Proportional stratified interleaving into shards (operator 7), DataFrame functions only.

Rows are shuffled by a seeded hash and ranked inside their source; row r of a
source of n rows has the fractional rank (2 r + 1) / (2 n).  In the order of
those ranks every stretch holds the sources in their proportions, so shards cut
from it match the mixture.  The law is ``rows``: shard sizes differ by one row
at most.

Neither rank is one window over a source or over all rows: hash ranges hold
about ``ROWS`` rows each, their counts give every range its first rank, and row
numbers run inside a range.  The range counts are the only rows a single task
orders (one for ``ROWS`` rows).

Defined cases: a null source is a source of its own; null texts have size 1 and
the checksum of no bytes; empty and long texts count by their bytes; repeated
rows are rows of their own; ties are ordered by doc_id, checksum and size; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS = 4_000


def _first_of_ranges(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """counts with ``first``: the rows of the ranges before, inside ``keys``."""
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def shards(docs: DataFrame, n_shards: int = 16, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is not ``key``), source."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    rows = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("stratum"), "source",
        (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), digest.alias("digest"),
        F.conv(F.substring(digest, 1, 5), 16, 10).cast("long").alias("h"))
    strata = rows.groupBy("stratum").agg(F.count("*").alias("n_stratum"))
    total = max(docs.count(), 1)
    ranges = -(-total // ROWS)

    per = F.ceil(F.col("n_stratum") / ROWS)
    rows = rows.join(strata, "stratum").withColumn("range", F.floor(F.col("h") * per / F.lit(1 << 20)).cast("long"))
    first = _first_of_ranges(rows.groupBy("stratum", "range").agg(F.count("*").alias("n")), ["stratum"], "range")
    inside = W.partitionBy("stratum", "range").orderBy("digest", "doc_id", "text_crc32", "size")
    rows = rows.join(first.select("stratum", "range", "first"), ["stratum", "range"])
    rows = rows.withColumn("odd", 2 * (F.col("first") + F.row_number().over(inside)) - 1)
    # integer division: which of the equal parts of [0, 1) holds the fractional rank
    rows = rows.select("doc_id", "source", "stratum", "size", "text_crc32", "digest",
                       (F.col("odd") / (2 * F.col("n_stratum"))).alias("fraction"),
                       F.expr(f"(odd * {ranges}) div (2 * n_stratum)").alias("part"))
    first = _first_of_ranges(rows.groupBy("part").agg(F.count("*").alias("n")), [], "part")
    inside = W.partitionBy("part").orderBy("fraction", "stratum", "digest", "doc_id", "text_crc32", "size")
    rows = rows.join(first.select("part", "first"), "part")
    rows = rows.withColumn("place", F.col("first") + F.row_number().over(inside) - 1)
    rows = rows.withColumn("shard", F.expr(f"place * {n_shards} div {total}"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source")


def op7_stratified_shards(spark, sf_dir):
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
