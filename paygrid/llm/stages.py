"""The pipeline's stages: operators as steps from documents to documents.

Each takes (spark, docs, sf_dir); all but the last return the columns of docs.

Defined cases, for all stages: null and empty texts are kept (rejected by the quality classifier only if it
scores them so); null and repeated ids and repeated rows are kept, but of rows with one id and text, and of
documents that are alike, one stays: the one whose id is the component's, of rows that differ in other columns
the first as JSON text; columns of any name are carried along; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from paygrid.llm import bpe, decontaminate, exchange, jaccard_join, pii, quality
from paygrid.llm.staging import written


def keep_quality(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # the score's name may be taken
    own = _free("quality_score_given", docs)
    rows = docs.withColumnRenamed("quality_score", own) if "quality_score" in docs.columns else docs
    kept = quality.score(rows, labels).filter(F.col("quality_score") >= quality.REJECT_BELOW).drop("quality_score")
    return kept.select(*[F.col(own).alias(c) if c == "quality_score" else c for c in docs.columns])


def _free(name, docs):
    """The name, or a longer one that no column has."""
    while name in docs.columns:
        name += "_"
    return name


def one_of_alike(spark, docs, sf_dir):
    """One row of each component of the Jaccard join: one whose id is the component's; texts without words are all kept."""
    keys = exchange.row_keys(docs)
    found = written(jaccard_join.keyed_links(docs, keys).select(F.col("id").alias("__row"), "keep", "n_shingles"), "alike")
    gone = found.filter("__row <> keep").select("__row").distinct()
    # rows given twice have one key
    twice = found.filter("__row = keep AND n_shingles > 0").groupBy("__row").count().filter("count > 1").select("__row")
    marked = written(gone.withColumn("first", F.lit(False)).union(twice.withColumn("first", F.lit(True))), "alike-rows")
    # the table's columns travel in one, so that no name of theirs meets a helper's
    rows = docs.select(F.struct(*docs.columns).alias("whole"), *exchange.key_columns(keys))
    on = [c for c in rows.columns if c != "whole"]
    marked = exchange.by_key(marked, keys)
    # all rows but the few that are marked need no join
    clear, rest = exchange.sifted(rows, marked, on)
    kept = rest.join(marked.filter("NOT first"), on, "left_anti")
    twice = marked.filter("first")
    if not twice.isEmpty():
        first = kept.join(twice, on, "left_semi").groupBy(*on).agg(F.min_by("whole", F.to_json("whole")).alias("whole"))
        kept = kept.join(twice, on, "left_anti").unionByName(first)
    # dealt out evenly: what is left of each file would make later stages' tasks as large as the files were
    return clear.unionByName(kept).select("whole.*").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def remove_benchmark(spark, docs, sf_dir):
    """Texts without the words that occur in benchmark phrases; a text that had nothing else is empty."""
    rows = decontaminate.scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove=True)
    if "n_chars" not in docs.columns:
        return rows
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mask_personal_data(spark, docs, sf_dir):
    """Texts with personal data replaced by its kind."""
    return pii.mask(docs)


def tokens(spark, docs, sf_dir):
    """(doc_id, ids): the token ids of each text."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
