"""Merkle fingerprints of documents (operator 1), DataFrame functions only.

A document's tree: clauses (cut after punctuation) are leaves, paragraphs (lines)
are nodes over their clauses, sections are nodes over eight paragraphs, and the
root is over the sections.  The fingerprint is ``root:sections:leaves``; equal
roots mean equal texts, differing sections locate an edit, and the likeness of
two fingerprints is the share of leaves they have in common (twice the common
distinct leaves over the distinct leaves of both).

The next document by doc_id is found without one window over all rows: id
ranges hold about ``ROWS`` rows each (quantiles, then equal widths), each range
leads inside itself, and a range's last row takes the next range's first.  The
only rows a single task orders are one a range.

Defined cases: null and empty texts are one empty clause, and alike; a text
without punctuation is one clause; documents that repeat a doc_id follow each
other by text; null doc_ids are a range of their own, the first; one document alone is its own next;
an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS = 5_000
COARSE = 128
SECTION = 8
PARAGRAPH = r"(?<=\n)"
CLAUSE = r"(?<=[.!?;:|,])(?=[^.!?;:|,])"


def tree(text) -> object:
    """struct(root, sections, leaves) of a text column."""
    clauses = lambda p: F.transform(F.split(p, CLAUSE), lambda c: F.xxhash64(c))
    paragraphs = F.transform(F.split(text, PARAGRAPH), clauses)
    named = F.struct(paragraphs.alias("p"))
    with_nodes = F.transform(F.array(named), lambda s: F.struct(
        F.transform(s["p"], lambda leaves: F.xxhash64(leaves)).alias("nodes"), F.flatten(s["p"]).alias("leaves")))
    with_sections = F.transform(with_nodes, lambda s: F.struct(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(s["nodes"]) - 1) / SECTION).cast("int")),
                    lambda i: F.xxhash64(F.slice(s["nodes"], i * SECTION + 1, SECTION))).alias("sections"),
        s["leaves"].alias("leaves")))
    with_root = F.transform(with_sections, lambda s: F.struct(
        F.sha2(F.array_join(s["sections"].cast("array<string>"), ",").cast("binary"), 256).alias("root"),
        s["sections"].alias("sections"), s["leaves"].alias("leaves")))
    return F.get(with_root, 0)


def fingerprint(t) -> object:
    """A tree as ``root:sections:leaves``, hashes in hexadecimal."""
    joined = lambda a: F.array_join(F.transform(a, lambda h: F.lower(F.hex(h))), ",")
    return F.concat(t["root"], F.lit(":"), joined(t["sections"]), F.lit(":"), joined(t["leaves"]))


def likeness(a, b) -> object:
    common = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    both = F.size(F.array_distinct(a["leaves"])) + F.size(F.array_distinct(b["leaves"]))
    return F.when(a["root"] == b["root"], 1.0).otherwise(2.0 * common / both)


def _search(column, bounds: list[int], lo: int = 0):
    """Number of bounds at or below the column, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(lo)
    mid = len(bounds) // 2
    return F.when(column < bounds[mid], _search(column, bounds[:mid], lo)).otherwise(_search(column, bounds[mid + 1:], lo + mid + 1))


def id_range(docs: DataFrame, column: str):
    """A column that numbers ranges of about ROWS rows, in order of ``column`` (long); nulls are range -1."""
    n = docs.count()
    coarse = max(1, min(COARSE, n // ROWS))
    cuts = [i / coarse for i in range(1, coarse)]
    quantiles = docs.agg(F.percentile_approx(column, cuts, 10_000).alias("q")).first()["q"] if cuts else []
    bounds = sorted(set(quantiles or []))
    own = _search(F.col(column), bounds)
    numbered = lambda x: F.when(F.col(column).isNull(), F.lit(-1)).otherwise(x).cast("long")
    fine = max(1, -(-n // (coarse * ROWS)))
    low, high = docs.agg(F.min(column), F.max(column)).first() if fine > 1 else (None, None)
    if low is None:
        return numbered(own)
    edges = [low, *bounds, high + 1]
    # decimals: ids of both signs can be further apart than a long reaches
    exact = lambda x: F.lit(Decimal(x)).cast("decimal(20,0)")
    starts = F.array(*[exact(e) for e in edges[:-1]])
    widths = F.array(*[exact(max(1, -(-(b - a) // fine))) for a, b in zip(edges[:-1], edges[1:], strict=True)])
    inside = F.floor((F.col(column).cast("decimal(20,0)") - F.get(starts, own)) / F.get(widths, own)).cast("long")
    return numbered(own.cast("long") * fine + F.greatest(F.lit(0), F.least(inside, F.lit(fine - 1))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The contract's columns and the edited and next documents' trees behind them."""
    own = docs.select("doc_id", F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("range", id_range(own, "id"))
    order = W.partitionBy("range").orderBy("id", "text")
    heads = own.withColumn("k", F.row_number().over(order)).filter("k = 1").select("range", F.col("text").alias("head"))
    ranges = own.select("range").distinct()
    everything = W.partitionBy().orderBy("range")
    ranges = ranges.select("range", F.lead("range").over(everything).alias("after"),
                           F.min("range").over(everything).alias("least"))
    heads = ranges.select("range", F.coalesce("after", "least").alias("after")).join(
        heads.withColumnRenamed("range", "after"), "after").select("range", "head")

    rows = own.repartition("range").withColumn("tree", tree(F.col("text")))
    rows = rows.withColumn("next", F.lead(F.struct("text", "tree")).over(order))
    rows = rows.join(heads, "range")
    rows = rows.withColumn("next_text", F.coalesce(F.col("next.text"), F.col("head")))
    n = F.char_length("text")
    part = F.floor(n / 4).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - int(char_length(text) div 4))"), F.expr("left(next_text, int(char_length(text) div 4))"))
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), "text", "tree", part.alias("part"), edited.alias("edited"),
        F.coalesce(F.col("next.tree"), tree(F.col("head"))).alias("next_tree"))
    rows = rows.withColumn("edited_tree", tree(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("tree")).alias("fingerprint"), fingerprint(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("tree"), F.col("edited_tree")).alias("near_edited"),
        likeness(F.col("tree"), F.col("next_tree")).alias("near_next"))


def op1_merkle_fingerprints(spark, sf_dir):
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
