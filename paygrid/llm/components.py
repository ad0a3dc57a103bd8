"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm.staging import written


def connected(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of edges (a, b): root is the least id of its component.

    Each round ties every node to the least neighbour it knows of, until nothing
    changes; rounds grow with the logarithm of a component's size.  Self-edges
    keep a node in the result.
    """
    spark = edges.sparkSession
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    now = written(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi > lo").distinct(), "edges")
    state = None
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).filter("hi > lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
        now = written(small.filter("hi > lo").distinct(), "edges")
        got = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if got == state:
            break
        state = got
    return nodes.join(now.select(F.col("hi").alias("id"), F.col("lo").alias("root")), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
