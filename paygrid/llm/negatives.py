"""Hard-negative mining by Strassen products of anchor and candidate tiles (operator 12).

Scores are integer inner products, so they are exact.  The anchors are a stated query set (one row in
``every``), and every row is a candidate:

1. Rows that take part are cleaned once and written; components become ``floor(scale * x)``.
2. Candidates are dealt over cells by row, whatever their label, so a label that holds a third of all rows
   is spread like any other; anchors are cut into blocks, and a (block, cell) pair is one task with bounded rows.
3. Inside a task, tiles of anchors and candidates meet in recursive seven-product multiplication with zero
   padding and exact integer sums; a tile's best rows are merged into each anchor's heap.
4. Pass one keeps each anchor's best rows of its own label (positives); the tasks' heaps are merged by a window
   with a limit.  Pass two knows the positives' scores, keeps for each the best rows of other labels inside its
   score window, and the tasks' heaps are merged likewise.

Defined cases: rows with a null id, label or vector, or a null or non-finite component (after scaling, too)
take no part; shorter vectors are padded with zeros, empty ones score 0; ties go to the smaller id; repeated
rows count as often as they are given, but rows that share an anchor's id are one anchor (the least label, then
vector) and none of them is its positive or negative; scores outside 64 bits are compared exactly within a
task and returned as the nearest long, whose window counts; an empty table, or one without anchors, gives no
rows; only vec_id, label and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paygrid.llm import arrays as A
from paygrid.llm.staging import written

#: Rows of a cell of candidates, and of a block of anchors.
CELL, BLOCK = 1 << 18, 1 << 14
#: Rows of an anchor tile and of a candidate tile.
TILE_ANCHORS, TILE_ROWS = 128, 8192
#: Tiles with a side of at most so much are multiplied directly.
LEAF = 32
#: Cells that even a small table is dealt over, when it has rows for them.
SPREAD = 8
LONG = (-(2 ** 63), 2 ** 63 - 1)


def _plain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b exactly: in doubles if no partial sum can leave their 53 bits, else in the operands' own type."""
    if a.dtype == object or a.size == 0 or b.size == 0:
        return a @ b
    bound = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if bound < 2 ** 53 else a @ b


def _padded(a: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if a.shape == (rows, columns):
        return a
    out = np.zeros((rows, columns), a.dtype)
    out[:a.shape[0], :a.shape[1]] = a
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of integers by seven half-size products a level; odd sides are padded with zeros.

    64-bit sums may wrap on the way: they are right modulo 2 ** 64, so a result that fits is exact.
    """
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return _plain(a, b)
    h, q, w = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = _padded(a, 2 * h, 2 * q), _padded(b, 2 * q, 2 * w)
    a11, a12, a21, a22 = a[:h, :q], a[:h, q:], a[h:, :q], a[h:, q:]
    b11, b12, b21, b22 = b[:q, :w], b[:q, w:], b[q:, :w], b[q:, w:]
    out = np.zeros((2 * h, 2 * w), a.dtype)
    c11, c12, c21, c22 = out[:h, :w], out[:h, w:], out[h:, :w], out[h:, w:]
    # each product goes into the quarters that need it, and is dropped
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11 += p
    c22 += p
    p = strassen(a21 + a22, b11, leaf)
    c21 += p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12 += p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by smaller id: a heap of one anchor, in order."""
    if len(scores) > 4 * k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        scores, ids = scores[keep], ids[keep]
    order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), np.int64) if scores.dtype == object else np.lexsort((ids, ~scores))
    return scores[order[:k]], ids[order[:k]]


def _matrix(column, width: int, exact: bool) -> np.ndarray:
    """Rows of a list column as integers, padded with zeros to a width; Python's integers if 64 bits may not do."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    counts = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), object if not exact else np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), counts)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[row, at] = flat.astype(np.int64) if exact else [int(x) for x in flat.tolist()]
    return out


def _cell(anchors: pa.Table, rows: pa.Table) -> tuple:
    """Anchor and candidate ids, labels and matrices of one task; candidates in order of id."""
    A.give_back()
    lists = [t.column("vec").combine_chunks() for t in (anchors, rows)]
    lists = [x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks) for x in lists]
    width = max(int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in lists)
    top = [float(np.abs(x.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).max(initial=0)) for x in lists]
    exact = top[0] * top[1] * max(width, 1) < 2 ** 62 and max(top) < 2 ** 62
    order = np.argsort(ids := rows.column("vec_id").to_numpy(), kind="stable")
    return (anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(), _matrix(lists[0], width, exact),
            ids[order], rows.column("label").to_numpy()[order], _matrix(lists[1], width, exact)[order])


def _tiles(a: np.ndarray, b: np.ndarray):
    """(anchor slice, row slice, scores) of all tiles."""
    for i in range(0, len(a), TILE_ANCHORS):
        for j in range(0, len(b), TILE_ROWS):
            yield slice(i, i + TILE_ANCHORS), slice(j, j + TILE_ROWS), strassen(a[i:i + TILE_ANCHORS], np.ascontiguousarray(b[j:j + TILE_ROWS].T))


def _merge(heaps: dict, key, scores, ids, k: int) -> None:
    if len(scores):
        held = heaps.get(key)
        if held is not None:
            scores, ids = np.concatenate([held[0], scores]), np.concatenate([held[1], ids])
        heaps[key] = best(scores, ids, k)


def _longs(values) -> pa.Array:
    return pa.array([min(max(int(x), LONG[0]), LONG[1]) for x in values], pa.int64())


def clean(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part; vec holds whole numbers as doubles."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("vec"))
    own = own.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite))
    # Spark's floor gives a long, which a large double does not fit
    whole = F.transform("vec", lambda x: F.when(F.abs(x) < F.lit(2.0 ** 52), F.floor(x).cast("double")).otherwise(x))
    return own.withColumn("vec", whole)


def mine(vectors: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Negatives of each anchor and positive: anchor_id, slot and positive_id, rank, negative_id, and both scores.

    ``vectors``: (vec_id, label, vec) as ``clean`` gives.  A negative's score is from ``low`` to ``high``
    hundredths of the positive's.  slot: the positive's place among the anchor's, from 1.
    """
    spark = vectors.sparkSession
    rows = written(vectors, "negatives-rows")
    n, top = rows.agg(F.count("*"), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x))))).first()
    if (top or 0) < 2 ** 15:  # two bytes a component travel, not eight
        rows = rows.withColumn("vec", F.col("vec").cast("array<smallint>"))
    anchors = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.*")
    anchors = written(anchors, "negatives-anchors")
    blocks = max(1, -(-anchors.count() // BLOCK))
    cells = max(1, -(-n // CELL), min(SPREAD, n // 1024))
    # a written table's rows keep their order, so a retry deals them alike
    dealt = rows.withColumn("cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def everywhere(df):
        df = df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        return df.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))

    def met(left, task, schema):
        return everywhere(left).groupBy("block", "cell").cogroup(dealt.groupBy("block", "cell")).applyInArrow(task, schema)

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        heaps: dict = {}
        if len(left) and len(right):
            a_ids, a_labels, a, ids, labels, b = _cell(left, right)
            for label in np.unique(a_labels):
                mine, own = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
                for i, j, scores in _tiles(a[mine], b[own]):
                    near = ids[own[j]]
                    for x, line in zip(mine[i].tolist(), scores, strict=True):
                        other = near != a_ids[x]
                        _merge(heaps, int(a_ids[x]), line[other], near[other], n_positives)
        flat = [(x, i, s) for x, (ss, ii) in heaps.items() for s, i in zip(ss.tolist(), ii.tolist(), strict=True)]
        return pa.table([pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.int64()), _longs([f[2] for f in flat])],
                        ["anchor_id", "positive_id", "positive_score"])

    found = met(anchors, positives, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= n_positives)
    found = written(found, "negatives-positives")
    asked = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("asked"))

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        heaps: dict = {}
        if len(left) and len(right):
            a_ids, a_labels, a, ids, labels, b = _cell(left, right)
            # whole numbers s with low * p <= 100 s <= high * p
            spans = [[(r["slot"], -(-low * r["positive_score"] // 100), high * r["positive_score"] // 100) for r in x] for x in left.column("asked").to_pylist()]
            for i, j, scores in _tiles(a, b):
                near, kinds = ids[j], labels[j]
                for x, line in zip(range(len(a))[i], scores, strict=True):
                    floor, roof = min(s[1] for s in spans[x]), max(s[2] for s in spans[x])
                    fit = np.flatnonzero((line >= floor) & (line <= roof) & (kinds != a_labels[x]) & (near != a_ids[x]))
                    some, own = line[fit], near[fit]
                    for slot, lo, hi in spans[x]:
                        keep = (some >= lo) & (some <= hi)
                        held = heaps.get((int(a_ids[x]), slot))
                        if held is not None and len(held[0]) == n_negatives:
                            keep &= some >= held[0][-1]
                        _merge(heaps, (int(a_ids[x]), slot), some[keep], own[keep], n_negatives)
        flat = [(x, slot, i, s) for (x, slot), (ss, ii) in heaps.items() for s, i in zip(ss.tolist(), ii.tolist(), strict=True)]
        return pa.table([pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.int32()),
                         pa.array([f[2] for f in flat], pa.int64()), _longs([f[3] for f in flat])], ["anchor_id", "slot", "negative_id", "negative_score"])

    found_negatives = met(anchors.join(asked, "vec_id"), negatives, "anchor_id long, slot int, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found_negatives.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    return ranked.join(found, ["anchor_id", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "slot")


def op12_hard_negatives(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    out = mine(clean(vectors))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT vec_id, label, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v WHERE vec_id % 100 = 0),
c AS (SELECT vec_id, label, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM a JOIN c ON a.i = c.i AND a.vec_id <> c.vec_id GROUP BY 1, 2, 3),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY rank <= 10
"""
