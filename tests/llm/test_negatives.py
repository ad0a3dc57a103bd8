"""Operator 12 against a brute force over all pairs."""

import math
import random

import numpy as np
import pytest

from paygrid.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, cell string, slot int"


def brute(rows, every=100, n_positives=5, n_negatives=10):
    taken = []
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(256 * x) for x in vec):
            continue
        taken.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in vec]))
    anchors = {}
    for i, label, vec in taken:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, vec)), (label, vec))
    out = []
    for a, (label, vec) in anchors.items():
        score = lambda v: sum(x * y for x, y in zip(vec, v))  # noqa: E731, B023
        others = sorted((-score(v), i, own) for i, own, v in taken if i != a)
        for p, i, _ in [o for o in others if o[2] == label][:n_positives]:
            good = [o for o in others if o[2] != label and 30 * -p <= 100 * -o[0] <= 90 * -p][:n_negatives]
            out += [(a, i, r, j, -p, -s) for r, (s, j, _) in enumerate(good, 1)]
    return sorted(out)


def run(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(tuple(r) for r in N.op12_hard_negatives(spark, str(tmp_path)).collect())


def vectors(n, dims, rng, values=(-1.0, -0.5, 0.0, 0.25, 0.5, 1.0)):
    return [(i, [rng.choice(values) for _ in range(dims)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("m,k,n,leaf", [(1, 1, 1, 1), (7, 5, 3, 1), (16, 16, 16, 2), (33, 17, 50, 4), (128, 64, 200, 32), (3, 0, 4, 1)])
def test_strassen_equals_the_plain_product(m, k, n, leaf):
    rng = np.random.default_rng(m)
    a, b = rng.integers(-2 ** 20, 2 ** 20, (m, k)), rng.integers(-2 ** 20, 2 ** 20, (k, n))
    assert (N.strassen(a, b, leaf) == a @ b).all()
    big = a.astype(object) * 2 ** 70
    assert (N.strassen(big, b.astype(object), leaf) == big @ b.astype(object)).all()
    wide = rng.integers(-2 ** 28, 2 ** 28, (m, k))
    assert (N.strassen(wide, b, leaf) == wide @ b).all()   # beyond 53 bits


def test_ties_bad_rows_and_repeats(spark, tmp_path):
    rng = random.Random(1)
    rows = vectors(330, 6, rng)
    rows += [(None, [1.0] * 6, 1), (401, None, 1), (402, [1.0, None, 1.0], 1), (403, [float("nan")] * 6, 1), (404, [float("inf")] * 6, 0),
             (405, [1.0] * 6, None), (500, [1.0] * 6, None), (406, [], 1), (407, [1.0, 1.0], 1), (408, [1.0] * 9, 2), (600, [], 0),
             (rows[100][0], rows[100][1], rows[100][2]), (200, [0.5] * 6, 2), *rows[30:60], (-100, [1.0, 0.5], 0)]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_small_tiles_cells_and_blocks(spark, tmp_path, monkeypatch):
    for name, value in {"CELL": 40, "BLOCK": 2, "TILE_ANCHORS": 2, "TILE_ROWS": 9, "LEAF": 1}.items():
        monkeypatch.setattr(N, name, value)
    rows = vectors(420, 5, random.Random(2))
    assert run(spark, tmp_path, rows) == brute(rows)


def test_one_label_holds_most_rows_and_large_components(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1e6, 1e6) for _ in range(4)], 0 if i % 9 else i % 10) for i in range(250)]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_scores_beyond_64_bits_are_the_nearest_long(spark, tmp_path):
    rows = [(100, [1e30], 1), (1, [1e30], 1), (2, [5e29], 2), (3, [1.0], 2)]
    got = run(spark, tmp_path, rows)
    assert got == []   # the positive's score is cut to a long, and no negative's is in its window
    assert N.strassen(np.array([[10 ** 30]], object), np.array([[10 ** 30]], object))[0, 0] == 10 ** 60


def test_empty_and_without_anchors(spark, tmp_path):
    frame = spark.createDataFrame([], SCHEMA)
    assert N.mine(N.clean(frame)).collect() == []
    frame = spark.createDataFrame([(1, [1.0], 1, "x", 1)], SCHEMA)
    assert N.mine(N.clean(frame)).collect() == []
