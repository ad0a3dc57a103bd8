"""Quality classifier by co-training two views (operator 6).

The *text-content* view measures words and symbols, the *page-metadata* view
what is known of the page without its words: length, lines, layout, language and
source.  Each view has a logistic regression.  Round by round, each adds its most
confident labels of unlabelled rows to the other's training rows; at the end both
are calibrated on labelled rows kept aside, and their calibrated log-odds are
averaged into the score of every document.

Training takes at most ``LABELLED`` labelled and ``UNLABELLED`` other rows (of
whole texts; only their features reach the driver); scoring is one pass without a
shuffle.  Defined cases: null and empty texts have features of an empty text;
null lang and source are a value of their own; without labels of both kinds the
score is the share of good labels (1 without labels, so nothing is rejected);
repeated rows come back each; letters are counted in whole texts; only doc_id, text, lang and source
of documents and the labels are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paygrid.llm.learning import bounded_sample, logistic, predict

LABELLED = 6_000
UNLABELLED = 6_000
ROUNDS = 5
#: Share of the unlabelled rows that each view labels in a round, by class, and how sure it must be.
EXCHANGE = 0.04
SURE = 0.95
CONTENT, PAGE = 10, 24
REJECT_BELOW = 0.5


def content_features(text: str) -> list[float]:
    words = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    marks = sum(text.count(c) for c in "#$%&*")
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    distinct = len(set(words))
    return [
        min(marks / n, 3), min(text.count("|") / n, 1), min(text.count("!") / n, 3), upper / n,
        distinct / n ** 0.8, float(distinct / n < 0.2 and len(words) > 20), min(sum(map(len, words)) / n, 20) / 5,
        sum(w[:1].isupper() for w in words) / n, sum(map(text.count, "0123456789")) / chars * 10, float(len(words) < 8),
    ]


def page_features(text: str, lang: str | None, source: str | None) -> list[float]:
    lines = text.split("\n")
    n, chars = len(lines), max(len(text), 1)
    blanks = max(text.count(" "), 1)
    packed = len(zlib.compress(text.encode("utf-8", "surrogatepass"), 1))
    out = [
        np.log1p(len(text)), np.log1p(n), np.log1p(max(map(len, lines))), min(text.count(".") / blanks, 1), min(text.count(",") / blanks, 1),
        float(sum(x[-1:].isalnum() for x in lines)) / n, min(packed / chars, 1.2) * 2, min(chars / blanks, 30) / 5,
        float(sum(map(str.isalpha, text))) / chars * 4, len(set(lines)) / n,
    ]
    place = [0.0] * (PAGE - len(out))
    place[zlib.crc32((lang or "?").encode()) % 6] = 1.0
    place[6 + zlib.crc32((source or "?").encode()) % 8] = 1.0
    return out + place


def _features(batch) -> tuple[np.ndarray, np.ndarray]:
    text, lang, source = ([x for x in batch.column(batch.schema.get_field_index(c)).to_pylist()] for c in ("text", "lang", "source"))
    a = np.array([content_features(t or "") for t in text], float).reshape(-1, CONTENT)
    b = np.array([page_features(t or "", x, s) for t, x, s in zip(text, lang, source, strict=True)], float).reshape(-1, PAGE)
    return a, b


def _sampled(docs: DataFrame, labels: DataFrame):
    """(content, page, quality or -1) arrays of the bounded training rows."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    with_label = bounded_sample(known, "doc_id", LABELLED, "quality")
    others = docs.select("doc_id").join(known, "doc_id", "left_anti").filter("doc_id is not null").distinct()
    without = bounded_sample(others, "doc_id", UNLABELLED, "quality").withColumn("quality", F.lit(-1))
    rows = with_label.select("doc_id", F.col("quality").cast("int")).union(without)

    def task(batches):
        for batch in batches:
            x = np.column_stack(_features(batch))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()), batch.column(batch.schema.get_field_index("quality")), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    # LABELLED + UNLABELLED rows of two numbers
    rows = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(rows), "doc_id").mapInArrow(task, "doc_id long, quality int, x array<double>")
    got = sorted((r["doc_id"], r["quality"], r["x"]) for r in rows.collect())
    x = np.array([g[2] for g in got], float).reshape(-1, CONTENT + PAGE)
    return x[:, :CONTENT], x[:, CONTENT:], np.array([g[1] for g in got], int)


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> dict | None:
    """Calibrated coefficients of the two views; y: 1, 0, or -1 for unlabelled."""
    labelled = np.flatnonzero(y >= 0)
    if not 0 < (y[labelled] == 1).sum() < len(labelled):
        return None
    aside, own = labelled[::4], np.setdiff1d(labelled, labelled[::4])
    if len(set(y[own])) < 2 or len(set(y[aside])) < 2:
        aside = own = labelled
    views, centre, scale = [a, b], [], []
    for i, v in enumerate(views):
        centre.append(v.mean(axis=0))
        scale.append(np.maximum(v.std(axis=0), 1e-6))
        views[i] = (v - centre[-1]) / scale[-1]
    given = [np.full(len(y), -1), np.full(len(y), -1)]
    for g in given:
        g[own] = y[own]
    free = y < 0
    b_of = [None, None]
    for _ in range(ROUNDS):
        for i in (0, 1):
            at = np.flatnonzero(given[i] >= 0)
            b_of[i] = logistic(views[i][at], given[i][at].astype(float))
        for i in (0, 1):
            p = predict(views[i], b_of[i])
            open_ = np.flatnonzero(free & (given[1 - i] < 0))
            many = int(EXCHANGE * free.sum())
            for label, sure in ((1, p[open_]), (0, 1 - p[open_])):
                best = open_[np.argsort(-sure, kind="stable")[:many]]
                best = best[(p if label else 1 - p)[best] >= SURE]
                given[1 - i][best] = label
    out = {"views": []}
    for i in (0, 1):
        z = views[i] @ b_of[i][:-1] + b_of[i][-1]
        slope = logistic(z[aside][:, None], y[aside].astype(float), ridge=1e-4)
        out["views"].append((centre[i], scale[i], b_of[i], slope))
    return out


def combined(model: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mean of the views' calibrated log-odds, as a probability."""
    total = 0.0
    for v, (centre, scale, coef, slope) in zip((a, b), model["views"], strict=True):
        z = ((v - centre) / scale) @ coef[:-1] + coef[-1]
        total = total + np.clip(z * slope[0] + slope[1], -12, 12)
    return 1 / (1 + np.exp(-total / 2))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with ``quality_score``: the probability that a document is good."""
    a, b, y = _sampled(docs, labels)
    model = co_train(a, b, y)
    prior = float((y == 1).sum() / (y >= 0).sum()) if (y >= 0).any() else 1.0

    def task(batches):
        for batch in (x.slice(k, 500) for x in batches for k in range(0, len(x), 500)):
            p = np.full(len(batch), prior) if model is None else combined(model, *_features(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, "quality_score"])

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def op6_quality_classifier(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs.select("doc_id", "text", "lang", "source"), labels)
    return scored.select("doc_id", F.col("quality_score").alias("score"), (F.col("quality_score") >= REJECT_BELOW).cast("int").alias("predicted"))
