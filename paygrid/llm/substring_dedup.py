"""Substring dedup by fixed-block anchors (operator 3).

A repeat of ``window`` words holds a whole block of ``window // 2`` words that
starts at a multiple of the block's size in its document.  So:

0. of texts that are equal as a whole only the first takes part: all windows of
   its copies start earlier;
1. every document indexes its non-overlapping blocks and probes them with
   every rolling window of the block's size (``exchange``); positions whose key
   meets a block elsewhere are anchors;
2. anchors are extended: each ``window`` around an anchor is keyed and grouped,
   and all but its earliest start are repeats (any other window cannot repeat);
3. overlapping repeats merge into maximal runs, which are removed.

Defined cases: null and empty texts have no words and come back empty; a null
doc_id sorts before all others; different texts of a doc_id are documents of their
own, in order of a digest; a row given twice does not repeat itself; an empty table gives no rows;
columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm import arrays as A
from paygrid.llm import exchange as X
from paygrid.llm.staging import written

SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>"


def _rows(first: np.ndarray, counts: np.ndarray, keep: np.ndarray | None = None):
    """(index, row) of the windows of each row; keep: flags over all positions."""
    index = A.ranges_to_index(first, counts)
    row = np.repeat(np.arange(len(counts)), counts)
    if keep is not None:
        keep = keep[index]
        index, row = index[keep], row[keep]
    return index, row


def runs(flags: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per row the runs of set flags, as [start, end) structs; first: n + 1 row starts."""
    step = np.diff(flags.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    edge = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(flags))]
    edge = np.unique(edge)
    both = edge[flags[edge] & flags[edge - 1]] if len(flags) else edge
    start = np.sort(np.concatenate([np.flatnonzero(step == 1), both]))
    end = np.sort(np.concatenate([np.flatnonzero(step == -1), both]))
    row = np.searchsorted(first, start, "right") - 1
    per = np.searchsorted(start, first).astype(np.int32)
    base = first[row] if len(row) else row
    pairs = pa.StructArray.from_arrays([pa.array((start - base).astype(np.int32)), pa.array((end - base).astype(np.int32))], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(per, pa.int32()), pairs)


def joined_words(data, starts, ends, keep, first) -> list[bytes]:
    """Per row its kept words, joined by one space."""
    s, size = starts[keep], (ends - starts)[keep] + 1
    index = A.ranges_to_index(s, size)
    np.minimum(index, max(len(data) - 1, 0), out=index)
    out = data[index] if len(index) else np.zeros(0, np.uint8)
    last = np.cumsum(size)
    out[last - 1] = 0x20
    whole = out.tobytes()
    at = np.concatenate([[0], last])[np.concatenate([[0], np.cumsum(keep)])[first]].tolist()
    return [whole[a:b - 1] if b > a else b"" for a, b in zip(at[:-1], at[1:], strict=True)]


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """One row a document: word counts, kept text, and the removed runs [start, end) of words."""
    block = window // 2
    n_buckets = X.buckets(docs)
    codes = A.byte_codes()
    rows = X.keyed(docs, X.row_keys(docs))
    copies = X.copies(rows)
    own = X.compact(rows)
    single = own.join(copies, "id", "left_anti")

    def keyed_words(roll, batch, offs, data):
        starts, ends, first = A.words(data, offs, A.SPACE)
        return roll.prefix(A.word_codes(roll, codes, data, starts, ends)), starts, ends, first

    def probe(batches):
        roll, out = A.Rolling(), X.Requests(n_buckets, False, lambda p: p % block == 0)
        for batch, offs, data in A.text_slices(batches):
            prefix, _, _, first = keyed_words(roll, batch, offs, data)
            index, row = _rows(first[:-1], np.maximum(np.diff(first) - block + 1, 0))
            yield from out.add(A.ids(batch, "id"), row, index - first[row], roll.at(prefix, index, block))
        yield from out.flush()

    def extend(batches):
        roll, out = A.Rolling(), X.Requests(n_buckets, True)
        for batch, offs, data in A.text_slices(batches):
            prefix, _, _, first = keyed_words(roll, batch, offs, data)
            anchors = X.hit_flags(batch.column(batch.schema.get_field_index("hits")), first[:-1], int(first[-1]))
            total = np.concatenate([[0], np.cumsum(anchors)])
            near = total[np.minimum(np.arange(len(anchors)) + window - block + 1, len(anchors))] > total[:-1]
            index, row = _rows(first[:-1], np.maximum(np.diff(first) - window + 1, 0), near)
            yield from out.add(A.ids(batch, "id"), row, index - first[row], roll.at(prefix, index, window))
        yield from out.flush()

    def finish(batches):
        for batch, offs, data in A.text_slices(batches):
            starts, ends, first = A.words(data, offs, A.SPACE)
            hits = X.hit_flags(batch.column(batch.schema.get_field_index("hits")), first[:-1], int(first[-1]))
            gone = A.covered(hits, window) | X.whole_rows(batch, first, window)
            total = np.concatenate([[0], np.cumsum(gone)])[first]
            yield pa.RecordBatch.from_arrays([
                X.doc_ids(batch), pa.array(np.diff(first), pa.int64()),
                pa.array(np.diff(total), pa.int64()),
                pa.array(joined_words(data, starts, ends, ~gone, first), pa.binary()).cast(pa.string()),
                runs(gone, first),
            ], ["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    # written, so that the probes' shuffle is gone before the windows need the disk
    anchors = written(X.answers(single.mapInArrow(probe, X.REQUEST), False, lambda p: p % block == 0), "block-anchors")
    near = X.with_hits(single, anchors).filter(F.col("hits").isNotNull())
    repeats = X.answers(near.mapInArrow(extend, X.REQUEST), True)
    return X.with_hits(own, repeats).join(copies, "id", "left").mapInArrow(finish, SCHEMA)


def op3_substring_dedup(spark, sf_dir):
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 19], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM w WHERE len(ws) >= 20)),
later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM starts)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM later),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.p) AS text, count(*) AS n
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.p = e.p WHERE g.p IS NULL GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
"""
