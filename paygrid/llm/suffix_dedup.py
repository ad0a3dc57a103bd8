"""Suffix-array dedup by difference-cover blockwise construction (operator 4).

Texts are UTF-8 bytes; a repeat is a string of ``length`` bytes that starts
earlier too.  A difference cover D modulo v has, for any two positions i and
j, a shift s < v with (i + s) mod v and (j + s) mod v both in D.  So:

0. Of texts that are equal as a whole only the first takes part: all strings of
   its copies start earlier.
1. *Cover sample.*  Only positions in D are keyed, by their next
   ``length - v + 1`` bytes, and sorted bucket by bucket (``exchange``): equal
   keys have equal ranks.  Two suffixes that agree on ``length`` bytes have a
   pair of equally ranked sample positions inside them.  A suffix without a
   tied sample cannot tie that deep; its order past that depth is never needed.
2. *Suffix buckets.*  The suffixes that can tie are dealt into buckets by their
   key and each task sorts one bucket at a time; inside a tie the smallest
   (doc_id, start) is the first, all others are repeats.
3. Overlapping repeats merge into maximal runs of bytes, which are removed.

Only a depth of ``length`` bytes is ever sorted, since deeper order changes no
removal; keys are 64-bit hashes of the bytes beside the bucket's own bits.

Defined cases: a null text is empty; empty and short texts lose nothing; a null
doc_id sorts first; different texts of a doc_id are documents of their own, in
order of a digest; a row given twice does not repeat itself; an empty table
gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm import arrays as A
from paygrid.llm import exchange as X
from paygrid.llm.staging import written
from paygrid.llm.substring_dedup import _rows, runs

#: A perfect difference set: its differences modulo 57 are 1 to 56, once each.
COVER_MODULUS = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
SCHEMA = "doc_id long, n_bytes long, n_removed long, kept binary, removed array<struct<start:int,end:int>>"


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row a document: byte counts, the kept bytes, and the removed runs [start, end)."""
    if length < COVER_MODULUS + 16:
        raise ValueError(f"length must be {COVER_MODULUS + 16} at least")
    depth = length - COVER_MODULUS + 1
    n_buckets = X.buckets(docs)
    codes = A.byte_codes()
    cover = np.array(COVER)
    rank = np.zeros(COVER_MODULUS, np.int64)
    rank[cover] = np.arange(len(cover))
    rows = X.keyed(docs, X.row_keys(docs))
    copies = X.copies(rows)
    own = X.compact(rows)
    single = own.join(copies, "id", "left_anti")

    def sample(batches):
        roll, out = A.Rolling(), X.Requests(n_buckets, False)
        for batch, offs, data in A.text_slices(batches):
            counts = np.maximum(np.diff(offs) - depth + 1, 0)
            cycles = -(-counts // COVER_MODULUS)
            row = np.repeat(np.arange(len(counts)), cycles)
            pos = (A.ranges_to_index(np.zeros(len(counts), np.int64), cycles) * COVER_MODULUS)[:, None] + cover
            row, pos = np.repeat(row, len(cover)), pos.ravel()
            keep = pos < counts[row]
            row, pos = row[keep], pos[keep]
            keys = roll.at(roll.prefix(codes[data]), pos + offs[row], depth)
            ordinal = pos // COVER_MODULUS * len(cover) + rank[pos % COVER_MODULUS]
            yield from out.add(A.ids(batch, "id"), row, ordinal, keys)
        yield from out.flush()

    def tied_flags(batch, offs):
        """Flags over the bytes of the tied sample positions."""
        per = (np.diff(offs) // COVER_MODULUS + 1) * len(cover)
        first = np.concatenate([[0], np.cumsum(per)])
        hits = np.flatnonzero(X.hit_flags(batch.column(batch.schema.get_field_index("hits")), first[:-1], int(first[-1])))
        row = np.searchsorted(first, hits, "right") - 1
        hits -= first[row]
        flags = np.zeros(int(offs[-1]), bool)
        flags[offs[row] + hits // len(cover) * COVER_MODULUS + cover[hits % len(cover)]] = True
        return flags

    def suffixes(batches):
        roll, out = A.Rolling(), X.Requests(n_buckets, True)
        for batch, offs, data in A.text_slices(batches):
            tied = tied_flags(batch, offs)
            total = np.concatenate([[0], np.cumsum(tied)])
            near = total[np.minimum(np.arange(len(tied)) + COVER_MODULUS, len(tied))] > total[:-1]
            index, row = _rows(offs[:-1], np.maximum(np.diff(offs) - length + 1, 0), near)
            keys = roll.at(roll.prefix(codes[data]), index, length)
            yield from out.add(A.ids(batch, "id"), row, index - offs[row], keys)
        yield from out.flush()

    def finish(batches):
        for batch, offs, data in A.text_slices(batches):
            hits = X.hit_flags(batch.column(batch.schema.get_field_index("hits")), offs[:-1], len(data))
            gone = A.covered(hits, length) | X.whole_rows(batch, offs, length)
            total = np.concatenate([[0], np.cumsum(gone)])[offs]
            at = (offs - total).astype(np.int32)
            kept = data[~gone].tobytes()
            yield pa.RecordBatch.from_arrays([
                X.doc_ids(batch), pa.array(np.diff(offs), pa.int64()),
                pa.array(np.diff(total), pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(kept)]),
                runs(gone, offs),
            ], ["doc_id", "n_bytes", "n_removed", "kept", "removed"])

    # written, so that the sample's shuffle is gone before the suffixes need the disk
    ties = written(X.answers(single.mapInArrow(sample, X.REQUEST), False), "cover-ties")
    near = X.with_hits(single, ties).filter(F.col("hits").isNotNull())
    repeats = X.answers(near.mapInArrow(suffixes, X.REQUEST), True)
    return X.with_hits(own, repeats).join(copies, "id", "left").mapInArrow(finish, SCHEMA)


def op4_suffix_array_dedup(spark, sf_dir):
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                      F.sha2(F.col("kept"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM t WHERE length(h) >= 200)),
later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min((doc_id, p)) OVER (PARTITION BY k) AS f FROM starts)
  WHERE f <> (doc_id, p)),
mark AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER o + 100 THEN 0 ELSE 1 END AS fresh
  FROM later WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
run AS (
  SELECT doc_id, min(p) AS s, max(p) + 100 AS e
  FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM mark) GROUP BY doc_id, g),
gaps AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM run),
cut AS (
  SELECT g.doc_id, count(*) AS n, sum(e - s) AS gone, max(e) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head
  FROM gaps g JOIN t USING (doc_id) GROUP BY g.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM t LEFT JOIN cut USING (doc_id)
"""
