"""Which keys of a document occur in other places: a packed key exchange.

Long texts have a key at nearly every position, so one row a key would be
most of the cost.  Here a task packs the keys of many documents by key
bucket: document ids, positions and keys in byte planes that compress well.
Before the shuffle a task keeps one entry a key (the earliest), so a key that
a third of all rows share costs one entry a task, and what it already knows
locally travels on as an answer.  A reducer sees the packs of one bucket,
sorts its keys, and answers with rows (id, base, lows): positions base * 65536
+ low.  Joined back on the id, they tell each document its hits.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paygrid.llm.arrays import NULL_ID, give_back

CHUNK_ENTRIES = 1_000_000
#: A sieve has so many bits a key, up to so many in all (8 MB, which every task is told).
SIEVE_EACH = 32
SIEVE_BITS = 1 << 26
SALTS = 32
REQUEST = "bucket int, pack binary"
REPLY = "id long, base int, lows binary"


def buckets(df: DataFrame) -> int:
    """Key buckets: twice the session's shuffle partitions, so they grow with the cluster's setting; 128 at least."""
    return max(128, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _planes(a: np.ndarray) -> bytes:
    """Little-endian byte planes: small numbers leave planes of zeros."""
    a = np.ascontiguousarray(a)
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _unplanes(buf, at: int, n: int, kind) -> tuple[np.ndarray, int]:
    size = np.dtype(kind).itemsize
    a = np.frombuffer(buf, np.uint8, n * size, at).reshape(size, n).T
    return np.ascontiguousarray(a).view(kind).reshape(n), at + n * size


def _pack(docs: np.ndarray, code: np.ndarray, keys: np.ndarray | None) -> bytes:
    """docs: ids in order; code: document << 32 | position, in order."""
    doc, pos = (code >> 32), (code & 0xFFFFFFFF).astype(np.uint32)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    gaps = np.diff(pos, prepend=np.uint32(0)).astype(np.uint32)
    gaps[first] = pos[first]
    counts = np.diff(first, append=len(doc)).astype(np.uint32)
    head = struct.pack("<IIB", len(first), len(doc), 0 if keys is None else keys.itemsize)
    own = np.diff(docs[doc[first]], prepend=0)
    return b"".join([head, _planes(own), _planes(counts), _planes(gaps), b"" if keys is None else keys.tobytes()])


def _unpack(buf) -> tuple:
    """(ids, document index, position, keys or None)."""
    n_docs, n, size = struct.unpack_from("<IIB", buf)
    ids, at = _unplanes(buf, 9, n_docs, np.int64)
    counts, at = _unplanes(buf, at, n_docs, np.uint32)
    gaps, at = _unplanes(buf, at, n, np.uint32)
    ids = np.cumsum(ids)
    doc = np.repeat(np.arange(n_docs), counts)
    pos = np.cumsum(gaps, dtype=np.int64)
    first = np.cumsum(counts, dtype=np.int64) - counts
    pos -= np.repeat(pos[first] - gaps[first], counts)
    keys = np.frombuffer(buf, np.uint32 if size == 4 else np.uint64, n, at) if size else None
    return ids, doc, pos, keys


class Requests:
    """Gathers a task's entries and packs them by bucket.

    ``earliest``: only later occurrences are hits, and keys travel whole (64 bits
    beside the bucket's own bits); else every place of a key with two or more is a
    hit, and 32 bits beside the bucket's are enough, as the caller verifies hits.
    """

    def __init__(self, n_buckets: int, earliest: bool, prefer=None):
        self.n, self.earliest, self.prefer = n_buckets, earliest, prefer
        self.held: list[tuple] = []
        self.count = 0

    def add(self, ids: np.ndarray, row: np.ndarray, pos: np.ndarray, key: np.ndarray):
        self.held.append((ids[row] if len(row) else np.zeros(0, np.int64), pos.astype(np.uint32), key))
        self.count += len(row)
        if self.count >= CHUNK_ENTRIES:
            yield from self.flush()

    def flush(self):
        if not self.count:
            return
        columns = [list(x) for x in zip(*self.held, strict=True)]
        self.held, self.count = [], 0
        ids, pos, key = (np.concatenate(columns.pop(0)) for _ in range(3))
        if len(ids) > 1 and (ids[1:] < ids[:-1]).any():
            order = np.argsort(ids, kind="stable")
            ids, pos, key = ids[order], pos[order], key[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        docs = ids[first]
        code = (np.repeat(np.arange(len(docs)), np.diff(first, append=len(ids))) << 32) | pos.astype(np.int64)
        del ids, pos
        order = np.argsort(key)
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(start, append=len(key))
        code = code[order]
        del order
        least = np.minimum.reduceat(code, start)
        most = np.maximum.reduceat(code, start)
        many = np.flatnonzero(most != least)
        rows_b, rows_p = [], []
        if len(many):
            at = np.repeat(least, size)
            own = code[np.repeat(most != least, size) & ((code != at) if self.earliest else True)]
            # no key, so any bucket will do: spread by the smallest id
            rows_b.append(int(docs[own[0] >> 32] % self.n))
            own.sort()
            rows_p.append(_pack(docs, own[np.concatenate([[True], own[1:] != own[:-1]])], None))
        if self.prefer is not None and len(many):
            good = np.where(self.prefer(code & 0xFFFFFFFF), code, np.int64(2 ** 62))
            best = np.minimum.reduceat(good, start)
            least = np.where(best < 2 ** 62, best, least)
        key = key[start]
        edge = np.searchsorted(key >> np.uint64(32), (np.arange(self.n + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(self.n))
        edge[-1] = len(key)
        for b in range(self.n):
            lo, hi = edge[b], edge[b + 1]
            if hi > lo:
                order = np.argsort(least[lo:hi])
                own = key[lo:hi][order]
                rows_b.append(b)
                rows_p.append(_pack(docs, least[lo:hi][order], own if self.earliest else own.astype(np.uint32)))
        del key, code, start, size, least, most
        # a few MB a batch keeps the JVM side small
        for at in range(0, len(rows_b), 64):
            yield pa.RecordBatch.from_arrays([pa.array(rows_b[at:at + 64], pa.int32()), pa.array(rows_p[at:at + 64], pa.binary())], ["bucket", "pack"])
        give_back()


def _rows(ids: np.ndarray, pos: np.ndarray) -> pa.Table:
    """Reply rows of hits in (id, position) order."""
    base = (pos >> 16).astype(np.int32)
    cut = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (base[1:] != base[:-1])])) if len(ids) else np.zeros(0, np.int64)
    offs = np.append(cut * 2, len(ids) * 2).astype(np.int32)
    data = (pos & 0xFFFF).astype("<u2").tobytes()
    lows = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(data)])
    return pa.table([pa.array(ids[cut], pa.int64()), pa.array(base[cut], pa.int32()), lows], ["id", "base", "lows"])


def answers(requests: DataFrame, earliest: bool, needs=None) -> DataFrame:
    """Reply rows to packed requests.

    ``needs(positions)``: flags of entries of which a key needs one at least to be a hit.
    """

    def reduce(table: pa.Table) -> pa.Table:
        give_back()
        packs = [_unpack(x.as_buffer()) for x in table.column("pack").combine_chunks()]
        every = np.unique(np.concatenate([x[0] for x in packs]))
        done, code, key = [], [], []
        for ids, doc, pos, keys in packs:
            own = (np.searchsorted(every, ids)[doc] << 32) | pos
            if keys is None:
                done.append(own)
            else:
                code.append(own)
                key.append(keys)
        del packs
        if key:
            key, code = np.concatenate(key), np.concatenate(code)
            order = np.argsort(key)
            key, code = key[order], code[order]
            del order
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(start, append=len(key))
            least = np.minimum.reduceat(code, start)
            # a row given twice is in one place, not in two
            many = np.maximum.reduceat(code, start) != least
            if needs is not None:
                many &= np.logical_or.reduceat(needs(code & 0xFFFFFFFF), start)
            hit = np.repeat(many, size)
            if earliest:
                hit &= code != np.repeat(least, size)
            done.append(code[hit])
        code = np.sort(np.concatenate(done))
        if len(code):
            code = code[np.concatenate([[True], code[1:] != code[:-1]])]
        return _rows(every[code >> 32], code & 0xFFFFFFFF)

    return requests.groupBy("bucket").applyInArrow(reduce, REPLY)


def row_keys(docs: DataFrame) -> DataFrame | None:
    """(id, digest, row): numbers of the distinct rows in order of id (null first) and text's digest.

    None if ids tell the texts apart: no null id, and no id with two texts.
    """
    # not at the top: tasks carry this module, and workers have no other part of the library
    from paygrid.llm.staging import written

    own = docs.select(_id().alias("id"), _digest().alias("digest"))
    texts = own.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
    if texts.filter((F.col("a") < F.col("b")) | (F.col("id") == NULL_ID)).isEmpty():
        return None
    # a sort's partitions are in order, and so are these numbers
    numbered = own.distinct().orderBy("id", "digest").select("id", "digest", F.monotonically_increasing_id().alias("row"))
    return written(numbered, "row-keys")


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def _digest():
    return F.md5(F.coalesce("text", F.lit("")))


def with_row_key(docs: DataFrame, keys: DataFrame | None) -> DataFrame:
    """docs with ``__row``: the row's number, or its id if keys is None."""
    if keys is None:
        return docs.withColumn("__row", _id())
    keys = keys.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("row").alias("__row"))
    return docs.withColumn("__id", _id()).withColumn("__digest", _digest()).join(keys, ["__id", "__digest"]).drop("__id", "__digest")


def key_columns(keys: DataFrame | None) -> list:
    """Columns of a document that tell its row key, without a join: its id, and its text's digest if keys are given."""
    return [_id().alias("__id")] if keys is None else [_id().alias("__id"), _digest().alias("__digest")]


def by_key(rows: DataFrame, keys: DataFrame | None) -> DataFrame:
    """rows with ``key_columns`` in place of the row key ``__row``."""
    if keys is None:
        return rows.withColumnRenamed("__row", "__id")
    keys = keys.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("row").alias("__row"))
    return rows.join(keys, "__row").drop("__row")


def keyed(docs: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(id, text): what travels of a document; id is its row key, and ``doc`` its doc_id where that is another."""
    rows = with_row_key(docs.select("doc_id", "text"), keys)
    return rows.select(F.col("__row").alias("id"), *([] if keys is None else [F.col("doc_id").cast("long").alias("doc")]), "text")


def doc_ids(batch) -> pa.Array:
    """The doc_ids of rows that ``keyed`` made."""
    at = batch.schema.get_field_index("doc")
    return batch.column(at if at >= 0 else batch.schema.get_field_index("id")).cast(pa.int64())


def compact(docs: DataFrame) -> DataFrame:
    """(id, doc if there is one, size, text): the text as a zstd frame, half of what a shuffle's own compression leaves."""
    carried = ["id", "doc"] if "doc" in docs.columns else ["id"]
    from paygrid.llm import arrays as A

    def pack(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        for batch, offs, data in A.text_slices(batches):
            raw = data.tobytes()
            at = offs.tolist()
            yield pa.RecordBatch.from_arrays([
                *(batch.column(batch.schema.get_field_index(c)) for c in carried), pa.array(np.diff(offs), pa.int64()),
                pa.array([press(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
            ], [*carried, "size", "text"])

    # not null: else an inner join filters before its exchange, and the outer join cannot reuse that
    kinds = {c: T.LongType() for c in [*carried, "size"]} | {"text": T.BinaryType()}
    return docs.mapInArrow(pack, T.StructType([T.StructField(n, k, n == "doc") for n, k in kinds.items()]))


def copies(docs: DataFrame) -> DataFrame:
    """Ids of the rows whose whole text an earlier id has too."""
    own = docs.select("id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    first = own.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # a third of all rows may share a text: its rows are dealt over SALTS tasks
    first = first.filter("first < last").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = own.withColumn("salt", F.pmod("id", F.lit(SALTS)).cast("int"))
    return own.join(first, ["digest", "salt"]).filter("id > first").select("id").distinct().withColumn("copy", F.lit(True))


def sifted(rows: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that are not among keys, the others); on: columns of both, never null.

    A bitmap of the keys' hashes tells the first kind, which need not travel to a join.  The others are to be joined
    still: some meet only the hash of a key, more of them where keys are more than the bitmap's bits.
    """
    bits = min(SIEVE_BITS, 1 << max(15, (SIEVE_EACH * keys.count()).bit_length()))
    slot = F.pmod(F.xxhash64(*on), F.lit(bits))
    marks = keys.select(slot.alias("__slot")).groupBy(F.bitmap_bucket_number("__slot").alias("__part"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("__slot")).alias("__marks"))
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("__marks", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    rows = rows.withColumn("__part", F.bitmap_bucket_number(slot)).join(F.broadcast(marks), "__part", "left").withColumn("__met", met)
    return tuple(rows.filter(F.col("__met") == kind).drop("__part", "__marks", "__met") for kind in (False, True))


def with_hits(docs: DataFrame, replies: DataFrame) -> DataFrame:
    """docs (id, text) with ``hits``: an array of (base, lows), null without any."""
    per = replies.groupBy("id").agg(F.collect_list(F.struct("base", "lows")).alias("hits"))
    return docs.join(per, "id", "left")


def hit_flags(column: pa.Array, starts: np.ndarray, total: int) -> np.ndarray:
    """Flags over a slice's positions; starts: each row's first position."""
    flags = np.zeros(total, bool)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return flags
    counts = np.diff(column.offsets.to_numpy())
    if column.null_count:
        counts = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, counts)
    inner = column.flatten()
    if len(inner) == 0:
        return flags
    row = np.repeat(np.arange(len(column)), counts)
    base = inner.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
    lows = inner.field(1)
    if lows.offset or inner.offset:
        lows = pa.concat_arrays([lows])
    offs = np.frombuffer(lows.buffers()[1], np.int32)[lows.offset:lows.offset + len(lows) + 1]
    data = np.frombuffer(lows.buffers()[2], np.uint8)[offs[0]:offs[-1]].view("<u2")
    each = np.diff(offs) // 2
    flags[np.repeat(starts[row] + (base << 16), each) + data] = True
    return flags


def whole_rows(batch, first: np.ndarray, size: int) -> np.ndarray:
    """Flags over all positions of the rows that are copies and hold a window of ``size``."""
    copy = batch.column(batch.schema.get_field_index("copy")).fill_null(False).to_numpy(zero_copy_only=False)
    counts = np.diff(first)
    return np.repeat(copy.astype(bool) & (counts >= size), counts)
