"""Byte-level BPE encoding and decoding through a global distinct-word shuffle (operator 9).

1. Tasks cut texts into pre-tokens and keep, for a chunk of documents, the
   distinct words and each position's number among them (written once to the
   shared folder, in buckets by chunk, so later steps and retries see the same chunks).
2. The chunks' words are shuffled by word bucket; each distinct word of a bucket
   is merged to token ids once, however many chunks have it.
3. The ids return to their chunks, and every document is put together again by
   position.

A word that a third of all rows share comes once from each chunk.  Decoding
joins ids with the token-byte table (one row a token; fixed by the vocabulary).

Defined cases: a null or empty text has no ids and decodes to no bytes; a text
of one very long word is one word, merged in n log n; rows that repeat an id
are encoded each; a null doc_id is kept; an empty table gives no rows; only
doc_id and text are read.
"""

from __future__ import annotations

import array
import base64
import heapq
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paygrid.llm import arrays as A
from paygrid.llm.exchange import _planes, _unplanes
from paygrid.session import scratch_path

CHUNK_BYTES = 8 << 20
PACKED = "chunk long, bucket int, kind int, body binary"
#: White space of the pattern (Unicode's White_Space), for a pattern of Python's re.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _char_class(prop: str) -> str:
    """The code points of a Unicode property, as ranges of a character class."""
    import regex

    test = regex.compile(rf"\p{{{prop}}}+")
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = []
    for m in test.finditer(every):
        run = m[0]
        start = 0
        for i in range(1, len(run) + 1):
            if i == len(run) or ord(run[i]) != ord(run[i - 1]) + 1:
                out.append(f"\\U{ord(run[start]):08x}-\\U{ord(run[i - 1]):08x}")
                start = i
    return "".join(out)


def compiled(pattern: str) -> str:
    """The pattern for Python's re, which is several times faster than regex."""
    letters, digits = _char_class("L"), _char_class("N")
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{WHITE}{letters}{digits}]")
    out = inside.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
    return out.replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a word: again and again the adjacent pair of least rank, the leftmost first, becomes one."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= 64:
        parts = [word[i:i + 1] for i in range(n)]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]
    end = list(range(1, n + 1))       # of the part that starts here; 0: no part
    before = list(range(-1, n - 1))   # start of the part before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not end[i] or end[i] == n or end[end[i]] != stop:
            continue
        j = end[i]
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class _Index(dict):
    """word -> index, in order of first use."""

    def __missing__(self, word):
        self[word] = at = len(self)
        return at


def encode(docs: DataFrame, ranks_path: str, pattern: str, with_decoded: bool = False) -> DataFrame:
    """(doc_id, ids): each document's token ids; with ``decoded``, their bytes again."""
    spark = docs.sparkSession
    n_buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))
    tokens_of = spark.sparkContext.broadcast(token_table(ranks.value))
    source = compiled(pattern)

    def pack(batches):
        import re
        import zlib

        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        find = re.compile(source).findall

        def chunk(ids, counts, at, index):
            own = int.from_bytes(os.urandom(8), "little", signed=True)
            at = np.concatenate(at)
            # frequent words get small numbers: their byte planes compress best
            order = np.argsort(-np.bincount(at, minlength=len(index)), kind="stable")
            number = np.empty(len(order), np.uint32)
            number[order] = np.arange(len(order), dtype=np.uint32)
            at = number[at]
            body = len(ids).to_bytes(8, "little") + _planes(np.array(ids, np.int64)) + _planes(np.array(counts, np.uint32)) + _planes(at)
            rows = [(own, 0, 0, press(body))]
            words = list(index)
            words = [words[i].encode() for i in order.tolist()]
            into = np.fromiter((zlib.crc32(w) % n_buckets for w in words), np.int64, len(words))
            order = np.argsort(into, kind="stable")
            edge = np.searchsorted(into[order], np.arange(n_buckets + 1))
            for b in range(n_buckets):
                if (some := order[edge[b]:edge[b + 1]]).size:
                    mine = [words[i] for i in some]
                    sizes = np.fromiter(map(len, mine), np.uint32, len(mine))
                    rows.append((own, b, 1, press(len(mine).to_bytes(8, "little") + _planes(np.diff(some, prepend=0).astype(np.uint32)) + _planes(sizes) + b"".join(mine))))
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.binary())], ["chunk", "bucket", "kind", "body"])

        ids, counts, at, index, size = [], [], [], _Index(), 0
        for batch in (b.slice(k, 500) for b in batches for k in range(0, len(b), 500)):
            for i, text in zip(batch.column(0).fill_null(A.NULL_ID).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = find(text) if text else []
                ids.append(i)
                counts.append(len(found))
                at.append(np.fromiter(map(index.__getitem__, found), np.uint32, len(found)))
                size += len(text or "")
                if size >= CHUNK_BYTES:
                    yield chunk(ids, counts, at, index)
                    ids, counts, at, index, size = [], [], [], _Index(), 0
                    A.give_back()
        if ids:
            yield chunk(ids, counts, at, index)

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, PACKED)
    # in buckets by chunk: the positions need no shuffle of their own
    name = f"bpe_chunks_{os.urandom(8).hex()}"
    (packed.write.partitionBy("kind").bucketBy(n_buckets, "chunk").option("path", scratch_path(spark, name)).saveAsTable(name))
    packed = spark.table(name)

    def merge_words(table: pa.Table) -> pa.Table:
        A.give_back()
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        known: dict[bytes, int] = {}  # word -> its place among the bucket's distinct words
        flat, ends = array.array("I"), array.array("q", [0])
        table_of = ranks.value
        asked = []
        for raw in table.column("body"):
            raw = unpress(raw.as_buffer())
            n = int.from_bytes(raw[:8], "little")
            own, at = _unplanes(raw, 8, n, np.uint32)
            sizes, at = _unplanes(raw, at, n, np.uint32)
            places = np.empty(n, np.int64)
            for i, size in enumerate(sizes.tolist()):
                word = raw[at:at + size]
                at += size
                if (place := known.get(word)) is None:
                    place = known[word] = len(known)
                    flat.extend(merge(word, table_of))
                    ends.append(len(flat))
                places[i] = place
            asked.append((np.cumsum(own, dtype=np.uint32), places))
        flat, ends = np.frombuffer(flat, np.uint32), np.frombuffer(ends, np.int64)
        bodies = []
        for own, places in asked:
            counts = ends[places + 1] - ends[places]
            ids = flat[A.ranges_to_index(ends[places], counts)]
            bodies.append(zstandard.compress(len(own).to_bytes(8, "little") + _planes(own) + _planes(counts.astype(np.uint32)) + _planes(ids), 1))
        return pa.table([table.column("chunk"), pa.array(bodies, pa.binary())], ["chunk", "body"])

    def assemble(positions: pa.Table, words: pa.Table) -> pa.Table:
        A.give_back()
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        own, sizes, flat = [], [], []
        docs_body = unpress(positions.column("body")[0].as_py())
        for raw in words.column("body").to_pylist():
            raw = unpress(raw)
            n = int.from_bytes(raw[:8], "little")
            a, at = _unplanes(raw, 8, n, np.uint32)
            b, at = _unplanes(raw, at, n, np.uint32)
            own.append(a)
            sizes.append(b)
            flat.append(_unplanes(raw, at, int(b.sum()), np.uint32)[0])
        n = int.from_bytes(docs_body[:8], "little")
        ids, at = _unplanes(docs_body, 8, n, np.int64)
        counts, at = _unplanes(docs_body, at, n, np.uint32)
        where, _ = _unplanes(docs_body, at, int(counts.sum()), np.uint32)
        if own:
            own, sizes, flat = np.concatenate(own), np.concatenate(sizes).astype(np.int64), np.concatenate(flat)
            start = np.empty(len(own), np.int64)
            start[own] = np.cumsum(sizes) - sizes
            size = np.empty(len(own), np.int64)
            size[own] = sizes
            tokens = flat[A.ranges_to_index(start[where], size[where])].astype(np.int32)
            per = np.concatenate([[0], np.cumsum(size[where])])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        else:
            tokens, per = np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), pa.array(tokens))
        out = [pa.array(ids, mask=ids == A.NULL_ID), lists]
        return pa.table([*out, _decoded(lists, *tokens_of.value)][:2 + with_decoded], ["doc_id", "ids", "decoded"][:2 + with_decoded])

    words = packed.filter("kind = 1").groupBy("bucket").applyInArrow(merge_words, "chunk long, body binary")
    positions = packed.filter("kind = 0").select("chunk", "body")
    schema = "doc_id long, ids array<int>" + ", decoded binary" * with_decoded
    return positions.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(assemble, schema)


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each id (none for an id without a token): their numbers, and all of them."""
    table = sorted((rank, token) for token, rank in ranks.items())
    size = np.zeros(table[-1][0] + 1, np.int64)
    size[[r for r, _ in table]] = [len(t) for _, t in table]
    return size, np.frombuffer(b"".join(t for _, t in table), np.uint8)


def _decoded(lists: pa.ListArray, size: np.ndarray, data: np.ndarray) -> pa.Array:
    """The bytes of each list of ids, joined from the token-byte table."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    width = size[flat]
    ends = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(counts)])]
    out = data[A.ranges_to_index((np.cumsum(size) - size)[flat], width)]
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """encoded with ``decoded``: the bytes of its ids; null ids give none."""
    tokens = encoded.sparkSession.sparkContext.broadcast(token_table(load_ranks(ranks_path)))

    def join(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                ids = part.column(part.schema.get_field_index("ids"))
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(ids, *tokens.value)], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(join, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def op9_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = encode(docs, path, public_tokenizers.PATTERN, with_decoded=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
