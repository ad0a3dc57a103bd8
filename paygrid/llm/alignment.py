"""Cross-tokenizer alignment by products of token-byte incidence matrices (operator 13).

Two tokenizers cut the same bytes.  With A and B the token-byte incidence matrices, a nonzero of A·Bᵀ is a
pair of tokens whose byte ranges overlap (its value: the bytes they share), and with G the token-group
incidence, a nonzero of G_A·G_Bᵀ is a pair inside one group (a group ends where tokens of both end).

1. Both tokenizers cut before a space that follows a character that is no white space, whatever surrounds it
   (checked against the vocabulary), so a text is a list of *segments* and nothing reaches across two.  A task
   keeps a chunk's distinct segments, and each document's segments as numbers.
2. Only distinct segments are tokenised; their matrices are built by hand in CSR and multiplied row by row.
3. Pair counts of the chunks are summed by id pair in one shuffle with partial sums; the highest count of a B
   id is a table of one row per B token (bounded by the vocabulary), and is broadcast.
4. The counts return to the chunks that asked, which sum them by segment and then by document.

A chunk holds a bounded amount of text (or one text), so a task's memory is bounded; a pair that every chunk
has is one row a chunk, and AQE splits such a key.

Defined cases: null and empty texts, and texts whose tokens do not give their bytes back (U+2581 in a text
stands for a space), have no tokens: zeros and no groups; repeated rows and repeated ids come back each; a
null doc_id is kept; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm import arrays as A
from paygrid.llm.exchange import _planes, _unplanes
from paygrid.llm.staging import written, written_in_buckets

CHUNK_BYTES = 8 << 20
#: Characters of distinct segments whose matrices are built at a time, and of those that are tokenised in one text.
BLOCK_BYTES = 1 << 19
JOINED = 1 << 13
#: From a space after a non-white character (or the start) up to the next such space.
SEGMENT = r"\s*\S+(?:[^\S ]\s*(?:\S+|\Z))*|\s+"
STATS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


class Csr(NamedTuple):
    """Rows of a sparse matrix: row r has columns[first[r]:first[r + 1]], with those values."""

    first: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def incidence(sizes: np.ndarray) -> Csr:
    """Token-byte incidence: token r covers the next sizes[r] bytes."""
    first = np.concatenate([[0], np.cumsum(sizes)])
    return Csr(first, np.arange(first[-1]), np.ones(first[-1], np.int64), int(first[-1]))


def membership(group: np.ndarray, n_groups: int) -> Csr:
    """Token-group incidence: token r is in group[r]."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), n_groups)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.columns, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(m.columns, minlength=m.width))])
    return Csr(first, m.rows()[order], m.values[order], len(m.first) - 1)


def product(x: Csr, y: Csr) -> Csr:
    """x·y by Gustavson's rule: row i is the sum of the rows of y at the nonzeros of row i of x."""
    each = np.diff(y.first)[x.columns]
    at = A.ranges_to_index(y.first[x.columns], each)
    key = np.repeat(x.rows(), each) * np.int64(max(y.width, 1)) + y.columns[at]
    value = np.repeat(x.values, each) * y.values[at]
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key, value = key[new], np.add.reduceat(value, new) if len(new) else value
    row = key // max(y.width, 1)
    return Csr(np.searchsorted(row, np.arange(len(x.first))), key % max(y.width, 1), value, y.width)


def _unmapped() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable bytes stand for themselves, others follow 255."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


#: Pre-tokens of a byte-level tokenizer that cuts by its library's own expression.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _first_encoder(path: str):
    """(ids of a text, bytes of each token) of a byte-level tokenizer file.

    Where its merges are in order of their tokens' ids, ids are ranks, and a faster library gives the same ids.
    """
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = _unmapped()
    vocabulary, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    own = {i: bytes(plain[c] for c in t) if all(c in plain for c in t) else t.encode()
           for t, i in vocabulary.items() | {(t["content"], t["id"]) for t in spec["added_tokens"]}}
    cut = spec["pre_tokenizer"] or {}
    ordered = (cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not spec["normalizer"]
               and sorted(vocabulary[c] for c in plain) == list(range(256)) and all(vocabulary[x + y] == 256 + i for i, (x, y) in enumerate(merges)))
    if ordered:
        import tiktoken

        ranks = {own[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, own
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids, own


class _Tokenizers:
    """Both tokenizers of a task, and the bytes of their tokens."""

    def __init__(self, bpe: str, pieces: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.a, own = _first_encoder(bpe)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.table_a = self._table([own.get(i, b"") for i in range(max(own) + 1)])
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", x) for x in names):
            raise ValueError("a piece reaches over the start of a word: texts cannot be cut into segments")
        self.table_b = self._table([bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)])
        self.space = self.b.piece_to_id("▁")

    @staticmethod
    def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(t) for t in tokens], np.int64)
        return size, np.cumsum(size) - size, np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, segments: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids of all segments, first id of each) of both; segments start with a space."""
        got_a = self._first(segments)
        # the second adds that space by itself, but not to nothing
        got_b = [ids or [self.space] for ids in self.b.encode([s[1:] for s in segments], num_threads=1)]
        out = []
        for got in (got_a, got_b):
            first = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)
            out.append((np.fromiter((i for x in got for i in x), np.int64, int(first[-1])), first))
        return out

    def _first(self, segments: list[str]) -> list[list[int]]:
        """Ids of the first tokenizer; it cuts between two segments too, so many go in one text and come out apart."""
        out: list = [None] * len(segments)
        alone = [i for i, s in enumerate(segments) if s[-1].isspace()]
        group, size = [], 0
        for i in [*(i for i, s in enumerate(segments) if not s[-1].isspace()), None]:
            if i is not None:
                group.append(i)
                size += len(segments[i])
            if group and (i is None or size >= JOINED):
                ids = np.array(self.a("".join([segments[g] for g in group])), np.int64)
                ends = np.cumsum(self.table_a[0][ids])
                want = np.cumsum([len(segments[g].encode()) for g in group])
                cut = np.searchsorted(ends, want)
                if cut[-1] < len(ends) and (ends[cut] == want).all():
                    ids, cut = ids.tolist(), [0, *(cut + 1).tolist()]
                    for g, a, b in zip(group, cut[:-1], cut[1:], strict=True):
                        out[g] = ids[a:b]
                else:
                    alone += group
                group, size = [], 0
        for i in alone:
            out[i] = list(self.a(segments[i]))
        return out


class Aligned(NamedTuple):
    """Distinct segments, aligned: flags, numbers of each, its groups, and its links as id pairs."""

    good: np.ndarray
    stats: dict[str, np.ndarray]
    groups: list[str]
    first: np.ndarray      # first link of each segment
    pairs: np.ndarray      # A id << 32 | B id of each link


def _gives(table, ids, first, data, offs) -> np.ndarray:
    """Flags of the segments that are their tokens' bytes."""
    size, start, every = table
    width = size[ids]
    own = np.concatenate([[0], np.cumsum(width)])[first]
    good = np.diff(own) == np.diff(offs)
    keep = np.repeat(good, np.diff(first))
    joined = every[A.ranges_to_index(start[ids[keep]], width[keep])]
    want = data[A.ranges_to_index(offs[:-1][good], np.diff(offs)[good])]
    row = np.repeat(np.flatnonzero(good), np.diff(offs)[good])
    good[row[joined != want]] = False
    return good


def align_segments(tokenizers: _Tokenizers, segments: list[str]) -> Aligned:
    """Overlap links and groups of distinct segments, by products of their incidence matrices."""
    raw = [s.encode() for s in segments]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    (ids_a, first_a), (ids_b, first_b) = tokenizers.encode(segments)
    good = _gives(tokenizers.table_a, ids_a, first_a, data, offs) & _gives(tokenizers.table_b, ids_b, first_b, data, offs)
    keep_a, keep_b = np.repeat(good, np.diff(first_a)), np.repeat(good, np.diff(first_b))
    ids_a, ids_b = ids_a[keep_a], ids_b[keep_b]
    n_a, n_b = np.where(good, np.diff(first_a), 0), np.where(good, np.diff(first_b), 0)
    size_a, size_b = tokenizers.table_a[0][ids_a], tokenizers.table_b[0][ids_b]
    seg_a = np.repeat(np.arange(len(segments)), n_a)
    # groups: both cuts of the concatenated bytes end there
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    ends = np.intersect1d(end_a, end_b)
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    links = product(incidence(size_a), transposed(incidence(size_b)))
    shared = product(membership(group_a, len(ends)), transposed(membership(group_b, len(ends))))
    of_link = seg_a[links.rows()]
    count = lambda at: np.bincount(at, minlength=len(segments)).astype(np.int64)
    seg_of_group = np.empty(len(ends), np.int64)
    seg_of_group[group_a] = seg_a
    stats = {"n_a": n_a, "n_b": n_b, "n_groups": count(seg_of_group), "n_links": count(of_link), "n_shared": count(seg_a[shared.rows()])}
    text = [""] * len(segments)
    cut_a, cut_b = np.searchsorted(group_a, np.arange(len(ends) + 1)).tolist(), np.searchsorted(group_b, np.arange(len(ends) + 1)).tolist()
    name_a, name_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    for g, s in enumerate(seg_of_group.tolist()):
        own = ",".join(name_a[cut_a[g]:cut_a[g + 1]]) + "|" + ",".join(name_b[cut_b[g]:cut_b[g + 1]])
        text[s] = f"{text[s]};{own}" if text[s] else own
    return Aligned(good, stats, text, np.concatenate([[0], np.cumsum(count(of_link))]), (ids_a[links.rows()] << 32) | ids_b[links.columns])


def _aligned_in_blocks(tokenizers: _Tokenizers, segments: list[str]) -> Aligned:
    parts, at = [], 0
    while at < len(segments):
        to, size = at, 0
        while to < len(segments) and (to == at or size + len(segments[to]) <= BLOCK_BYTES):
            size += len(segments[to])
            to += 1
        parts.append(align_segments(tokenizers, segments[at:to]))
        at = to
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.first) for p in parts]))])
    return Aligned(np.concatenate([p.good for p in parts]), {c: np.concatenate([p.stats[c] for p in parts]) for c in STATS},
                   [g for p in parts for g in p.groups], first, np.concatenate([p.pairs for p in parts]))


class _Index(dict):
    """segment -> number, in order of first use."""

    def __missing__(self, segment):
        self[segment] = at = len(self)
        return at


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def _chunk_row(chunk: int, tokenizers: _Tokenizers, ids: list[int], at: list[np.ndarray], index: _Index, with_groups: bool) -> tuple:
    """(chunk, documents, pairs): what a chunk keeps of its documents, and the pair counts it asks for."""
    import hashlib

    import zstandard

    segments = list(index)
    got = _aligned_in_blocks(tokenizers, segments) if segments else Aligned(np.zeros(0, bool), {c: np.zeros(0, np.int64) for c in STATS}, [], np.zeros(1, np.int64), np.zeros(0, np.int64))
    counts = np.array([len(x) for x in at], np.int64)
    flat = np.concatenate(at).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    # a text with a segment that does not give its bytes back has no tokens at all
    whole = _sums(~got.good[flat], first) == 0
    flat, counts = flat[np.repeat(whole, counts)], np.where(whole, counts, 0)
    used = np.bincount(flat, minlength=len(segments))
    order = np.argsort(-used, kind="stable")      # frequent segments get small numbers: their byte planes compress best
    order = order[:int((used > 0).sum())]
    number = np.zeros(len(segments), np.uint32)
    number[order] = np.arange(len(order), dtype=np.uint32)
    n_links = np.diff(got.first)[order]
    links = got.pairs[A.ranges_to_index(got.first[:-1][order], n_links)]
    keys, place = np.unique(links, return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, place, np.repeat(used[order], n_links))
    digests = []
    for own, whole_text in zip(at, whole.tolist(), strict=True):
        some = whole_text and len(own)
        digests.append(hashlib.sha256(";".join([got.groups[i] for i in own.tolist()]).encode()).digest() if some else bytes(32))
    groups = [got.groups[i].encode() for i in order.tolist()] if with_groups else []
    head = np.array([len(ids), len(flat), len(order), len(links), len(groups)], np.int64).tobytes()
    docs = b"".join([head, _planes(np.array(ids, np.int64)), _planes(counts.astype(np.uint32)), _planes(number[flat]),
                     *(_planes(got.stats[c][order].astype(np.uint32)) for c in STATS), _planes(place.astype(np.uint32)),
                     *digests, _planes(np.array([len(g) for g in groups], np.uint32)), *groups])
    body = len(keys).to_bytes(8, "little") + _planes(np.diff(keys, prepend=0)) + _planes(totals)
    return chunk, zstandard.compress(docs, 1), zstandard.compress(body, 1)


def _read_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.decompress(raw)
    n = int.from_bytes(raw[:8], "little")
    gaps, at = _unplanes(raw, 8, n, np.int64)
    return np.cumsum(gaps), _unplanes(raw, at, n, np.int64)[0]


def _assemble(docs: bytes, totals: np.ndarray, best: np.ndarray, with_groups: bool) -> pa.Table:
    """The rows of a chunk's documents; totals and best are in the order of the chunk's pairs."""
    import zstandard

    raw = zstandard.decompress(docs)
    n, n_flat, n_segments, n_links, n_groups = np.frombuffer(raw, np.int64, 5).tolist()
    ids, at = _unplanes(raw, 40, n, np.int64)
    counts, at = _unplanes(raw, at, n, np.uint32)
    flat, at = _unplanes(raw, at, n_flat, np.uint32)
    per = {}
    for c in STATS:
        per[c], at = _unplanes(raw, at, n_segments, np.uint32)
    place, at = _unplanes(raw, at, n_links, np.uint32)
    digests = raw[at:at + 32 * n].hex()
    at += 32 * n
    links = np.concatenate([[0], np.cumsum(per["n_links"], dtype=np.int64)])
    per["n_best"], per["count_sum"] = _sums(best[place].astype(np.int64), links), _sums(totals[place], links)
    first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    out = {"doc_id": pa.array(ids, mask=ids == A.NULL_ID)}
    for c in (*STATS, "n_best", "count_sum"):
        out[c] = pa.array(_sums(per[c][flat].astype(np.int64), first))
    out["groups_sha256"] = pa.array([digests[64 * i:64 * i + 64] if c else "" for i, c in enumerate(counts.tolist())], pa.string())
    if with_groups:
        sizes, at = _unplanes(raw, at, n_groups, np.uint32)
        ends = (at + np.cumsum(sizes, dtype=np.int64)).tolist()
        groups = [raw[a:b].decode() for a, b in zip([at, *ends[:-1]], ends, strict=True)]
        numbers, cut = flat.tolist(), first.tolist()
        out["groups"] = pa.array([";".join([groups[i] for i in numbers[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.string())
    return pa.table(out)


def packed_chunks(docs: DataFrame, bpe: str, pieces: str, with_groups: bool = False) -> DataFrame:
    """(chunk, docs, pairs), written once in buckets by chunk: later steps see the same chunks and need not shuffle them."""

    def pack(batches):
        find = re.compile(SEGMENT).findall
        tokenizers = _Tokenizers(bpe, pieces)
        task, made = TaskContext.get().partitionId(), 0
        ids, at, index, size = [], [], _Index(), 0

        def chunk():
            row = _chunk_row(task << 32 | made, tokenizers, ids, at, index, with_groups)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["chunk", "docs", "pairs"])

        for batch in (b.slice(k, 500) for b in batches for k in range(0, len(b), 500)):
            for i, text in zip(batch.column(0).fill_null(A.NULL_ID).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = find(" " + text) if text else []
                ids.append(i)
                at.append(np.fromiter(map(index.__getitem__, found), np.uint32, len(found)))
                size += len(text or "")
                if size >= CHUNK_BYTES:
                    yield chunk()
                    made += 1
                    ids, at, index, size = [], [], _Index(), 0
                    A.give_back()
        if ids:
            yield chunk()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written_in_buckets(rows.mapInArrow(pack, "chunk long, docs binary, pairs binary"), "alignment_chunks", "chunk")


def _asked(chunks: DataFrame) -> DataFrame:
    """(chunk, pair, n): the id pairs of each chunk."""

    def rows(batches):
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, totals = _read_pairs(raw)
                for k in range(0, len(keys), 50_000):
                    own = keys[k:k + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), chunk)), pa.array(own), pa.array(totals[k:k + 50_000])], ["chunk", "pair", "n"])

    return chunks.select("chunk", "pairs").mapInArrow(rows, "chunk long, pair long, n long")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): how many links hold an id pair, and whether no pair of its B id has more."""
    counts = _asked(chunks).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))})
    counts = written(counts, "alignment-pairs")
    # one row a B token: the vocabulary bounds it
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(F.broadcast(top), "b").select("pair", "a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, bpe: str, pieces: str, with_groups: bool = False) -> DataFrame:
    """One row a document: its numbers of tokens, groups and links, and the SHA-256 of its token ids group by group.

    ``with_groups`` also returns the groups themselves, as text.
    """
    chunks = packed_chunks(docs, bpe, pieces, with_groups)
    replies = _asked(chunks).select("chunk", "pair").join(pair_counts(chunks).select("pair", "n", "best"), "pair")

    def assemble(own: pa.Table, found: pa.Table) -> pa.Table:
        A.give_back()
        order = np.argsort(found.column("pair").to_numpy())
        return _assemble(own.column("docs")[0].as_py(), found.column("n").to_numpy()[order], found.column("best").to_numpy()[order], with_groups)

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in (*STATS, "n_best", "count_sum")) + ", groups_sha256 string" + ", groups string" * with_groups
    return chunks.select("chunk", "docs").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(assemble, schema)


def op13_token_alignment(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")
