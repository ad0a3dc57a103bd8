"""Benchmark decontamination by an FM-index per training shard (operator 2).

Words are runs of ASCII letters (lower-cased), digits and non-ASCII bytes.  The
test phrases are all windows of ``window`` words of the benchmark items (a
shorter item is one phrase); they are the stated query set, broadcast in blocks
of at most ``BLOCK_BYTES`` of text.  Each task indexes a shard of documents:

1. words outside the block's vocabulary cannot be in a phrase, so only runs of
   vocabulary words as long as the shortest phrase are indexed, with a separator
   between them (nothing else of a text can match);
2. the index is the Burrows-Wheeler transform of the runs (full suffix sort by
   prefix doubling), a wavelet matrix with rank words, and every 16th position
   and run start;
3. all phrases are searched backwards at once by wavelet ranks, and occurrences
   are located by stepping to a sampled suffix position;
4. the spans of the hits merge into runs of words to remove.

No row leaves its task, so there is no shuffle to be skewed.

Defined cases: null and empty texts have no words and no hit; items without
words have no phrase; null item texts none either, null item_ids and doc_ids
are kept (a null item_id is not listed); repeated rows come back each; without
benchmark rows nothing is hit; only doc_id, text and item_id, text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm import arrays as A
from paygrid.llm.substring_dedup import runs

BLOCK_BYTES = 4 << 20
#: Indexed words of a shard; a shard ends with a task too.
SHARD_WORDS = 1_000_000
SAMPLE = 16


class Wavelet:
    """Wavelet matrix of a sequence of symbols: rank of a symbol before a place."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.sums, self.zeros = [], [], []
        n = len(seq)
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level) & 1 == 1
            words = np.zeros(n // 64 + 1, np.uint64)
            packed = np.packbits(bit, bitorder="little")
            words.view(np.uint8)[:len(packed)] = packed
            self.bits.append(words)
            self.sums.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(n - int(bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[k][word] + np.bitwise_count(self.bits[k][word] & mask)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol before place i; arrays of one length."""
        lo = np.zeros(len(i), np.int64)
        for k in range(self.levels):
            one = (symbol >> (self.levels - 1 - k)) & 1 == 1
            a, b = self._ones(k, lo), self._ones(k, i)
            lo, i = np.where(one, self.zeros[k] + a, lo - a), np.where(one, self.zeros[k] + b, i - b)
        return i - lo


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling; an end sorts first."""
    n = len(seq)
    rank = seq.astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(n - step, 0)] = rank[step:] + 1
        key = rank * (int(after.max(initial=0)) + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Backward search and location over a sequence of symbols 1 .. n - 1, 0 between runs."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        order = suffix_array(seq)
        self.before = seq[order - 1]  # the symbol before the first is the last: the sequence ends in a separator
        self.wavelet = Wavelet(self.before, n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=n_symbols))])
        # a run's first place too, so no walk ever crosses a separator
        self.sampled = (order % SAMPLE == 0) | (self.before == 0)
        self.places = order[self.sampled]
        self.count = np.concatenate([[0], np.cumsum(self.sampled)])
        self.n = len(seq)

    def search(self, phrases: np.ndarray, lengths: np.ndarray):
        """Row ranges [lo, hi) of the phrases (rows, padded at the end)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > back) & (lo < hi))
            symbol = phrases[live, lengths[live] - 1 - back]
            at = self.first[symbol]
            lo[live], hi[live] = at + self.wavelet.rank(symbol, lo[live]), at + self.wavelet.rank(symbol, hi[live])
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps, live = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(live):
            known = self.sampled[rows[live]]
            out[live[known]] = self.places[self.count[rows[live[known]]]] + steps[live[known]]
            live = live[~known]
            symbol = self.before[rows[live]]
            rows[live] = self.first[symbol] + self.wavelet.rank(symbol, rows[live])
            steps[live] += 1
        return out % self.n


def _item_words(roll, codes, texts):
    raw = [(t or "").encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    data = A.LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    starts, ends, first = A.words(data, offs, A.NOT_ALNUM)
    return A.word_codes(roll, codes, data, starts, ends), first


def phrase_block(rows, window: int, codes) -> dict | None:
    """Phrases of (item_id, text) rows as symbols of the block's own vocabulary."""
    hashes, first = _item_words(A.Rolling(), codes, [t for _, t in rows])
    if not len(hashes):
        return None
    vocabulary, symbol = np.unique(hashes, return_inverse=True)
    found: dict[tuple, set] = {}
    for (item, _), a, b in zip(rows, first[:-1].tolist(), first[1:].tolist(), strict=True):
        for i in range(a, max(b - window, a) + 1 if b > a else a):
            found.setdefault(tuple(symbol[i:min(i + window, b)] + 1), set()).add(item)
    lengths = np.array([len(p) for p in found])
    phrases = np.zeros((len(found), window), np.int64)
    for i, p in enumerate(found):
        phrases[i, :len(p)] = p
    return {"vocabulary": vocabulary, "phrases": phrases, "lengths": lengths, "items": [sorted(x for x in s if x is not None) for s in found.values()]}


def _blocks(benchmark: DataFrame):
    """The benchmark's rows in blocks of bounded text, through the driver one block at a time."""
    rows, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        rows.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= BLOCK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def without(texts: pa.Array, row: np.ndarray, start: list[int], end: list[int]) -> pa.Array:
    """texts without the byte spans [start, end) of the rows, which are in order."""
    out = texts.to_pylist()
    edge = np.flatnonzero(np.diff(row, prepend=-1, append=-1)).tolist() if len(row) else []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        raw, at, parts = out[row[a]].encode(), 0, []
        for i in range(a, b):
            parts.append(raw[at:start[i]])
            at = end[i]
        out[row[a]] = (b"".join(parts) + raw[at:]).decode()
    return pa.array(out, texts.type)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, with_spans: bool = True, remove: bool = False) -> DataFrame:
    """One row a document: doc_id, text, n_words, n_hit, items (ids with occurring phrases, in order),
    and the hit runs as byte spans [start, end) of the text; or with ``remove`` the columns of docs, text without the runs."""
    spark = docs.sparkSession
    codes = A.byte_codes()
    blocks = [spark.sparkContext.broadcast(b) for rows in _blocks(benchmark) if (b := phrase_block(rows, window, codes))]
    item_type = benchmark.schema["item_id"].dataType.simpleString()

    def shard(held, symbols, where, block, hit, items):
        """Search a shard: symbols of its runs, each with the word of the shard it stands for (-1: none)."""
        index = FmIndex(symbols, len(block["vocabulary"]) + 1)
        lo, hi = index.search(block["phrases"], block["lengths"])
        phrase = np.repeat(np.arange(len(lo)), hi - lo)
        at = where[index.locate(A.ranges_to_index(lo, hi - lo))]
        size = block["lengths"][phrase]
        step = np.zeros(len(hit) + 1, np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, at + size, -1)
        hit |= np.cumsum(step[:-1]) > 0
        row = np.searchsorted(held, at, "right") - 1
        for r, p in np.unique(np.stack([row, phrase]), axis=1).T.tolist():
            items.setdefault(r, set()).update(block["items"][p])

    def task(batches):
        roll = A.Rolling()
        held, n_held = [], 0

        def flush():
            first = np.concatenate([[0], np.cumsum(np.concatenate([h["counts"] for h in held]))])
            hit, items = np.zeros(int(first[-1]), bool), {}
            for k, block in enumerate(blocks):
                symbols = np.concatenate([h["symbols"][k] for h in held])
                base = np.concatenate([[0], np.cumsum([int(h["counts"].sum()) for h in held])])
                where = np.concatenate([h["where"][k] + b for h, b in zip(held, base, strict=False)])
                if len(symbols):
                    shard(first, symbols, where, block.value, hit, items)
            row = word = 0
            for h in held:
                n, w = len(h["counts"]), int(h["counts"].sum())
                own, own_first = hit[word:word + w], first[row:row + n + 1] - word
                total = np.concatenate([[0], np.cumsum(own)])[own_first]
                listed = [sorted(items.get(row + i, ())) for i in range(n)]
                columns = [h["batch"].column(h["batch"].schema.get_field_index(c)) for c in ("doc_id", "text")[:1 + with_spans]]
                columns += [pa.array(h["counts"], pa.int64()), pa.array(np.diff(total), pa.int64()), pa.array(listed, pa.list_(columns_type))]
                names = ["doc_id", "text", "n_words", "n_hit", "items"] if with_spans else ["doc_id", "n_words", "n_hit", "items"]
                if with_spans:
                    spans = runs(own, own_first)
                    flat = spans.flatten()
                    a, b = (flat.field(i).to_numpy() for i in (0, 1))
                    r = np.repeat(np.arange(n), np.diff(spans.offsets.to_numpy()))
                    pairs = pa.StructArray.from_arrays([
                        pa.array((h["starts"][own_first[r] + a] - h["offs"][r]).astype(np.int32)),
                        pa.array((h["ends"][own_first[r] + b - 1] - h["offs"][r]).astype(np.int32))], ["start", "end"])
                    if remove:
                        names = h["batch"].schema.names
                        at = names.index("text")
                        columns = list(h["batch"].columns)
                        columns[at] = without(columns[at], r, *(pairs.field(i).to_pylist() for i in (0, 1)))
                        yield pa.RecordBatch.from_arrays(columns, names)
                        row, word = row + n, word + w
                        continue
                    columns.append(pa.ListArray.from_arrays(spans.offsets, pairs))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(columns, names)
                row, word = row + n, word + w
            held.clear()

        columns_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_type]
        for batch, offs, data in A.text_slices(batches):
            data = A.LOWER[data]
            starts, ends, first = A.words(data, offs, A.NOT_ALNUM)
            hashes = A.word_codes(roll, codes, data, starts, ends)
            symbols, where = [], []
            for block in blocks:
                known = block.value["vocabulary"]
                table = np.zeros(1 << 20, bool)
                table[(known >> np.uint64(44)).astype(np.int64)] = True
                maybe = np.flatnonzero(table[(hashes >> np.uint64(44)).astype(np.int64)])
                at = np.searchsorted(known, hashes[maybe])
                at[at == len(known)] = 0
                same = known[at] == hashes[maybe]
                maybe, at = maybe[same], at[same]
                # runs of neighbouring known words of one row, long enough for some phrase
                cut = np.zeros(len(starts) + 1, bool)
                cut[first[:-1]] = True
                new = np.concatenate([[True], (np.diff(maybe) != 1) | cut[maybe[1:]]]) if len(maybe) else np.zeros(0, bool)
                begin = np.flatnonzero(new)
                size = np.diff(begin, append=len(maybe))
                keep = np.repeat(size >= int(block.value["lengths"].min()), size)
                maybe, at, new = maybe[keep], at[keep] + 1, new[keep]
                # a separator after each run
                place = np.arange(len(maybe)) + np.cumsum(new) - 1
                total = len(maybe) + int(new.sum())
                s, w = np.zeros(total, np.int64), np.full(total, -1, np.int64)
                s[place], w[place] = at, maybe
                symbols.append(s)
                where.append(w)
                n_held += total
            held.append({"batch": batch, "counts": np.diff(first), "symbols": symbols, "where": where} | ({"starts": starts, "ends": ends, "offs": offs} if with_spans else {}))
            if not with_spans:
                held[-1]["batch"] = batch.select(["doc_id"])
            if n_held >= SHARD_WORDS or len(held) >= 16:
                yield from flush()
                n_held = 0
        if held:
            yield from flush()

    if remove:
        return docs.mapInArrow(task, docs.schema)
    own = docs.select("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + "text string, " * with_spans + f"n_words long, n_hit long, items array<{item_type}>" + ", spans array<struct<start:int,end:int>>" * with_spans
    return own.mapInArrow(task, schema)


def op2_decontamination(spark, sf_dir):
    out = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), with_spans=False)
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH low AS (
  SELECT doc_id, NULL AS item_id, text FROM documents UNION ALL SELECT NULL, item_id, text FROM benchmark),
w AS (
  SELECT doc_id, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
q AS (
  SELECT DISTINCT item_id, len(p) AS n, array_to_string(p, ' ') AS k FROM (
    SELECT item_id, unnest(CASE WHEN len(ws) >= 10 THEN list_transform(range(1, len(ws) - 8), lambda i: ws[i:i + 9]) ELSE [ws] END) AS p
    FROM w WHERE item_id IS NOT NULL AND len(ws) > 0)),
d AS (SELECT doc_id, ws FROM w WHERE doc_id IS NOT NULL),
sizes AS (SELECT DISTINCT n FROM q),
hits_at AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, sizes WHERE len(ws) >= n)),
found AS (SELECT DISTINCT h.doc_id, h.p, h.n, q.item_id FROM hits_at h JOIN q ON q.k = h.k AND q.n = h.n),
hit AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM (SELECT DISTINCT doc_id, p, n FROM found)) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
