"""Personal data by bootstrapped contextual extraction (operator 10).

*Seeds* are the spans of four base patterns (email, ip, card, phone).  The words
around a seed are lexical patterns for its kind, each in five forms: one and two
words before it, one and two after it, and the last label (a word with a colon or
an equals sign) up to four words before it.  Case and digits are folded, and a
line's start and end count as words.  Spark joins patterns and the instances they
introduce to a bipartite graph, and scores it in rounds: a pattern is as good as
the share of its slots that hold instances believed in, an instance as the
patterns that introduce it.  Patterns of at least ``SUPPORT`` different seeds and
``CONFIDENT`` score then discover further identifiers: slots of up to ``WORDS``
words shaped like their kind that no base pattern took.

Patterns are 64-bit hashes.  All supported ones are scored, as rows: texts meet a
bit table of fixed size first, so that few other contexts are shuffled, and then
the join decides.  The confident ones are broadcast in blocks of ``BLOCK``.
Occurrences are counted in the tasks before they are shuffled, so a pattern that
a third of all rows share costs one row a task and instance.

Defined cases: null and empty texts have no spans; long texts are searched whole,
in linear time; rows that repeat an id are searched each; null doc_ids are kept;
without seeds or patterns only base spans are found; an empty table gives no rows;
discovered spans of a kind are leftmost and do not overlap; only doc_id and text
are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm import arrays as A
from paygrid.llm.staging import written

KINDS = ("email", "ip", "card", "phone")
SUPPORT, CONFIDENT, ROUNDS = 5, 0.8, 3
#: Words of a slot; patterns of a broadcast block; bits of the table that texts meet first; rows a task counts at a time.
WORDS, BLOCK, BITS, HELD = 4, 500_000, 24, 200_000
SPANS = "array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is one part, so starts inside it need no try
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_EDGE = "\"'()[]{}<>.,;:!?#$%&*|"
# of bytes read as latin-1, so spaces are those of ASCII
_SHAPE = {
    "email": re.compile(r"[^\s@]+ ?(?:@|\(at\)|\[at\]) ?[^\s@]+", re.ASCII),
    "ip": re.compile(r"[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}"),
    "card": re.compile(r"[0-9Xx*][0-9Xx* -]{10,22}[0-9]"),
    "phone": re.compile(r"\+?[0-9(][0-9(). -]{5,18}[0-9]"),
}
_FOLD = A.LOWER.copy()
_FOLD[0x30:0x3A] = 0x30
_EDGES = A.separator_table(_EDGE.encode())
_MARK = np.uint64(0x5851F42D4C957F2D)  # a line's start or end as a word


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind and start; of a kind leftmost and not overlapping."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        if at >= end:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                out.append(("email", start, m.end()))
                end = m.end()
        at = text.find("@", at + 1)
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_DIGIT = re.compile("[0-9@]")


def _base(text: str | None) -> list[tuple[str, int, int]]:
    return base_spans(text) if text and _DIGIT.search(text) else []


def _salted(form: int, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Hash of a context of one or two words, by its form."""
    h = first * np.uint64(A.BASE) + np.uint64(form + 1)
    return A.mix(h if second is None else A.mix(h) + second)


class Contexts:
    """The words of a slice and the contexts of a slot at each: ``before`` a slot's first word, ``after`` its last.

    Both are lists of (hashes, flags of the words that have such a context).
    """

    def __init__(self, roll, codes, offs, data):
        self.offs, self.data = offs, data
        folded = _FOLD[data]
        self.starts, self.ends, self.first = A.words(data, offs, A.SPACE)
        n = len(self.starts)
        line = np.concatenate([[0], np.cumsum(data == 10)])[self.starts]
        new = np.ones(n, bool)
        new[1:] = line[1:] != line[:-1]
        new[self.first[:-1][self.first[:-1] < n]] = True
        self.line = np.cumsum(new)
        prefix = roll.prefix(codes[folded])
        code = roll.ranges(prefix, self.starts, self.ends)
        last = np.ones(n, bool)
        last[:-1] = new[1:]
        every = np.ones(n, bool)

        def shift(a, by, edge):
            """The word ``by`` places on in its line; the mark just past the line's edge."""
            out = np.full(n, _MARK)
            if by < 0:
                out[1:] = a[:-1]
            else:
                out[:-1] = a[1:]
            out[edge] = _MARK
            return out

        one, after = shift(code, -1, new), shift(code, 1, last)
        self.before = [(_salted(0, one), every), (_salted(1, one, shift(one, -1, new)), ~new)]
        self.after = [(_salted(2, after), every), (_salted(3, after, shift(after, 1, last)), ~last)]
        # labels: without the colon and a mark before it
        label = (self.ends - self.starts > 1) & np.isin(folded[self.ends - 1], np.frombuffer(b":=", np.uint8)) if n else every
        at = np.maximum.accumulate(np.where(label, np.arange(n), -1))
        at = np.concatenate([[-1], at[:-1]])[:n]
        has = (at >= 0) & (np.arange(n) - at <= 4)
        has[has] = self.line[at[has]] == self.line[has]
        own = code.copy()
        k = np.flatnonzero(label)
        inner = np.minimum(self.starts[k] + _EDGES[folded[self.starts[k]]], self.ends[k] - 1)
        own[k] = roll.ranges(prefix, inner, self.ends[k] - 1)
        self.before.append((_salted(4, own[np.maximum(at, 0)] if n else own), has))

        # words that a slot shaped like some kind can start or end with
        paired = np.zeros(len(data), bool)
        if len(data) >= 4:
            paired[:-3] = (np.isin(folded[:-3], np.frombuffer(b"([", np.uint8)) & (folded[1:-2] == 0x61)
                           & (folded[2:-1] == 0x74) & np.isin(folded[3:], np.frombuffer(b")]", np.uint8)))
        count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[np.stack([self.starts, self.ends])], axis=0)[0] > 0
        ats = count(paired | (data == 0x40))
        likely = count(folded == 0x30) | ats
        self.likely = [likely.copy(), likely.copy()]
        self.likely[0][:-1] |= ats[1:]
        self.likely[1][1:] |= ats[:-1]
        self.chars = np.flatnonzero((data & 0xC0) != 0x80)

    def rows(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, "right") - 1

    def span_words(self, row: int, start: int, end: int):
        """(first byte, byte after the last, first word, last word) of a span of characters of a row."""
        base = np.searchsorted(self.chars, self.offs[row])
        a, b = int(self.chars[base + start]), int(self.chars[base + end - 1])
        return a, b, int(np.searchsorted(self.starts, a, "right")) - 1, int(np.searchsorted(self.starts, b, "right")) - 1

    def to_chars(self, row: int, a: int, b: int) -> tuple[int, int]:
        base, x, y = np.searchsorted(self.chars, [self.offs[row], a, b]).tolist()
        return x - base, y - base

    def bare(self, a: int, b: int) -> bool:
        """Whether bytes [a, b) are marks only."""
        return bool(_EDGES[self.data[a:b]].all())

    def slots(self, side: int, word: int) -> list[tuple[str, int, int]]:
        """(kind, start, end) in bytes: of each kind the longest slot of its shape that starts (side 0) or ends (1) at a word."""
        places, w = [], word
        while len(places) < WORDS and 0 <= w < len(self.starts) and self.line[w] == self.line[word]:
            a, b = (self.starts[word], self.ends[w]) if side == 0 else (self.starts[w], self.ends[word])
            places.append((int(a), int(b)))
            w += 1 if side == 0 else -1
        if not places:
            return []
        zero = min(a for a, _ in places)
        text = self.data[zero:max(b for _, b in places)].tobytes().decode("latin-1")
        out = []
        for kind, shape in _SHAPE.items():
            for a, b in reversed(places):
                whole = text[a - zero:b - zero]
                x, y = a - zero + len(whole) - len(whole.lstrip(_EDGE)), b - zero - len(whole) + len(whole.rstrip(_EDGE))
                if shape.fullmatch(text, a - zero, b - zero):
                    out.append((kind, a, b))
                    break
                if x < y and shape.fullmatch(text, x, y):
                    out.append((kind, x + zero, y + zero))
                    break
        return out


def _slices(batches):
    """(rows, texts, base spans of each, Contexts maker) of runs of rows."""
    roll, codes = A.Rolling(), A.byte_codes()
    for batch, offs, data in A.text_slices(batches):
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        yield batch, texts, [_base(t) for t in texts], lambda o=offs, d=data: Contexts(roll, codes, o, d)


def _counted(seen: Counter):
    rows = [(*k, n) for k, n in seen.items()]
    seen.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                                      ["kind", "context", "instance", "n"])


def seeds(docs: DataFrame) -> DataFrame:
    """(kind, context, instance, n): the contexts of base spans."""
    def task(batches):
        seen = Counter()
        for _, texts, base, contexts in _slices(batches):
            if not any(base):
                continue
            c = contexts()
            for row, (text, spans) in enumerate(zip(texts, base, strict=True)):
                for kind, start, end in spans:
                    a, b, i, j = c.span_words(row, start, end)
                    of = [(h, i) for h, has in c.before if c.bare(c.starts[i], a) and has[i]]
                    of += [(h, j) for h, has in c.after if c.bare(b + 1, c.ends[j]) and has[j]]
                    for h, w in of:
                        seen[kind, int(h[w].view(np.int64)), text[start:end]] += 1
            if len(seen) >= HELD:
                yield _counted(seen)
        if seen:
            yield _counted(seen)

    return docs.select("text").mapInArrow(task, "kind string, context long, instance string, n long")


def _bits(patterns: DataFrame) -> np.ndarray:
    """A table of 2 ** BITS bits (packed): which leading bits the patterns' contexts have."""
    def task(batches):
        table = np.zeros(1 << BITS, bool)
        for batch in batches:
            table[(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(table).tobytes()], pa.binary())], ["bits"])

    out = np.zeros((1 << BITS) // 8, np.uint8)
    for row in patterns.select("context").mapInArrow(task, "bits binary").toLocalIterator():
        out |= np.frombuffer(row["bits"], np.uint8)
    return out


def supported_patterns(seed: DataFrame) -> DataFrame:
    """(kind, context) of the patterns with seeds enough."""
    return seed.groupBy("kind", "context").agg(F.count_distinct("instance").alias("n")).filter(F.col("n") >= SUPPORT).select("kind", "context")


def pattern_scores(docs: DataFrame) -> DataFrame | None:
    """(kind, context, score) of all supported patterns that the rounds of scoring leave; None without any."""
    spark = docs.sparkSession
    seed = written(seeds(docs), "pii-seeds")
    known = seed.groupBy("kind", "instance").agg(F.lit(1.0).alias("seed"))
    support = written(supported_patterns(seed), "pii-patterns")
    if support.isEmpty():
        return None
    bits = spark.sparkContext.broadcast(_bits(support))

    def task(batches):
        table = np.unpackbits(bits.value).view(bool)
        seen = Counter()
        for _, texts, base, contexts in _slices(batches):
            c, at = contexts(), {}
            for row, (text, spans) in enumerate(zip(texts, base, strict=True)):
                for kind, start, end in spans:
                    a, b, i, j = c.span_words(row, start, end)
                    # a slot that begins (ends) with a base span holds it, not another shape
                    if c.bare(c.starts[i], a):
                        at[0, i] = [(kind, text[start:end])]
                    if c.bare(b + 1, c.ends[j]):
                        at[1, j] = [(kind, text[start:end])]
            for side, forms in enumerate((c.before, c.after)):
                for h, has in forms:
                    word = np.flatnonzero(has & table[(h >> np.uint64(64 - BITS)).astype(np.int64)])
                    for context, n in zip(*np.unique(h[word].view(np.int64), return_counts=True), strict=True):
                        seen["", int(context), ""] += int(n)  # all slots of the pattern, for its share
                    for w in word[c.likely[side][word]].tolist():
                        if (side, w) not in at:
                            at[side, w] = [(k, c.data[a:b].tobytes().decode(errors="replace")) for k, a, b in c.slots(side, w)]
                        for kind, instance in at[side, w]:
                            seen[kind, int(h[w].view(np.int64)), instance] += 1
            if len(seen) >= HELD:
                yield _counted(seen)
        if seen:
            yield _counted(seen)

    counts = written(docs.select("text").mapInArrow(task, "kind string, context long, instance string, n long"), "pii-slots")
    total = counts.filter("kind = ''").groupBy("context").agg(F.sum("n").alias("slots"))
    total = written(support.join(total, "context"), "pii-totals")
    edges = counts.filter("kind <> ''").join(support, ["kind", "context"], "left_semi")
    edges = edges.groupBy("kind", "context", "instance").agg(F.sum("n").alias("n"))
    edges = written(edges.join(known, ["kind", "instance"], "left"), "pii-edges")
    belief = edges.withColumn("belief", F.coalesce("seed", F.lit(0.0)))
    scores = None
    for _ in range(ROUNDS):
        good = belief.groupBy("kind", "context").agg(F.sum(F.col("belief") * F.col("n")).alias("good"))
        scores = written(total.join(good, ["kind", "context"]).select("kind", "context", (F.col("good") / F.col("slots")).alias("score")), "pii-scores")
        # an instance is believed in as far as some pattern that introduces it errs not
        doubt = edges.join(scores, ["kind", "context"]).groupBy("kind", "instance").agg(
            F.least(F.lit(0.99), 1 - F.exp(F.sum(F.log(1 - F.least(F.lit(0.95), F.col("score")))))).alias("by_patterns"))
        belief = edges.join(doubt, ["kind", "instance"], "left").withColumn(
            "belief", F.coalesce("seed", F.when(F.col("by_patterns") >= CONFIDENT, F.col("by_patterns")), F.lit(0.0)))
    return scores


def confident_patterns(docs: DataFrame) -> list:
    """Broadcast blocks (contexts in order, their kinds as bits) of the confident patterns."""
    scores = pattern_scores(docs)
    if scores is None:
        return []
    bit = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, 1 << k)])
    rows = scores.filter(F.col("score") >= CONFIDENT).groupBy("context").agg(F.bit_or(bit[F.col("kind")]).alias("kinds"))
    blocks, held = [], []

    def block():
        h, kinds = np.array([r[0] for r in held], np.int64).view(np.uint64), np.array([r[1] for r in held], np.uint8)
        order = np.argsort(h)
        held.clear()
        return docs.sparkSession.sparkContext.broadcast((h[order], kinds[order]))

    for row in rows.toLocalIterator():
        held.append(row)
        if len(held) >= BLOCK:
            blocks.append(block())
    if held:
        blocks.append(block())
    return blocks


def _discover(blocks: list, batches):
    """(rows, texts, base spans, discovered spans) of runs of rows; spans are (kind, start, end) in characters."""
    known = []
    for block in blocks:
        h, kinds = block.value
        table = np.zeros(1 << 20, bool)
        table[(h >> np.uint64(44)).astype(np.int64)] = True
        known.append((h, kinds, table))
    for batch, texts, base, contexts in _slices(batches):
        more: list[set] = [set() for _ in texts]
        c = contexts() if known else None
        for h, kinds, table in known:
            for side, forms in enumerate((c.before, c.after)):
                for hashes, has in forms:
                    word = np.flatnonzero(has & c.likely[side] & table[(hashes >> np.uint64(44)).astype(np.int64)])
                    place = np.minimum(np.searchsorted(h, hashes[word]), len(h) - 1)
                    word, place = word[h[place] == hashes[word]], place[h[place] == hashes[word]]
                    for w, row, of in zip(word.tolist(), c.rows(word).tolist(), kinds[place].tolist(), strict=True):
                        for kind, a, b in c.slots(side, w):
                            if of >> KINDS.index(kind) & 1:
                                more[row].add((kind, *c.to_chars(row, a, b)))
        out = []
        for own, found in zip(base, more, strict=True):
            taken, end = [], {}
            starts = sorted((s, e) for _, s, e in own)
            firsts = [s for s, _ in starts]
            reach = np.maximum.accumulate([e for _, e in starts]).tolist() if starts else []
            for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
                before = bisect_left(firsts, b)
                if a >= end.get(kind, 0) and not (before and reach[before - 1] > a):
                    taken.append((kind, a, b))
                    end[kind] = b
            out.append(taken)
        yield batch, texts, base, out


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text, base, spans): base spans, and all spans with the discovered ones, by kind and start."""
    patterns = confident_patterns(docs)
    rank = {k: i for i, k in enumerate(KINDS)}
    kind_type = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        for batch, _, own, more in _discover(patterns, batches):
            base = [as_rows(x) for x in own]
            every = [as_rows(sorted([*x, *y], key=lambda s: (rank[s[0]], s[1], s[2]))) for x, y in zip(own, more, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base, span), pa.array(every, span)], ["doc_id", "text", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(task, f"doc_id {kind_type}, text string, base {SPANS}, spans {SPANS}")


def mask(docs: DataFrame) -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets, and n_chars anew if there is such a column."""
    patterns = confident_patterns(docs)

    def task(batches):
        for batch, texts, base, more in _discover(patterns, batches):
            at = batch.schema.get_field_index("text")
            out = []
            for text, own in zip(texts, (x + y for x, y in zip(base, more, strict=True)), strict=True):
                if own:
                    parts, end = [], 0
                    for kind, a, b in sorted(own, key=lambda s: (s[1], -s[2])):
                        if a >= end:
                            parts += [text[end:a], f"[{kind.upper()}]"]
                            end = b
                        elif b > end:
                            end = b
                    text = "".join(parts) + text[end:]
                out.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(task, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op10_pii(spark, sf_dir):
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(line(F.col("base")).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
