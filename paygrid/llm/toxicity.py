"""Toxicity by a weighted lexicon matched with Aho-Corasick (operator 5).

Texts are folded: lower case, homoglyphs to Latin letters, digits and symbols
inside words to the letters they stand for.  The lexicon is learned from a
bounded sample of labelled rows (``TRAIN_ROWS`` rows, ``TRAIN_BYTES`` of whole
texts): words, and beginnings of families of words, whose rate in toxic texts is
well above that in others and that are seen in enough toxic texts and contexts;
while learning, a word counts at most ``REPEATS`` times in a text, so that one
text's refrain is not a habit of many.  A phrase of an entry and a neighbour (the
next whole word, however long or far away) that is mostly seen in other texts is
an exception and counts nothing.  A text's evidence, also normalised by its length,
goes through a logistic regression to a score from 0 to 1.

Scoring is one pass without a shuffle.  Defined cases: null, empty and long texts
are scored (no words: no evidence); without labels of both kinds the lexicon is
empty and the score is the share of toxic labels (0 without labels); repeated
rows come back each; null doc_ids are kept and not held out; a labelled doc_id
given twice counts once; only doc_id, text and the labels are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm.learning import bounded_sample, logistic, predict

TRAIN_ROWS = 4_000
TRAIN_BYTES = 32 << 20
#: Of toxic texts, this share must show a word in its own context each.
SUPPORT = 0.02
LEAST_WEIGHT = 1.5
#: Lengths of the beginnings of words that may be entries, and of how many different words they must be.
STEMS = range(3, 9)
FAMILY = 5
REPEATS = 5

#: Letters that look like Latin ones, and what stands for letters inside words.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s",
    "і": "i", "ї": "i", "ј": "j", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
SYMBOLS = {"@": "a", "$": "s", "!": "i"}
_INSIDE = re.compile(r"(?<=[^\W_])[@$!](?=[^\W_])")
_DIGIT = re.compile(r"(?<=[a-z])[013457]+(?=[a-z])|\b[013457](?=[a-z][a-z])")
_GLYPHS = str.maketrans(HOMOGLYPHS)
_AS_LETTERS = str.maketrans(DIGITS)
_WORD = re.compile(r"[^\W_]+")


def _letters(m: re.Match) -> str:
    return m[0].translate(_AS_LETTERS)


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = text.translate(_GLYPHS)
    if "@" in text or "$" in text or "!" in text:
        text = _INSIDE.sub(lambda m: SYMBOLS[m[0]], text)
    # twice: a first digit may stand before one that is a letter only now
    return _DIGIT.sub(_letters, _DIGIT.sub(_letters, text))


def learn_lexicon(rows: list[tuple[str, int]]) -> tuple[dict[str, float], dict[str, set]]:
    """(weights, exceptions: word -> neighbours) from (text, toxic) rows.

    An entry is a word, or the beginning (ending in ``*``) of a family of words;
    its weight is the log ratio of its rates among toxic texts' and other words.
    """
    n_toxic = sum(y for _, y in rows)
    if not n_toxic or n_toxic == len(rows):
        return {}, {}
    words = [_WORD.findall(fold(text)) for text, _ in rows]
    total = [1, 1]
    counts = (Counter(), Counter())
    texts, contexts, family = Counter(), defaultdict(set), defaultdict(set)

    def entries(found):
        """Counts of the entries of a text; a repeated word counts REPEATS times at most."""
        own = Counter()
        for word, n in Counter(found).items():
            n = min(n, REPEATS)
            own[word] += n
            for k in STEMS:
                if k < len(word):
                    own[word[:k] + "*"] += n
        return own

    for found, (_, y) in zip(words, rows, strict=True):
        total[y] += len(found)
        if y:
            own = entries(found)
            counts[1].update(own)
            texts.update(own.keys())
    least = max(3, SUPPORT * n_toxic)
    candidates = {e for e, n in texts.items() if n >= least}
    for found, (_, y) in zip(words, rows, strict=True):
        if not y:
            counts[0].update({e: n for e, n in entries(found).items() if e in candidates})
            continue
        for before, word, after in zip(["", *found], found, [*found[1:], ""], strict=False):
            if word in candidates:
                contexts[word].add((before, after))
            for k in STEMS:
                if k < len(word) and (stem := word[:k] + "*") in candidates:
                    family[stem].add(word)
    found_weights = {}
    for entry in candidates:
        n = counts[1][entry]
        if (entry[-1] == "*" and len(family[entry]) < FAMILY) or (entry[-1] != "*" and len(contexts[entry]) < least):
            continue
        weight = math.log((n + 0.5) / total[1]) - math.log((counts[0][entry] + 0.5) / total[0])
        if weight >= LEAST_WEIGHT:
            found_weights[entry] = weight
    # of entries inside each other the one that explains most stays
    weights: dict[str, float] = {}
    for entry in sorted(found_weights, key=lambda e: (-found_weights[e] * counts[1][e], e)):
        stem = entry.rstrip("*")
        inside = any(stem.startswith(w[:-1]) for w in weights if w[-1] == "*")
        around = entry[-1] == "*" and any(w.startswith(stem) for w in weights)
        if not inside and not around:
            weights[entry] = found_weights[entry]
    pairs = defaultdict(lambda: [0, 0])
    for found, (_, y) in zip(words, rows, strict=True):
        seen = set()
        for i, word in enumerate(found):
            if word in weights:  # beginnings have no exceptions
                seen.update((word, side, found[i + d]) for side, d in (("<", -1), (">", 1)) if 0 <= i + d < len(found))
        for p in seen:
            pairs[p][y] += 1
    exceptions = defaultdict(set)
    for (word, side, near), (clean, bad) in pairs.items():
        if clean >= 3 and bad * 4 <= clean:
            exceptions[word].add(side + near)
    return weights, dict(exceptions)


class Lexicon:
    """Aho-Corasick over folded texts: evidence of whole-word entries outside their exceptions."""

    def __init__(self, weights: dict[str, float], exceptions: dict[str, set]):
        import ahocorasick

        self.weights, self.exceptions = weights, exceptions
        self.automaton = ahocorasick.Automaton()
        for word in weights:
            self.automaton.add_word(word.rstrip("*"), word)
        if weights:
            self.automaton.make_automaton()

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Evidence, evidence by length, different entries."""
        if not text or not self.weights:
            return 0.0, 0.0, 0.0
        text = fold(text)
        total, kinds = 0.0, set()
        for end, word in self.automaton.iter(text):
            start = end - len(word.rstrip("*")) + 1
            if (start and text[start - 1].isalnum()) or (word[-1] != "*" and text[end + 1:end + 2].isalnum()):
                continue
            if not (bad := self.exceptions.get(word)) or not self._excepted(text, start, end + 1, bad):
                total += self.weights[word]
                kinds.add(word)
        return math.log1p(total), math.log1p(1000 * total / (len(text) + 500)), float(len(kinds))

    @staticmethod
    def _excepted(text: str, start: int, end: int, bad: set) -> bool:
        """Whether the next whole word before or after, however long or far away, makes this one harmless."""
        after = _WORD.search(text, end)
        if after and ">" + after[0] in bad:
            return True
        last = start
        while last and not _WORD.match(text, last - 1):
            last -= 1
        first = last
        while first and _WORD.match(text, first - 1):
            first -= 1
        return first < last and "<" + text[first:last] in bad


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Model from labelled rows (doc_id, toxic); the caller has left out what is held out."""
    rows = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = bounded_sample(rows, "doc_id", TRAIN_ROWS, "toxicity")
    known = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")  # TRAIN_ROWS rows of two numbers
    sizes = known.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).toLocalIterator()
    take, left = [], TRAIN_BYTES
    for r in sorted(map(tuple, sizes)):
        if r[1] <= left:
            left -= r[1]
            take.append(r[0])
    got = [(r[0] or "", int(r[1])) for r in known.filter(F.col("doc_id").isin(take)).orderBy("doc_id").select("text", "toxic").collect()] if take else []
    prior = float(np.mean([y for _, y in got])) if got else 0.0
    weights, exceptions = learn_lexicon(got)
    if not weights:
        return {"weights": {}, "exceptions": {}, "prior": prior, "b": None}
    lexicon = Lexicon(weights, exceptions)
    x = np.array([lexicon.features(t) for t, _ in got])
    return {"weights": weights, "exceptions": exceptions, "prior": prior, "b": logistic(x, np.array([y for _, y in got], float))}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row."""
    def task(batches):
        lexicon = Lexicon(model["weights"], model["exceptions"])
        for batch in batches:
            x = np.array([lexicon.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, 3)
            p = np.full(len(x), model["prior"]) if model["b"] is None else predict(x, model["b"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(task, f"doc_id {kind}, score double")


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_toxicity(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels.filter(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
