"""Operators 3, 4 and 8 against brute force, with nulls, ties, repeated rows and long texts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from paygrid.llm import exchange, jaccard_join, stages, substring_dedup, suffix_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Seen(list):
    """What a spy saw; it stays behind when tasks carry the module that the spy is in."""

    def __reduce__(self):
        return list, ()


def texts(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["ab", "añ", "c", "dd", "e", "ff"])
    passage = [[word() + word() + word() for _ in range(rnd.randrange(15, 60))] for _ in range(4)]
    out = []
    for _ in range(n):
        words = [word() + word() + word() for _ in range(rnd.randrange(0, 80))]
        for p in rnd.sample(passage, rnd.randrange(0, 3)):
            words[rnd.randrange(len(words) + 1):0] = p
        out.append(rnd.choice([" ", "\n", "  "]).join(words))
    copies = out[:10]
    return [*out, *copies, "", None, " \t", "x " * 3000, "x " * 3000]


def earlier(keys, size):
    """keys: per document its window keys; flags of what a later window covers."""
    first = {}
    for d, ks in enumerate(keys):
        for p, k in enumerate(ks):
            first.setdefault(k, (d, p))
    return [{x for p, k in enumerate(ks) if first[k] != (d, p) for x in range(p, p + size)} for d, ks in enumerate(keys)]


def test_substring_dedup(table):
    rows = texts(1)
    words = [[w.decode() for w in WORD.findall((t or "").encode())] for t in rows]
    gone = earlier([[tuple(w[p:p + 20]) for p in range(len(w) - 19)] for w in words], 20)
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(table(list(enumerate(rows)))).collect()}
    assert len(got) == len(rows)
    for i, w in enumerate(words):
        assert got[i].n_words == len(w) and got[i].n_removed == len(gone[i])
        assert got[i].kept_text == " ".join(x for p, x in enumerate(w) if p not in gone[i])
        assert {x for s in got[i].removed for x in range(s.start, s.end)} == gone[i]


def test_substring_dedup_moves_frames_and_leaves_no_probes(table, monkeypatch):
    calls = Seen()
    join = exchange.with_hits
    monkeypatch.setattr(exchange, "with_hits", lambda docs, replies: (calls.append((docs, replies)), join(docs, replies))[1])
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"a {passage} ü b"), (2, f"c {passage} d"), (3, None), (4, "")]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(table(rows)).collect()}
    assert got == {1: (33, 0, f"a {passage} ü b"), 2: (32, 30, "c d"), 3: (0, 0, ""), 4: (0, 0, "")}
    assert [docs.schema["text"].dataType.simpleString() for docs, _ in calls] == ["binary", "binary"]
    assert calls[0][1].inputFiles()   # the probes' answers are files: their shuffle is gone


def test_suffix_dedup(table):
    rows = texts(2)
    raw = [(t or "").encode() for t in rows]
    gone = earlier([[b[p:p + 100] for p in range(len(b) - 99)] for b in raw], 100)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(table(list(enumerate(rows)))).collect()}
    for i, b in enumerate(raw):
        assert got[i].n_bytes == len(b) and got[i].n_removed == len(gone[i])
        assert bytes(got[i].kept) == bytes(x for p, x in enumerate(b) if p not in gone[i])
    cover = suffix_dedup.COVER
    assert sorted((a - b) % 57 for a in cover for b in cover if a != b) == list(range(1, 57))


@pytest.mark.parametrize("run", [substring_dedup.remove_repeats, suffix_dedup.remove_repeats])
def test_repeated_rows_null_ids_and_empty_table(table, run):
    long = " ".join(f"w{i}" for i in range(60))
    got = run(table([(1, long), (1, long), (None, long)])).collect()
    assert sorted((r.doc_id or -1, r.n_removed > 0) for r in got) == [(-1, False), (1, True), (1, True)]
    assert run(table([])).collect() == []
    same = run(table([(1, long), (1, long)])).collect()  # a row given twice does not repeat itself
    assert [r.n_removed for r in same] == [0, 0]


def brute_links(rows):
    sets = []
    for t in rows:
        w = WORD.findall((t or "").encode().lower() if (t or "").isascii() else (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())
        sets.append({tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    n = len(rows)
    root = list(range(n))
    links = [0] * n
    for a in range(n):
        for b in range(n):
            if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                links[a] += 1
                ra, rb = root[a], root[b]
                root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return [(i, len(sets[i]), root[i], links[i]) for i in range(n)]


@pytest.mark.parametrize("block,level,hot", [(1_000_000, 4, 1 << 20), (300, 1, 40), (300, 0, 1 << 20)])
def test_jaccard_join(table, block, level, hot, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "LEVEL", level)
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rnd = random.Random(3)
    rows = [t for t in texts(4, 30) if t is None or len(t) < 3000]
    for t in rows[:12]:
        words = (t or "").split()
        for _ in range(6):
            near = list(words)
            for _ in range(rnd.randrange(1, 4)):
                if near:
                    near[rnd.randrange(len(near))] = "Zz" + str(rnd.random())
            rows.append(" ".join(near))
    rows += ["one two", "ONE two", "three"]
    got = sorted(tuple(r) for r in jaccard_join.links(table(list(enumerate(rows)))).collect())
    assert got == brute_links(rows)


@pytest.mark.parametrize("first", [0, 90, 256])
def test_jaccard_join_asks_further_only_where_a_link_may_be(table, first, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FIRST", first)
    rnd = random.Random(12)
    fresh = lambda n: [f"w{rnd.random()}" for _ in range(n)]
    shared = fresh(12)
    rows = [" ".join(fresh(60) + shared + fresh(60)) for _ in range(150)]   # a passage in common, but no links
    for _ in range(8):
        own = fresh(100)
        rows += [" ".join(own), " ".join([*own[:50], "other", *own[51:]]), " ".join(own[8:])]
    rows += [rows[0], rows[-1].upper(), "one two", "one two three", "ONE two", "", None]
    sent = Seen()
    pack = jaccard_join.X.compact
    monkeypatch.setattr(jaccard_join.X, "compact", lambda docs: (sent.append(docs), pack(docs))[1])
    assert sorted(tuple(r) for r in jaccard_join.links(table(list(enumerate(rows)))).collect()) == brute_links(rows)
    if first == 90:
        assert 24 <= sent[0].count() <= 50   # of 181 rows: texts of the others do not travel
    else:
        assert sent[0].count() >= 24


def test_sieve_tells_rows_that_are_not_among_keys(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("id * 7919 - 9000000 AS a", "cast(id AS string) AS b", "id")
    keys = rows.filter("id % 50 = 3").select("a", "b")
    for bits in (exchange.SIEVE_BITS, 64):
        monkeypatch.setattr(exchange, "SIEVE_BITS", bits)
        for on in (["a"], ["a", "b"]):
            clear, rest = exchange.sifted(rows, keys, on)
            assert clear.columns == rest.columns and set(rows.columns) == set(clear.columns)
            clear, rest = ({r.id for r in x.select("id").collect()} for x in (clear, rest))
            assert len(clear) + len(rest) == 5000 and not clear & rest
            assert set(range(3, 5000, 50)) <= rest
            assert len(rest) < 400 or bits == 64
    clear, rest = exchange.sifted(rows, keys.filter("false"), ["a"])
    assert (clear.count(), rest.count()) == (5000, 0)


def test_stage_moves_only_rows_that_are_alike(spark, table, monkeypatch):
    group = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    rows = [(i, group(f"t{i}x")) for i in range(100)]
    for more in ([(200, group("t5x")), (201, group("t7x") + " x"), (9, group("t9x"))], [(None, group("t5x")), (6, "another"), (9, group("t9x"))]):
        moved = Seen()
        part = exchange.sifted
        with monkeypatch.context() as m:
            m.setattr(exchange, "sifted", lambda *a: (moved.append(part(*a)), moved[-1])[1])
            got = Counter((r.doc_id, r.text) for r in stages.one_of_alike(spark, table(rows + more), None).collect())
        # 200 and 201 go; a null id is 5's copy; 9 was given twice; 6 with another text stays
        assert got == Counter(rows) + Counter([r for r in more if r == (6, "another")])
        assert moved[-1][0].count() >= 95


def test_jaccard_join_empty(table):
    assert jaccard_join.links(table([])).collect() == []


def by_row(rows):
    """rows in the order of their keys: null ids first, then by id and digest of the text; each once."""
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))


def test_repeated_ids_with_other_texts(table):
    rnd = random.Random(9)
    rows = [(rnd.choice([None, 3, 4, 5, *range(20, 40)]), t or "") for t in texts(6, 40)]
    rows += rows[:4]
    order = by_row(rows)
    words = [[w.decode() for w in WORD.findall(t.encode())] for _, t in order]
    gone = earlier([[tuple(w[p:p + 20]) for p in range(len(w) - 19)] for w in words], 20)
    want = {r: " ".join(x for p, x in enumerate(w) if p not in g) for r, w, g in zip(order, words, gone, strict=True)}
    got = substring_dedup.remove_repeats(table(rows)).collect()
    assert Counter((r.doc_id, r.kept_text) for r in got) == Counter((r[0], want[r]) for r in rows)
    gone = earlier([[t.encode()[p:p + 100] for p in range(len(t.encode()) - 99)] for _, t in order], 100)
    want = {r: bytes(x for p, x in enumerate(r[1].encode()) if p not in g) for r, g in zip(order, gone, strict=True)}
    got = suffix_dedup.remove_repeats(table(rows)).collect()
    assert Counter((r.doc_id, bytes(r.kept)) for r in got) == Counter((r[0], want[r]) for r in rows)


def test_jaccard_join_null_and_repeated_ids(table):
    group = lambda w: " ".join(f"{w}{i}" for i in range(40))
    rows = [(None, group("a")), (5, group("a")), (3, group("a") + " x"), (9, group("a")), (None, group("b")), (4, group("b")), (8, group("b")),
            (5, group("c")), (6, group("c")), (None, group("d")), (None, group("d") + " x"), (None, "alone"), (7, "other"), (None, None), (5, "")]
    got = Counter((r.doc_id, r.component_id, r.n_links) for r in jaccard_join.links(table(rows)).collect())
    want = [(None, 3, 3), (5, 3, 3), (3, 3, 3), (9, 3, 3), (None, 4, 2), (4, 4, 2), (8, 4, 2), (5, 5, 1), (6, 5, 1),
            (None, None, 1), (None, None, 1), (None, None, 0), (7, 7, 0), (None, None, 0), (5, 5, 0)]
    assert got == Counter(want)


def test_stage_keeps_one_row_of_alike(spark, table):
    group = lambda w: " ".join(f"{w}{i}" for i in range(40))
    rows = [(None, group("a")), (5, group("a")), (3, group("a") + " x"), (5, group("c")), (6, group("c")), (6, group("c")), (6, group("e")),
            (None, group("d")), (None, group("d")), (None, "alone"), (7, "other"), (7, "other"), (8, "one more"), (None, None), (None, None), (9, ""), (9, "")]
    want = [(3, group("a") + " x"), (5, group("c")), (6, group("e")), (None, group("d")), (None, "alone"), (7, "other"), (8, "one more"),
            (None, None), (None, None), (9, ""), (9, "")]
    docs = table(rows)
    got = stages.one_of_alike(spark, docs, None)
    assert got.columns == docs.columns and Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)
    rows = [(1, group("a")), (2, group("a")), (3, group("b")), (3, group("b"))]  # ids tell texts apart
    assert sorted((r.doc_id, r.text) for r in stages.one_of_alike(spark, table(rows), None).collect()) == [(1, group("a")), (3, group("b"))]


def test_stage_cuts_benchmark_by_row(spark, corpus):
    leak = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(None, f"ü {leak}. end"), (None, "clean"), (5, f"one {leak}! two {leak} ü"), (5, "clean too"), (5, f"one {leak}! two {leak} ü"), (6, leak), (7, None), (8, "")]
    sf = corpus(rows, benchmark=([(1, leak)], "item_id long, text string"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = stages.remove_benchmark(spark, docs, sf)
    want = [(i, t and t.replace(leak, "")) for i, t in rows]
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.n_chars) for r in got.collect()) == Counter((i, t, None if t is None else len(t)) for i, t in want)


def test_common_shingles_are_those_of_most_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEVEL", 1)
    rng = random.Random(2)
    every = [rng.randrange(2 ** 64) for _ in range(30)]
    rows = [(i, sorted(every[:5] + rng.sample(every[5:15], 6) + ([every[20 + i]] if i < 10 else []))) for i in range(32)]
    sets = spark.createDataFrame([(i, len(k), 0, np.array(k, np.uint64).tobytes()) for i, k in rows], "id long, n long, skip long, keys binary")
    count = Counter(x for _, k in rows for x in k)
    code = lambda least: sorted({x >> 24 for x, n in count.items() if n >= 2 ** least})
    assert jaccard_join.common_shingles(sets, 7).tolist() == code(1)
    monkeypatch.setattr(jaccard_join, "HOT", len(code(5)))
    assert jaccard_join.common_shingles(sets, 7).tolist() == code(5)   # whole levels only
    monkeypatch.setattr(jaccard_join, "HOT", 1)
    assert jaccard_join.common_shingles(sets, 7).tolist() == []
    keys = np.array(rows[0][1], np.uint64)
    hot = np.array(code(5), np.uint64)
    assert sorted(jaccard_join._cold_first(keys, hot).tolist()) == keys.tolist()
    assert [x >> 24 in set(code(5)) for x in jaccard_join._cold_first(keys, hot).tolist()] == [False] * (len(keys) - 5) + [True] * 5


def test_stages_carry_columns_of_any_name(spark, tmp_path):
    group = lambda w: " ".join(f"{w}{i}" for i in range(40))
    leak = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(1, group("a"), "x", 9, "r", 0.5, "w"), (2, group("a"), "y", 8, "s", 0.1, "w"), (3, f"{leak}. end", "z", 7, "t", 0.2, "w"),
            (4, group("b"), "z", 2, "u", 0.3, "w"), (4, group("b"), "b", 1, "u", 0.3, "w")]
    rows = [(*r, "en", "s") for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string, __id int, __digest string, quality_score double, whole string, lang string, source string")
    alike = stages.one_of_alike(spark, docs, None)
    assert alike.columns == docs.columns
    assert sorted(tuple(r) for r in alike.collect()) == [rows[0], rows[2], rows[4]]   # of the last two the first as JSON
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = stages.remove_benchmark(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and {r.doc_id: r.text for r in got.collect()}[3] == ". end"
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = stages.keep_quality(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= set(rows)
