"""Operator 13 against whole-text tokenisation and pairwise range comparison."""

import collections
import hashlib
import random

import numpy as np
import pytest

from paygrid.llm import alignment

P = pytest.importorskip("public_tokenizers")
BPE, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(rows):
    """The contract's columns of (doc_id, text) rows, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    chars = {c: i for c, i in alignment._unmapped().items()}
    out, pairs = [], collections.Counter()
    for doc, text in rows:
        if not text:
            out.append((doc, [], [], [], []))
            continue
        whole = (" " + text).encode()
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(chars[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != whole or b"".join(bb) != whole:
            out.append((doc, [], [], [], []))
            continue
        ea, eb = np.cumsum([len(x) for x in ba]), np.cumsum([len(x) for x in bb])
        sa, sb = ea - [len(x) for x in ba], eb - [len(x) for x in bb]
        links = [(ia[i], ib[j]) for i in range(len(ia)) for j in range(len(ib)) if sa[i] < eb[j] and sb[j] < ea[i]]
        pairs.update(links)
        groups, p, q = [], 0, 0
        for end in sorted(set(ea.tolist()) & set(eb.tolist())):
            np_, nq = int(np.searchsorted(ea, end)) + 1, int(np.searchsorted(eb, end)) + 1
            groups.append((ia[p:np_], ib[q:nq]))
            p, q = np_, nq
        out.append((doc, ia, ib, groups, links))
    top = collections.Counter()
    for (_, j), n in pairs.items():
        top[j] = max(top[j], n)
    rows = []
    for doc, ia, ib, groups, links in out:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((doc, len(ia), len(ib), len(groups), len(links), sum(pairs[x] == top[x[1]] for x in links), sum(pairs[x] for x in links),
                     hashlib.sha256(text.encode()).hexdigest() if ia else "", sum(len(x) * len(y) for x, y in groups)))
    return rows


TEXTS = [None, "", " ", "  ", "a", " a", "a ", "a  b\n\n  c\t d \r\n e", "x\n", "x \n", "\n\n x", "word<|endoftext|> <s> <0x41> <unk>", "▁ x", "foo▁bar",
         "Ünïcödé ﬁ é 漢字かな混じり文 🙂🙂 x y　z\u0085w\x1cq \x00   é", "don't we'll I'm 123,456.78 ====    ----", "z" * 5000 + " " * 300 + "q",
         "same words same words same words", "same words same words same words", "{\r\n  };\r\n", "a  b", "a  b  　 c"]


def test_matches_whole_text_tokenisation(spark, corpus, monkeypatch):
    rng = random.Random(3)
    alphabet = "ab eé.\n\t 漢'1s  " 
    rows = list(enumerate(TEXTS)) + [(None, "no id here"), (3, "twice the id"), (3, "twice the id")]
    rows += [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(60)]
    folder = corpus(rows)
    got = [tuple(r) for r in alignment.op13_token_alignment(spark, folder).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_small_chunks_and_blocks(spark, table):
    rows = [(i, f"word{i % 7} other words {i % 5}, ends  here\n") for i in range(40)]
    big = alignment._aligned_in_blocks.__globals__
    kept = big["CHUNK_BYTES"], big["BLOCK_BYTES"], big["JOINED"]
    try:
        big["CHUNK_BYTES"], big["BLOCK_BYTES"], big["JOINED"] = 90, 20, 9
        got = alignment.align(table(rows), BPE, PIECES, with_groups=True).collect()
    finally:
        big["CHUNK_BYTES"], big["BLOCK_BYTES"], big["JOINED"] = kept
    want = {r[0]: r[1:7] + (r[8],) for r in brute(rows)}
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("alignment_chunks")]
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.n_shared) for r in got} == want


def test_empty_table(spark, table):
    assert alignment.align(table([]), BPE, PIECES).collect() == []


def test_products_equal_dense_ones():
    rng = np.random.default_rng(5)
    for _ in range(20):
        x, y = rng.integers(0, 3, (rng.integers(1, 6), 5)), rng.integers(0, 3, (5, rng.integers(1, 6)))

        def csr(m):
            r, c = np.nonzero(m)
            return alignment.Csr(np.searchsorted(r, np.arange(len(m) + 1)), c, m[r, c], m.shape[1])

        got = alignment.product(csr(x), csr(y))
        dense = np.zeros((x.shape[0], y.shape[1]), int)
        dense[got.rows(), got.columns] = got.values
        assert (dense == x @ y).all()
        t = alignment.transposed(csr(x))
        assert (t.columns == np.nonzero(x.T)[1]).all() and len(t.first) == 6


def test_the_faster_library_is_only_taken_for_ordered_merges(tmp_path):
    import json

    spec = json.load(open(BPE, encoding="utf-8"))
    fast, own = alignment._first_encoder(BPE)
    spec["model"]["merges"][1000:1002] = spec["model"]["merges"][1001:999:-1]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    slow, other = alignment._first_encoder(str(path))
    assert own == other and fast.__module__.startswith("tiktoken") and not slow.__module__.startswith("tiktoken")
    for text in (t for t in TEXTS if t):
        assert fast(text) == list(slow(text)), text
