"""N-gram Jaccard join with set-relation skipping (operator 8).

Documents are sets of distinct word shingles; two link when their Jaccard
similarity is ``percent`` hundredths or more.  The join is exact:

1. *Classes.*  Documents with equal sets are one class; its least doc_id stands
   for it (row keys of ``exchange`` where ids are null or have several texts), so
   copies cost no pairs.
2. *Shared shingles.*  A packed exchange tells each class which of its shingles
   other classes have.  A link needs ``percent`` hundredths of a set shared, so
   all other classes are done.  Most are done by a part of the codes already: every
   row asks for its shingles of codes in that part first, and a class with more
   unshared ones there than a link allows asks no further (a class with copies
   does).  Two linked sets both stay, so what the others ask afterwards is whole.
3. *Candidate groups.*  Shingles are ordered, unshared ones first and the most
   common ones last; of a linked pair, some shingle is in both sets' prefixes
   (size - required + 1).  Sets that share a prefix shingle and have fitting sizes
   are chained, not paired, so a list costs its length.  Components of the chains
   hold every link.  Any one order of all shingles is right; this one keeps shared
   passages out of the prefixes, which would chain sets that have nothing else in
   common.  Common shingles are counted over all sets, and a table of at most
   ``HOT`` codes of them goes to every task.
4. *Join inside a group.*  Lists of a shingle are ordered by set size, and a
   probe skips to the blocks of fitting sizes.  A set's answers are counted from
   its lists; a set much like one with known answers takes those and corrects
   them by the shingles they do not share.  Groups over ``BLOCK`` shingles are
   cut by size and joined block by block, so no task holds a whole group.
5. Links make components; a component's id is its least doc_id that is not null.

Defined cases: null, empty and blank texts have empty sets, link with nothing,
and are their own component; fewer words than a shingle are one shingle; rows that
repeat a doc_id come back each, and link by their own texts; a component of null doc_ids
only has a null id; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.llm import arrays as A
from paygrid.llm import exchange as X
from paygrid.llm.components import connected
from paygrid.llm.staging import written, written_in_buckets

#: A shingle is asked for first if the last byte of its code is below this: more codes cost more, fewer tell less.
FIRST = 90
#: Shingles of a block of a candidate group.
BLOCK = 1_000_000
#: A set takes the answers of one that differs from it by at most this share of its shingles.
ALIKE = 0.3
#: Codes of common shingles that are told to every task: those that most sets have, whole levels of counts at a time.
HOT = 1 << 20
#: Levels are powers of two; a shingle in fewer than 2 ** LEVEL sets is not common.
LEVEL = 4
#: Bits of a shingle's code that are left away when common ones are counted.
CUT = np.uint64(24)
CHAINS = "bucket int, kind int, body binary"


def _sets(roll, codes, batch, offs, data, size):
    """Sorted distinct shingle hashes of the rows of a slice, and each row's first."""
    starts, ends, first = A.words(A.LOWER[data], offs, A.SPACE)
    counts = np.diff(first)
    prefix = roll.prefix(A.word_codes(roll, codes, A.LOWER[data], starts, ends))
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    index = A.ranges_to_index(first[:-1], n)
    last = np.minimum(index + size, np.repeat(first[1:], n))
    keys = roll.ranges(prefix, index, last)
    at = np.concatenate([[0], np.cumsum(n)])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        keys[a:b].sort()
    row = np.repeat(np.arange(len(n)), n)
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    keys, row = keys[new], row[new]
    return keys, np.searchsorted(row, np.arange(len(n) + 1))


def _in_first(keys: np.ndarray) -> np.ndarray:
    """Flags of the codes that are asked for first."""
    return (keys & np.uint64(0xFF)) < np.uint64(FIRST)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node reachable) of the edges; numpy label propagation with jumps."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def _chain(key, lo, hi, ids, percent):
    """Edges between neighbours of fitting sizes in a key's list, in order of size."""
    order = np.lexsort((lo, key))
    key, lo, hi, ids = key[order], lo[order], hi[order], ids[order]
    start = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(start) - 1
    top = np.maximum.accumulate(hi + (group.astype(np.int64) << 40)) & ((1 << 40) - 1)
    joined = np.zeros(len(key), bool)
    joined[1:] = ~start[1:] & (lo[1:] * percent <= top[:-1] * 100)
    return key, lo, hi, ids, joined, np.flatnonzero(joined)


def common_shingles(sets: DataFrame, n_buckets: int) -> np.ndarray:
    """Sorted codes (without their last CUT bits) of the shingles that most sets have, HOT at most.

    Counted over all sets: a task sends each code of its sets once, with a count, to the code's bucket, and a
    bucket returns the codes of a level as one value.  The lowest level that is told is the least that all fit with.
    """
    span = np.uint64(64) - CUT

    def count(batches):
        held, size = [], 0

        def flush():
            code, n = np.unique(np.concatenate(held) >> CUT, return_counts=True)
            held.clear()
            edge = np.searchsorted(code, [(b << int(span)) // n_buckets for b in range(n_buckets)] + [1 << int(span)])
            rows = [(b, X._planes(np.diff(code[i:j], prepend=np.uint64(0))) + X._planes(n[i:j].astype(np.uint32)), j - i)
                    for b, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if j > i]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                               pa.array([r[2] for r in rows], pa.int64())], ["bucket", "body", "n"])

        for batch in batches:
            for raw in batch.column(batch.schema.get_field_index("keys")).to_pylist():
                held.append(np.frombuffer(raw, np.uint64))
                size += len(held[-1])
                if size >= 1_000_000:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def merge(table: pa.Table) -> pa.Table:
        A.give_back()
        codes, counts = [], []
        for raw, n in zip(table.column("body").to_pylist(), table.column("n").to_pylist(), strict=True):
            gaps, at = X._unplanes(raw, 0, n, np.uint64)
            codes.append(np.cumsum(gaps, dtype=np.uint64))
            counts.append(X._unplanes(raw, at, n, np.uint32)[0])
        code, place = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
        level = np.floor(np.log2(total)).astype(np.int64)
        found = [(k, code[level == k]) for k in range(LEVEL, int(level.max()) + 1) if (level == k).any()]
        return pa.table([pa.array([k for k, _ in found], pa.int32()), pa.array([len(c) for _, c in found], pa.int64()),
                         pa.array([c.tobytes() for _, c in found], pa.binary())], ["level", "n", "codes"])

    common = written(sets.mapInArrow(count, "bucket int, body binary, n long").groupBy("bucket").applyInArrow(merge, "level int, n long, codes binary"), "common-shingles")
    least, total = None, 0
    for level, n in sorted(common.groupBy("level").agg(F.sum("n")).collect(), reverse=True):
        total += n
        if total > HOT:
            break
        least = level
    if least is None:
        return np.zeros(0, np.uint64)
    told = [np.frombuffer(r[0], np.uint64) for r in common.filter(F.col("level") >= least).select("codes").collect()]
    return np.sort(np.concatenate(told))


def _cold_first(keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """keys with the common ones last; each part keeps its order."""
    if not len(hot):
        return keys
    code = keys >> CUT
    common = hot[np.minimum(np.searchsorted(hot, code), len(hot) - 1)] == code
    return np.concatenate([keys[~common], keys[common]])


def candidate_edges(sets: DataFrame, percent: int, n_buckets: int, hot=None) -> DataFrame:
    """Chains (a, b) over the prefix lists of sets (id, n, skip, keys); ``hot``: a broadcast of the common shingles' codes."""

    def task(batches):
        held = []

        def flush():
            ids, n, keys = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            key, lo, hi, ids, joined, at = _chain(keys, n, n, ids, percent)
            rows_b, rows_k, rows = [], [], []
            if len(at):
                node, root = _stars(ids[at], ids[at - 1])
                rows_b.append(int(node[0] % n_buckets))
                rows_k.append(0)
                rows.append(node.tobytes() + root.tobytes())
            head = np.flatnonzero(~joined)
            hi = np.maximum.reduceat(hi, head)
            key, lo, ids = key[head], lo[head], ids[head]
            edge = np.searchsorted(key >> np.uint64(32), (np.arange(n_buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(n_buckets))
            edge[-1] = len(key)
            for b in range(n_buckets):
                s = slice(edge[b], edge[b + 1])
                if s.stop > s.start:
                    rows_b.append(b)
                    rows_k.append(1)
                    rows.append(key[s].tobytes() + lo[s].tobytes() + hi[s].tobytes() + ids[s].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(rows_b, pa.int32()), pa.array(rows_k, pa.int32()), pa.array(rows, pa.binary())], ["bucket", "kind", "body"])

        count = 0
        for batch in batches:
            for i, n, skip, raw in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("id", "n", "skip", "keys")), strict=True):
                take = n - (percent * n + 99) // 100 + 1 - skip
                keys = np.frombuffer(raw, np.uint64)
                keys = (_cold_first(keys, hot.value) if hot is not None else keys)[:take]
                held.append((np.full(len(keys), i, np.int64), np.full(len(keys), n, np.int64), keys))
                count += len(keys)
                if count >= 1_000_000:
                    yield flush()
                    count = 0
        if count:
            yield flush()

    def reduce(table: pa.Table) -> pa.Table:
        A.give_back()
        pairs, lists = [], []
        for kind, raw in zip(table.column("kind").to_pylist(), table.column("body").to_pylist(), strict=True):
            if kind == 0:
                pairs.append(np.frombuffer(raw, np.int64).reshape(2, -1))
            else:
                lists.append(np.frombuffer(raw, np.int64).reshape(4, -1))
        if lists:
            key, lo, hi, ids = np.concatenate(lists, axis=1)
            _, _, _, ids, _, at = _chain(key.view(np.uint64), lo, hi, ids, percent)
            pairs.append(np.stack([ids[at], ids[at - 1]]))
        a, b = np.concatenate(pairs, axis=1)
        node, root = _stars(a, b)
        apart = node != root
        return pa.table([pa.array(node[apart]), pa.array(root[apart])], ["a", "b"])

    return sets.mapInArrow(task, CHAINS).groupBy("bucket").applyInArrow(reduce, "a long, b long")


def _join(sizes, weights, tokens, first, percent, side, home):
    """Links of the sets of one candidate group, in order of size: (links of each, root index of each).

    side: 0 or 1 for each set, and links are counted across the sides only; None: all pairs.
    home: flags; links between two guests are counted elsewhere.
    """
    n = len(sizes)
    owner = np.repeat(np.arange(n), np.diff(first))
    _, token = np.unique(tokens, return_inverse=True)
    # index: the lists one after another, each in order of set (that is, of size)
    entries = np.sort(token.astype(np.int64) * n + owner)
    lists = (entries % n).astype(np.int64)
    links = np.zeros(n, np.int64)
    root = np.arange(n)
    done = np.zeros(n, bool)

    def fitting(x):
        """The sets whose sizes allow a link with x."""
        lo = np.searchsorted(sizes, -(-sizes[x] * percent // 100), "left")
        hi = np.searchsorted(sizes, sizes[x] * 100 // percent, "right")
        return int(lo), int(hi)

    def listed(t, lo, hi):
        """Sets in [lo, hi) of the tokens' lists: each list is entered at its block of lo and left at hi."""
        a, b = np.searchsorted(entries, t * n + lo), np.searchsorted(entries, t * n + hi)
        return lists[A.ranges_to_index(a, b - a)]

    def answer(x, common):
        linked = 100 * common >= percent * (sizes[x] + sizes - common)
        linked[x] = False
        if not home[x]:
            linked &= home
        if side is not None:
            linked &= side != side[x]
        at = np.flatnonzero(linked)
        links[x] = weights[at].sum()
        if len(at):
            roots = np.unique(np.append(root[at], root[x]))
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
        done[x] = True

    for x in range(n):
        if done[x]:
            continue
        own = token[first[x]:first[x + 1]]
        lo, hi = fitting(x)
        common = np.bincount(listed(own, lo, hi), minlength=n)
        answer(x, common)
        near = np.flatnonzero(~done & (sizes[x] + sizes - 2 * common <= ALIKE * sizes))
        # answers of a set alike: those of x, corrected by the shingles on one side only
        wide = None
        for y in near.tolist():
            if wide is None:
                span_lo, span_hi = fitting(near[0])[0], fitting(near[-1])[1]
                wide = np.bincount(listed(own, min(lo, span_lo), max(hi, span_hi)), minlength=n)
            other = token[first[y]:first[y + 1]]
            lost, found = np.setdiff1d(own, other, True), np.setdiff1d(other, own, True)
            corrected = wide - np.bincount(listed(lost, 0, n), minlength=n) + np.bincount(listed(found, 0, n), minlength=n)
            y_lo, y_hi = fitting(y)
            corrected[:y_lo] = 0
            corrected[y_hi:] = 0
            answer(y, corrected)
    return links, root


def links(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, n_links (other documents it links with)."""
    return keyed_links(docs, X.row_keys(docs), size, percent).select("doc_id", "n_shingles", "component_id", "n_links")


def keyed_links(docs: DataFrame, keys: DataFrame | None, size: int = 5, percent: int = 80) -> DataFrame:
    """The columns of links, the row's key (id), and the key of the component's row with the component's id (keep)."""
    codes = A.byte_codes()
    own = X.keyed(docs, keys)
    n_buckets = X.buckets(docs)

    def digests(batches):
        roll = A.Rolling()
        for batch, offs, data in A.text_slices(batches):
            keys, first = _sets(roll, codes, batch, offs, data, size)
            part = np.concatenate([[0], np.cumsum(_in_first(keys))])[first]
            total = np.concatenate([[0], np.cumsum(keys)]).astype(np.uint64)
            mixed = np.concatenate([[0], np.cumsum(A.mix(keys * np.uint64(A.INVERSE)))]).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("id")), X.doc_ids(batch), pa.array(np.diff(first), pa.int64()), pa.array(np.diff(part), pa.int64()),
                pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)), pa.array((mixed[first[1:]] - mixed[first[:-1]]).view(np.int64)),
            ], ["id", "doc", "n", "part", "h1", "h2"])

    def asking(among):
        def ask(batches):
            roll, out = A.Rolling(), X.Requests(n_buckets, False)
            for batch, offs, data in A.text_slices(batches):
                keys, first = _sets(roll, codes, batch, offs, data, size)
                counts = np.diff(first)
                row = np.repeat(np.arange(len(counts)), counts)
                at = np.flatnonzero(among(keys))
                yield from out.add(A.ids(batch, "id"), row[at], at - first[row[at]], keys[at])
            yield from out.flush()
        return ask

    def survivors(batches):
        roll = A.Rolling()
        for batch, offs, data in A.text_slices(batches):
            keys, first = _sets(roll, codes, batch, offs, data, size)
            shared = X.hit_flags(batch.column(batch.schema.get_field_index("hits")), first[:-1], len(keys))
            total = np.concatenate([[0], np.cumsum(shared)])[first]
            n = np.diff(first)
            keep = np.flatnonzero(100 * np.diff(total) >= percent * n)
            kept = [keys[a:b][shared[a:b]] for a, b in zip(first[keep].tolist(), first[keep + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(A.ids(batch, "id")[keep]), pa.array(n[keep], pa.int64()), pa.array((n - np.diff(total))[keep], pa.int64()),
                pa.array([k.tobytes() for k in kept], pa.binary()),
            ], ["id", "n", "skip", "keys"])

    sets = written(own.mapInArrow(digests, "id long, doc long, n long, part long, h1 long, h2 long"), "set-digests")
    named = F.when(F.col("doc").isNotNull(), F.col("id"))
    classes = sets.filter("n > 0").groupBy("n", "h1", "h2").agg(
        F.min("id").alias("rep"), F.min("doc").alias("least"), F.min(named).alias("named"), F.count("*").alias("weight"), F.min("part").alias("part"))
    # a place may be told of twice; a count too high only lets a class ask further
    told = X.answers(own.mapInArrow(asking(_in_first), X.REQUEST), False).groupBy("id").agg(F.sum(F.octet_length("lows") / 2).alias("told"))
    unshared = F.col("part") - F.coalesce("told", F.lit(0))
    further = classes.join(told.withColumnRenamed("id", "rep"), "rep", "left").filter(
        (F.col("weight") > 1) | (100 * unshared <= (100 - percent) * F.col("n")))
    further = written(further.select(F.col("rep").alias("id")), "ask-further")
    _, rest = X.sifted(own.select("id", "text"), further, ["id"])
    single = X.compact(rest).join(further, "id", "left_semi")
    replies = X.answers(single.mapInArrow(asking(lambda keys: np.ones(len(keys), bool)), X.REQUEST), False)
    # rows given twice are one; they lie by id already, as the join left them
    shared = X.with_hits(single, replies).filter(F.col("hits").isNotNull()).dropDuplicates(["id"])
    # in buckets by id, so that the sets need not travel to be told their groups
    kept = written_in_buckets(shared.mapInArrow(survivors, "id long, n long, skip long, keys binary"), "shared_sets", "id")
    hot = docs.sparkSession.sparkContext.broadcast(common_shingles(kept, n_buckets))
    groups = connected(candidate_edges(kept, percent, n_buckets, hot))

    # Groups over BLOCK are cut by size into segments of two bands: a set links only into its own and the next
    # band, so a segment's sets and the next segment's first band (its guests) hold all links of the segment's
    # sets.  A segment still over BLOCK meets sub-block by sub-block.  Worked out on narrow rows, so the sets
    # themselves travel once, or twice as guests.
    narrow = kept.select("id", "n", (F.col("n") - F.col("skip")).alias("size")).join(groups, "id")
    narrow = narrow.join(classes.select(F.col("rep").alias("id"), "weight"), "id")
    total = narrow.groupBy("root").agg((F.sum("size") > BLOCK).alias("large"))
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent * 1.0001)).cast("int")
    narrow = narrow.join(total, "root").withColumn("band", F.when(F.col("large"), band).otherwise(0))
    place = lambda seg, home: F.struct(seg.cast("int").alias("seg"), F.lit(home).alias("home"))
    seg = F.floor(F.col("band") / 2)
    narrow = narrow.select("id", "root", "large", "size", "weight", F.explode(
        F.when((F.col("band") % 2 == 0) & (F.col("band") > 0), F.array(place(seg, True), place(seg - 1, False)))
        .otherwise(F.array(place(seg, True)))).alias("p")).select("id", "root", "large", "size", "weight", "p.*")
    amount = narrow.groupBy("root", "seg").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("k"))
    narrow = written(narrow.join(amount, ["root", "seg"]).drop("size"), "group-members")
    members = kept.select("id", "n", "keys").join(narrow, "id").withColumn("own", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    members = members.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    members = members.select("root", "seg", "home", "id", "n", "weight", "keys", "own",
                             F.when(F.col("large"), F.xxhash64("root", "seg")).otherwise(F.pmod(F.xxhash64("root"), F.lit(n_buckets))).alias("g"),
                             F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"))

    def join(table: pa.Table) -> pa.Table:
        A.give_back()
        col = {c: table.column(c).to_numpy() for c in ("root", "seg", "home", "id", "n", "weight", "own", "i", "j")}
        raw = table.column("keys").to_pylist()
        order = np.lexsort((col["id"], col["n"], col["seg"], col["root"]))
        new = (np.diff(col["root"][order]) != 0) | (np.diff(col["seg"][order]) != 0)
        edge = np.flatnonzero(np.concatenate([[True], new, [True]]))
        out_i, out_r, out_l = [], [], []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            at = order[a:b]
            tokens = [np.frombuffer(raw[x], np.uint64) for x in at]
            first = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
            side = None if col["i"][at[0]] == col["j"][at[0]] else (col["own"][at] == col["j"][at[0]]).astype(np.int8)
            got, root = _join(col["n"][at], col["weight"][at], np.concatenate(tokens), first, percent, side, col["home"][at])
            ids = col["id"][at]
            least = np.full(len(at), 2 ** 63 - 1, np.int64)
            np.minimum.at(least, root, ids)
            out_i.append(ids)
            out_r.append(least[root])
            out_l.append(got)
        return pa.table([pa.array(np.concatenate(x)) for x in (out_i, out_r, out_l)], ["id", "root", "links"])

    joined = written(members.groupBy("g", "i", "j").applyInArrow(join, "id long, root long, links long"), "set-links")
    found = connected(joined.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = joined.groupBy("id").agg(F.sum("links").alias("links"))
    classes = (classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
               .join(counted.withColumnRenamed("id", "rep"), "rep", "left")
               .select("n", "h1", "h2", F.coalesce("root", "rep").alias("root"), "least", "named", "rep",
                       (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")))
    if keys is None:
        classes = classes.select("n", "h1", "h2", "links", F.col("root").alias("component"), F.col("root").alias("keep"))
    else:
        # the root's row may have no id, while others of its component do; a large component is dealt over SALTS tasks
        names = classes.groupBy("root").agg(F.min("least").alias("component"), F.coalesce(F.min("named"), F.min("rep")).alias("keep"))
        names = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(X.SALTS - 1))))
        classes = classes.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(X.SALTS)).cast("int"))
        classes = classes.join(names, ["root", "salt"]).select("n", "h1", "h2", "links", "component", "keep")
    out = sets.join(classes, ["n", "h1", "h2"], "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "doc").alias("component_id"),
                      F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "id", F.coalesce("keep", "id").alias("keep"))


def op8_jaccard_join(spark, sf_dir):
    return links(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT reach.id, link.b FROM reach JOIN link ON link.a = reach.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id,
  (SELECT count(*) FROM link WHERE a = d.doc_id) AS n_links
FROM documents d JOIN reach ON reach.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""
