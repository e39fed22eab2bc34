"""Operator 4, near duplicates by ProbMinHash.

A text is a weighted set of word 5-shingles (weight 1 + ln(occurrences)).
``signature`` lets every shingle send Poisson arrivals at the rate of its
weight, each to a random register; a register keeps its first arrival's
shingle.  Arrivals are drawn up to a horizon by which all registers are very
likely taken; where they are, the process ends there, as no later arrival can
win a register, and only where one is still open the horizon doubles.
Two registers agree with the probability Jaccard similarity of the texts.

A *link* joins two texts whose probability Jaccard similarity, worked out
exactly from the whole texts, is at least ``threshold``.  That is the one
definition: texts of equal shingles in very different numbers are not linked
(the plain set similarity plays no part).

Spark then does the matching:

1. Texts with equal word sequences are one *node* (a 128-bit content hash),
   so copies are counted once and never paired.
2. Each node files its signature under ``BANDS`` keys of ``ROWS`` registers.
3. Inside a bucket, signatures are compared in numpy.  Buckets are split into
   blocks of bounded size, so no task ever holds a whole large bucket; of the
   pairs that look similar, only a maximum spanning forest (at most n - 1
   pairs for n members) leaves a block.
4. Pairs are verified on the whole texts.
5. Verified links give components; buckets that still hold several components
   are compared once more, members outside the bucket's largest component, in
   lots of bounded size, against all of its blocks: first by signatures alone;
   then texts are sent to the (lot, block) groups for the members that are in a
   similar pair across components, and every such pair that its group hasn't
   joined yet is verified there.  So of the candidate pairs none between
   components of any size is left out, no group is larger than a lot and a
   block, and no pairs are joined to texts that a group of near copies would
   multiply.  Candidates are the pairs that share a band and agree in
   ``CUTOFF`` registers; a link at exactly 0.8 is none of them with a chance of
   6 in 100,000, a closer one with a smaller one.
6. The final component's smallest doc_id is the class of its documents.

Defined cases: null text counts as empty; all texts without words are copies
of one another; texts of fewer than five words are one shingle; null ids are
kept (a class of null ids only has class null; of it the stage keeps the
smallest row key); repeated rows each get a
result; empty tables give empty results; ties don't matter (classes are
components); other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_shuffle, extras_aside, map_groups, map_text, query, row_key, slices, stage, table

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 6, 32
M = ROWS * BANDS
#: of M registers, so many must agree before a pair is verified: five standard deviations under the threshold
CUTOFF = int(M * (THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / M) ** 0.5))
BLOCK = 512
#: shingles that a task verifying links holds of the texts it has met
HELD = 1_000_000
BAND_SHIFT = 56

_GOLDEN = 0x9E3779B97F4A7C15
_G = np.uint64(_GOLDEN)


def _odd(r: int) -> np.uint64:
    return np.uint64(r * _GOLDEN & 0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Memo of word hashes; emptied when it has grown large."""

    def __missing__(self, w):
        if len(self) > 50_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return h


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shingles(words: list[str], memo: _Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the word k-shingles (sorted) and their counts."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    k = min(k, n)
    s = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        s = _mix(s * _G + h[i:n - k + 1 + i])
    return np.unique(s, return_counts=True)


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int = M) -> np.ndarray:
    """ProbMinHash registers of several (hashes, weights), a row each (uint64;
    all zero for an empty set).

    Arrivals up to a horizon are drawn in rounds for all sets at once (round r
    holds every shingle's r-th arrival before its set's horizon).  Where a
    register is still open the horizon doubles; arrivals are functions of
    (shingle, r), so a later horizon repeats the earlier ones exactly."""
    out = np.zeros((len(sets), m), np.uint64)
    total = np.array([w.sum() for _, w in sets])
    todo = np.flatnonzero(total > 0)
    spread = np.log(m) + 3.0
    while len(todo):
        h = np.concatenate([sets[i][0] for i in todo])
        rate = np.concatenate([sets[i][1] for i in todo])
        row = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        stop = (m * spread / total[todo])[row]
        t, r = np.zeros(len(h)), 0
        at, slot, who = [], [], []
        while len(h):
            u = _mix(h + _odd(2 * r + 1))
            t = t - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
            on = t <= stop
            h, rate, t, row, stop = h[on], rate[on], t[on], row[on], stop[on]
            at.append(t)
            who.append(h)
            slot.append(row * m + (_mix(h ^ _odd(2 * r + 2)) % np.uint64(m)).astype(np.int64))
            r += 1
        at, slot, who = np.concatenate(at), np.concatenate(slot), np.concatenate(who)
        first = np.full(len(todo) * m, np.inf)
        np.minimum.at(first, slot, at)
        won = at == first[slot]
        got = np.zeros(len(todo) * m, np.uint64)
        got[slot[won]] = who[won]
        full = np.isfinite(first).reshape(-1, m).all(1)
        out[todo[full]] = got.reshape(-1, m)[full]
        todo, spread = todo[~full], spread * 2
    return out


def similarity(a: tuple, b: tuple) -> tuple[float, float]:
    """(set Jaccard, probability Jaccard) of two shingle sets with counts; links go by the second."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(common)
    if not len(common):
        return (1.0, 1.0) if not union else (0.0, 0.0)
    x, y = weights(a[1]), weights(b[1])
    # sum over common s of 1 / sum_t max(x_t / x_s, y_t / y_s): for each s, t counts by x where x_t / y_t > x_s / y_s
    only_x, only_y = x.sum() - x[i].sum(), y.sum() - y[j].sum()
    cx, cy = x[i], y[j]
    ratio = cx / cy
    order = np.argsort(ratio)
    above = cx.sum() - np.cumsum(cx[order])
    upto = np.cumsum(cy[order])
    q = 1.0 / ((above + only_x) / cx[order] + (upto + only_y) / cy[order])
    return len(common) / union, float(q.sum())


def sketches(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without text, plus node (16 bytes of content hash)
    and sig (M x 2 bytes; null for texts without words)."""
    def run(texts):
        memo, node, sets = _Words(), [], []
        for t in texts:
            w = words_of(t)
            node.append(hashlib.blake2b(" ".join(w).encode("utf-8", "surrogatepass"), digest_size=16).digest())
            s, c = shingles(w, memo)
            sets.append((s, weights(c)))
        short = (signatures(sets) >> np.uint64(48)).astype("<u2")
        return {"node": node, "sig": [short[i].tobytes() if len(s) else None for i, (s, _) in enumerate(sets)]}

    return map_text(docs, [c for c in docs.columns if c != "text"], run, "node binary, sig binary", budget=750_000)


def _band_keys(nodes: DataFrame) -> DataFrame:
    """(key, node) for every band of every node: 24 bytes a row, no signature.
    The key's top bits are the band."""
    width = 2 * ROWS
    band = lambda b: (F.lit(b << BAND_SHIFT).cast("long").bitwiseOR(
        F.shiftrightunsigned(F.xxhash64(F.substring("sig", 1 + b * width, width)), 64 - BAND_SHIFT)))
    return nodes.where(F.col("sig").isNotNull()).select(F.explode(F.array(*map(band, range(BANDS)))).alias("key"), "node")


def _agreeing(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of rows of p and q that agree in CUTOFF registers or more, and in how many."""
    a, b, n = [], [], []
    for i in range(len(p)):
        same = np.count_nonzero(q == p[i], axis=1)
        j = np.flatnonzero(same >= CUTOFF)
        a.append(np.full(len(j), i))
        b.append(j)
        n.append(same[j])
    return np.concatenate(a), np.concatenate(b), np.concatenate(n)


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), M)


def _forest_pairs(t, starts):
    """A maximum spanning forest of every block's similar pairs."""
    node, s = t.column("node").to_pylist(), _sigs(t.column("sig"))
    out = {"a": [], "b": []}
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
        if hi - lo < 2:
            continue
        rows = sorted(range(lo, hi), key=node.__getitem__)
        sub = s[rows]
        a, b, n = _agreeing(sub, sub)
        keep = a < b
        a, b, n = a[keep], b[keep], n[keep]
        root = list(range(hi - lo))

        def find(x, root=root):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for k in np.lexsort((b, a, -n)):
            x, y = find(int(a[k])), find(int(b[k]))
            if x != y:
                root[x] = y
                out["a"].append(node[rows[a[k]]])
                out["b"].append(node[rows[b[k]]])
    return out


def _cross_pairs(t, starts):
    """Per group the index pairs (probe, member, registers in common) that are
    similar and of different components.

    A pair is looked at in the first band that it shares only, so once over
    all buckets, and a pair of two probes from one side."""
    node, label = t.column("node").to_pylist(), t.column("label").to_pylist()
    s, key = _sigs(t.column("sig")), t.column("key").to_numpy()
    probe, apart = t.column("probe").to_numpy(), t.column("apart").to_numpy()
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
        p, q = lo + np.flatnonzero(probe[lo:hi]), lo + np.flatnonzero(~probe[lo:hi])
        if not len(p) or not len(q):
            continue
        numbers = lambda c: {x: i for i, x in enumerate(sorted(set(c)))}
        nodes, labels = numbers(node[lo:hi]), numbers(label[lo:hi])
        who, part = np.array([nodes[x] for x in node[lo:hi]]), np.array([labels[x] for x in label[lo:hi]])
        members, a, b, n = s[q], [], [], []
        for i in p:
            same = members == s[i]
            count = np.count_nonzero(same, axis=1)
            j = np.flatnonzero((count >= CUTOFF) & (part[q - lo] != part[i - lo]) & ~(apart[q] & (who[q - lo] < who[i - lo])))
            j = j[same[j].reshape(len(j), BANDS, ROWS).all(2).argmax(1) == key[lo] >> BAND_SHIFT]
            a.append(np.full(len(j), i))
            b.append(q[j])
            n.append(count[j])
        yield np.concatenate(a), np.concatenate(b), np.concatenate(n)


def _in_pairs(t, starts):
    """The rows of every group that are in one of its ``_cross_pairs``."""
    rows = [np.unique(np.concatenate([a, b])) for a, b, _ in _cross_pairs(t, starts)]
    got = t.take(np.concatenate(rows) if rows else np.zeros(0, np.int64))
    return {c: got.column(c).to_pylist() for c in got.column_names}


def _cross_links(t, starts, threshold: float):
    """Verified links between a probe and a member of another component.

    Links of a group are a spanning forest of the components in it, best
    estimates first, so nothing is verified between components that the group
    has joined already."""
    node, label, text = t.column("node").to_pylist(), t.column("label").to_pylist(), t.column("text")
    memo, out = _Words(), {"a": [], "b": []}
    for a, b, n in _cross_pairs(t, starts):
        sets, held = {}, 0  # shingles of the nodes last looked at
        root: dict[bytes, bytes] = {}

        def find(x, root=root):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        def parts(i, sets=sets):
            nonlocal held
            if node[i] not in sets:
                if held > HELD:
                    sets.clear()
                    held = 0
                got = sets[node[i]] = shingles(words_of(text[int(i)].as_py()), memo)
                held += len(got[0])
            return sets[node[i]]

        for k in np.argsort(-n, kind="stable"):
            i, j = a[k], b[k]
            x, y = find(label[i]), find(label[j])
            if x != y and similarity(parts(i), parts(j))[1] >= threshold:
                root[x] = y
                out["a"].append(node[i])
                out["b"].append(node[j])
    return out


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose whole texts are similar enough."""
    got = (pairs.join(by_shuffle(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))), "a")
           .join(by_shuffle(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))), "b")
           .select("a", "b", "text_a", "text_b"))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        memo, seen = _Words(), {}

        def parts(node, text):
            if node not in seen:
                if len(seen) > 64:
                    seen.clear()
                seen[node] = shingles(words_of(text), memo)
            return seen[node]

        for rb in batches:
            size = pc.add(pc.binary_length(rb.column(2)), pc.binary_length(rb.column(3))).to_pylist()
            for lo, hi in slices(size, 2_000_000):  # texts become Python objects a few at a time
                part = rb.slice(lo, hi - lo)
                keep = [similarity(parts(w, x), parts(v, y))[1] >= threshold
                        for w, v, x, y in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return got.mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest
    node that can be reached.  Every round each node's neighbours are linked
    to the smallest among them and itself, which also shortens paths, so the
    rounds grow with the logarithm of a component's diameter."""
    edges = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # large star: neighbours above a node move to the node's lowest; then small star: the rest, with the node itself
        large = both.where("b > a").join(by_shuffle(low), "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(by_shuffle(small_low), "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("low").alias("y")),
                                           F.struct(F.col("b").alias("x"), F.col("low").alias("y")))).alias("e"))
                 .select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct())
        new = stage(small, "links")
        stat = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        same = stat(new) == stat(edges)
        edges = new
        if same:
            break
    own = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(own)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, row (see ``row_key``), class_id, n_class
    (documents of the class), n_links (links of its text in the forest of verified
    links that joins the class; 0 for a text without any) and keeper
    (the row key of the class's first document: smallest id, then row key,
    null ids last)."""
    docs = docs.select("doc_id", "text", row_key().alias("row"))
    sketch = stage(sketches(docs), "sketch")  # one row per document, read several times below
    nodes = stage(sketch.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("rep"), F.min("row").alias("row"),
                                             F.max("sig").alias("sig"), F.count(F.lit(1)).alias("copies")), "nodes")
    keys = _band_keys(nodes)
    # buckets of the same members (count and two xors of member hashes) are kept once
    shared = (keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                      F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("n > 1")
              .groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n"))
    member = stage(keys.join(shared, "key").select("key", "n", "node"), "members")
    busy = member.select("node").distinct()
    sig = stage(nodes.join(by_shuffle(busy), "node").select("node", "row", "sig"), "busy")
    # one text for each node that shares a bucket
    text = stage(docs.select("row", "text").join(by_shuffle(sig.select("row", "node")), "row")
                 .groupBy("node").agg(F.min("text").alias("text")), "texts")
    sig = sig.select("node", "sig")

    member = member.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own_block = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    first = member.select("key", own_block.alias("block"), "node").join(by_shuffle(sig), "node")
    tried = stage(map_groups(first, ["key", "block"], _forest_pairs, "a binary, b binary").distinct(), "pairs")
    links = stage(_verified(tried, text, threshold), "verified")
    label = stage(components(links), "labels")

    labelled = member.join(by_shuffle(label), "node", "left").withColumn("label", F.coalesce("label", "node"))
    main = (labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("key").agg(F.max(F.struct("c", "label"))["label"].alias("main"), F.count(F.lit(1)).alias("parts"),
                                F.ceil((F.sum("c") - F.max("c")) / BLOCK).cast("int").alias("lots"))
            .where("parts > 1").drop("parts"))
    again = labelled.join(main, "key").withColumn("apart", F.expr("label <> main"))
    again = stage(again.select("key", "blocks", "lots", "node", "label", "apart").join(by_shuffle(sig), "node"), "again")
    row = ["node", "label", "apart", "sig"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own_lot = F.pmod(F.xxhash64("key", "node"), F.col("lots")).cast("int")
    probes = again.where("apart").select("key", own_lot.alias("lot"), every("blocks").alias("block"), F.lit(True).alias("probe"), *row)
    base = again.select("key", every("lots").alias("lot"), own_block.alias("block"), F.lit(False).alias("probe"), *row)
    # a group is a lot of probes and a block of members; texts come to those that the signatures leave
    group = ["key", "lot", "block"]
    found = stage(map_groups(probes.union(base), group, _in_pairs,
                             "key long, lot int, block int, probe boolean, node binary, label binary, apart boolean, sig binary"), "found")
    more = map_groups(found.join(by_shuffle(text), "node"), group,
                      lambda t, starts: _cross_links(t, starts, threshold), "a binary, b binary")
    links = stage(links.union(more), "verified")
    label = components(links)

    degree = (links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node")
              .agg(F.count(F.lit(1)).alias("n_links")))
    full = (nodes.select("node", "rep", "copies").join(by_shuffle(label), "node", "left").join(by_shuffle(degree), "node", "left")
            .withColumn("label", F.coalesce("label", "node")).withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))))
    full = stage(full, "nodes-labelled")
    classes = (full.groupBy("label").agg(F.min("rep").alias("rep"), F.sum("copies").alias("n_class"))
               .select("label", F.col("rep.doc_id").alias("class_id"), F.col("rep.row").alias("keeper"), "n_class"))
    full = full.join(by_shuffle(classes), "label").select("node", "class_id", "n_class", "n_links", "keeper")
    return sketch.select("doc_id", "row", "node").join(by_shuffle(full), "node").select("doc_id", "row", "class_id", "n_class", "n_links", "keeper")


@query("op4_probminhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_class", "n_links", (F.col("n_class") > 1).alias("is_duplicated"))


@extras_aside
def stage_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the document with the smallest id stays
    (once, where that very row repeats; null ids last, equal ids by row key).
    Survivors are decided on row keys; the documents are shuffled once, to meet
    their decision, and repeated rows, which then stand together, become one."""
    cols = docs.columns
    got = near_duplicates(docs).select("row", "keeper")
    kept = stage(got.where("row = keeper").select(F.col("row").alias("survivor")).distinct(), "survivors")
    rows = docs.withColumn("survivor", row_key()).join(by_shuffle(kept), "survivor")
    return rows.dropDuplicates(["survivor"]).select(*cols)
