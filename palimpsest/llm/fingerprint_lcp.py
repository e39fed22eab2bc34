"""Operator 9, document fingerprints by locally consistent parsing.

A text is parsed bottom-up.  On each level runs of one symbol become a symbol,
then deterministic coin tossing (the lowest bit in which a symbol differs from
its left neighbour, and that bit) reduces the symbols, in a few rounds, to
labels below six in which neighbours still differ; a phrase starts at every
local minimum.  A phrase's name is a hash of its symbols, and the names are
the next level's symbols.  A boundary depends on a handful of symbols around
it, so equal substrings are cut alike, whatever stands before them.

The fingerprint is ``root-sketch``: a hash of the top symbols and of the
length, then the smallest ``SKETCH`` 32-bit values among the phrase names of
level 2 and above (hexadecimal).  ``likeness`` estimates the share of phrases
that two texts have in common from the two sketches.

``neighbour_fingerprints`` also needs the next document's text.  Documents are
range-partitioned and sorted by id once (the only shuffle of texts); each
partition is read as a stream that holds two documents; its last document is
finished in a second, small step with the first of the next partition.

Defined cases: null text counts as empty; an empty text has no phrases, and
two empty texts are alike (1.0), an empty and another one not (0.0); null ids
come first, equal ids are ordered by text; a single document is its own next;
an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, query, slices, stage, table, text_or_empty

LEVELS = 5
FROM_LEVEL = 2
SKETCH = 64
ROUNDS = 3  # after the first: 64-bit symbols, then labels below 128, 14, 8, 6
CHARS = 1_000_000

_G = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def _toss(sym: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round: 2 * (lowest bit that differs from the left) + that bit; a
    text's first symbol counts as differing in bit 0."""
    one = sym.dtype.type(1)
    x = np.empty_like(sym)
    x[0] = one
    np.bitwise_xor(sym[1:], sym[:-1], out=x[1:])
    x[first] = one
    low = np.bitwise_count((x & (~x + one)) - one)  # index of the lowest set bit
    bit = (sym >> low.astype(sym.dtype)) & one
    return (low * np.uint8(2) + bit.astype(np.uint8)).astype(np.uint8)


def _starts(doc: np.ndarray) -> np.ndarray:
    first = np.empty(len(doc), bool)
    first[0] = True
    np.not_equal(doc[1:], doc[:-1], out=first[1:])
    return first


def _named(sym: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
    """Names of the phrases that start at ``at``."""
    size = np.diff(np.append(at, len(sym)))
    name = np.full(len(at), np.uint64(level + 1)) * _G + size.astype(np.uint64)
    rows, step = np.arange(len(at)), 0
    while len(rows):
        name[rows] = _mix(name[rows] * _G + sym[at[rows] + step])
        step += 1
        rows = rows[size[rows] > step]
    return name


def parse(sym: np.ndarray, doc: np.ndarray):
    """Yield (level, phrase names, text of each phrase) of concatenated texts."""
    for level in range(1, LEVELS + 1):
        if not len(sym):
            return
        first = _starts(doc)
        fresh = first.copy()
        fresh[1:] |= sym[1:] != sym[:-1]
        if not fresh.all():
            at = np.flatnonzero(fresh)
            run = np.diff(np.append(at, len(sym)))
            sym, doc, first = sym[at], doc[at], first[at]
            long = run > 1
            wide = sym.astype(np.uint64)
            wide[long] = _mix(wide[long] * _G + run[long].astype(np.uint64))
            sym = wide
        label = _toss(sym, first)
        for _ in range(ROUNDS):
            label = _toss(label, first)
        cut = first.copy()
        if len(label) > 2:
            cut[1:-1] |= (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:])
        # a text's second symbol and its last one never start a phrase, whatever stands next to the text
        cut[1:] &= ~first[:-1] | first[1:]
        cut[:-1] &= ~first[1:] | first[:-1]
        at = np.flatnonzero(cut)
        sym, doc = _named(sym.astype(np.uint64), at, level), doc[at]
        yield level, sym, doc


def fingerprints(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """(root, sorted sketch values) of every text."""
    raw = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.fromiter((len(r) >> 2 for r in raw), np.int64, len(raw))
    out: list = [(0, np.zeros(0, np.uint32))] * len(texts)
    if not size.sum():
        return out
    sym = np.frombuffer(b"".join(raw), "<u4") + np.uint32(1)
    doc = np.repeat(np.arange(len(texts)), size)
    names, docs, top = [], [], None
    for level, name, of in parse(sym, doc):
        top = (name, of)
        if level >= FROM_LEVEL:
            names.append(name)
            docs.append(of)
    # root: the top symbols in order, and the length
    name, of = top
    at = np.flatnonzero(_starts(of))
    text = of[at]
    root = size[text].astype(np.uint64)
    stop = np.append(at[1:], len(name))
    where = np.arange(len(name)) - np.repeat(at, stop - at)
    root = _mix(root * _G) ^ np.add.reduceat(_mix(name + _mix(where.astype(np.uint64) * _G)), at)
    roots = dict(zip(text.tolist(), root.tolist(), strict=True))
    name, of = np.concatenate(names), np.concatenate(docs)
    key = np.sort((of.astype(np.uint64) << np.uint64(32)) | (name >> np.uint64(32)))
    keep = np.empty(len(key), bool)
    keep[0] = True
    np.not_equal(key[1:], key[:-1], out=keep[1:])
    key = key[keep]
    of, value = (key >> np.uint64(32)).astype(np.int64), key.astype(np.uint32)
    at = np.flatnonzero(_starts(of))
    stop = np.append(at[1:], len(of))
    for a, b in zip(at.tolist(), stop.tolist(), strict=True):
        i = int(of[a])
        out[i] = (roots[i], value[a:min(b, a + SKETCH)])
    return out


def as_bytes(fp: tuple[int, np.ndarray]) -> bytes:
    return fp[0].to_bytes(8, "big") + fp[1].astype(">u4").tobytes()


def as_text(c: str) -> Column:
    """``root-sketch`` of a fingerprint's bytes."""
    digits = F.lower(F.hex(c))
    return F.concat(F.substring(digits, 1, 16), F.lit("-"), F.substr(digits, F.lit(17)))


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of common phrases among the smallest values of both sketches."""
    x, y = a[1], b[1]
    if a[0] == b[0] and len(x) == len(y):
        return 1.0
    if not len(x) or not len(y):
        return 0.0
    both = np.sort(np.concatenate([x, y]))
    twice = both[1:] == both[:-1]
    distinct = len(both) - int(twice.sum())
    if len(x) < SKETCH and len(y) < SKETCH:
        return float(twice.sum() / distinct)  # whole phrase sets
    # the sketch of the union: its SKETCH smallest, of which some are in both
    values, counts = np.unique(both, return_counts=True)
    return float((counts[:SKETCH] == 2).mean())


def edited(text: str, following: str) -> str:
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


RESULT = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double")


def _compare(texts: list[str]) -> dict[str, list]:
    """Results of all texts but the last, each against the one after it."""
    fp = fingerprints(texts)
    new = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    efp = fingerprints(new)
    return {
        "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in new],
        "fingerprint": [as_bytes(f) for f in fp[:-1]], "edited_fingerprint": [as_bytes(f) for f in efp],
        "near_edited": [likeness(a, b) for a, b in zip(fp, efp, strict=False)],
        "near_next": [likeness(a, b) for a, b in zip(fp, fp[1:], strict=False)]}


HEAD, DONE, OPEN = 1, 2, 3
_FIELDS = f"doc_id long, kind int, text string, {RESULT}"
_ENDS = f"doc_id long, {RESULT}"


def _partition(batches, schema):
    """Rows of a sorted partition: DONE with results; the first text again as
    HEAD and the last as OPEN, for the step across partitions."""
    import pyarrow as pa

    last = None  # (id, text) whose next text isn't known yet

    def rows(**cols):
        n = len(cols["doc_id"])
        return pa.RecordBatch.from_arrays([pa.array(cols.get(f.name, [None] * n), f.type) for f in schema], schema=schema)

    for rb in batches:
        ids, texts = rb.column(0).to_pylist(), rb.column(1).to_pylist()
        for a, b in slices([len(t) for t in texts], CHARS):
            if last is None:
                yield rows(doc_id=[ids[a]], kind=[HEAD], text=[texts[a]])
                own_ids, own = ids[a:b], texts[a:b]
            else:
                own_ids, own = [last[0], *ids[a:b]], [last[1], *texts[a:b]]
            if len(own) > 1:
                yield rows(doc_id=own_ids[:-1], kind=[DONE] * (len(own) - 1), **_compare(own))
            last = own_ids[-1], own[-1]
    if last is not None:
        yield rows(doc_id=[last[0]], kind=[OPEN], text=[last[1]])


def _edges(batches, schema):
    """The few HEAD and OPEN rows, sorted: every OPEN text with the HEAD after it (the last with the first)."""
    import pyarrow as pa

    begin = waiting = None

    def row(i, a, b):
        got = _compare([a, b])
        return pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), *(pa.array(got[f.name], f.type) for f in list(schema)[1:])], schema=schema)

    for rb in batches:
        for i, kind, text in zip(*(rb.column(c).to_pylist() for c in range(3)), strict=True):
            if kind == HEAD:
                if begin is None:
                    begin = text
                if waiting is not None:
                    yield row(*waiting, text)
                    waiting = None
            else:
                waiting = i, text
    if waiting is not None:
        yield row(*waiting, begin)


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the fields of ``RESULT``, digests and
    fingerprints as hexadecimal text (staged as bytes)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    ordered = src.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    one, two = arrow_schema(_FIELDS), arrow_schema(_ENDS)
    parts = stage(ordered.mapInArrow(lambda b: _partition(b, one), _FIELDS), "fingerprints")
    edges = parts.where(F.col("kind") != DONE).select("doc_id", "kind", "text")  # two rows a partition
    ends = edges.coalesce(1).sortWithinPartitions("doc_id", "kind").mapInArrow(lambda b: _edges(b, two), _ENDS)
    every = parts.where(F.col("kind") == DONE).drop("kind", "text").unionByName(ends)
    return every.select("doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), as_text("fingerprint").alias("fingerprint"),
                        as_text("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next")


@query("op9_lcp_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
