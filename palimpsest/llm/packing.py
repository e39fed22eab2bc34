"""Operator 12, best-fit packing of documents into token sequences.

1. ``encode_pieces`` turns every whole text into token ids and one end token.
   A document longer than the capacity is cut from its end into pieces of full
   length, so that only its first piece is shorter.
2. ``place`` needs nothing but the pieces' lengths.  Pieces of equal length
   are interchangeable, so the packing is made on the histogram of lengths (as
   many rows as the capacity has tokens, whatever the input's size):

   * large-item matching: pieces above a third of the capacity fit at most
     twice into a sequence.  From the longest down each takes the longest
     large partner that still fits; as the sets of possible partners are
     nested, no other matching has more pairs;
   * the smaller pieces, from the longest down, go to the smallest gap that
     holds them (best fit), and a new sequence is opened only where none does.

   The result is a short list of *runs*: the pieces of one length, counted
   from a to b, go one by one (or t to a sequence) into consecutive sequences
   at one offset.
3. Spark numbers the pieces of every length: a running number inside each task
   plus the pieces of that length in the tasks before, from the counts by task
   and length.  A piece's number finds its run by binary search.

No task or driver holds more than a batch of pieces, the histogram or the runs;
the hottest length is spread over as many groups as there are tasks.
``sequences`` gathers the ids of every sequence, which are of bounded length.

Ids: a byte-level vocabulary file of the usual form is run by a faster library
with the same merges; any other file by its own (see ``encoder``).

Defined cases: a null text is empty and gives the end token alone; null ids are
kept; repeated rows are documents each; which of several pieces of one length
takes which place is not fixed; an empty table gives an empty result; the
columns named in ``keep`` pass, others are left out, and a kept column that
has the name of a result is an error; ``place`` passes all columns it doesn't
make itself.
"""

from __future__ import annotations

import bisect
import functools
import json

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, query, slices, stage, table, text_or_empty

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"
#: fixed value: how the byte-level splitter of such files cuts a text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_level(spec: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """(bytes -> id, special string -> id) where ids of the file are the ranks
    of its merges and its splitter is the plain byte-level one; else None."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel":
        return None
    if split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    if any(not t["special"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return None
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    if any(c not in byte for t in ids for c in t):
        return None
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    first = 256
    if sorted(i for t, i in ids.items() if len(t) == 1) != list(range(first)):
        return None
    if len(ids) != first + len(merged) or any(ids.get(t) != first + i for i, t in enumerate(merged)):
        return None
    return {bytes(byte[c] for c in t): i for t, i in ids.items()}, special


@functools.lru_cache(maxsize=2)
def encoder(spec: str):
    """text -> ids (little-endian unsigned 32-bit numbers) by a vocabulary file's text."""
    known = _byte_level(json.loads(spec))
    if known is not None:
        import tiktoken

        ranks, special = known
        quick = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: quick.encode_to_numpy(text, allowed_special="all").astype("<u4")
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec)
    library.no_truncation()
    library.no_padding()
    return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, "<u4")


def encode_pieces(docs: DataFrame, spec: str, keep: tuple[str, ...] = ("doc_id",), capacity: int = CAPACITY,
                  end: int = END, text_col: str = "text") -> DataFrame:
    """``keep`` plus piece (from 0), start (ids of the document before it),
    length and ids (binary, four little-endian bytes an id) of every piece."""
    spark = docs.sparkSession
    importable(spark)
    made = T.StructType.fromDDL("piece int, start long, length long, ids binary")
    if clash := set(keep) & set(made.names):
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    src = docs.select(*keep, text_or_empty(text_col).alias("__whole_text"))
    sent = spark.sparkContext.broadcast(spec)

    def run(batches):
        import pyarrow as pa

        encode, last = encoder(sent.value), np.array([end], "<u4")
        for rb in batches:
            texts = rb.column(rb.num_columns - 1).to_pylist()
            for a, b in slices([len(t) for t in texts], 2_000_000):
                row, piece, start, length, ids = [], [], [], [], []
                for i in range(a, b):
                    found = np.concatenate([encode(texts[i]), last])
                    cuts = [0, *range(len(found) % capacity or capacity, len(found) + 1, capacity)] if len(found) > capacity else [0, len(found)]
                    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i)
                        piece.append(k)
                        start.append(lo)
                        length.append(hi - lo)
                        ids.append(found[lo:hi].tobytes())
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rb.column(j).take(at) for j in range(len(keep))]
                    + [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=[*keep, *made.names])

    return src.mapInArrow(run, T.StructType([src.schema[c] for c in keep] + made.fields))


class Bins:
    """Ranges of consecutive sequences by their free space."""

    def __init__(self, capacity: int):
        self.capacity, self.opened = capacity, 0
        self.gaps: list[int] = []  # sorted, those with sequences
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def open(self, n: int) -> int:
        self.opened += n
        return self.opened - n

    def add(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.ranges:
                bisect.insort(self.gaps, gap)
            self.ranges.setdefault(gap, []).append((first, n))

    def take(self, size: int) -> tuple[int, int, int] | None:
        """(gap, first, n) of the smallest gap that holds ``size``."""
        at = bisect.bisect_left(self.gaps, size)
        if at == len(self.gaps):
            return None
        gap = self.gaps[at]
        first, n = self.ranges[gap].pop()
        if not self.ranges[gap]:
            del self.ranges[gap], self.gaps[at]
        return gap, first, n


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs (length, number of its first piece, first sequence, pieces a
    sequence, offset) sorted by length and number, and how many sequences."""
    left = {s: n for s, n in histogram.items() if n}
    done: dict[int, int] = {}
    bins, runs = Bins(capacity), []

    def run(size, n, first, each, offset):
        runs.append((size, done.get(size, 0), first, each, offset))
        done[size] = done.get(size, 0) + n
        left[size] -= n
        if not left[size]:
            del left[size]

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for a in large:
        while a in left:
            n = left[a]
            b = next((s for s in large if s <= min(a, capacity - a) and s in left and (s < a or n > 1)), None)
            if b is None:
                first = bins.open(n)
                run(a, n, first, 1, 0)
                bins.add(capacity - a, first, n)
                continue
            n = n // 2 if a == b else min(n, left[b])
            first = bins.open(n)
            run(a, n, first, 1, 0)
            run(b, n, first, 1, a)
            bins.add(capacity - a - b, first, n)
    for s in sorted(left, reverse=True):
        while s in left:
            gap, first, n = bins.take(s) or (capacity, None, left[s])
            each = gap // s
            used = min(n, left[s] // each)
            if first is None:
                first = bins.open(max(used, 1))
                n = max(used, 1)
            if used:
                run(s, used * each, first, each, capacity - gap)
                bins.add(gap - each * s, first, used)
                bins.add(gap, first + used, n - used)
            else:  # the last few, in one sequence
                few = left[s]
                run(s, few, first, few, capacity - gap)
                bins.add(gap - few * s, first, 1)
                bins.add(gap, first + 1, n - 1)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), bins.opened


def locate(runs: np.ndarray, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces with these lengths and numbers."""
    by = np.searchsorted(runs[:, 0], length, "left"), np.searchsorted(runs[:, 0], length, "right")
    low, high = by[0].copy(), by[1].copy()
    while (high - low > 1).any():  # the last run of the length that begins at or before the number
        mid = (low + high) // 2
        up = (high - low > 1) & (runs[np.minimum(mid, len(runs) - 1), 1] <= number)
        high = np.where((high - low > 1) & ~up, mid, high)
        low = np.where(up, mid, low)
    r = runs[low]
    k = number - r[:, 1]
    return r[:, 2] + k // r[:, 3], r[:, 4] + k % r[:, 3] * length


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a column length, 1 to ``capacity``) plus sequence_id and offset."""
    spark = pieces.sparkSession
    importable(spark)
    if clash := {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError(f"pieces have columns of the result: {sorted(clash)}")
    at, cols = pieces.columns.index("length"), pieces.columns
    task, own, before = (f"__packing_{x}" for x in ("task", "own", "before"))

    def number(batches):
        import pyarrow as pa

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for rb in batches:
            size = rb.column(at).to_numpy()
            order = np.argsort(size, kind="stable")
            new = np.diff(size[order], prepend=-1) != 0
            within = np.arange(len(size)) - np.maximum.accumulate(np.where(new, np.arange(len(size)), 0))
            nth = np.empty(len(size), np.int64)
            nth[order] = within
            nth += seen[size]
            seen += np.bincount(size, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(np.full(len(size), part), pa.int32()), pa.array(nth, pa.int64())],
                                             names=[*cols, task, own])

    numbered = stage(pieces.mapInArrow(number, T.StructType([*pieces.schema.fields, *T.StructType.fromDDL(f"{task} int, {own} long")])), "pieces")
    counts = stage(numbered.groupBy(task, "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # a row for each length, ``capacity`` at most
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if histogram and not 0 < min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    runs, _ = plan(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(task, "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias(before))
    found = numbered.join(offsets, [task, "length"]).select(*cols, (F.col(own) + F.col(before)).alias(own))

    def seat(batches):
        import pyarrow as pa

        for rb in batches:
            sequence, offset = locate(runs, rb.column(at).to_numpy(), rb.column(len(cols)).to_numpy())
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                             names=[*cols, "sequence_id", "offset"])

    return found.mapInArrow(seat, T.StructType([*pieces.schema.fields, *T.StructType.fromDDL("sequence_id long, offset long")]))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, n_pieces, length and ids (binary) of every sequence; a
    group is as many pieces as a sequence holds."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    got = placed.groupBy("sequence_id").agg(rows.alias("r"))
    joined = F.aggregate(F.col("r.ids"), F.lit(b""), lambda a, x: F.concat(a, x))
    return got.select("sequence_id", F.size("r").alias("n_pieces"),
                      F.aggregate("r.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("length"), joined.alias("ids"))


@query("op12_best_fit")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = encode_pieces(table(spark, sf_dir, "documents"), vocabulary())
    return place(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
