"""Operator 13, hard negatives by Strassen products of integer tiles.

Rows are dealt into blocks of bounded size by a hash of their id; the anchors
(a stated set of rows) go to every block.  Inside a task a block's rows are
held as one integer matrix and the anchors pass by in lots.  The scores of a
lot and a tile of rows are one integer product, computed by Strassen's
recursion: seven products of half the size, zero padding where a side is odd,
and only additions around them.  Additions and products of 64-bit integers are
exact modulo 2^64, so every score that fits into 64 bits is exact.

Two passes, as a window depends on a positive's final score:

1. positives: each lot keeps a heap of its anchors' best rows of the same
   label, merged tile by tile, and Spark merges the heaps of all blocks;
2. negatives: every (anchor, positive) has a window of scores; its heap keeps
   the best rows of other labels inside it, merged the same way.

Heaps hold k rows, and no pairs leave a task but theirs.  Hot labels don't
matter: nothing is grouped by label.

Defined cases: null ids, labels and vectors and vectors with a null or
non-finite component take no part, nor do vectors with an integer component
beyond 2^27; only vectors of the anchor's length are its candidates; rows that
share the anchor's id count as its own; repeated rows are candidates each;
repeated anchor rows (equal id, label and vector) are one anchor; ties go to the
smaller id; a window of a negative score is empty, as its lower end lies above
its upper; an anchor without positives has no rows; an empty table gives an
empty result; other columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, importable, query, stage, table
from .gnat_codes import integers

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a window's ends, per cent of the positive's score
BLOCK, TILE, LOT = 32_768, 2_048, 256
LEAF = 32
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The k best (score, id) of every row: higher scores, then smaller ids."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.row = np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.rows = rows

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        start = np.searchsorted(row, np.arange(self.rows))
        keep = np.arange(len(row)) - start[row] < self.k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]

    def offer(self, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray) -> None:
        """Rows x columns of scores, those that fit, and the columns' ids."""
        n = scores.shape[1]
        if n > 4 * self.k:  # only what reaches a row's k-th best score, ties included
            held = np.where(fits, scores, NONE)
            fits = fits & (held >= np.partition(held, n - self.k, axis=1)[:, n - self.k, None])
        row, col = np.nonzero(fits)
        if len(row):
            self.merge(row, scores[row, col], ids[col])


def _meet(rows: DataFrame, asks: DataFrame, blocks: int, fn, extra: str, result: str) -> DataFrame:
    """``fn(block, lot)`` for every block of ``rows`` (id, label, x) and lot of
    ``asks`` (id, label, x and the columns named in ``extra``), in one task a
    block: its rows come first and are held, the asks follow in lots."""
    importable(rows.sparkSession)
    names = [c.strip().split(" ")[0] for c in extra.split(",")]
    kinds = dict(zip(names, (c.strip().split(" ", 1)[1] for c in extra.split(",")), strict=True))
    base = rows.select(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(blocks)).cast("int").alias("block"), F.size("x").alias("dim"), F.lit(0).alias("asks"),
                       "id", "label", "x", *(F.lit(None).cast(kinds[c]).alias(c) for c in names))
    every = asks.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.size("x").alias("dim"), F.lit(1).alias("asks"),
                        "id", "label", "x", *names)
    schema = arrow_schema(result)
    dealt = base.union(every).repartitionById(blocks, "block").sortWithinPartitions("block", "dim", "asks", "id")

    def run(batches):
        import pyarrow as pa

        now, held = None, []
        for rb in batches:
            if not rb.num_rows:
                continue
            key = np.stack([rb.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), rb.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                block, dim, asking = key[a].tolist()
                if (block, dim) != now:
                    now, held = (block, dim), []
                part = rb.slice(a, b - a)
                if not asking:
                    held.append(_matrix(part, dim))
                elif held:
                    if len(held) > 1:
                        held = [tuple(np.concatenate(c) for c in zip(*held, strict=True))]
                    for lo in range(0, b - a, LOT):
                        lot = part.slice(lo, LOT)
                        got = fn(held[0], _matrix(lot, dim), {c: lot.column(6 + i) for i, c in enumerate(names)})
                        if got is not None:
                            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(got, schema, strict=True)], schema=schema)

    return dealt.mapInArrow(run, result)


def _matrix(rb, dim: int):
    return (rb.column(3).to_numpy(), rb.column(4).to_numpy(), rb.column(5).flatten().to_numpy().reshape(rb.num_rows, dim))


def _positives(block, lot, extra):
    ids, labels, x = block
    who, label, a = lot
    heaps = Heaps(len(who), POSITIVES)
    for s in range(0, len(ids), TILE):
        t = slice(s, s + TILE)
        scores = strassen(a, np.ascontiguousarray(x[t].T))
        heaps.offer(scores, (label[:, None] == labels[t]) & (who[:, None] != ids[t]), ids[t])
    own = extra["anchor"].to_numpy()
    return (who[heaps.row], own[heaps.row], heaps.id, heaps.score) if len(heaps.row) else None


def _ends(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest integer n with LOW * score <= 100 * n <= HIGH * score, without leaving 64 bits."""
    whole, rest = np.divmod(score, 100)
    return whole * LOW - (-(rest * LOW) // 100), whole * HIGH + rest * HIGH // 100


def _negatives(block, lot, extra):
    ids, labels, x = block
    who, label, a = lot
    found = [np.array(c.to_pylist(), dtype=object) for c in (extra["positive_ids"], extra["positive_scores"])]
    count = np.array([len(s) for s in found[1]])
    heaps = [Heaps(len(who), NEGATIVES) for _ in range(POSITIVES)]
    score = np.array([[*s, *[-1] * (POSITIVES - len(s))] for s in found[1]], np.int64)  # -1: an empty window
    low, high = _ends(score)
    for s in range(0, len(ids), TILE):
        t = slice(s, s + TILE)
        scores = strassen(a, np.ascontiguousarray(x[t].T))
        other = (label[:, None] != labels[t]) & (who[:, None] != ids[t])
        for k, heap in enumerate(heaps):
            heap.offer(scores, other & (scores >= low[:, k, None]) & (scores <= high[:, k, None]), ids[t])
    own = extra["anchor"].to_numpy()
    out = []
    for k, heap in enumerate(heaps):
        r = heap.row
        assert (count[r] > k).all()
        out.append((who[r], own[r], np.full(len(r), k), np.array([found[0][i][k] for i in r], np.int64), score[r, k], heap.id, heap.score))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    if label is not None:
        vectors = vectors.withColumn("label", label)
    spark = vectors.sparkSession
    src = integers(vectors, SCALE).where("label is not null").select("id", F.col("label").cast("long").alias("label"), "x")
    src = stage(src.withColumn("anchor", F.when(is_anchor, F.xxhash64("label", "x"))), "integer-vectors")
    rows = src.select("id", "label", "x")
    asks = src.where("anchor is not null").dropDuplicates(["id", "label", "x"])
    n = src.count()
    # enough blocks for all cores, of 1,024 rows or more; of BLOCK rows at most on large tables
    blocks = max(-(-n // BLOCK), min(2 * spark.sparkContext.defaultParallelism, -(-n // 1024)), 1)
    best = lambda keys, score, other: Window.partitionBy(*keys).orderBy(F.desc(score), other)
    found = _meet(rows, asks, blocks, _positives, "anchor long", "anchor_id long, anchor long, positive_id long, score long")
    found = found.withColumn("k", F.row_number().over(best(("anchor_id", "anchor"), "score", "positive_id"))).where(F.col("k") <= POSITIVES)
    lists = found.groupBy("anchor_id", "anchor").agg(F.array_sort(F.collect_list(F.struct("k", "positive_id", "score"))).alias("p"))
    lists = lists.select(F.col("anchor_id").alias("id"), "anchor", F.col("p.positive_id").alias("positive_ids"), F.col("p.score").alias("positive_scores"))
    asks = stage(asks.join(lists, ["id", "anchor"]), "anchors")
    got = _meet(rows, asks, blocks, _negatives, "anchor long, positive_ids array<long>, positive_scores array<long>",
                "anchor_id long, anchor long, k int, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(best(("anchor_id", "anchor", "k"), "negative_score", "negative_id"))
    return (got.withColumn("rank", rank).where(F.col("rank") <= NEGATIVES)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


SQL = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)::INT AS rank,
  n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND {LOW} * p.positive_score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) <= {NEGATIVES}
"""


@query("op13_hard_negatives", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)
