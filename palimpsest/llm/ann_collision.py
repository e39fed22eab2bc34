"""Operator 8, approximate nearest neighbours by collision counting.

Each random projection of the unit vectors has one sorted array.  A query's
window around its own projection grows with a radius (virtual rehashing: the
arrays are never hashed anew, windows only take in what lies next to them), and
every vector counts the projections in whose window it lies.  A vector at the
radius collides in a known share of the projections; those that reach this
share, less ``SLACK`` standard deviations, are verified by their exact cosine on
the original vectors.

1. A sample of at most ``SAMPLE`` vectors (those of the smallest id hashes) is
   searched first, in tasks over the queries: radii grow until ``k`` verified
   vectors lie within one.  A table of that size is thereby searched whole.
2. The k-th distance in the sample bounds the k-th distance among all vectors, so
   it is the radius at which a query's windows over all other vectors end.  The
   vectors are dealt into blocks, each held by one task, and the queries pass by
   with their radius; a block counts, verifies and keeps its ``k`` best of each
   query.  Vectors that the sample gave are verified in any case, so no query
   is left with fewer than it could have.
3. Spark merges the best of all blocks.

A vector is shuffled once, and a query once for each block of ``BLOCK`` vectors.

Defined cases: vectors that are null, empty, all zero, or hold a null or
non-finite component take no part, nor do null ids; only vectors of the
query's length are its candidates; rows that share the query's id count as its
own; repeated candidate rows are candidates each (they differ in nothing, so
their order doesn't matter); repeated query rows are one query; ties in score
go to the smaller id; an empty table gives an empty result; other columns are
left out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import importable, query, stage, table
from .hard_negatives import _meet

K = 5
PROJECTIONS = 192
SAMPLE, BLOCK = 4096, 32_768
START, GROWTH = 0.2, 1.05  # first radius (Euclidean, unit vectors) and its growth
WIDTH = 1.5     # half a window at radius r, in standard deviations of a projected difference of length r
SLACK = 1.8     # standard deviations by which a vector may miss its expected collisions
SEED = 20240229


def projections(dim: int, m: int = PROJECTIONS) -> np.ndarray:
    """m random directions as columns, orthonormal within each lot of ``dim``."""
    rng = np.random.default_rng([SEED, dim])
    lots = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-m // dim))]
    return np.concatenate(lots, axis=1)[:, :m]


def threshold(m: int = PROJECTIONS) -> int:
    """Collisions that a vector at the radius reaches almost surely."""
    p = math.erf(WIDTH / math.sqrt(2))
    return math.ceil(m * p - SLACK * math.sqrt(m * p * (1 - p)))


def half_window(radius, dim: int):
    return WIDTH * radius / np.sqrt(dim)


def cosine(vectors: np.ndarray, norms: np.ndarray, q: np.ndarray, q_norm: float) -> np.ndarray:
    # row sums, not a matrix product: equal vectors get equal scores whatever stands around them
    return (vectors * q).sum(axis=1) / (norms * q_norm)


class Arrays:
    """The sorted projections of a set of vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors**2).sum(1))
        self.axes = projections(vectors.shape[1])
        p = (vectors / self.norms[:, None]) @ self.axes
        self.order = np.ascontiguousarray(np.argsort(p, axis=0, kind="stable").T.astype(np.int32))
        self.ranked = np.ascontiguousarray(np.take_along_axis(p.T, self.order, axis=1))
        self.least, self.verified = threshold(), 0

    def windows(self, pq: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end positions of the queries' windows, projections x queries."""
        low, high = (np.stack([np.searchsorted(r, pq[:, j] + sign * half, side) for j, r in enumerate(self.ranked)])
                     for sign, side in ((-1, "left"), (1, "right")))
        return low, high

    def collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many windows hold each vector: all but those that leave it out."""
        out = [o[:a] for o, a in zip(self.order, low, strict=True)] + [o[b:] for o, b in zip(self.order, high, strict=True)]
        return len(self.order) - np.bincount(np.concatenate(out), minlength=len(self.ids))

    def scores(self, rows: np.ndarray, q: np.ndarray, q_norm: float) -> np.ndarray:
        self.verified += len(rows)
        return cosine(self.vectors[rows], self.norms[rows], q, q_norm)

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        top = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[top]], scores[top]

    def grow(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, by radii that grow until k verified
        vectors lie within one."""
        q_norm = float(np.sqrt((q**2).sum()))
        pq = ((q / q_norm) @ self.axes)[None]
        seen = self.ids == query_id
        rows, scores, radius = np.zeros(0, np.int64), np.zeros(0), START
        low, high = self.windows(pq, np.zeros(1))
        high, counts = low, np.zeros(len(self.ids), np.int64)
        while True:
            whole = radius > 2.0  # no two unit vectors are farther apart
            if whole:
                new = np.flatnonzero(~seen)
            else:
                # only what the wider windows take in is counted
                first, end = self.windows(pq, np.array([half_window(radius, len(q))]))
                taken = [o[a:b] for o, a, b in zip(self.order, first[:, 0], low[:, 0], strict=True)]
                taken += [o[a:b] for o, a, b in zip(self.order, high[:, 0], end[:, 0], strict=True)]
                counts += np.bincount(np.concatenate(taken), minlength=len(self.ids))
                low, high = first, end
                new = np.flatnonzero((counts >= self.least) & ~seen)
            seen[new] = True
            rows, scores = np.concatenate([rows, new]), np.concatenate([scores, self.scores(new, q, q_norm)])
            if whole or np.count_nonzero(scores >= 1 - radius**2 / 2) >= k:
                return self.best(rows, scores, k)
            radius *= GROWTH

    def within(self, query_id: int, q: np.ndarray, low: np.ndarray, high: np.ndarray, sure: np.ndarray, k: int):
        """(ids, scores) of the k best whose collisions in the given windows suffice, or that are ``sure``."""
        rows = np.flatnonzero(((self.collisions(low, high) >= self.least) | np.isin(self.ids, sure)) & (self.ids != query_id))
        return self.best(rows, self.scores(rows, q, float(np.sqrt((q**2).sum()))), k)


def radius_of(scores: np.ndarray, k: int) -> float:
    """The distance of the k-th best, a little more than rounding could take from it; infinite where there are fewer."""
    return float(np.sqrt(max(2 - 2 * scores[k - 1], 0.0) + 1e-12)) if len(scores) >= k else math.inf


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def sampled(asks: DataFrame, sample: list, k: int) -> DataFrame:
    """``asks`` (id, x) plus near and score (arrays) of the k best of the sample, and the radius."""
    importable(asks.sparkSession)
    by: dict[int, tuple[list, list]] = {}
    for r in sample:  # SAMPLE rows at most
        ids, rows = by.setdefault(len(r.x), ([], []))
        ids.append(r.id)
        rows.append(r.x)

    def run(batches):
        import pyarrow as pa

        arrays = {dim: Arrays(np.array(ids), np.array(rows)) for dim, (ids, rows) in by.items()}
        for rb in batches:
            near, score, radius = [], [], []
            for i, x in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                found = arrays[len(x)].grow(i, np.array(x), k) if len(x) in arrays else (np.zeros(0, np.int64), np.zeros(0))
                near.append(found[0])
                score.append(found[1])
                radius.append(radius_of(found[1], k))
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(near, pa.list_(pa.int64())), pa.array(score, pa.list_(pa.float64())),
                                              pa.array(radius, pa.float64())], names=["id", "x", "near", "score", "radius"])

    return asks.select("id", "x").mapInArrow(run, "id long, x array<double>, near array<long>, score array<double>, radius double")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score of each query's k nearest found."""
    v = F.col("x")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), is_query.alias("q"))
    src = src.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    src = stage(src.select("id", "x", F.coalesce("q", F.lit(False)).alias("q")), "vectors")
    asks = src.where("q").dropDuplicates(["id", "x"])
    n, cores = src.count(), src.sparkSession.sparkContext.defaultParallelism
    # queries are few bytes but much work, so their number decides how many tasks they get
    asks = asks.repartition(max(1, min(2 * cores, n // SAMPLE * 4), n // (4 * BLOCK)))
    sample = src.select("id", "x").orderBy(F.xxhash64("id"), "id", "x").limit(SAMPLE).collect()
    first = sampled(asks, sample, k)
    if n <= SAMPLE:
        found = first.select(F.col("id").alias("query_id"), F.inline(F.arrays_zip("near", "score"))).toDF("query_id", "id", "score")
    else:
        held: list = []

        def run(block, lot, extra):
            if not held or held[0] is not block[0]:
                held[:] = [block[0], Arrays(block[0], block[2])]
            arrays = held[1]
            who, _, x = lot
            norms = np.sqrt((x**2).sum(1))
            low, high = arrays.windows((x / norms[:, None]) @ arrays.axes, half_window(extra["radius"].to_numpy(), x.shape[1]))
            got = [arrays.within(int(i), q, low[:, j], high[:, j], np.array(sure), k)
                   for j, (i, q, sure) in enumerate(zip(who, x, extra["near"].to_pylist(), strict=True))]
            count = [len(ids) for ids, _ in got]
            return np.repeat(who, count), np.concatenate([ids for ids, _ in got]), np.concatenate([s for _, s in got])

        blocks = max(-(-n // BLOCK), min(2 * cores, -(-n // SAMPLE)))
        found = _meet(src.select("id", F.lit(0).alias("label"), "x"), stage(first.withColumn("label", F.lit(0)), "queries"), blocks, run,
                      "near array<long>, radius double", "query_id long, id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


@query("op8_ann_collision")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return got.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
