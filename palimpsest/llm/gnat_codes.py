"""Operator 11, vector code compression with a GNAT over codebook entries.

Vectors become integers, are cut into equal parts, and every part is replaced
by the index of its codebook's nearest entry.  Codebooks begin as the parts of
the vectors with the smallest ids and move to their parts' means, rounded
down, for a few rounds; everything is integer arithmetic, so results are exact.

Nearest entries come from a geometric near-neighbour access tree over each
codebook: a node's split points are evaluated for all queries that reach it,
the other entries hang below their nearest split point, and for every ordered
pair of split points the tree keeps the range of distances from the one to all
entries below the other.  A query drops a whole subtree as soon as some split
point's distance shows that every entry in it is strictly farther than the best
so far.  Ranges, distances and the best so far are square roots rounded to the
safe side, so rounding never drops an entry at equal distance; the winner is
then settled on the integer squared distances, ties to the lower index.

Spark reads the vectors once into an integer table; each round is one pass that
returns, from every task, the counts and component sums of its entries (codebook
size times vector length numbers), and one grouped aggregate.  The codebooks,
which the driver keeps, have that size too.  Errors are summed by label in an
aggregate; the few labels that hold more than a thousandth of all rows (at most
a thousand labels) meet their rows by broadcast, all others in a shuffle.

Defined cases: null ids, null or empty vectors and vectors with a null or
non-finite component are dropped; so are vectors of another length than that of
the smallest id (or all, if that isn't a multiple of the parts) and vectors with
an integer component beyond 2^27, whose squares could leave 64 bits; repeated
rows count each, ordered by vector where ids are equal; fewer vectors than
entries give smaller codebooks; equal entries are told apart by index; null
labels are one label; an empty table gives an empty result; other columns are
left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, query, stage, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
FAN, LEAF = 8, 8
LIMIT = 1 << 27
HOT = 1000
UP, DOWN = 1 + 1e-15, 1 - 1e-15  # wider than the rounding of a root of an integer and one subtraction


def _squared(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    return ((q[:, None, :] - e[None, :, :]) ** 2).sum(-1)


class Gnat:
    """The tree over one codebook's entries (k x width, int64)."""

    def __init__(self, entries: np.ndarray, fan: int = FAN, leaf: int = LEAF):
        self.entries, self.fan, self.leaf = entries, fan, max(fan, leaf)
        self.compared = 0
        self.root = self._build(np.arange(len(entries)))

    def _build(self, ids: np.ndarray):
        if len(ids) <= self.leaf:
            return ids, None
        own = self.entries[ids]
        # split points far from one another, from the lowest index on
        picked, near = [0], _squared(own, own[:1])[:, 0]
        while len(picked) < self.fan:
            near[picked] = -1
            picked.append(int(np.argmax(near)))
            near = np.minimum(near, _squared(own, own[picked[-1:]])[:, 0])
        picked = np.sort(picked)
        d2 = _squared(own, own[picked])  # members x split points
        part = np.argmin(d2, axis=1)
        part[picked] = np.arange(len(picked))
        low, high = np.zeros((len(picked), len(picked))), np.zeros((len(picked), len(picked)))
        below = []
        for j in range(len(picked)):
            inside = part == j
            d = np.sqrt(d2[inside].astype(np.float64))
            low[:, j], high[:, j] = d.min(0) * DOWN, d.max(0) * UP
            inside[picked[j]] = False
            below.append(self._build(ids[inside]) if inside.any() else None)
        return ids[picked], (low, high, below)

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of every query's nearest entry."""
        best = np.full(len(q), np.iinfo(np.int64).max), np.full(len(q), len(self.entries))
        for a in range(0, len(q), 4096):
            rows = np.arange(a, min(a + 4096, len(q)))
            self._visit(self.root, q, rows, *best)
        return best[1], best[0]

    def _visit(self, node, q, rows, best, index):
        ids, inner = node
        d2 = _squared(q[rows], self.entries[ids])
        self.compared += d2.size
        first = np.argmin(d2, axis=1)  # ids ascend, so ties go to the lower one
        least, who = d2[np.arange(len(rows)), first], ids[first]
        better = (least < best[rows]) | ((least == best[rows]) & (who < index[rows]))
        best[rows[better]], index[rows[better]] = least[better], who[better]
        if inner is None:
            return
        low, high, below = inner
        d = np.sqrt(d2.astype(np.float64))
        d_low, d_high = d * DOWN, d * UP
        for nearest_first in (True, False):
            for j, child in enumerate(below):
                if child is None:
                    continue
                at = np.flatnonzero((first == j) == nearest_first)
                if len(at):
                    gap = np.maximum(d_low[at] - high[:, j], low[:, j] - d_high[at]).max(1)
                    at = at[gap * DOWN <= np.sqrt(best[rows[at]].astype(np.float64)) * UP]
                if len(at):
                    self._visit(child, q, rows[at], best, index)


def integers(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label and x (array<long>: floor of ``scale`` times each component) of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    src = src.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
    src = src.where(F.forall(v, lambda c: F.abs(c * scale) <= float(LIMIT)))
    return src.select("id", "label", F.transform(v, lambda c: F.floor(c * scale).cast("long")).alias("x"))


def _parts(column, parts: int) -> np.ndarray:
    """rows x parts x width of an Arrow list column of equal lengths."""
    n = len(column)
    return column.flatten().to_numpy().reshape(n, parts, -1)


def update(x: DataFrame, books: list[np.ndarray], parts: int) -> list[np.ndarray]:
    """Every entry replaced by the mean of its parts, rounded down."""

    def run(batches):
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        k, width = books[0].shape
        total = np.zeros((parts, k, width + 1), np.int64)
        for rb in batches:
            q = _parts(rb.column(0), parts)
            for p in range(parts):
                index, _ = trees[p].nearest(q[:, p])
                order = np.argsort(index, kind="stable")
                used, start = np.unique(index[order], return_index=True)
                if len(used):
                    total[p, used, :width] += np.add.reduceat(q[order, p], start, axis=0)
                    total[p, used, width] += np.diff(start, append=len(index))
        p, e, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array(total[p, e, j], pa.int64())], names=["p", "e", "j", "s"])

    sums = x.mapInArrow(run, "p int, e int, j int, s long").groupBy("p", "e", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    k, width = books[0].shape
    got = {(r.p, r.e, r.j): int(r.s) for r in sums.collect()}  # codebook size
    return [np.array([[got.get((p, e, j), 0) // n for j in range(width)] if (n := got.get((p, e, width))) else books[p][e].tolist()
                      for e in range(k)], np.int64) for p in range(parts)]


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error of every vector; the codebooks)."""
    importable(vectors.sparkSession)
    spark = vectors.sparkSession
    kept = integers(vectors, scale)
    first = kept.orderBy("id", "x").select(F.size("x").alias("n")).first()
    width = (first.n if first and first.n % parts == 0 else 0) // parts
    kept = stage(kept.where(F.size("x") == width * parts if width else F.lit(False)), "integer-vectors")
    seeds = kept.orderBy("id", "x").limit(entries).select("x").collect()
    seeds = np.array([r.x for r in seeds], np.int64).reshape(len(seeds), parts, width)
    kind = vectors.schema["label"].dataType
    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", kind), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not len(seeds):
        return spark.createDataFrame([], out), [np.zeros((0, width), np.int64)] * parts
    books = [np.ascontiguousarray(seeds[:, p]) for p in range(parts)]
    for _ in range(rounds):
        books = update(kept.select("x"), books, parts)
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches):
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        names = np.array([f"{i:0{digits}x}" for i in range(entries)], object)
        for rb in batches:
            q = _parts(rb.column(2), parts)
            found = [t.nearest(q[:, p]) for p, t in enumerate(trees)]
            code = sum((names[i] for i, _ in found[1:]), names[found[0][0]])
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(code, pa.string()),
                                              pa.array(sum(d for _, d in found), pa.int64())], names=out.names)

    return kept.select("id", "label", "x").mapInArrow(run, out), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` plus label_error, the errors summed over rows of its label."""
    coded = stage(coded, "codes")
    totals = stage(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    rows = totals.agg(F.sum("n")).first()[0] or 0
    least = rows // HOT + 1
    # labels of more than a thousandth of all rows: less than HOT of them
    hot = F.broadcast(totals.where(F.col("n") >= least).select(F.col("label").alias("hot"), "label_error"))
    met = coded.join(hot, F.col("label").eqNullSafe(F.col("hot")), "left")
    cold = totals.where(F.col("n") < least).select(F.col("label").alias("cold"), F.col("label_error").alias("cold_error"))
    rest = met.where("label_error is null").drop("hot", "label_error").join(cold, F.col("label").eqNullSafe(F.col("cold")))
    return met.where("label_error is not null").drop("hot").unionByName(rest.drop("cold").withColumnRenamed("cold_error", "label_error"))


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(c)) for b in books for e in b for c in e).encode()).hexdigest()


def _sql() -> str:
    dist = "list_inner_product(q.x, c.x) * -2 + list_inner_product(c.x, c.x) + list_inner_product(q.x, q.x)"
    assign = lambda r: f"""a{r} AS MATERIALIZED (
  SELECT q.vec_id, q.p, min(struct_pack(d := {dist}, e := c.e)) AS got FROM parts q JOIN c{r} c ON q.p = c.p GROUP BY q.vec_id, q.p)"""  # noqa: E731
    moved = lambda r: f"""s{r} AS (
  SELECT a.p, a.got.e AS e, j, sum(q.x[j])::HUGEINT AS s, count(*) AS n
  FROM a{r} a JOIN parts q ON a.vec_id = q.vec_id AND a.p = q.p, range(1, 17) t(j) GROUP BY a.p, a.got.e, j),
m{r} AS (SELECT p, e, list((CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END)::DOUBLE ORDER BY j) AS x FROM s{r} GROUP BY p, e),
c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.p = m.p AND c.e = m.e)"""  # noqa: E731
    rounds = ",\n".join(f"{assign(r)},\n{moved(r)}" for r in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, x[p * 16 + 1:p * 16 + 16] AS x FROM kept, range({PARTS}) t(p)),
c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES}),
{rounds},
{assign(ROUNDS)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', got.e::INT), '' ORDER BY p) AS code, sum(got.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id),
book AS (
  SELECT sha256(string_agg(x[j]::BIGINT::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM c{ROUNDS}, range(1, 17) t(j))
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, b.codebooks_sha256
FROM kept k JOIN coded c ON k.vec_id = c.vec_id, book b
"""


@query("op11_gnat_codes", _sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
