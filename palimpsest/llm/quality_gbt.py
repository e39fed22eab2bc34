"""Operator 10, quality classifier: histogram gradient-boosted trees over
document statistics, flattened into arrays for vectorised traversal.

``document_stats`` turns whole texts into a fixed set of numbers;
``fit`` bins each number at its training quantiles and grows depth-wise
trees on per-bin gradient sums; ``Forest`` keeps every tree as flat arrays
(feature, bin threshold, children, leaf value) which ``score`` walks for a
whole batch at once.

The fit runs on a bounded sample of labelled rows (``max_train_rows``,
chosen by a hash of the id, so the choice is the same at any partitioning);
statistics are computed by Spark tasks for those rows only, and only the
numbers (about 25 doubles a row) reach the driver.  Scoring covers every row.

Defined cases: null text counts as empty; empty texts get a score from their
(all zero) statistics; null or repeated ids keep one result per input row;
rows of ``labels`` that repeat an id count by their mean label; with no
labelled rows, or one class only, the score is the smoothed share of label 1
(0.5 for none); very long texts are read whole; other columns, whatever
their names, are left out.
"""

from __future__ import annotations

import pickle
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, extras_aside, map_text, query, stage, table

MAX_TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

STATS = (
    "log_chars", "log_words", "mean_word", "long_words", "distinct_words", "top_word", "upper", "lower", "digit",
    "space", "ascii_punct", "other_ascii", "non_ascii", "bang", "pipe", "sentence_ends", "lines", "mean_line",
    "repeated_lines", "repeated_line_chars", "repeated_trigrams", "compressed", "upper_words", "word_entropy",
    "char_entropy",
)

_CLASS = np.zeros(256, np.uint8)  # 0 non-ASCII, 1 upper, 2 lower, 3 digit, 4 space, 5 punctuation, 6 other ASCII
_CLASS[:128] = 6
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = 5
_UPPER_WORD = re.compile(r"\b[A-Z]{2,}\b")


def _entropy(counts: np.ndarray) -> float:
    p = counts[counts > 0] / counts.sum()
    return float(-(p * np.log2(p)).sum())


def stats_of(text: str) -> np.ndarray:
    """The statistics of one whole text; all zero for an empty one."""
    out = np.zeros(len(STATS))
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kind = np.bincount(_CLASS, weights=by_byte, minlength=7)
    n = len(raw)
    words = text.split()
    nw = max(1, len(words))
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    counts = np.fromiter(seen.values(), np.int64, len(seen)) if seen else np.ones(1, np.int64)
    lines = [x for x in text.split("\n") if x.strip()]
    nl = max(1, len(lines))
    once = set(lines)
    tri = len(set(zip(words, words[1:], words[2:], strict=False)))
    out[:] = (
        np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / nw, sum(len(w) > 14 for w in words) / nw,
        len(seen) / nw, counts.max() / nw, kind[1] / n, kind[2] / n, kind[3] / n, kind[4] / n, kind[5] / n,
        kind[6] / n, kind[0] / n, by_byte[33] / n, by_byte[124] / n,
        (by_byte[46] + by_byte[33] + by_byte[63]) / nw, np.log1p(len(lines)), len(text) / nl,
        1 - len(once) / nl, 1 - sum(map(len, once)) / max(1, sum(map(len, lines))),
        1 - tri / max(1, len(words) - 2) if len(words) > 2 else 0.0, len(zlib.compress(raw, 1)) / n,
        len(_UPPER_WORD.findall(text)) / nw, _entropy(counts), _entropy(by_byte),
    )
    return out


@dataclass
class Forest:
    """Trees as flat arrays, concatenated; children are absolute indexes and
    a leaf points to itself, so ``depth`` steps settle every row."""

    edges: list[np.ndarray]  # per feature: bin edges
    feature: np.ndarray
    split: np.ndarray  # go left while bin <= split
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1) if self.edges else np.zeros((len(x), 0), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        if len(self.roots):
            b = self.bins(x)
            rows = np.arange(len(x))[:, None]
            at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
            for _ in range(self.depth):
                at = np.where(b[rows, self.feature[at]] <= self.split[at], self.left[at], self.right[at])
            margin = margin + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 48, rate: float = 0.15,
        ridge: float = 2.0, least: int = 10) -> Forest:
    """Second-order boosting of the logistic loss on binned features."""
    n, base = len(y), (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(base / (1 - base)))
    empty = np.zeros(0, int)
    if n < 2 * least or y.min() == y.max():
        return Forest([], empty, empty, empty, empty, np.zeros(0), empty, 0, base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    f = Forest(edges, empty, empty, empty, empty, np.zeros(0), empty, depth, base)
    b = f.bins(x)
    width, k = bins + 1, x.shape[1]
    cell = b + np.arange(k) * width  # one histogram slot for each feature and bin
    margin = np.full(n, base)
    feature, split, left, right, value, roots = [], [], [], [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)

        def grow(rows: np.ndarray, level: int) -> int:
            me = len(feature)
            gs, hs = g[rows].sum(), h[rows].sum()
            for a, v in ((feature, 0), (split, width), (left, me), (right, me), (value, -rate * gs / (hs + ridge))):
                a.append(v)
            if level < depth and len(rows) >= 2 * least:
                slot = cell[rows].ravel()
                gh = np.bincount(slot, np.repeat(g[rows], k), k * width).reshape(k, width).cumsum(1)
                hh = np.bincount(slot, np.repeat(h[rows], k), k * width).reshape(k, width).cumsum(1)
                nn = np.bincount(slot, minlength=k * width).reshape(k, width).cumsum(1)
                gain = gh**2 / (hh + ridge) + (gs - gh) ** 2 / (hs - hh + ridge) - gs**2 / (hs + ridge)
                gain[(nn < least) | (len(rows) - nn < least)] = -1
                j, s = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[j, s] > 1e-6:
                    go = b[rows, j] <= s
                    feature[me], split[me] = int(j), int(s)
                    left[me] = grow(rows[go], level + 1)
                    right[me] = grow(rows[~go], level + 1)
                    return me
            margin[rows] += value[me]
            return me

        roots.append(grow(np.arange(n), 0))
    arr = lambda a: np.asarray(a, np.int64)
    v = np.asarray(value)
    v[arr(left) != np.arange(len(v))] = 0.0
    return Forest(edges, arr(feature), arr(split), arr(left), arr(right), v, arr(roots), depth, base)


def document_stats(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``stats`` (array of doubles) of the whole text."""
    return map_text(docs, keep, lambda texts: {"stats": [stats_of(t) for t in texts]}, "stats array<double>", text_col)


def train(docs: DataFrame, labels: DataFrame, in_fold: Column | None = None,
          max_train_rows: int = MAX_TRAIN_ROWS) -> Forest:
    """Fit on at most about ``max_train_rows`` labelled documents.

    The sample is by id hash, and, where ids repeat, by row hash as well, equal
    rows once; its numbers meet in one task, so the bound is that task's memory."""
    lab = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg(F.avg("quality").alias("__y")))
    if in_fold is not None:
        lab = lab.where(in_fold)
    share = lambda n: F.lit(int(max_train_rows / max(n, max_train_rows, 1) * (1 << 20)))
    part = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 20))
    lab = lab.where(part("doc_id") < share(lab.count()))
    # at most about max_train_rows ids of 16 bytes: a bounded table, staged so that the planner sees its size
    one = F.broadcast(stage(lab, "quality-labels"))
    found = docs.select("doc_id").join(one, "doc_id").agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    rows = docs.select("doc_id", "text").join(one, "doc_id")
    if found[0] > found[1]:
        rows = rows.where(part("doc_id", F.coalesce("text", F.lit("")), F.lit(1)) < share(found[0])).dropDuplicates(["doc_id", "text"])
    stats = document_stats(rows.select("__y", "text"), ["__y"])

    def run(batches):
        import pyarrow as pa

        y, x = [np.zeros(0)], [np.zeros((0, len(STATS)))]
        for rb in batches:
            y.append(rb.column(0).to_numpy(zero_copy_only=False))
            x.append(rb.column(1).flatten().to_numpy().reshape(-1, len(STATS)))
        x, y = np.concatenate(x), np.concatenate(y)
        order = np.lexsort(x.T)  # the fit doesn't depend on the order of arrival
        forest = fit(x[order], (y[order] >= 0.5).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(forest)], pa.binary())], names=["forest"])

    # computed by all tasks, then gathered in one, away from the driver's memory
    return pickle.loads(stage(stats, "quality-sample").coalesce(1).mapInArrow(run, "forest binary").first()["forest"])


def score(docs: DataFrame, forest: Forest, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus ``__score`` for every row."""
    def run(texts):
        return {"__score": forest.score(np.array([stats_of(t) for t in texts]))}

    return map_text(docs, docs.columns if keep is None else keep, run, "__score double", text_col)


@query("op10_quality_gbt")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = train(docs, table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    s = F.col("__score")
    return score(docs, forest, keep=["doc_id"]).select(
        "doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), s.alias("score"),
        (s >= THRESHOLD).cast("int").alias("predicted"))


@extras_aside
def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored under the threshold go."""
    forest = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return score(docs, forest).where(F.col("__score") >= THRESHOLD).drop("__score")
