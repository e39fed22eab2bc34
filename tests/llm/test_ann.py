"""Collision counting: recall against brute force, share of vectors verified, several blocks, ties and repeats."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import ann_collision as A

VEC = "vec_id long, embedding array<double>"


def brute(rows, k=5, every=50):
    out = {}
    for i, q in rows:
        if i % every == 0:
            q = np.array(q)
            s = [(-float((np.array(v) * q).sum() / (np.linalg.norm(v) * np.linalg.norm(q))), j) for j, v in rows if j != i and len(v) == len(q)]
            out[i] = sorted(s)[:k]
    return out


@pytest.mark.parametrize("block", [32_768, 400])
def test_many_blocks_and_a_small_sample(spark, monkeypatch, block):
    monkeypatch.setattr(A, "SAMPLE", 200)
    monkeypatch.setattr(A, "BLOCK", block)
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((30, 24))
    x = centre[rng.integers(0, 30, 1500)] + 0.4 * rng.standard_normal((1500, 24))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(2000 + j, [1.0, float(j)]) for j in range(3)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (50, rows[50][1])]
    got = A.nearest(spark.createDataFrame(rows, VEC).repartition(5), F.col("vec_id") % 50 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((round(r.score, 9), r.id))
    want = brute(rows)
    assert set(by) == set(want) and len(by[2000]) == 2 and all(len(by[q]) == 5 for q in by if q < 2000)
    hit = sum(len((Counter((round(-s, 9), j) for s, j in w) & Counter(by[q]))) for q, w in want.items())
    assert hit >= 0.95 * sum(map(len, want.values()))


@pytest.mark.parametrize("spread", [0.35, None])
def test_few_vectors_are_verified(spread):
    """Clustered vectors and unstructured ones: recall of 0.9 or more with under a fifth of all pairs verified."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 64)) if spread is None else rng.standard_normal((60, 64))[rng.integers(0, 60, 6000)] + spread * rng.standard_normal((6000, 64))
    ids, queries = np.arange(6000), range(0, 6000, 150)
    sample, whole = A.Arrays(ids[:A.SAMPLE], x[:A.SAMPLE]), A.Arrays(ids, x)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in queries:
        near, score = sample.grow(q, x[q], 5)
        low, high = whole.windows((u[q] @ whole.axes)[None], A.half_window(np.array([A.radius_of(score, 5)]), 64))
        found, _ = whole.within(q, x[q], low[:, 0], high[:, 0], near, 5)
        c = u @ u[q]
        c[q] = -2
        hit += len(set(found.tolist()) & set(np.argsort(-c)[:5].tolist()))
    assert hit >= 0.9 * 5 * len(queries)
    assert whole.verified < 0.2 * len(queries) * 6000 and sample.verified < 0.25 * len(queries) * A.SAMPLE


def test_given_vectors(spark):
    """Recall and share verified on the given table, which the sample holds whole."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    arrays = A.Arrays(np.array([i for i, _ in rows]), np.array([v for _, v in rows], float))
    hit = total = 0
    for i, want in brute(rows).items():
        found, _ = arrays.grow(i, np.array(dict(rows)[i], float), 5)
        hit += len(set(found.tolist()) & {j for _, j in want})
        total += 5
    share = arrays.verified / (len(rows) * total / 5)
    print("share verified", share, "recall", hit / total)
    assert hit >= 0.9 * total and share < 0.2
