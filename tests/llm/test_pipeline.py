"""The corpus pipeline as a whole and its stages on edge rows."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import neardup, quality_gbt

WORDS = ["tower", "river", "garden", "window", "market", "silver", "winter", "letter", "summer", "bridge", "candle", "forest"]


def prose(seed, n=80):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n)).capitalize() + "."


CLASH = ["__score", "score", "__key", "row", "__row", "survivor", "__source", "__p", "extra", "node", "sig", "stats"]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(1, prose(1)), (2, prose(1)), (3, prose(1).rsplit(" ", 2)[0] + " other end"), (4, prose(4)), (5, None), (None, prose(6)), (None, prose(6)), (8, "")]
    rows = [(i, t, "en", "src", None, *[f"{c}{k}" for c in CLASH]) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))


@pytest.mark.parametrize("name", ["quality", "language", "near_duplicates", "mixing"])
def test_stages_pass_clashing_columns(spark, sf, docs, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf)
    assert out.columns == docs.columns
    given = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in out.collect()} <= given


def test_one_document_of_each_class_stays(spark, sf, docs):
    out = neardup.stage_neardup(spark, docs, sf).collect()
    texts = [r.text for r in out]
    assert sorted((r.doc_id or 0) for r in out) == [0, 1, 4, 5] and texts.count(prose(6)) == 1


def test_stages_of_an_empty_table(spark, sf, docs):
    none = docs.where(F.lit(False))
    for name, fn in corpus_pipeline.STAGES:
        none_left = fn(spark, none, sf)
        assert none_left.count() == 0, name


def test_run_gives_the_stages_one_after_the_other(spark, sf):
    """Each stage's rows are among those that it was given, and the last are those of ``run``."""
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    left = rows.count()
    for name, fn in corpus_pipeline.STAGES[:-1]:
        new = fn(spark, rows, sf)
        found = new.collect()
        assert new.columns == rows.columns and not Counter(map(tuple, found)) - Counter(map(tuple, rows.collect())), name
        rows = spark.createDataFrame(found, rows.schema)
        assert 0 < rows.count() <= left, name
        left = rows.count()
    last = dict(corpus_pipeline.STAGES)["tokens"](spark, rows, sf)
    key = lambda df: sorted((r.doc_id, tuple(r.ids)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf)) == key(last)


def test_training_rows_are_bounded_where_ids_repeat(spark):
    docs = spark.createDataFrame([(1, prose(i)) for i in range(2000)] + [(2, prose(1))] * 2000, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    fit = quality_gbt.document_stats
    quality_gbt.document_stats = lambda df, keep: seen.append(df.count()) or fit(df, keep)
    try:
        quality_gbt.train(docs, labels, max_train_rows=100)
    finally:
        quality_gbt.document_stats = fit
    assert seen[0] < 200


def test_links_are_exactly_those_of_the_definition(spark):
    """Texts with heavy repetition: equal shingle sets in different numbers, links worked out pair by pair."""
    texts = []
    for k in range(30):
        words = [f"w{k}x{i}" for i in range(200)]
        texts.append(" ".join(words))
        texts.append(" ".join(words[:70] * (1 + 2 * (k % 15)) + words))
    memo = neardup._Words()
    sets = [neardup.shingles(neardup.words_of(t), memo) for t in texts]
    linked = {(i, i + 1) for i in range(0, len(texts), 2) if neardup.similarity(sets[i], sets[i + 1])[1] >= 0.8}
    rows = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by = {r.doc_id: r.class_id for r in rows}
    got = {(i, i + 1) for i in range(0, len(texts), 2) if by[i] == by[i + 1]}
    assert got == linked and 0 < len(linked) < 30 and all(by[i] in (i, i - 1) for i in by)
