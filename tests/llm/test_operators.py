"""Small tests of the training-data operators: brute force, round trips and edge rows."""

import hashlib
import math
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import pytest

from palimpsest.llm import ann_collision, bpe_lexicon, fingerprint_lcp, langid, license_scan, lm_hmm, mixing, neardup, quality_gbt, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, label int"
WORDS = [f"{a}{b}{c}" for a, b, c in product(["tor", "bal", "min", "sel"], ["en", "ar", "ion"], ["d", "th", "x"])]


def prose(seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n)).capitalize() + "."


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, an empty and a long text, ties, repeated rows, columns with clashing names."""
    base = prose(1)
    near = base.rsplit(" ", 2)[0] + " other ending"
    texts = [(1, base), (2, base), (3, near), (4, prose(2)), (5, None), (6, ""), (None, prose(3)), (None, prose(3)), (9, prose(9, 20_000)),
             (10, "word"), (10, "word"), (11, "Released under the MIT License.\n" + prose(4)), (12, "BUY!! NOW!! " * 40)]
    rows = [(i, t, "en" if k % 3 else None, "src" if k % 4 else None, None, 0.5, "x", 1) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def near_brute(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        if a == b or (a | b and len(a & b) / len(a | b) >= 0.8):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def test_near_duplicates_match_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    want = Counter(near_brute([r.text for r in rows]))
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sorted(r.n_class for r in got) == sorted(n for n in want.values() for _ in range(n))
    by = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert by[1] == by[2] == by[3] == 1 and by[5] == by[6] == 5 and by[4] == 4


def test_near_duplicate_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(1, 2**62, 400).astype(np.uint64))
    x, y = (a[:300], np.ones(300, np.int64)), (a[60:360], np.ones(300, np.int64))
    s = neardup.signatures([(h, neardup.weights(c)) for h, c in (x, y)], 2048)
    assert abs(float((s[0] == s[1]).mean()) - neardup.similarity(x, y)[1]) < 0.05
    assert math.isclose(*neardup.similarity(x, y))


def test_neardup_stage_keeps_one_of_each(spark, docs):
    kept = neardup.stage_neardup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "4", "5", "9", "10", "11", "12", "None"])


def test_neardup_stage_keeps_one_of_null_and_equal_ids(spark):
    near = lambda k, end: prose(k, 80).rsplit(" ", 1)[0] + end
    rows = [(None, near(31, " one")), (None, near(31, " two")), (7, near(32, " one")), (7, near(32, " two")), (8, near(32, " three")),
            (None, near(33, " one")), (9, near(33, " two"))]
    kept = neardup.stage_neardup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["7", "9", "None"]


def test_near_duplicate_groups_are_bounded(spark, monkeypatch):
    """A family of texts just below the threshold: nearly all members are components of their own."""
    rng = np.random.default_rng(11)
    form, texts = prose(20, 160).split(), []
    for k in range(120):
        w = list(form)
        for i in rng.choice(160, 3, replace=False):
            w[i] = f"own{k}at{i}"
        texts.append(" ".join(w))
    texts += [t.rsplit(" ", 1)[0] + " end" for t in texts[:20]]
    sizes, plain = [], neardup.map_groups

    def seen(df, keys, fn, fields):
        sizes.append(df.groupBy(*keys).count().agg({"count": "max"}).first()[0] or 0)
        return plain(df, keys, fn, fields)

    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "map_groups", seen)
    got = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(near_brute(texts)))
    assert len({r.class_id for r in got}) > 60 and max(sizes) <= 5 * 8


def test_components_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in neardup.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == 100


def test_licence_scan(docs, spark):
    got = {r.doc_id: r for r in license_scan.scan(docs).collect() if r.doc_id in (11, 6, 1)}
    assert (got[11].n_base, got[11].first_word, got[11].base_labels, got[11].labels, got[11].score) == (1, 3, "mit", "mit,mit-notice", 1.0)
    assert (got[6].n_words, got[6].n_base, got[6].first_word, got[6].labels) == (0, 0, None, "")
    assert license_scan.scan(docs).count() == docs.count()
    gap = spark.createDataFrame([(1, "x CC  BY-NC 4.0; cc by, Permission is hereby granted free of charge to any nice person obtaining a copy of this software and associated documentation files")],
                                "doc_id long, text string")
    r = license_scan.scan(gap).first()
    assert (r.n_base, r.first_word, r.last_word, r.labels) == (2, 1, 6, "cc-by,mit-text")


def test_licence_notice_with_repeated_tail(spark):
    rows = [(1, "released under the mit license the mit license"), (None, "so released under the mit license the mit license"),
            (2, "released under the nice mit license the mit license"), (3, "the mit license the mit license")]
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == got[None] == ("mit,mit-notice", 1.0) and got[3] == ("mit", 1.0)


def test_bpe_round_trip(spark, docs):
    from tokenizers import Tokenizer

    spec = bpe_lexicon.vocabulary()
    tok = Tokenizer.from_str(spec)
    more = spark.createDataFrame([(50, "it's ΣΑΣ İ ﬁ é<|endoftext|>x <|start"), (51, "a" * 3000), (52, "日本語 ½ \x1c\x85 I'LL")], "doc_id long, text string")
    all_docs = docs.select("doc_id", "text").union(more)
    name = bpe_lexicon.build_lexicon(all_docs, spec, size=40)
    want = Counter()
    for r in all_docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[(r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(tuple(r) for r in bpe_lexicon.round_trip(all_docs, spec, name, ["doc_id"]).collect()) == want


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = sorted({w.encode() for w in WORDS})
    raw = bpe_lexicon.compile_lexicon([(w, [i, i + 1]) for i, w in enumerate(words)])
    (tmp_path / "x.fst").write_bytes(raw)
    lex = bpe_lexicon.Lexicon(str(tmp_path / "x.fst"))
    assert lex.find([*words, b"torend", b"to", b"", b"zz"]).tolist() == [*range(len(words)), words.index(b"torend"), -1, -1, -1]
    assert lex.ids(5) == [5, 6]
    assert len(lex.final) < 30  # shared suffixes: far fewer states than the 36 words' 200 letters


def test_language_model_base_and_exact_forward(docs):
    got = lm_hmm.score_texts(docs, lm_hmm.crc_fold(docs["doc_id"], 7) != 2).collect()
    rows = docs.select("doc_id", "text").collect()
    tokens = {k: [*lm_hmm.words_of(r.text or ""), "end"] for k, r in enumerate(rows)}
    train = [k for k, r in enumerate(rows) if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 != 2]
    c = Counter(t for k in train for t in tokens[k])
    n, v = sum(c.values()), len(c)
    want = sorted(round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens[k]), 4) for k in tokens)
    assert sorted(round(r.base_score, 4) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    rng = np.random.default_rng(3)
    m = lm_hmm.first_model(rng.random(6), states=2)
    seq = [rng.integers(0, 6, 5).astype(np.uint16), rng.integers(0, 6, 200).astype(np.uint16)]
    paths = sum(m.start[s0] * math.prod(m.move[a, b] * m.emit[b, o] for a, b, o in zip((s0, *p), p, seq[0], strict=False))
                for s0 in range(2) for p in product(range(2), repeat=5))
    log = lm_hmm.log_likelihoods(seq, m)
    assert math.isclose(log[0], math.log(paths), rel_tol=1e-9)
    state, plain = m.start, 0.0
    for o in seq[1]:
        state = (state @ m.move) * m.emit[:, o]
        plain += math.log(state.sum())
        state = state / state.sum()
    assert math.isclose(log[1], plain, rel_tol=1e-9)
    s, mv, e, total = lm_hmm.expected_counts(seq, m)
    assert math.isclose(e.sum(), 205) and math.isclose(mv.sum(), 205) and math.isclose(s.sum(), 2) and math.isclose(total, log.sum())


def test_baum_welch_improves(docs):
    seen = lm_hmm.train(lm_hmm.sequences(docs, lm_hmm.vocabulary(lm_hmm.word_counts(docs), docs.count()), ["doc_id"]),
                        np.ones(lm_hmm.CLASSES), rounds=3)[1]
    assert seen[0] < seen[1] < seen[2]


def test_nearest(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    x[7] = x[0] * 2
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (None, [1.0] * 16), (1004, [1.0, 2.0])]
    got = ann_collision.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 300, 50):
        s = y @ y[q]
        s[q] = -2
        hit += len({r.id for r in got if r.query_id == q} & set(np.argsort(-s)[:5].tolist()))
    assert hit >= 27 and {r.query_id for r in got} == set(range(0, 300, 50))
    assert [r.id for r in got if r.query_id == 0 and r["rank"] == 1] == [7]
    few = ann_collision.nearest(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
    assert few.count() == 2


def test_fingerprints(docs):
    got = fingerprint_lcp.neighbour_fingerprints(docs).collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    want = Counter()
    for k, (_, _, t) in enumerate(rows):
        e = fingerprint_lcp.edited(t, rows[(k + 1) % len(rows)][2])
        want[(len(t), hashlib.sha256(e.encode()).hexdigest())] += 1
    assert Counter((r.n_chars, r.edited_sha256) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1.0 and by[2].near_next > 0.6 and by[3].near_next < 0.4


def test_parsing_is_locally_consistent():
    t = prose(8, 400)
    a, b = fingerprint_lcp.fingerprints([t, "Something else stands before. " + t])
    assert fingerprint_lcp.likeness(a, b) > 0.7
    assert fingerprint_lcp.fingerprints([prose(1), t])[1][0] == a[0]


def test_quality(spark, docs):
    good = [(i, prose(i), 1) for i in range(100)]
    bad = [(200 + i, "!! ".join(prose(i).upper().split()), 0) for i in range(60)]
    labelled = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    forest = quality_gbt.train(labelled, labelled.select("doc_id", "quality"))
    got = quality_gbt.score(docs, forest)
    assert got.columns == [*docs.columns, "__score"] and got.count() == docs.count()
    s = {r.doc_id: r["__score"] for r in got.collect()}
    assert s[1] > 0.7 and 0 <= s[5] == s[6] <= 1
    new = spark.createDataFrame([(i, prose(500 + i)) for i in range(20)] + [(20 + i, "!! ".join(prose(600 + i).upper().split())) for i in range(20)],
                                "doc_id long, text string")
    held_out = {r.doc_id: r["__score"] for r in quality_gbt.score(new, forest).collect()}
    assert all((held_out[i] >= 0.7) == (i < 20) for i in range(40))
    assert quality_gbt.fit(np.zeros((0, len(quality_gbt.STATS))), np.zeros(0)).score(np.zeros((2, len(quality_gbt.STATS)))).tolist() == [0.5, 0.5]


def test_language(spark):
    en, fr = "the quick house of this nation and that other thing with them", "les maisons de cette nation et des autres choses avec elles aussi"
    train = spark.createDataFrame([(i, en if i % 2 else fr, "en" if i % 2 else "fr") for i in range(20)], "doc_id long, text string, lang string")
    model = langid.train_text_model(train)
    pages = spark.createDataFrame([
        (1, "http://a.example.fr/x", f"<html lang='en'><p>{fr}</p>"), (2, "http://b.example.com/", f"<html><body>{en}"),
        (3, "http://a.example.fr/y", "<html lang=fr>1234"), (4, None, None), (None, "nonsense", ""), (2, "http://b.example.com/", f"<html><body>{en}")],
        "page_id long, url string, html string")
    got = langid.identify_pages(pages, model).collect()
    by = {r.page_id: r.language for r in got}
    assert len(got) == 6 and (by[1], by[2], by[3], by[4], by[None]) == ("fr", "en", "fr", "und", "und")


def test_mixing_meets_marginals(spark):
    rows = [(i, "w " * (i % 7 + 1), ["en", "de"][i % 5 == 0], f"s{i % 3}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, ["doc_id"], budget=0.4).toPandas()
    cells = got.drop_duplicates(["__source", "__lang", "__topic"])
    tokens = got.groupby("__lang")["__tokens"].sum() ** mixing.TEMPER["lang"]
    share = cells.groupby("__lang")["__share"].sum()
    assert np.allclose(share, tokens / tokens.sum(), atol=1e-6) and math.isclose(cells["__share"].sum(), 1, rel_tol=1e-6)
    assert math.isclose((got["__p"] * got["__tokens"]).sum(), 0.4 * got["__tokens"].sum(), rel_tol=1e-6)
    assert got["__kept"].equals(got["__draw"] < got["__p"])


def test_mixing_reports_marginals_that_conflict(spark, caplog, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 3)
    rows = [("s0", "a", "prose", 900), ("s1", "b", "prose", 100)]
    cells = spark.createDataFrame(rows, "__source string, __lang string, __topic string, __tokens long")
    w = {r["__source"]: r["__w"] for r in mixing.rake(cells).collect()}
    said = [r.args for r in caplog.records if "marginals not met" in r.msg]
    goal = 900**0.5 / (900**0.5 + 100**0.5)
    assert len(said) == 1 and math.isclose(said[0][1]["source"], abs(w["s0"] - goal), rel_tol=1e-6) and said[0][1]["source"] > 0.01
    assert said[0][1]["topic"] < 1e-9


def test_mixing_edge_rows(spark, docs):
    assert mixing.mix(docs, ["doc_id"]).count() == docs.count()
    assert mixing.stage_mixing(spark, docs, "").columns == docs.columns


def test_warc_round_trip_and_assembly(spark, tmp_path):
    big = "é" * 800
    tricky = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30
    rows = [(1, "http://a/x", big), (2, None, big), (3, "http://b/\r\ny", big), (4, "u", None), (5, "u", "short"), (6, "u", "short"), (7, "u", tricky), (None, "u", big), (3, "http://b/\r\ny", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    got = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(got) == len(rows) and all(r.request and r.metadata for r in got)
    assert {bytes(r.capture.payload).decode() for r in got if r.capture.type == "response"} == {big, "", "short", tricky}
    kinds = Counter((r.metadata.fields["page-id"], r.capture.type) for r in got)
    assert kinds[("3", "response")] == 2 and kinds[("1", "revisit")] == kinds[("2", "revisit")] == kinds[("", "revisit")] == 1


def test_empty_tables(spark, docs):
    none = docs.where("false")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    spec = bpe_lexicon.vocabulary()
    assert neardup.near_duplicates(none).count() == 0
    assert license_scan.scan(none).count() == 0
    assert fingerprint_lcp.neighbour_fingerprints(none).count() == 0
    assert mixing.mix(none, ["doc_id"]).count() == 0
    assert bpe_lexicon.round_trip(none, spec, bpe_lexicon.build_lexicon(none, spec), ["doc_id"]).count() == 0
    assert lm_hmm.score_texts(none, lm_hmm.crc_fold(none["doc_id"], 7) != 2).count() == 0
    assert langid.identify_pages(pages, langid.train_text_model(none)).count() == 0
    assert quality_gbt.score(none, quality_gbt.train(none, none.selectExpr("doc_id", "label as quality"))).count() == 0
    from pyspark.sql import functions as F
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann_collision.nearest(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_another_vocabulary_file_goes_through_its_library(spark, docs):
    import json

    from tokenizers import Tokenizer

    spec = json.loads(bpe_lexicon.vocabulary())
    spec["normalizer"] = None
    spec = json.dumps(spec)
    library = Tokenizer.from_str(spec)
    rows = docs.select("doc_id", "text").collect()
    got = bpe_lexicon.round_trip(docs, spec, bpe_lexicon.build_lexicon(docs, spec), ["doc_id"]).collect()
    ids = [library.encode(r.text or "", add_special_tokens=False).ids for r in rows]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in got) == Counter(
        (r.doc_id, len(i), sha(" ".join(map(str, i)))) for r, i in zip(rows, ids, strict=True))


def test_ascii_words_are_split_like_all_others():
    import random

    rnd = random.Random(4)
    bpe = bpe_lexicon.Bpe(bpe_lexicon.vocabulary())
    for _ in range(300):
        t = "".join(chr(rnd.randrange(128)) for _ in range(60)).lower()
        assert bpe_lexicon.ASCII_PIECE.findall(t) == bpe.piece.findall(t)
