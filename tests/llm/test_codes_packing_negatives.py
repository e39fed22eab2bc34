"""Codebook trees, best-fit packing and hard negatives against plain versions, with edge rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.llm import gnat_codes, hard_negatives, packing

VEC = "vec_id long, embedding array<float>, label int, id long, x string, k int, anchor string, rank int"


def vectors(n=150, dim=8, seed=5):
    """Clusters, ties (whole-number components), copies, rows that take no part, clashing columns."""
    rng = np.random.default_rng(seed)
    centre = rng.integers(-3, 4, (6, dim))
    rows = [(i, [float(c) for c in centre[i % 6] + rng.integers(-1, 2, dim) / 4], i % 4, 7, "x", 1, "a", 2) for i in range(n)]
    rows += [rows[10], rows[50], rows[50]]
    ok = [1.0] * dim
    rows += [(1001, None, 1, *rows[0][3:]), (1050, [float("nan")] + ok[1:], 1, *rows[0][3:]), (1100, [float("inf")] + ok[1:], 1, *rows[0][3:]),
             (1150, [None] + ok[1:], 1, *rows[0][3:]), (1200, ok, None, *rows[0][3:]), (None, ok, 2, *rows[0][3:]), (1250, [0.0] * dim, 3, *rows[0][3:]),
             (1300, ok + ok, 2, *rows[0][3:])]
    return rows


# --- codes

@settings(max_examples=40, deadline=None)
@given(st.integers(1, 60), st.integers(1, 3), st.integers(0, 6), st.integers(0, 10**6))
def test_tree_finds_the_nearest_entry_and_the_lowest_of_ties(k, width, spread, seed):
    rng = np.random.default_rng(seed)
    entries, q = rng.integers(-spread, spread + 1, (k, width)), rng.integers(-spread - 2, spread + 3, (40, width))
    d2 = ((q[:, None] - entries[None]) ** 2).sum(-1)
    index, error = gnat_codes.Gnat(entries, fan=3, leaf=3).nearest(q)
    assert (index == d2.argmin(1)).all() and (error == d2.min(1)).all()


def test_tree_with_large_components_is_exact():
    rng = np.random.default_rng(1)
    far = gnat_codes.LIMIT
    entries = far - rng.integers(0, 3, (100, 16))
    q = np.concatenate([far - rng.integers(0, 4, (50, 16)), -far + rng.integers(0, 4, (50, 16))])
    d2 = ((q[:, None] - entries[None]) ** 2).sum(-1)
    index, error = gnat_codes.Gnat(entries).nearest(q)
    assert (index == d2.argmin(1)).all() and (error == d2.min(1)).all()


def test_tree_leaves_out_subtrees():
    rng = np.random.default_rng(2)
    centre = rng.normal(0, 2000, (24, 16))
    draw = lambda n: np.floor(centre[rng.integers(0, 24, n)] + rng.normal(0, 200, (n, 16))).astype(np.int64)
    tree, q = gnat_codes.Gnat(draw(256)), draw(2000)
    tree.nearest(q)
    assert tree.compared < 0.5 * 256 * len(q)


def plain_codes(rows, entries, parts=4, rounds=4, scale=1024):
    kept = sorted(((i, tuple(np.floor(np.array(v, np.float64) * scale).astype(int).tolist()), lab) for i, v, lab, *_ in rows
                   if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)), key=lambda r: r[:2])
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    x = np.array([r[1] for r in kept]).reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]

    def assign(p):
        d2 = ((x[:, p][:, None] - books[p][None]) ** 2).sum(-1)
        return d2.argmin(1), d2.min(1)

    for _ in range(rounds):
        for p in range(parts):
            index, _ = assign(p)
            for e in set(index.tolist()):
                books[p][e] = x[index == e, p].sum(0) // (index == e).sum()
    found = [assign(p) for p in range(parts)]
    error = sum(d for _, d in found)
    by = Counter()
    for r, e in zip(kept, error.tolist()):
        by[r[2]] += e
    return Counter((r[0], "".join(f"{i[j]:02x}" for i, _ in found), int(error[j]), by[r[2]]) for j, r in enumerate(kept)), books


@pytest.mark.parametrize("entries", [20, 256])
def test_codes_match_a_plain_version(spark, entries):
    rows = vectors()
    coded, books = gnat_codes.compress(spark.createDataFrame(rows, VEC).repartition(5), entries=entries)
    got = Counter((r.id, r.code, r.error, r.label_error) for r in gnat_codes.with_label_error(coded).collect())
    want, plain = plain_codes(rows, entries)
    assert got == want
    assert all((a == b).all() for a, b in zip(books, plain, strict=True))
    assert gnat_codes.digest(books) == hashlib.sha256(",".join(str(c) for b in plain for c in b.ravel().tolist()).encode()).hexdigest()


def test_label_errors_of_rare_and_frequent_labels(spark):
    rows = [(i, None if i % 3 == 0 else i % 3 if i % 50 else 1000 + i, "00", i) for i in range(3000)]
    got = gnat_codes.with_label_error(spark.createDataFrame(rows, "id long, label int, code string, error long")).collect()
    by = Counter()
    for _, lab, _, e in rows:
        by[lab] += e
    assert len(got) == len(rows) and all(r.label_error == by[r.label] for r in got)


def test_codes_of_an_empty_table(spark):
    coded, books = gnat_codes.compress(spark.createDataFrame([], VEC))
    assert gnat_codes.with_label_error(coded).collect() == [] and gnat_codes.digest(books) == hashlib.sha256(b"").hexdigest()


# --- packing

DOC = "doc_id long, text string, piece string, length string, sequence_id long"


def text(seed, n):
    return " ".join(np.random.default_rng(seed).choice(["alpha", "Été", "42", "<|endoftext|>", "don't", "\n\n", "語", "x" * 30], n))


def test_ids_are_the_librarys(spark):
    from tokenizers import Tokenizer

    spec = packing.vocabulary()
    library = Tokenizer.from_str(spec)
    rng = np.random.default_rng(0)
    samples = ["", " ", "a" * 5000, *(text(i, 200) for i in range(20))]
    samples += ["".join(chr(c) for c in rng.integers(1, 0x3000, 300)) for _ in range(40)]
    quick = packing.encoder(spec)
    assert all(quick(s).tolist() == library.encode(s, add_special_tokens=False).ids for s in samples)
    import public_tokenizers

    other = packing.vocabulary(public_tokenizers.path("word_bpe_49k.json"))  # not a byte-level file: run by its own library
    assert packing.encoder(other)("Hello World").tolist() == Tokenizer.from_str(other).encode("Hello World", add_special_tokens=False).ids


def test_pieces_and_sequences_are_whole(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(packing.vocabulary())
    texts = [(1, text(1, 2000)), (2, None), (3, ""), (None, "word"), (None, "word"), (6, text(6, 300)), (7, text(7, 100)), (7, text(7, 100))]
    texts += [(100 + i, text(i, int(n))) for i, n in enumerate(np.random.default_rng(3).integers(1, 250, 150))]
    docs = spark.createDataFrame([(i, t, "p", "l", 5) for i, t in texts], DOC).repartition(6)
    spec, capacity = packing.vocabulary(), 128
    pieces = packing.encode_pieces(docs, spec, capacity=capacity)
    placed = packing.place(pieces, capacity)
    rows = placed.collect()
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, packing.END]
    want = Counter()
    for i, t in texts:
        n = ids(t)
        cuts = list(range(len(n), 0, -capacity))[::-1]
        for k, hi in enumerate(cuts):
            lo = cuts[k - 1] if k else 0
            want[(i, k, lo, hi - lo, np.array(n[lo:hi], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= plain_best_fit([r.length for r in rows], capacity)
    got = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed).collect()}
    assert got == {s: b"".join(bytes(r.ids) for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset)) for s in bins}


def plain_best_fit(lengths, capacity):
    gaps = []
    for s in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40), max_size=24))
def test_runs_seat_every_piece_once_and_need_no_more_than_best_fit(histogram):
    capacity = 24
    runs, opened = packing.plan(histogram, capacity)
    length = np.array([s for s, n in histogram.items() for _ in range(n)], np.int64)
    number = np.array([k for n in histogram.values() for k in range(n)], np.int64)
    if not len(length):
        assert opened == 0
        return
    sequence, offset = packing.locate(runs, length, number)
    assert set(sequence.tolist()) == set(range(opened))
    at = Counter()
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist())):
        assert o == at[s]
        at[s] += n
    assert max(at.values()) <= capacity
    assert -(-int(length.sum()) // capacity) <= opened <= plain_best_fit(length.tolist(), capacity) + 1


def test_packing_of_an_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], DOC)
    assert packing.place(packing.encode_pieces(docs, packing.vocabulary())).collect() == []
    with pytest.raises(ValueError):
        packing.encode_pieces(docs, packing.vocabulary(), keep=("doc_id", "piece"))
    with pytest.raises(ValueError):
        packing.place(docs)


def test_packing_query_gives_digests(spark, sf):
    rows = packing.op12(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    quick = packing.encoder(packing.vocabulary())
    for r in rows[:100]:
        ids = np.append(quick(docs[r.doc_id] or ""), 2).astype("<u4")[r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and len(ids) == r.length
    assert {r.doc_id for r in rows} == set(docs)
    assert len({r.sequence_id for r in rows}) <= plain_best_fit([r.length for r in rows], 1024)


# --- hard negatives

@settings(max_examples=30, deadline=None)
@given(st.integers(1, 40), st.integers(0, 20), st.integers(1, 40), st.integers(0, 10**6))
def test_strassen_is_exact(m, k, n, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-2**29, 2**29, (m, k)), rng.integers(-2**29, 2**29, (k, n))
    assert (hard_negatives.strassen(a, b, leaf=3) == a @ b).all()


def plain_negatives(rows, every):
    kept = [(i, lab, np.floor(np.array(v, np.float64) * 256).astype(int)) for i, v, lab, *_ in rows
            if i is not None and lab is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out, seen = Counter(), set()
    for i, lab, x in kept:
        if i % every or (i, lab, tuple(x)) in seen:
            continue
        seen.add((i, lab, tuple(x)))
        other = [(-int(x @ y), j, m) for j, m, y in kept if j != i and len(y) == len(x)]
        for s, p, _ in sorted(o for o in other if o[2] == lab)[:5]:
            fits = [(n, q) for n, q, m in other if m != lab and 50 * -s <= 100 * -n <= 95 * -s]
            for r, (n, q) in enumerate(sorted(fits)[:3], 1):
                out[(i, p, r, q, -s, -n)] += 1
    return out


@pytest.mark.parametrize("block, tile, lot", [(32_768, 2_048, 256), (16, 5, 3)])
def test_negatives_match_a_plain_version(spark, monkeypatch, block, tile, lot):
    """Many blocks, tiles and lots; ties, repeated rows and other lengths."""
    for name, value in (("BLOCK", block), ("TILE", tile), ("LOT", lot)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(220)
    got = hard_negatives.mine(spark.createDataFrame(rows, VEC).repartition(4), F.col("id") % 10 == 0).collect()
    assert Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got) == plain_negatives(rows, 10)
    assert got


def test_negatives_of_an_empty_table(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VEC), F.col("id") % 50 == 0).collect() == []
