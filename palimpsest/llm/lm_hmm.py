"""Operator 7, language-model scoring with a hidden Markov model.

Words are emitted in two steps: a latent state emits a *class*, the class its
word.  The ``OWN`` most frequent training words (and the end of a text) are
classes of their own; all other words fall into ``SHARED`` classes by a hash
and are emitted in proportion to (count + 1), with one share for unseen words.
So the emission table has a fixed size while the word counts, which follow the
corpus, stay in a Spark table that is never broadcast or collected.

* Counts: native, over all training texts.
* Sequences: one pass turns each text into its classes (2 bytes a word) and
  the part of its score that frequent words (``FREQUENT`` of them, a bounded
  broadcast) decide; rare words are joined to the counts by shuffle.
* Training: in each Baum-Welch round every partition sums its expected counts,
  Spark adds them up cell by cell, and the driver normalises one small table.
* Scoring: the exact forward recursion, scaled at each step.  Long texts are
  cut into segments whose transfer matrices are multiplied in parallel, which
  is the same product.

The score is the log10 probability of the whole text, its end included.

Defined cases: null text counts as empty: its only token is the end; a null id
counts as id '' for the fold; repeated rows each get a result; words of any
length; without training texts counts are 0, classes are uniform, and the
scores those of that model; ties among the most frequent words go by the word;
an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, map_text, most_frequent, query, slices, stage, table, text_or_empty

FOLDS, HELD_OUT = 7, 2
OWN, SHARED, FREQUENT = 2048, 1024, 131_072
STATES, ROUNDS = 4, 4
STAY = 0.9          # chance to stay in a state, at the start
SEGMENT = 64
TOKENS = 200_000    # words worked on at a time
EPSILON = 0.1       # added to every class, spread as the classes' frequencies, in each round
SEED = 7

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = OWN + SHARED  # class of the end token
CLASSES = END + 1


def words_of(text: str) -> list[bytes]:
    # bytes.lower and bytes.split know A-Z and the six ASCII spaces only
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, c) over all texts."""
    words = F.regexp_extract_all(F.translate(text_or_empty(text_col), UPPER, LOWER), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.select(F.explode(words).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c")).select(F.col("w").cast("binary").alias("word"), "c")


def shared_class(word: bytes) -> int:
    return OWN + (xxhash.xxh64_intdigest(word, seed=42) & (SHARED - 1))


@dataclass
class Vocabulary:
    """Bounded facts about the training words."""

    frequent: dict[bytes, tuple[int, float]]  # word -> (class, log10(count + 1))
    class_log: np.ndarray   # log10 of (count + distinct + 1) of a shared class, 0 for the others
    class_count: np.ndarray
    tokens: int
    distinct: int
    end_count: int


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """``counts`` as staged by ``word_counts``; ``texts``: training texts."""
    top = most_frequent(counts, "word", "c", FREQUENT).toArrow()
    ranked = sorted(zip(top.column(1).to_pylist(), top.column(0).to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    words, c = [w for _, w in ranked], [n for n, _ in ranked]
    frequent = {w: (i if i < OWN else shared_class(w), float(np.log10(n + 1))) for i, (w, n) in enumerate(zip(words, c, strict=True))}
    own = [w for w, (k, _) in frequent.items() if k < OWN]
    lot = F.lit(OWN) + F.xxhash64(F.col("word").cast("string")).bitwiseAND(F.lit(SHARED - 1))
    by_class = counts.groupBy(lot.alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # SHARED rows
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class:
        n[r["k"]], v[r["k"]] = r["n"], r["v"]
    tokens, distinct = int(n.sum()) + texts, int(v.sum()) + (texts > 0)
    for i, w in enumerate(own):  # they aren't in a shared class
        n[shared_class(w)] -= c[i]
        v[shared_class(w)] -= 1
    class_log = np.where((np.arange(CLASSES) >= OWN) & (np.arange(CLASSES) < END), np.log10(n + v + 1), 0.0)
    n[:len(own)], n[END] = c[:len(own)], texts
    return Vocabulary(frequent, class_log, n, tokens, distinct, texts)


SEQUENCE = ("n_tokens long, classes binary, known long, base_sum double, class_sum double, "
            "rare array<struct<word: binary, tf: int, k: int>>")


def sequences(docs: DataFrame, vocab: Vocabulary, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` plus ``SEQUENCE``: classes of all tokens, what frequent words
    add to the two scores, and the rare words with their occurrences."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)  # FREQUENT words and CLASSES numbers

    def run(texts):
        v = sent.value
        get, memo = v.frequent.get, {}
        end = float(np.log10(v.end_count + 1))
        out: dict[str, list] = {f: [] for f in ("n_tokens", "classes", "known", "base_sum", "class_sum", "rare")}
        for t in texts:
            words = words_of(t)
            hit = [get(w) for w in words]
            rare: dict[bytes, int] = {}
            classes = np.empty(len(words) + 1, np.uint16)
            known, base, within = int(v.end_count > 0), end, 0.0
            for i, h in enumerate(hit):
                if h is not None:
                    k, x = h
                    known += 1
                    base += x
                    if k >= OWN:
                        within += x
                    classes[i] = k
                else:
                    w = words[i]
                    if w in rare:
                        rare[w] += 1
                    else:
                        rare[w] = 1
                    k = memo.get(w)
                    if k is None:
                        k = memo[w] = shared_class(w)
                    classes[i] = k
            classes[-1] = END
            out["n_tokens"].append(len(classes))
            out["classes"].append(classes.tobytes())
            out["known"].append(known)
            out["base_sum"].append(base)
            out["class_sum"].append(within - float(v.class_log[classes].sum()))
            out["rare"].append([{"word": w, "tf": n, "k": memo[w]} for w, n in rare.items()])
        return out

    return map_text(docs, keep, run, SEQUENCE, text_col)


@dataclass
class Hmm:
    start: np.ndarray   # states before the first token
    move: np.ndarray    # state to state
    emit: np.ndarray    # state to class


def first_model(class_count: np.ndarray, states: int = STATES) -> Hmm:
    rng = np.random.default_rng(SEED)
    p = (class_count + EPSILON) / (class_count + EPSILON).sum()
    emit = p * np.exp(0.5 * rng.standard_normal((states, len(p))))
    emit /= emit.sum(1, keepdims=True)
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return Hmm(np.full(states, 1 / states), move, emit)


class _Segments:
    """Tokens of several texts in segments of at most ``SEGMENT``, longest
    first, so that step t works on the first ``active[t]`` segments."""

    def __init__(self, texts: list[np.ndarray]):
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        self.tokens = np.concatenate(texts).astype(np.int64)
        per = -(-n // SEGMENT)
        self.text = np.repeat(np.arange(len(texts)), per)
        self.nth = np.arange(len(self.text)) - np.repeat(np.cumsum(per) - per, per)
        begin = np.repeat(np.cumsum(n) - n, per) + self.nth * SEGMENT
        size = np.minimum(SEGMENT, np.repeat(n, per) - self.nth * SEGMENT)
        order = np.argsort(-size, kind="stable")
        self.text, self.nth, self.begin, self.size = self.text[order], self.nth[order], begin[order], size[order]
        self.active = [int((self.size > t).sum()) for t in range(int(self.size.max()))]
        self.rounds = [np.flatnonzero(self.nth == j) for j in range(int(per.max()))]  # each text's j-th segment

    def at(self, t: int) -> np.ndarray:
        return self.tokens[self.begin[:self.active[t]] + t]


def _transfer(seg: _Segments, m: Hmm) -> tuple[np.ndarray, np.ndarray]:
    """Product of (move x emission) over each segment, and the log of its scale."""
    k = len(m.start)
    t = np.broadcast_to(np.eye(k), (len(seg.size), k, k)).copy()
    scale = np.zeros(len(seg.size))
    by_class = np.ascontiguousarray(m.emit.T)
    for i, a in enumerate(seg.active):
        x = (t[:a].reshape(-1, k) @ m.move).reshape(a, k, k) * by_class[seg.at(i)][:, None, :]
        s = x.sum((1, 2))
        t[:a] = x / s[:, None, None]
        scale[:a] += np.log(s)
    return t, scale


def _forward(seg: _Segments, m: Hmm, t: np.ndarray, scale: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """State distribution before each segment, and each text's log likelihood."""
    before = np.zeros((len(seg.size), len(m.start)))
    state = np.broadcast_to(m.start, (texts, len(m.start))).copy()
    log = np.zeros(texts)
    for own in seg.rounds:
        d = seg.text[own]
        before[own] = state[d]
        x = np.einsum("ni,nij->nj", state[d], t[own])
        s = x.sum(1)
        state[d] = x / s[:, None]
        log[d] += np.log(s) + scale[own]
    return before, log


def log_likelihoods(texts: list[np.ndarray], m: Hmm) -> np.ndarray:
    """Natural log likelihood of each class sequence."""
    seg = _Segments(texts)
    t, scale = _transfer(seg, m)
    return _forward(seg, m, t, scale, len(texts))[1]


def expected_counts(texts: list[np.ndarray], m: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions, and the log likelihood."""
    seg = _Segments(texts)
    k = len(m.start)
    t, scale = _transfer(seg, m)
    before, log = _forward(seg, m, t, scale, len(texts))
    after = np.ones((len(seg.size), k))
    back = np.ones((len(texts), k))
    for own in reversed(seg.rounds):
        d = seg.text[own]
        after[own] = back[d]
        x = np.einsum("nij,nj->ni", t[own], back[d])
        back[d] = x / x.sum(1, keepdims=True)
    by_class = np.ascontiguousarray(m.emit.T)
    alpha, state = [], before.copy()
    for i, a in enumerate(seg.active):
        x = (state[:a] @ m.move) * by_class[seg.at(i)]
        state[:a] = x / x.sum(1, keepdims=True)
        alpha.append(state[:a].copy())
    moves, emits, beta = np.zeros((k, k)), np.zeros((k, m.emit.shape[1])), after
    for i in range(len(seg.active) - 1, -1, -1):
        a = seg.active[i]
        o = seg.at(i)
        gamma = alpha[i] * beta[:a]
        gamma /= gamma.sum(1, keepdims=True)
        for j in range(k):
            emits[j] += np.bincount(o, gamma[:, j], m.emit.shape[1])
        prior = alpha[i - 1][:a] if i else before
        ahead = by_class[o] * beta[:a]
        pulled = ahead @ m.move.T
        norm = (prior[:a] * pulled).sum(1, keepdims=True)
        moves += m.move * ((prior[:a] / norm).T @ ahead)
        beta[:a] = pulled / pulled.sum(1, keepdims=True)
    starts = m.start * back
    return (starts / starts.sum(1, keepdims=True)).sum(0), moves, emits, float(log.sum())


def _pack(m: Hmm) -> np.ndarray:
    return np.concatenate([m.start, m.move.ravel(), m.emit.ravel()])


def train(seq: DataFrame, class_count: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> tuple[Hmm, list[float]]:
    """Baum-Welch over all rows of ``seq`` (column ``classes``); also the log
    likelihood before each round."""
    m, seen = first_model(class_count, states), []
    c = class_count.shape[0]
    prior = EPSILON * (class_count + EPSILON) / (class_count + EPSILON).sum()
    for _ in range(rounds):
        sent = seq.sparkSession.sparkContext.broadcast(m)

        def run(batches, sent=sent):
            import pyarrow as pa

            total = np.zeros(1 + states + states * states + states * c)
            for rb in batches:
                texts = [np.frombuffer(x, "<u2") for x in rb.column(0).to_pylist()]
                for a, b in slices([len(x) for x in texts], TOKENS):
                    s, mv, e, log = expected_counts(texts[a:b], sent.value)
                    total += np.concatenate([[log], s, mv.ravel(), e.ravel()])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cell", "x"])

        got = seq.select("classes").mapInArrow(run, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x")).toPandas()
        total = np.zeros(1 + states + states * states + states * c)
        total[got["cell"]] = got["x"]
        seen.append(float(total[0]))
        start, move, emit = np.split(total[1:], [states, states + states * states])
        if not start.sum():
            break  # nothing to learn from
        move, emit = move.reshape(states, states) + 1e-3, emit.reshape(states, c) + prior * c
        m = Hmm((start + 1e-3) / (start + 1e-3).sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    return m, seen


def score(seq: DataFrame, m: Hmm, keep: list[str]) -> DataFrame:
    """``keep`` plus ``forward``: log10 likelihood of the class sequence."""
    from pyspark.sql import types as T

    src = seq.select(*keep, "classes")
    schema = T.StructType([*(src.schema[c] for c in keep), T.StructField("forward", T.DoubleType())])
    sent = seq.sparkSession.sparkContext.broadcast(m)

    def run(batches):
        import pyarrow as pa

        for rb in batches:
            texts = [np.frombuffer(x, "<u2") for x in rb.column(rb.num_columns - 1).to_pylist()]
            log = np.zeros(len(texts))
            for a, b in slices([len(x) for x in texts], TOKENS):
                log[a:b] = log_likelihoods(texts[a:b], sent.value)
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(log / np.log(10))], names=[*keep, "forward"])

    return src.mapInArrow(run, schema)


def score_texts(docs: DataFrame, training: Column) -> DataFrame:
    """One row per document: doc_id, training, n_tokens, n_known,
    train_tokens, base_score, score."""
    docs = docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("training"))
    learn = docs.where("training")
    counts = stage(word_counts(learn), "word-counts")
    vocab = vocabulary(counts, learn.count())
    seq = stage(sequences(docs, vocab, ["doc_id", "training"]).withColumn("rid", F.monotonically_increasing_id()), "sequences")
    model, _ = train(seq.where("training"), vocab.class_count)
    # rare words meet their counts; a word's class decides nothing that isn't in class_sum already
    rare = seq.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", "r.tf")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))
    more = (rare.join(counts, "word", "left").groupBy("rid")
            .agg(F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("rare_known"), F.sum(F.col("tf") * log).alias("rare_sum")))
    facts = ["rid", "doc_id", "training", "n_tokens", "known", "base_sum", "class_sum"]
    got = score(seq, model, facts).join(more, "rid", "left")
    extra = F.coalesce("rare_sum", F.lit(0.0))
    base = float(np.log10(vocab.tokens + vocab.distinct + 1))
    return got.select("doc_id", "training", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0).cast("long"))).alias("n_known"),
                      F.lit(vocab.tokens).cast("long").alias("train_tokens"),
                      (F.col("base_sum") + extra - F.col("n_tokens") * base).alias("base_score"),
                      (F.col("forward") + F.col("class_sum") + extra).alias("score"))


@query("op7_hmm_lm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = score_texts(docs, crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    return got.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
