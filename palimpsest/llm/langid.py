"""Operator 2, language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior over the languages that the
training table has (those with ``SUPPORT`` documents or more) and one class for
all *others*:

* the text: a multinomial model of hashed character trigrams, whose counts
  are one grouped aggregation over all training texts (tempered, because
  neighbouring trigrams aren't independent).  A text of another language is
  expected to fit like one known language does the model of its nearest
  neighbour: from the models alone follow the likelihood a trigram of texts
  in their own language and in the best other one, and the class of others
  takes a likelihood between the two (``OTHER``);
* the declared markup language (``<html lang>``) through a table
  P(declared | language);
* the address suffix (top-level domain) and the host through hierarchical
  priors: counts of text-and-markup posteriors are summed by suffix, by
  domain and by host, and each level is smoothed towards the one above.  A
  page's own contribution is taken out of its host's, domain's and suffix's
  counts, so it can't vote for itself.

Where training documents are judged themselves (the pipeline's stage), counts
are kept by fold and each fold is judged by the model of all others.

Hosts are aggregated before anything is joined, so a host with a third of all
pages is one summed row; the join back carries a few numbers a page and no text.

Defined cases: null or empty text has no trigrams and is decided by the other
evidence; with none of that either (or too little to pass ``least``) the
language is ``und``, as it is where the others are likeliest; a null or broken
address has suffix, domain and host '' (one shared group); a declared language
that the training table lacks speaks for the others; ties go to the first
language in alphabetical order; repeated rows each get a result; an empty
training table has no languages, so everything is ``und``; other columns stay
untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_shuffle, extras_aside, importable, map_text, query, stage, table, text_or_empty

SUPPORT = 10       # documents that a language needs
MOST_LANGUAGES = 64  # the most frequent ones: bounds the model's size
OTHER = 0.4        # where, between a foreign (0) and its own text (1), the class of others stands
OWN_SHARE = 0.2    # of a text that its declared language must explain where another one wins
FOLDS = 4
SLOTS = 1 << 14
TEMPER = 0.05      # weight of one trigram's log likelihood
MOST = 60.0        # the most that a text's trigrams weigh together: longer texts are averaged, not cut
SMOOTH = 0.5       # added to every trigram slot
KAPPA = (4.0, 4.0, 8.0)  # pseudo-counts drawn from the level above: suffix, domain, host
TRUST = 0.9        # P(declared = language | declared at all)
LEAST = 0.6        # posterior needed for a decision
LETTERS = 8        # letters needed before a text counts as evidence
LEVELS = ["__suffix", "__domain", "__host"]  # of the address, coarse to fine

_TAG = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]{1,10};")


def visible_text(html: str) -> str:
    return _TAG.sub(" ", html)


def trigram_slots(text: str) -> np.ndarray:
    """Hashed trigrams of the letters (others count as one space)."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((raw >= 97) & (raw <= 122)) | (raw >= 0xC0)
    sym = np.where(letter, raw, 32).astype(np.uint32)
    sym = sym[np.concatenate(([True], letter[1:] | letter[:-1]))] if len(sym) else sym
    if np.count_nonzero(letter) < LETTERS or len(sym) < 3:
        return np.zeros(0, np.int64)
    x = sym.astype(np.uint64)
    h = (x[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (x[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (x[2:] * np.uint64(0x165667B19E3779F9))
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(50)).astype(np.int64)


@dataclass
class TextModel:
    """log P(slot | language) of every fold's others and, last, of all documents."""

    languages: list[str]
    log_p: np.ndarray  # folds + 1, languages, slots
    other: np.ndarray  # folds + 1: log likelihood a trigram of texts in other languages
    fit: np.ndarray  # expected log likelihood of a trigram of one language under the model of another

    @property
    def classes(self) -> list[str]:
        return [*self.languages, "other"]


def _code(lang: Column) -> Column:
    """``en`` of ``EN-us``; null where it isn't a language code."""
    code = F.lower(F.regexp_extract(F.coalesce(lang, F.lit("")), r"^\s*([A-Za-z]{2,3})(?:[^A-Za-z].*)?$", 1))
    return F.when((code != "") & (code != "und"), code)


def train_text_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, folds: int = FOLDS) -> TextModel:
    """A bounded table of counts by fold, language and slot, whatever the
    corpus; summed over all labelled documents."""
    importable(docs.sparkSession)
    src = docs.select(_code(F.col(lang_col).cast("string")).alias("__lang"), text_or_empty(text_col).alias("__text"))
    by = src.where("__lang is not null").groupBy("__lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    names = sorted(r["__lang"] for r in by.orderBy(F.desc("n"), "__lang").limit(MOST_LANGUAGES).collect())
    counts = np.zeros((folds, len(names), SLOTS))
    if names:
        def run(batches):
            import pyarrow as pa

            total = np.zeros((folds, len(names), SLOTS), np.int64)
            place = {x: i for i, x in enumerate(names)}
            for rb in batches:
                for lang, text, fold in zip(*(rb.column(i).to_pylist() for i in range(3)), strict=True):
                    slot = trigram_slots(text)
                    if len(slot):
                        total[fold, place[lang]] += np.bincount(slot, minlength=SLOTS)
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int32()) for x in at), pa.array(total[at])], names=["fold", "lang", "slot", "n"])

        labelled = src.where(F.col("__lang").isin(names)).withColumn("__fold", _fold("__text", folds))
        got = (labelled.mapInArrow(run, "fold int, lang int, slot int, n long")
               .groupBy("fold", "lang", "slot").agg(F.sum("n").alias("n"))).toArrow()
        counts[tuple(got.column(c).to_numpy() for c in ("fold", "lang", "slot"))] = got.column("n").to_numpy()
    every = counts.sum(0)
    used = np.concatenate([every[None] - counts, every[None]])
    log_p = np.log((used + SMOOTH) / (used + SMOOTH).sum(2, keepdims=True))
    seen = used / np.maximum(used.sum(2, keepdims=True), 1)
    fit = np.einsum("fls,fms->flm", seen, log_p)  # a trigram of language l under the model of m
    k = len(names)
    own = np.diagonal(fit, axis1=1, axis2=2)
    nearest = np.where(np.eye(k, dtype=bool), -np.inf, fit).max(2) if k > 1 else np.full((folds + 1, k), -np.log(SLOTS))
    other = (nearest + OTHER * (own - nearest)).mean(1) if k else np.zeros(folds + 1)
    return TextModel(names, log_p.astype(np.float32), other, fit[-1])


def _fold(text: str, folds: int) -> Column:
    """By the text alone, so that copies are never trained on."""
    return F.pmod(F.xxhash64(text), F.lit(folds)).cast("int")


def text_log_likelihood(docs: DataFrame, model: TextModel, keep: list[str], text_col: str, clean=None, fold: bool = False) -> DataFrame:
    """``keep`` plus ``__ll`` (one tempered log likelihood a class) and
    ``__grams`` (trigrams seen); with ``fold`` each text by the model that
    hasn't seen its fold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # folds x languages x slots x 4 bytes
    k, folds = len(model.classes), len(model.other) - 1

    def run(texts):
        m, ll, n = sent.value, [], []
        for t in texts:
            at, t = (int(t[:2]), t[2:]) if fold else (folds, t)
            slot = trigram_slots(clean(t) if clean else t)
            n.append(len(slot))
            each = [*m.log_p[at][:, slot].mean(1, dtype=np.float64).tolist(), float(m.other[at])] if len(slot) else [0.0] * k
            weight = min(len(slot), MOST / TEMPER) * TEMPER
            ll.append([x * weight for x in each])
        return {"__ll": ll, "__grams": n}

    if fold:  # two digits before the text name its fold
        docs = docs.withColumn(text_col, F.concat(F.lpad(_fold(text_or_empty(text_col), folds).cast("string"), 2, "0"), text_or_empty(text_col)))
    return map_text(docs, keep, run, "__ll array<double>, __grams long", text_col)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _matrix(column) -> np.ndarray:
    """Rows x classes of an Arrow column of arrays of equal length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _computed(df: DataFrame, fn, fields: str) -> DataFrame:
    """``df`` plus ``fields`` that ``fn`` computes from an Arrow batch as a
    dict of numpy arrays (two dimensions: an array column).  The numbers of a
    row meet in numpy as one expression tree over all languages and levels
    would cost the driver hundreds of MB to plan."""
    new = T.StructType.fromDDL(fields)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in new.fields]

        def column(v, kind):
            if v.ndim < 2:
                return pa.array(v, kind)
            at = pa.array(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32))
            return pa.ListArray.from_arrays(at, pa.array(v.ravel()), type=kind)

        for rb in batches:
            if rb.num_rows:
                got = fn(rb)
                yield pa.RecordBatch.from_arrays([*rb.columns, *(column(got[f.name], k) for f, k in zip(new.fields, kinds, strict=True))],
                                                 names=[*rb.schema.names, *new.names])

    return df.mapInArrow(run, T.StructType(df.schema.fields + new.fields))


def _evidence(rb, classes: list[str]) -> dict:
    """The text's and the markup's log likelihoods, and the vote they give."""
    k = len(classes)
    said = np.array([-1 if x is None else classes.index(x) for x in rb.column("__said").to_pylist()])
    local = _matrix(rb.column("__ll")).copy()
    told = np.flatnonzero(said >= 0)
    if k > 1:
        local[told] += np.log((1 - TRUST) / (k - 1))
        local[told, said[told]] += np.log(TRUST) - np.log((1 - TRUST) / (k - 1))
    spoken = (rb.column("__grams").to_numpy() > 0) | (said >= 0)
    return {"__local": local, "__own": _softmax(local) * spoken[:, None]}


def _posterior(rb, overall: np.ndarray) -> dict:
    """Every level's votes without the page's own, smoothed towards the level
    above; the host's prior and the page's evidence give the posterior."""
    own, prior = _matrix(rb.column("__own")), overall
    for lv, kappa in zip(LEVELS, KAPPA, strict=True):
        c = np.maximum(_matrix(rb.column(f"{lv}_votes")) - own, 0.0)
        prior = (c + kappa * prior) / (c.sum(1, keepdims=True) + kappa)
    return {"__prior": prior, "__post": _softmax(_matrix(rb.column("__local")) + np.log(np.maximum(prior, 1e-12)))}


def fuse(ev: DataFrame, classes: list[str], declared: Column, address: dict[str, Column]) -> DataFrame:
    """Posterior over ``classes`` (languages, then ``other``) for rows with
    ``__ll`` and ``__grams``.

    ``address``: suffix, domain and host columns, from coarse to fine.  Adds
    ``language``, ``confidence``, ``posterior`` (by class) and ``host_prior``
    (by class)."""
    k = len(classes)
    code = _code(declared)
    said = F.when(code.isin(classes[:-1]), code).when(code.isNotNull(), F.lit("other"))
    first = ev.select("*", *(F.coalesce(c, F.lit("")).alias(n) for n, c in zip(LEVELS, address.values(), strict=True)), said.alias("__said"))
    first = stage(_computed(first, lambda rb: _evidence(rb, classes), "__local array<double>, __own array<double>"), "langid-evidence")

    sums = [F.sum(F.col("__own")[i]) for i in range(k)]
    votes = [first.groupBy(*LEVELS[: n + 1]).agg(F.array(*sums).alias(f"{lv}_votes")) for n, lv in enumerate(LEVELS)]
    # hosts meet their domain and suffix as summed rows, pages meet their host once
    tree = votes[2].join(by_shuffle(votes[1]), LEVELS[:2]).join(by_shuffle(votes[0]), LEVELS[:1])
    total = np.array([x or 0.0 for x in first.agg(*sums).first()])  # one number a class
    overall = (total + 1.0) / (total.sum() + k)
    page = _computed(first.join(by_shuffle(tree), LEVELS), lambda rb: _posterior(rb, overall),
                     "__prior array<double>, __post array<double>")
    best, names = F.array_max("__post"), F.array(*map(F.lit, classes))
    voted = (F.col("__grams") > 0) | F.col("__said").isNotNull() | (F.col("__host") != "")
    likeliest = names[F.array_position("__post", best).cast("int") - 1]
    return page.select(
        *[c for c in ev.columns if c not in ("__ll", "__grams")], F.col("__grams").alias("n_grams"), F.col("__said").alias("declared"),
        F.when(voted & (best >= LEAST) & (likeliest != "other"), likeliest).otherwise("und").alias("language"),
        best.alias("confidence"), F.map_from_arrays(names, "__post").alias("posterior"),
        F.map_from_arrays(names, "__prior").alias("host_prior"))


def address_parts(url: Column) -> dict[str, Column]:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return {"suffix": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2), "host": host}


DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b"


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """One row per page: ``page_id``, ``language``, ``confidence``, ..."""
    html = text_or_empty("html")
    src = pages.select("page_id", *(c.alias(f"__a_{n}") for n, c in address_parts(F.col("url")).items()),
                       F.regexp_extract(html, DECLARED, 1).alias("__declared"), html.alias("__html"))
    ev = text_log_likelihood(src, model, [c for c in src.columns if c != "__html"], "__html", visible_text)
    out = fuse(ev, model.classes, F.col("__declared"), {n: F.col(f"__a_{n}") for n in ("suffix", "domain", "host")})
    return out.select("page_id", F.col("__a_host").alias("host"), F.col("__a_suffix").alias("suffix"), "declared",
                      "n_grams", "language", "confidence", "posterior", "host_prior")


@query("op2_langid_fusion")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train_text_model(table(spark, sf_dir, "documents"))
    got = identify_pages(table(spark, sf_dir, "pages"), model)
    return got.select(
        "page_id", "host", "suffix", "declared", "n_grams", "language", "confidence",
        *(F.col("posterior")[x].alias(f"p_{x}") for x in model.classes),
        *(F.col("host_prior")[x].alias(f"prior_{x}") for x in model.classes))


@extras_aside
def stage_langid(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents go whose language stays undecided or is none
    of the known ones, and those found to be in another language than their
    ``lang`` says: with less than ``OWN_SHARE`` of the text in it, going by how
    well its model fits (a document in two languages stays under either).
    ``lang`` is the declaration, ``source`` the host (no suffix); no document is
    judged by a model that has seen its text."""
    model = train_text_model(docs)
    cols = docs.columns
    none = F.lit("")
    # only ids, declarations and a few numbers a document are staged and joined, never the text
    key = F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_or_empty("text")), 256)
    src = docs.select(key.alias("__key"), F.col("lang").cast("string").alias("__lang"),
                      F.col("source").cast("string").alias("__src"), "text")
    ev = text_log_likelihood(src, model, ["__key", "__lang", "__src"], "text", fold=True)
    # a trigram's log likelihood in the declared language, and what it would be in a text of another one that holds OWN_SHARE of it
    by_class = F.map_from_arrays(F.array(*map(F.lit, model.classes)), F.col("__ll"))
    weight = F.least(F.col("__grams").cast("double"), F.lit(MOST / TEMPER)) * TEMPER
    ev = ev.withColumn("__told", F.when(F.col("__grams") > 0, F.try_element_at(by_class, _code(F.col("__lang"))) / weight))
    least = model.fit + OWN_SHARE * (np.diagonal(model.fit)[None] - model.fit)
    pairs = [(f"{a} {b}", float(least[i, j])) for i, a in enumerate(model.languages) for j, b in enumerate(model.languages)]
    cut = F.map_from_arrays(*(F.array(*map(F.lit, x)) for x in zip(*pairs, strict=True))) if pairs else F.create_map().cast("map<string,double>")
    got = fuse(ev, model.classes, F.col("__lang"), {"suffix": none, "domain": none, "host": F.col("__src")})
    needed = F.try_element_at(cut, F.concat_ws(" ", "language", "declared"))
    wrong = (F.col("language") == "und") | ((F.col("declared") != F.col("language")) & F.coalesce(F.col("__told") < needed, F.lit(True)))
    rejected = stage(got.where(wrong).select("__key", F.col("__lang").alias("__was")).distinct(), "langid-rejected")
    # rows of one id and text may differ in what they declare
    rejected = rejected.withColumnRenamed("__key", "__gone")
    same = (F.col("__key") == F.col("__gone")) & F.col("lang").cast("string").eqNullSafe(F.col("__was"))
    return docs.withColumn("__key", key).join(rejected, same, "left_anti").select(*cols)
