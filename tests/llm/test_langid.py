"""Language identification: the posterior worked out page by page, wrong and unknown languages, folds."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import langid

TEXTS = {
    "en": """the quick house of this nation and that other thing with them all over the river when winter came because nobody knew which
        way the children should walk through those woods until morning light showed every path again while their mother waited by the window""",
    "fr": """les maisons de cette nation et des autres choses avec elles aussi quand venait la neige sur les collines parce que personne ne savait
        quel chemin les enfants devaient prendre jusqu'au matin tandis que leur mere attendait toujours pres de la fenetre sans rien dire""",
    "fi": """kalastaja laski verkot jo varhain aamulla kun sumu peitti viela veneet eika kukaan puhunut mitaan pitkaan aikaan vaikka lapset
        juoksivat rantaa pitkin kohti vanhaa kirkkoa jonka kellot soivat hiljaa metsan takana joka syksy samalla tavalla""",
}


def some(lang, k):
    words = TEXTS[lang].split()
    return " ".join(np.random.default_rng(k).choice(words, 300))


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame([(i, some(lang, i), lang, f"s{i % 3}", 0) for i, lang in enumerate(["en", "fr"] * 40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def plain_posteriors(model, pages):
    """page -> {class: posterior}, one page at a time."""
    classes = model.classes
    k = len(classes)

    def softmax(x):
        e = [math.exp(v - max(x)) for v in x]
        return [v / sum(e) for v in e]

    local, own, where, votes = [], [], [], [defaultdict(lambda: [0.0] * k) for _ in range(3)]
    for _, url, html in pages:
        slots = langid.trigram_slots(langid.visible_text(html or ""))
        weight = min(len(slots), langid.MOST / langid.TEMPER) * langid.TEMPER
        ll = [sum(float(model.log_p[-1, j, s]) for s in slots) / len(slots) * weight for j in range(k - 1)] + [float(model.other[-1]) * weight] if len(slots) else [0.0] * k
        found = re.search(langid.DECLARED, html or "")
        said = None if not found else found.group(1).lower() if found.group(1).lower() in classes else "other"
        if said:
            ll = [v + math.log(langid.TRUST if c == said else (1 - langid.TRUST) / (k - 1)) for v, c in zip(ll, classes, strict=True)]
        vote = [v if len(slots) or said else 0.0 for v in softmax(ll)]
        host = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", url or "")
        host = host.group(1).lower() if host else ""
        at = (host.rsplit(".", 1)[-1], ".".join(host.rsplit(".", 2)[-2:]), host)
        local.append(ll)
        own.append(vote)
        where.append([at[:1], at[:2], at])
        for level, key in zip(votes, where[-1], strict=True):
            level[key] = [a + b for a, b in zip(level[key], vote, strict=True)]
    total = [sum(v[j] for v in own) for j in range(k)]
    overall = [(t + 1) / (sum(total) + k) for t in total]
    out = []
    for ll, vote, at in zip(local, own, where, strict=True):
        prior = overall
        for level, key, kappa in zip(votes, at, langid.KAPPA, strict=True):
            c = [max(a - b, 0.0) for a, b in zip(level[key], vote, strict=True)]
            prior = [(a + kappa * p) / (sum(c) + kappa) for a, p in zip(c, prior, strict=True)]
        out.append(dict(zip(classes, softmax([v + math.log(max(p, 1e-12)) for v, p in zip(ll, prior, strict=True)]), strict=True)))
    return out


def test_posterior_is_that_worked_out_page_by_page(spark, train):
    model = langid.train_text_model(train)
    assert model.languages == ["en", "fr"]
    pages = [(1, "http://a.example.fr/x", f"<html lang='en'><p>{some('fr', 1)}</p>"), (2, "http://a.example.fr/y", some("fr", 2)),
             (3, "http://b.example.com/", some("en", 3)), (4, "http://b.example.com/z", "<html lang='fi'>1234"), (5, None, None), (6, "nonsense", ""),
             (7, "http://c.example.com/", some("fi", 7)), (8, "http://b.example.com/", "the"), (8, "http://b.example.com/", "the")]
    got = langid.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).orderBy("page_id").collect()
    for r, want in zip(got, plain_posteriors(model, pages), strict=True):
        assert all(math.isclose(r.posterior[c], p, rel_tol=1e-5, abs_tol=1e-9) for c, p in want.items()), r.page_id
    by = {r.page_id: r.language for r in got}
    assert by[1] == by[2] == "fr" and by[3] == "en" and by[7] == "und" and by[4] == "und"


def test_stage_removes_wrong_and_unknown_languages(spark, sf, train):
    more = [(1000 + i, some("fi", 500 + i), ["en", "fr", "fi", None][i % 4], "s0", 0) for i in range(8)]
    more += [(2000 + i, some("en", 700 + i), "fr", "s1", 0) for i in range(5)] + [(3000, None, "en", "s1", 0), (3001, "", None, None, 0)]
    more += [(4000, some("fr", 900), None, None, 0), (4001, some("fr", 901), "FR-ca", "s2", 0), (4001, some("fr", 901), "en", "s2", 0)]
    out = langid.stage_langid(spark, train.unionByName(spark.createDataFrame(more, train.schema)), sf)
    kept = [(r.doc_id, r.lang) for r in out.where("doc_id >= 1000").collect()]
    assert out.where("doc_id < 1000").count() == 80
    assert sorted(kept) == [(3000, "en"), (4000, None), (4001, "FR-ca")]


def test_languages_come_from_the_data(spark, train):
    rare = spark.createDataFrame([(500 + i, some("fi", i), "fi", "s", 0) for i in range(5)], train.schema)
    assert langid.train_text_model(train.unionByName(rare)).languages == ["en", "fr"]
    assert langid.train_text_model(train.unionByName(rare), support=5).languages == ["en", "fi", "fr"]
    none = langid.train_text_model(train.where(F.lit(False)))
    assert none.classes == ["other"]
    pages = spark.createDataFrame([(1, "http://a.b/", some("en", 1))], "page_id long, url string, html string")
    assert langid.identify_pages(pages, none).first().language == "und"


def test_no_text_is_judged_by_a_model_that_saw_it(train):
    model = langid.train_text_model(train)
    fold = {r.fold for r in train.select(langid._fold("text", langid.FOLDS).alias("fold")).collect()}
    every = np.exp(model.log_p[-1])
    assert len(fold) > 1 and all(not np.allclose(np.exp(model.log_p[f]), every) for f in fold)
