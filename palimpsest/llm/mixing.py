"""Operator 3, mixing sources to target weights by iterative proportional
fitting, with DataFrame functions only.

Documents are summed into cells (source, language, topic) of tokens; the
cells' weights are raked to the three marginals in turn until every marginal
is met, or for ``MOST_ROUNDS`` rounds: marginals that conflict (a language found
in one source only, which holds only that language) can't all be met.  Then the
last round's weights are used, which meet the topics, raked last, and the largest
error of every marginal is logged as a warning; the ratio of a cell's raked weight to its tokens, times one common
factor, is the probability with which its documents are kept.  The factor is
set so that the kept tokens are ``budget`` of all tokens in expectation; a
cell whose probability would pass 1 is kept whole and the factor solved anew
for the rest.  A document is kept when a uniform number made from the md5 of
its id falls below its cell's probability, so a rerun keeps the same rows.

Targets: by default each marginal is the observed share of tokens to the power
``TEMPER``, normalised; a table (value, weight) may be given instead.  Values
without a target get the weight 0 and are not kept; targets without documents
are left out and the rest rescaled.

Only the cells are iterated on, never the documents.  Cells are grouped by
Spark, one short job a round, so nothing assumes that they fit one task.

Topic, without a topic column, is the text's form: tabular, shouted, numeric,
short, lined or prose, by counts of characters.

Defined cases: null source or language is a value of its own ('' in the
cell); null or empty text has no tokens: a cell without tokens has probability
0, and a document without tokens in another cell shares that cell's
probability; a null id draws by the text alone; repeated rows share one draw;
an empty table gives an empty result; other columns are left out (the query)
or kept (the stage).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_shuffle, extras_aside, query, stage, table, text_or_empty

TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
DIMS = ("source", "lang", "topic")
BUDGET = 0.5
CLOSE = 1e-10
MOST_ROUNDS = 200

log = logging.getLogger(__name__)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x09-\x0D\x20]+")).cast("long")


def topic_of(text: Column) -> Column:
    n = F.length(text)
    return (F.when(_count_of(text, "|") * 100 > n, "tabular").when(_count_of(text, UPPER) * 3 > n, "shouted")
            .when(_count_of(text, "0123456789") * 5 > n, "numeric").when(n < 400, "short")
            .when(_count_of(text, "\n") * 200 > n, "lined").otherwise("prose"))


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` plus the cell (__source, __lang, __topic), __tokens and __draw."""
    text = text_or_empty("text")
    ident = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(text.cast("binary")))).cast("binary"))
    draw = F.conv(F.substring(ident, 1, 13), 16, 10).cast("double") / float(1 << 52)
    return docs.select(*keep, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__{c}") for c in DIMS[:2]),
                       topic_of(text).alias("__topic"), token_count(text).alias("__tokens"), draw.alias("__draw"))


def default_targets(cells: DataFrame, dim: str) -> DataFrame:
    by = cells.groupBy(f"__{dim}").agg(F.sum("__tokens").cast("double").alias("t"))
    return by.select(F.col(f"__{dim}").alias("value"), F.when(F.col("t") > 0, F.pow("t", F.lit(TEMPER[dim]))).otherwise(0.0).alias("weight"))


def marginal_errors(w: DataFrame) -> dict[str, float]:
    """Largest difference of share and goal in every dimension."""
    out = {}
    for dim in DIMS:
        by = w.groupBy(f"__{dim}").agg(F.abs(F.sum("__w") - F.first(f"__goal_{dim}")).alias("e"))
        out[dim] = float(by.agg(F.max("e")).first()[0] or 0.0)
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Cells plus __w, the raked share of all tokens."""
    total = float(cells.agg(F.sum("__tokens")).first()[0] or 0)
    w = cells.withColumn("__w", F.col("__tokens") / F.lit(total or 1.0))
    for dim in DIMS:
        goal = (targets or {}).get(dim)
        goal = default_targets(cells, dim) if goal is None else goal
        goal = goal.select(F.col("value").alias(f"__{dim}"), F.col("weight").cast("double").alias(f"__goal_{dim}"))
        w = w.join(by_shuffle(goal), f"__{dim}", "left")
        w = w.withColumn(f"__goal_{dim}", F.coalesce(f"__goal_{dim}", F.lit(0.0)))
    w = w.where(" and ".join(["__tokens > 0", *(f"__goal_{d} > 0" for d in DIMS)]))
    for dim in DIMS:  # one value's goal as a share of the goals that have documents
        n = F.count(F.lit(1)).over(Window.partitionBy(f"__{dim}"))
        w = w.withColumn("__part", F.col(f"__goal_{dim}") / n)
        whole = float(w.agg(F.sum("__part")).first()[0] or 1.0)
        w = w.withColumn(f"__goal_{dim}", F.col(f"__goal_{dim}") / whole).drop("__part")
    w = stage(w.coalesce(8), "cells")
    for _ in range(MOST_ROUNDS):
        off = F.lit(0.0)
        for dim in DIMS:
            have = F.sum("__w").over(Window.partitionBy(f"__{dim}"))
            w = w.withColumn("__f", F.col(f"__goal_{dim}") / have)
            off = F.greatest(off, F.abs(F.col("__f") - 1))
            w = w.withColumn("__w", F.col("__w") * F.col("__f")).withColumn("__off", off).drop("__f")
            off = F.col("__off")
        w = stage(w.coalesce(8), "cells")
        if (w.agg(F.max("__off")).first()[0] or 0.0) < CLOSE:
            break
        w = w.drop("__off")
    else:
        log.warning("marginals not met after %d rounds; largest error of a share: %s", MOST_ROUNDS, marginal_errors(w))
    return w.select(*(f"__{d}" for d in DIMS), "__tokens", "__w")


def probabilities(cells: DataFrame, raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """__p by cell: min(1, factor * share / tokens), keeping ``budget`` of all
    tokens in expectation (or every cell with a target, if those hold less)."""
    total = float(cells.agg(F.sum("__tokens")).first()[0] or 0)
    ratio = F.col("__w") / F.col("__tokens")
    factor = budget * total
    while True:
        capped = F.lit(factor) * ratio >= 1.0
        full, rest, n = raked.agg(F.sum(F.when(capped, F.col("__tokens"))), F.sum(F.when(~capped, F.col("__w"))),
                                  F.count_if(capped)).first()
        if not rest:
            break
        again = max(factor, (budget * total - float(full or 0)) / float(rest))
        if again <= factor * (1 + 1e-12):
            break
        factor = again
    return raked.select(*(f"__{d}" for d in DIMS), F.col("__w").alias("__share"),
                        F.least(F.lit(1.0), F.lit(factor) * ratio).alias("__p"))


def mix(docs: DataFrame, keep: list[str], targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """``keep`` plus cell, __tokens, __share, __p and __kept for every row."""
    # the cell counts and the sampling both read these few columns, not the texts
    own = stage(features(docs, keep), "mixing-features")
    cell = [f"__{d}" for d in DIMS]
    cells = stage(own.groupBy(*cell).agg(F.sum("__tokens").alias("__tokens")).coalesce(8), "cells")
    p = stage(probabilities(cells, rake(cells, targets), budget).coalesce(1), "cell-probabilities")
    out = own.join(p, cell, "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return (out.withColumn("__p", zero("__p")).withColumn("__share", zero("__share"))
            .withColumn("__kept", F.col("__draw") < F.col("__p")))


def _sql() -> str:
    count_of = lambda chars: f"(length(t) - length(translate(t, '{chars}', '')))"
    goals = ", ".join(f"goal_{d} AS (SELECT {d}, pow(sum(tokens)::DOUBLE, {TEMPER[d]}) / sum(pow(sum(tokens)::DOUBLE, {TEMPER[d]})) OVER () AS g "
                      f"FROM cells WHERE tokens > 0 GROUP BY {d})" for d in DIMS)
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS source, coalesce(lang, '') AS lang FROM documents),
f AS (
  SELECT doc_id, source, lang,
    CASE WHEN {count_of('|')} * 100 > length(t) THEN 'tabular' WHEN {count_of(UPPER)} * 3 > length(t) THEN 'shouted'
         WHEN {count_of('0123456789')} * 5 > length(t) THEN 'numeric' WHEN length(t) < 400 THEN 'short'
         WHEN (length(t) - length(replace(t, chr(10), ''))) * 200 > length(t) THEN 'lined' ELSE 'prose' END AS topic,
    len(regexp_extract_all(t, '[^\\x09-\\x0D\\x20]+'))::BIGINT AS tokens,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 't' || md5(t))), 1, 13))::BIGINT / 4503599627370496.0 AS draw
  FROM d),
cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM f GROUP BY ALL),
total AS (SELECT sum(tokens) AS n FROM cells),
{goals},
w0 AS (
  SELECT c.source, c.lang, c.topic, c.tokens, c.tokens / n AS w, gs.g AS gs, gl.g AS gl, gt.g AS gt
  FROM cells c, total, goal_source gs, goal_lang gl, goal_topic gt
  WHERE c.source = gs.source AND c.lang = gl.lang AND c.topic = gt.topic AND c.tokens > 0),
ipf AS (
  SELECT 0 AS r, source, lang, topic, tokens, w, gs, gl, gt FROM w0
  UNION ALL
  SELECT r + 1, source, lang, topic, tokens, w * gt / sum(w) OVER (PARTITION BY topic) AS w, gs, gl, gt FROM (
    SELECT r, source, lang, topic, tokens, w * gl / sum(w) OVER (PARTITION BY lang) AS w, gs, gl, gt FROM (
      SELECT r, source, lang, topic, tokens, w * gs / sum(w) OVER (PARTITION BY source) AS w, gs, gl, gt
      FROM ipf WHERE r < 60))),
raked AS (SELECT source, lang, topic, tokens, w, w / tokens AS ratio FROM ipf WHERE r = 60),
-- the factor at which the cells of the largest ratios are kept whole and the rest fill the budget
sorted AS (
  SELECT *, coalesce(sum(tokens) OVER (ORDER BY ratio DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
    sum(w) OVER (ORDER BY ratio ASC ROWS UNBOUNDED PRECEDING) AS rest FROM raked),
factor AS (SELECT coalesce(arg_max(({BUDGET} * n - above) / rest, ratio) FILTER (WHERE ({BUDGET} * n - above) / rest * ratio <= 1),
  max(1 / ratio)) AS x FROM sorted, total),
p AS (SELECT source, lang, topic, w, least(1.0, x * ratio) AS p FROM raked, factor)
SELECT f.doc_id, f.source, f.lang, f.topic, f.tokens AS n_tokens, coalesce(p.w, 0.0) AS cell_share,
  coalesce(p.p, 0.0) AS probability, f.draw < coalesce(p.p, 0.0) AS kept
FROM f LEFT JOIN p USING (source, lang, topic)
"""


@query("op3_mixing_ipf", _sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", *(F.col(f"__{d}").alias(d) for d in DIMS), F.col("__tokens").alias("n_tokens"),
        F.col("__share").alias("cell_share"), F.col("__p").alias("probability"), F.col("__kept").alias("kept"))


@extras_aside
def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the sampled documents, as they were."""
    cell = [f"__{d}" for d in DIMS]
    own = stage(features(docs, []), "mixing-features")
    cells = stage(own.groupBy(*cell).agg(F.sum("__tokens").alias("__tokens")).coalesce(8), "cells")
    p = stage(probabilities(cells, rake(cells)).coalesce(1), "cell-probabilities")
    return (features(docs, docs.columns).join(p, cell, "left").where(F.col("__draw") < F.coalesce("__p", F.lit(0.0)))
            .select(*docs.columns))
