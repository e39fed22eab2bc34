"""Operator 5, license scans by diagonal voting, with DataFrame functions only.

Every text becomes rolling word 2-grams; their hashes are joined to the
positions of the same 2-grams in a table of templates (and compared word for
word, so hash collisions don't count).  A hit votes for its diagonal, the
start in the text less the position in the template.  Per text, template and
diagonal the votes are a bit mask of template positions.

* A short phrase (``base``) is found where one diagonal has all its bits.
* A longer notice is found by merging neighbouring diagonals (a few words
  inserted or left out move the rest to the next diagonals): diagonals of at
  least ``SEED`` votes no more than ``GAP`` apart form a span, which is
  verified by its coverage of the template and its length in the text.  A span
  that is too long (a tail repeated nearby) is replaced by its best run of
  neighbouring diagonals that is short enough.

Only hits (and one row a text) are shuffled, once, by a key made from id and
text, so the word tables of large texts never move and all later grouping
reuses that partitioning.  The templates are a parameter of bounded size
(``MOST_WORDS`` words each), which Spark broadcasts.

Defined cases: null text counts as empty and has no words; null ids are a
value of their own; repeated rows each get a result; texts of one word have no
2-grams; ties in coverage don't matter (labels are a set, the score a maximum);
an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import query, row_key, stage, table, text_or_empty

#: the base phrases of the contract and their labels
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: notices found by spans, with the labels that the method adds
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution license", "cc-by-notice"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd-text"),
)
MOST_WORDS = 63
SEED, GAP = 2, 3
COVERAGE = 0.7
STRETCH = 1.5  # a span's length in the text, as a multiple of the template's

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def template_rows(templates) -> list[tuple]:
    """(template, label, base, position, word, next word, 2-grams) of (text, label, base) triples."""
    out = []
    for t, (text, label, base) in enumerate(templates):
        w = text.split(" ")
        if not 2 <= len(w) <= MOST_WORDS:
            raise ValueError(f"a template needs 2 to {MOST_WORDS} words: {text!r}")
        out += [(t, label, base, i, a, b, len(w) - 1) for i, (a, b) in enumerate(zip(w, w[1:], strict=False))]
    return out


def default_templates() -> list[tuple]:
    return [(t, label, True) for t, label in BASE] + [(t, label, False) for t, label in NOTICES]


def votes(docs: DataFrame, templates) -> DataFrame:
    """Per text, template and diagonal: ``mask`` of matched positions,
    ``low`` and ``high`` start words; and per text one row of template -1
    with ``copies`` (equal rows) and ``n_words``."""
    spark = docs.sparkSession
    grams = spark.createDataFrame(template_rows(templates), "template int, label string, base boolean, tpos int, g0 string, g1 string, grams int")
    grams = grams.withColumn("gram", F.xxhash64("g0", "g1"))
    w = F.col("w")
    # element 0 pairs '' with the first word: it stands for the text itself
    src = (docs.select(F.col("doc_id"), row_key().alias("row"), words(text_or_empty("text")).alias("w"))
           .select("doc_id", "row", F.size(w).cast("long").alias("n_words"),
                   F.posexplode(F.arrays_zip(F.concat(F.array(F.lit("")), w).alias("a"), w.alias("b"))).alias("pos", "g"))
           .select("doc_id", "row", "n_words", "pos", F.col("g.a").alias("a"), F.col("g.b").alias("b"))
           .withColumn("gram", F.xxhash64("a", "b")))
    hit = F.col("template").isNotNull()
    got = (src.join(F.broadcast(grams), "gram", "left")  # the templates: at most a few thousand short rows
           .where((F.col("pos") == 0) | (hit & (F.col("a") == F.col("g0")) & (F.col("b") == F.col("g1")))))
    start = (F.col("pos") - 1).cast("long")
    got = got.select(
        "doc_id", "row", F.when(F.col("pos") == 0, -1).otherwise(F.col("template")).alias("template"),
        F.when(F.col("pos") == 0, F.col("n_words")).otherwise(start - F.col("tpos")).alias("diagonal"), start.alias("start"),
        F.when(F.col("pos") == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("tpos"))).alias("bit"))
    return (got.repartition("row").groupBy("row", "doc_id", "template", "diagonal")
            .agg(F.bit_or("bit").alias("mask"), F.min("start").alias("low"), F.max("start").alias("high"), F.count(F.lit(1)).alias("copies")))


def spans(voted: DataFrame, templates, coverage: float = COVERAGE) -> DataFrame:
    """Verified spans: row, doc_id, template, label, base, start, stop (words), coverage."""
    facts = voted.sparkSession.createDataFrame(
        [(t, label, base, len(text.split(" ")) - 1) for t, (text, label, base) in enumerate(templates)],
        "template int, label string, base boolean, grams int")
    v = voted.where("template >= 0").join(F.broadcast(facts), "template")
    full = v.where("base and bit_count(mask) = grams").select(
        "row", "doc_id", "template", "label", "base", F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("grams")).alias("stop"), F.lit(1.0).alias("coverage"))
    own = Window.partitionBy("row", "doc_id", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(own) > GAP, F.lit(True)).cast("int")
    seeds = v.where(f"not base and bit_count(mask) >= {SEED}").withColumn("fresh", fresh)
    seeds = seeds.withColumn("span", F.sum("fresh").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    merged = (seeds.groupBy("row", "doc_id", "template", "span")
              .agg(F.first("label").alias("label"), F.first("grams").alias("grams"), F.bit_or("mask").alias("mask"),
                   F.min("low").alias("low"), F.max("high").alias("high"))
              .withColumn("coverage", F.expr("bit_count(mask)") / F.col("grams"))
              .where(F.col("coverage") >= coverage).where(F.expr(f"high - low + 1 <= grams * {STRETCH}")))
    # a span that is too long stands for its best run of neighbouring diagonals that isn't
    whole = Window.partitionBy("row", "doc_id", "template", "span")
    ahead = whole.orderBy("diagonal").rangeBetween(0, 3 * MOST_WORDS)  # no run that fits reaches further
    part = (seeds.withColumn("reach", F.max("high").over(whole) - F.min("low").over(whole) + 1)
            .where(F.expr(f"reach > grams * {STRETCH}")).withColumn("run", F.collect_list(F.struct("mask", "low", "high")).over(ahead))
            .withColumn("run", F.expr("""transform(sequence(1, size(run)), k -> named_struct(
                'bits', bit_count(aggregate(slice(run, 1, k), 0L, (m, x) -> m | x.mask)),
                'low', array_min(transform(slice(run, 1, k), x -> x.low)), 'high', array_max(transform(slice(run, 1, k), x -> x.high))))"""))
            .withColumn("best", F.expr(f"""array_max(transform(filter(run, x -> x.high - x.low + 1 <= grams * {STRETCH}),
                x -> named_struct('bits', x.bits, 'less', x.low - x.high, 'low', x.low, 'high', x.high)))"""))
            .groupBy("row", "doc_id", "template", "span")
            .agg(F.first("label").alias("label"), F.first("grams").alias("grams"), F.max("best").alias("best"))
            .select("row", "doc_id", "template", "label", F.col("best.low").alias("low"), F.col("best.high").alias("high"),
                    (F.col("best.bits") / F.col("grams")).alias("coverage")).where(F.col("coverage") >= coverage))
    merged = merged.select(*part.columns).unionByName(part)
    return full.unionByName(merged.select("row", "doc_id", "template", "label", F.lit(False).alias("base"),
                                          F.col("low").alias("start"), (F.col("high") + 1).alias("stop"), "coverage"))


def scan(docs: DataFrame, templates=None, coverage: float = COVERAGE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and ``spans`` (array of template label, first
    and last word, coverage)."""
    templates = default_templates() if templates is None else templates
    # three parts below read the votes, so they are written once and the texts are cut into words once
    voted = stage(votes(docs, templates), "license-votes")
    texts = voted.where("template = -1").select("row", "doc_id", F.col("diagonal").alias("n_words"), "copies")
    found = spans(voted, templates, coverage).groupBy("row", "doc_id").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"), F.collect_set("label").alias("labels"),
        F.max("coverage").alias("score"), F.sort_array(F.collect_list(F.struct("start", "stop", "label", "coverage"))).alias("spans"))
    joined = lambda c: F.concat_ws(",", F.sort_array(F.coalesce(F.col(c), F.array().cast("array<string>"))))
    out = texts.join(found.withColumnRenamed("doc_id", "__id").withColumnRenamed("row", "__row"),
                     (F.col("row") == F.col("__row")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                      joined("base_labels").alias("base_labels"), joined("labels").alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"), "spans")


def _sql() -> str:
    rows = ", ".join(f"({t}, '{label}', {str(base).lower()}, {i}, '{a}', '{b}', {n})" for t, label, base, i, a, b, n in template_rows(default_templates()))
    return f"""
WITH tpl(template, label, base, tpos, g0, g1, grams) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
g AS (SELECT r, unnest(w[1:len(w) - 1]) AS a, unnest(w[2:]) AS b, unnest(range(0, len(w) - 1)) AS p FROM d WHERE len(w) > 1),
v AS (SELECT r, template, any_value(label) AS label, any_value(base) AS base, any_value(grams) AS grams, p - tpos AS diagonal,
        bit_or(1::BIGINT << tpos) AS mask, min(p) AS low, max(p) AS high
      FROM g JOIN tpl ON a = g0 AND b = g1 GROUP BY r, template, p - tpos),
base AS (SELECT r, label, true AS base, diagonal AS start, 1.0::DOUBLE AS coverage FROM v WHERE base AND bit_count(mask) = grams),
s1 AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= {GAP} THEN 0 ELSE 1 END AS fresh
       FROM v WHERE NOT base AND bit_count(mask) >= {SEED}),
s2 AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM s1),
m AS (SELECT r, any_value(label) AS label, false AS base, min(low) AS start, bit_count(bit_or(mask))::DOUBLE / any_value(grams) AS coverage,
        max(high) - min(low) + 1 AS n, any_value(grams) AS grams FROM s2 GROUP BY r, template, span),
-- a span that is too long stands for its best run of neighbouring diagonals that isn't
long AS (SELECT s2.* FROM s2 JOIN (SELECT r, template, span FROM s2 GROUP BY ALL HAVING max(high) - min(low) + 1 > any_value(grams) * {STRETCH}) USING (r, template, span)),
run AS (
  SELECT a.r, a.template, a.span, a.diagonal AS i, b.diagonal AS j, any_value(a.label) AS label, any_value(a.grams) AS grams,
    bit_count(bit_or(c.mask)) AS bits, min(c.low) AS low, max(c.high) AS high
  FROM long a JOIN long b ON a.r = b.r AND a.template = b.template AND a.span = b.span AND a.diagonal <= b.diagonal
  JOIN long c ON a.r = c.r AND a.template = c.template AND a.span = c.span AND c.diagonal BETWEEN a.diagonal AND b.diagonal
  GROUP BY a.r, a.template, a.span, a.diagonal, b.diagonal),
part AS (
  SELECT r, label, false AS base, low AS start, bits::DOUBLE / grams AS coverage FROM run WHERE high - low + 1 <= grams * {STRETCH}
  QUALIFY row_number() OVER (PARTITION BY r, template, span ORDER BY bits DESC, high - low, low DESC, high DESC) = 1),
f AS (SELECT * FROM base UNION ALL SELECT r, label, base, start, coverage FROM m WHERE coverage >= {COVERAGE} AND n <= grams * {STRETCH}
  UNION ALL SELECT * FROM part WHERE coverage >= {COVERAGE}),
x AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
        max(coverage) AS score FROM f GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(x.n_base, 0)::BIGINT AS n_base, x.first_word::BIGINT AS first_word,
  x.last_word::BIGINT AS last_word, coalesce(x.base_labels, '') AS base_labels, coalesce(x.labels, '') AS labels, coalesce(x.score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN x USING (r)
"""


@query("op5_license_diagonals", _sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")
