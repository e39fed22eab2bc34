"""Blank-page queries over page pixels derived from ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import images as I
from ..session import work_folder
from ..sources import model as M
from .registry import query

THRESHOLD = 150
MIN_PCT = 50.0

_PIXELS = """
WITH px AS (
  SELECT vec_id, i,
         CAST(least(greatest(round(CAST(embedding[3 * i + 1] AS DOUBLE) * 255.0 + 128.0), 0.0), 255.0) AS INTEGER) AS r,
         CAST(least(greatest(round(CAST(embedding[3 * i + 2] AS DOUBLE) * 255.0 + 128.0), 0.0), 255.0) AS INTEGER) AS g,
         CAST(least(greatest(round(CAST(embedding[3 * i + 3] AS DOUBLE) * 255.0 + 128.0), 0.0), 255.0) AS INTEGER) AS b
  FROM embeddings, range(0, 21) AS t(i)),
w AS (
  SELECT vec_id, count(*) AS total, count(*) FILTER (WHERE {cond}) AS white FROM px GROUP BY vec_id)
"""

_CONDS = {
    "all": "r >= {t} AND g >= {t} AND b >= {t}",
    "any": "r >= {t} OR g >= {t} OR b >= {t}",
    "mean": "(CAST(r AS DOUBLE) + g + b) / 3.0 >= {t}",
    "luma": "0.299 * CAST(r AS DOUBLE) + 0.587 * CAST(g AS DOUBLE) + 0.114 * CAST(b AS DOUBLE) >= {t}",
}


def _sql(mode: str, threshold: int = THRESHOLD, min_pct: float = MIN_PCT) -> str:
    cond = _CONDS[mode].format(t=f"{float(threshold)}")
    return _PIXELS.format(cond=cond) + f"""
SELECT vec_id, round(white * 100.0 / total, 4) AS whitespace_pct, round(100.0 - white * 100.0 / total, 4) AS ink_pct,
       total AS total_pixels, white AS white_pixels, white * 100.0 / total >= {min_pct} AS meets_threshold
FROM w
"""


def _spark(mode: str):
    def build(spark, sf):
        e = M.table(spark, sf, "embeddings")
        s = I.white_share(I.embedding_pixels(F.col("embedding")), mode, THRESHOLD, MIN_PCT)
        return e.select("vec_id", s["whitespace_pct"].alias("whitespace_pct"), s["ink_pct"].alias("ink_pct"),
                        s["total_pixels"].alias("total_pixels"), s["white_pixels"].alias("white_pixels"),
                        s["meets_threshold"].alias("meets_threshold"))
    return build


for _mode in I.REDUCTIONS:
    query(f"white_share_{_mode}", _sql(_mode), ops=("I1", "I2"))(_spark(_mode))


@query("record_whitespace", _PIXELS.format(cond=_CONDS["all"].format(t=f"{float(THRESHOLD)}")) + f"""
, s AS (SELECT vec_id // 3 AS record_id, vec_id % 3 AS pos, white * 100.0 / total AS pct FROM w)
SELECT record_id, count(*) AS n_pages, count(*) FILTER (WHERE pct >= {I.BLANK_MIN_PCT}) AS n_blank,
       string_agg(CAST(round(pct, 4) AS VARCHAR), '|' ORDER BY pos) AS scores
FROM s GROUP BY record_id
""", ops=("I3", "I1"))
def q_record_whitespace(spark, sf):
    e = M.table(spark, sf, "embeddings")
    pages = e.select((F.col("vec_id") / 3).cast("bigint").alias("record_id"), F.pmod("vec_id", F.lit(3)).alias("pos"),
                     I.white_share(I.embedding_pixels(F.col("embedding")), "all", THRESHOLD, I.BLANK_MIN_PCT)
                     .alias("score"))
    out = I.record_whitespace(pages)
    return out.select("record_id", F.size("image_whitespace").cast("bigint").alias("n_pages"),
                      F.col("n_blank").cast("bigint").alias("n_blank"),
                      F.array_join(F.transform("image_whitespace", lambda p: p["whitespace_pct"].cast("string")), "|")
                      .alias("scores"))


_FILE_SQL = _PIXELS.replace("FROM embeddings,", "FROM (SELECT * FROM embeddings WHERE vec_id % 29 <> 0) embeddings,")


def _file_pages(spark, sf):
    """Page files made of the embeddings' pixels, read by the image source; one in 29 is no image."""
    e = M.table(spark, sf, "embeddings")
    # pixels are a column of their own, made once a page: the bitmap names them many times
    px = e.select(F.col("vec_id").alias("page"), I.embedding_pixels(F.col("embedding")).alias("px"))
    data = F.when(F.pmod("page", F.lit(29)) == 0, F.lit("not an image").cast("binary")).otherwise(I.bitmap(F.col("px")))
    path = work_folder(spark, "pages")
    I.write_pages(px.select("page", data.alias("data")), path)
    return I.read_pages(spark, path)


def _file_query(mode: str):
    sql = _FILE_SQL.format(cond=_CONDS[mode].format(t=f"{float(THRESHOLD)}")) + f"""
SELECT e.vec_id, round(white * 100.0 / total, 4) AS whitespace_pct, total AS total_pixels, white AS white_pixels,
  coalesce(white * 100.0 / total >= {MIN_PCT}, false) AS meets_threshold
FROM embeddings e LEFT JOIN w ON w.vec_id = e.vec_id
"""

    @query(f"page_files_{mode}", sql, ops=("S6", "I1", "I2"))
    def build(spark, sf):
        s = I.image_white_share(F.col("image"), mode, THRESHOLD, MIN_PCT)
        got = _file_pages(spark, sf).select(F.col("page").cast("long").alias("vec_id"), s.alias("s"))
        return got.select("vec_id", *[F.col(f"s.{c}") for c in ("whitespace_pct", "total_pixels", "white_pixels", "meets_threshold")])


for _mode in ("all", "luma"):
    _file_query(_mode)
