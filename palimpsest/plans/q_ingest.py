"""Ingest queries: extraction payloads (S4, E1), new records (E2), state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract as E
from ..operators import schema as SC
from ..sources import model as M
from .oracle_base import with_model
from .registry import query


@query("extract_attributes", with_model("""
SELECT a.record_id, a.pos AS attr_pos, a.key, a.value,
       CASE WHEN (a.l_partkey + a.l_linenumber) % 5 = 3 THEN replace(a.value, '-', '/') ELSE a.value END AS raw_text,
       a.ai_confidence, CAST(4 AS INTEGER) AS n_vertices,
       CAST(CASE WHEN a.l_linenumber = 3 THEN 2 ELSE 0 END AS INTEGER) AS n_subs,
       CASE WHEN a.l_linenumber = 3 THEN round(1.0 - a.l_tax, 2) END AS sub_confidence,
       CASE WHEN a.l_linenumber = 3 THEN a.ai_confidence END AS sub_ai_confidence
FROM attrs a WHERE a.record_id % 97 <> 0
""", "attrs"), ops=("S4", "E1", "Q-1"))
def q_extract_attributes(spark, sf):
    ex = E.extract_attributes(M.load_payloads(spark, sf))
    rows = ex.select("record_id", F.posexplode_outer("attributes").alias("attr_pos", "a")).where(F.col("a").isNotNull())
    sub0 = F.get(F.col("a.subattributes"), 0)
    return rows.select("record_id", F.col("attr_pos").cast("int").alias("attr_pos"), F.col("a.key").alias("key"),
                       F.col("a.value").alias("value"), F.col("a.raw_text").alias("raw_text"),
                       F.col("a.ai_confidence").alias("ai_confidence"),
                       F.size("a.normalized_vertices").alias("n_vertices"),
                       F.coalesce(F.size("a.subattributes"), F.lit(0)).alias("n_subs"),
                       sub0["confidence"].alias("sub_confidence"), sub0["ai_confidence"].alias("sub_ai_confidence"))


_NEW_SQL = """
, u AS (
  SELECT upload_id AS record_id, record_group_id, upload_name,
         regexp_matches(upload_name, '^.+\\.[^.]*$') AS has_ext, CAST(upload_id % 3 + 1 AS BIGINT) AS n_pages
  FROM uploads),
v AS (
  SELECT *, CASE WHEN has_ext THEN regexp_extract(upload_name, '^(.+)(\\.[^.]*)$', 1) ELSE upload_name END AS name,
            CASE WHEN has_ext THEN regexp_extract(upload_name, '^(.+)(\\.[^.]*)$', 2) ELSE '' END AS ext
  FROM u),
w AS (SELECT *, lower(ext) IN ('.pdf', '.tif', '.tiff') AS raster FROM v),
n AS (
  SELECT w.record_id, w.record_group_id, w.name,
         w.name || CASE WHEN raster THEN '.png' ELSE ext END AS filename,
         TRY_CAST(trim(split_part(w.name, '_', 1)) AS BIGINT) AS api_number,
         CASE WHEN raster THEN (SELECT string_agg(CASE WHEN k = 1 THEN w.name || '.png'
                                                       ELSE w.name || '_' || CAST(k AS VARCHAR) || '.png' END, '|' ORDER BY k)
                                FROM range(1, w.n_pages + 1) AS t(k))
              ELSE w.name || ext END AS image_files
  FROM w)
"""


def _new_records(spark, sf):
    up = M.load_uploads(spark, sf).select(
        F.col("upload_id").alias("record_id"), "record_group_id", "upload_name",
        (F.pmod("upload_id", F.lit(3)) + 1).cast("int").alias("n_pages"),
        F.lit("Supplier#000000001").alias("contributor"))
    return E.new_records(up)


@query("new_records", with_model(_NEW_SQL + """
SELECT record_id, record_group_id, name, filename, api_number, image_files, 'processing' AS status FROM n
""", "uploads").replace("\n, u AS", ",\nu AS"), ops=("E2", "P7", "P11", "Q-17"))
def q_new_records(spark, sf):
    n = _new_records(spark, sf)
    return n.select("record_id", "record_group_id", "name", "filename", "api_number",
                    F.array_join("image_files", "|").alias("image_files"), "status")


@query("assemble_records", with_model(_NEW_SQL + """
, cnt AS (SELECT record_id, count(*) AS n FROM attrs GROUP BY record_id)
SELECT n.record_id,
       CASE WHEN c.record_id IS NULL THEN 'processing' WHEN n.record_id % 97 = 0 THEN 'error' ELSE 'digitized' END AS status,
       CASE WHEN c.record_id IS NOT NULL AND n.record_id % 97 = 0 THEN 'unable to process document' END AS error_message,
       CASE WHEN c.record_id IS NOT NULL AND n.record_id % 97 <> 0 THEN c.n ELSE 0 END AS n_attrs
FROM n LEFT JOIN cnt c ON c.record_id = n.record_id
""", "uploads", "attrs").replace("\n, u AS", ",\nu AS").replace("\n, cnt AS", ",\ncnt AS"), ops=("E3", "E1", "S4"))
def q_assemble_records(spark, sf):
    ex = E.extract_attributes(M.load_payloads(spark, sf))
    out = E.assemble_records(_new_records(spark, sf), ex)
    return out.select("record_id", "status", "error_message", F.size("attributes").cast("bigint").alias("n_attrs"))


@query("extract_attributes_default", with_model("""
, proc AS (SELECT r.record_id, p.processor_id IS NULL AS general FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
           LEFT JOIN processors p ON p.processor_id = g.processor_id),
rows AS (
  SELECT a.record_id, a.pos AS attr_pos, a.key, a.value, a.ai_confidence FROM attrs a JOIN proc ON proc.record_id = a.record_id AND NOT general
  UNION ALL
  SELECT a.record_id, 0, 'Depth', CAST(CAST(a.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), round(1.0 - a.l_tax, 2)
  FROM attrs a JOIN proc ON proc.record_id = a.record_id AND general WHERE a.pos = 0 AND a.l_linenumber = 3
  UNION ALL
  SELECT a.record_id, 1, 'Sec', CAST(a.l_suppkey AS VARCHAR), round(1.0 - a.l_tax, 2)
  FROM attrs a JOIN proc ON proc.record_id = a.record_id AND general WHERE a.pos = 0 AND a.l_linenumber = 3)
SELECT CAST(record_id AS BIGINT) AS record_id, CAST(attr_pos AS INTEGER) AS attr_pos, key, value, ai_confidence FROM rows WHERE record_id % 97 <> 0
""", "attrs", "recs", "groups", "processors"), ops=("E1", "J7"))
def q_extract_attributes_default(spark, sf):
    """Records whose group has no processor of its own come from the general one."""
    groups = SC.resolve_processor(M.load_record_groups(spark, sf), M.load_processors(spark, sf)).select("record_group_id", "has_processor")
    recs = M.load_records(spark, sf, with_attributes=False).select("record_id", "record_group_id").join(groups, "record_group_id")
    ex = E.extract_attributes(M.load_payloads(spark, sf).join(recs, "record_id"), default_processor=~F.col("has_processor"))
    rows = ex.select("record_id", F.posexplode_outer("attributes").alias("attr_pos", "a")).where(F.col("a").isNotNull())
    return rows.select("record_id", F.col("attr_pos").cast("int").alias("attr_pos"), "a.key", "a.value", "a.ai_confidence")
