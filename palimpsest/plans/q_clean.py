"""Cleaning queries (C1-C3) and their flat SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import attrs as A
from ..operators import clean as CL
from ..sources import model as M
from .oracle_base import with_model
from .registry import query

# The oracle's cleaning rules, written in DuckDB SQL on their own.
_CLEAN_CTES = r"""
, items AS (
  SELECT a.record_id, a.pos AS attr_pos, CAST(NULL AS INTEGER) AS sub_pos, a.key, a.key AS lookup, a.value,
         a.cleaning_checked, a.cleaning_error
  FROM attrs a
  UNION ALL
  SELECT s.record_id, s.attr_pos, CAST(s.sub_pos AS INTEGER), s.key, s.top_level_attribute || '::' || s.key, s.value,
         s.cleaning_checked, s.cleaning_error
  FROM subs s),
fnmap AS (
  SELECT r.record_id, sc.name, sc.cleaning_function
  FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
  JOIN processors p ON p.processor_id = g.processor_id CROSS JOIN schema sc),
j AS (
  SELECT i.*, f.name IS NOT NULL AS in_schema, f.cleaning_function AS fn,
         lower(trim(i.value)) AS t, regexp_replace(i.value, '[\s,]', '', 'g') AS s, trim(i.value) AS tv
  FROM items i LEFT JOIN fnmap f ON f.record_id = i.record_id AND f.name = i.lookup),
n AS (
  SELECT j.*,
    CASE WHEN regexp_matches(s, '^([+-]?\d+)(\.0*)?[A-Za-z%"'']*$')
         THEN TRY_CAST(regexp_extract(s, '^([+-]?\d+)(\.0*)?[A-Za-z%"'']*$', 1) AS BIGINT) END AS int_v,
    CASE WHEN regexp_matches(s, '^([+-]?(\d+\.?\d*|\.\d+))[A-Za-z%"'']*$')
         THEN TRY_CAST(regexp_extract(s, '^([+-]?(\d+\.?\d*|\.\d+))[A-Za-z%"'']*$', 1) AS DOUBLE) END AS float_v,
    coalesce(
      CASE WHEN regexp_matches(tv, '^\d{4}-\d{2}-\d{2}$') THEN CAST(try_strptime(tv, '%Y-%m-%d') AS DATE) END,
      CASE WHEN regexp_matches(tv, '^\d{2}/\d{2}/\d{4}$') THEN CAST(try_strptime(tv, '%m/%d/%Y') AS DATE) END,
      CASE WHEN regexp_matches(tv, '^\d{4}/\d{2}/\d{2}$') THEN CAST(try_strptime(tv, '%Y/%m/%d') AS DATE) END) AS date_v,
    coalesce(
      CASE WHEN regexp_matches(tv, '^(\d+)[ -]+(\d+)/(\d+)"?$')
                AND TRY_CAST(regexp_extract(tv, '^(\d+)[ -]+(\d+)/(\d+)"?$', 3) AS DOUBLE) <> 0
           THEN TRY_CAST(regexp_extract(tv, '^(\d+)[ -]+(\d+)/(\d+)"?$', 1) AS DOUBLE)
              + TRY_CAST(regexp_extract(tv, '^(\d+)[ -]+(\d+)/(\d+)"?$', 2) AS DOUBLE)
              / TRY_CAST(regexp_extract(tv, '^(\d+)[ -]+(\d+)/(\d+)"?$', 3) AS DOUBLE) END,
      CASE WHEN regexp_matches(tv, '^(\d+)/(\d+)"?$')
                AND TRY_CAST(regexp_extract(tv, '^(\d+)/(\d+)"?$', 2) AS DOUBLE) <> 0
           THEN TRY_CAST(regexp_extract(tv, '^(\d+)/(\d+)"?$', 1) AS DOUBLE)
              / TRY_CAST(regexp_extract(tv, '^(\d+)/(\d+)"?$', 2) AS DOUBLE) END,
      CASE WHEN regexp_matches(tv, '^(\d+(\.\d+)?|\.\d+)"?$')
           THEN TRY_CAST(regexp_extract(tv, '^(\d+(\.\d+)?|\.\d+)"?$', 1) AS DOUBLE) END) AS hole_v
  FROM j),
v AS (
  SELECT n.*,
    CASE fn
      WHEN 'clean_bool' THEN CASE WHEN t IN ('yes', 'true', 't', 'y', '1', 'x') THEN 'true'
                                  WHEN t IN ('no', 'false', 'f', 'n', '0') THEN 'false' END
      WHEN 'string_to_int' THEN CAST(int_v AS VARCHAR)
      WHEN 'string_to_float' THEN regexp_replace(CAST(CAST(float_v AS DECIMAL(38,6)) AS VARCHAR), '\.?0+$', '')
      WHEN 'string_to_date' THEN strftime(date_v, '%Y-%m-%d')
      WHEN 'clean_date' THEN strftime(date_v, '%Y-%m-%d')
      WHEN 'convert_hole_size_to_decimal' THEN regexp_replace(CAST(CAST(hole_v AS DECIMAL(38,6)) AS VARCHAR), '\.?0+$', '')
    END AS new_value,
    CASE fn WHEN 'clean_bool' THEN 'bool' WHEN 'string_to_int' THEN 'int' WHEN 'string_to_float' THEN 'float'
            WHEN 'string_to_date' THEN 'date' WHEN 'clean_date' THEN 'string'
            WHEN 'convert_hole_size_to_decimal' THEN 'float' END AS new_type
  FROM n),
st AS (
  SELECT v.*,
    CASE WHEN NOT in_schema THEN 'skip'
         WHEN fn IS NULL OR fn = '' THEN 'none'
         WHEN fn NOT IN ('clean_bool', 'string_to_int', 'string_to_float', 'string_to_date', 'clean_date',
                         'convert_hole_size_to_decimal', 'llm_clean') THEN 'skip'
         WHEN value IS NULL OR trim(value) = '' THEN 'none'
         WHEN new_value IS NOT NULL THEN 'ok'
         ELSE 'error' END AS state
  FROM v),
cleaned AS (
  SELECT record_id, attr_pos, sub_pos, key,
         value AS value_before,
         CASE WHEN state = 'ok' THEN new_value ELSE value END AS value,
         CASE WHEN state = 'ok' THEN new_type ELSE 'string' END AS value_type,
         CASE WHEN state = 'skip' THEN FALSE ELSE state = 'ok' END AS cleaned,
         CASE WHEN state = 'skip' THEN cleaning_checked ELSE TRUE END AS cleaning_checked,
         CASE WHEN state = 'skip' THEN cleaning_error
              WHEN state = 'error' THEN CASE WHEN fn = 'llm_clean' THEN 'llm_clean: not available'
                                             ELSE fn || ': could not clean ''' || value || '''' END
              END AS cleaning_error
  FROM st)
"""

CLEAN_SQL = with_model(_CLEAN_CTES + """
SELECT record_id, attr_pos, sub_pos, key, value, value_type, cleaned, cleaning_checked, cleaning_error FROM cleaned
""", "recs", "subs", "groups", "processors", "schema")


def _cleaned_long(spark, sf):
    return CL.clean_long(M.load_records(spark, sf), M.load_record_groups(spark, sf), M.load_processors(spark, sf)) \
        .drop("record_group_id", "last_cleaned")


@query("clean_records", CLEAN_SQL, ops=("C1", "C2", "C3", "A7", "J6"))
def q_clean_records(spark, sf):
    return _cleaned_long(spark, sf).drop("value_before")


CLEAN_SUMMARY_SQL = with_model(_CLEAN_CTES + """
SELECT key, value_type, cleaned, coalesce(cleaning_error IS NOT NULL, FALSE) AS has_error, count(*) AS n
FROM cleaned GROUP BY ALL
""", "recs", "subs", "groups", "processors", "schema")


@query("clean_summary", CLEAN_SUMMARY_SQL, ops=("C2",))
def q_clean_summary(spark, sf):
    return (_cleaned_long(spark, sf)
            .groupBy("key", "value_type", "cleaned", F.coalesce(F.col("cleaning_error").isNotNull(), F.lit(False))
                     .alias("has_error"))
            .agg(F.count(F.lit(1)).alias("n")))


CLEAN_AUDIT_SQL = with_model(_CLEAN_CTES + """
SELECT record_id, attr_pos, sub_pos, key, value_before, value AS value_after
FROM cleaned WHERE value IS DISTINCT FROM value_before
""", "recs", "subs", "groups", "processors", "schema")


@query("clean_audit", CLEAN_AUDIT_SQL, ops=("C2", "H1"))
def q_clean_audit(spark, sf):
    # the nested form (C2 on the record arrays) with its before/after lists
    recs = M.load_records(spark, sf)
    # what cleaning and its lists read; records are shuffled to meet their groups
    recs = recs.select("record_id", "record_group_id", A.with_fields_only("attributes", "key", "value", "top_level_attribute").alias("attributes"))
    out = CL.clean_records(recs, M.load_record_groups(spark, sf), M.load_processors(spark, sf))
    z = F.arrays_zip(F.col("audit_before").alias("b"), F.col("audit_after").alias("a"))

    def rows(p, i):
        top = F.array(F.struct(i.alias("attr_pos"), F.lit(None).cast("int").alias("sub_pos"),
                               p["a"]["key"].alias("key"), p["b"]["value"].alias("value_before"),
                               p["a"]["value"].alias("value_after")))
        subs = F.transform(F.arrays_zip(p["b"]["subattributes"].alias("sb"), p["a"]["subattributes"].alias("sa")),
                           lambda q, j: F.struct(i.alias("attr_pos"), j.alias("sub_pos"), q["sa"]["key"].alias("key"),
                                                 q["sb"]["value"].alias("value_before"),
                                                 q["sa"]["value"].alias("value_after")))
        return F.concat(top, subs)

    long = out.select("record_id", F.inline_outer(F.flatten(F.transform(z, rows)))).where(F.col("attr_pos").isNotNull())
    return long.where(~F.col("value_before").eqNullSafe(F.col("value_after")))
