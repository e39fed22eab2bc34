"""Queries over record views: progress, flags, long form, filters, order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import attrs as A
from ..operators import filters as FL
from ..operators import order as O
from ..operators import scope as S
from ..operators import views as V
from ..sources import model as M
from .oracle_base import with_model
from .registry import query

ERR_STRICT = """
err_strict AS (
  SELECT DISTINCT record_id FROM (
    SELECT record_id FROM attrs WHERE cleaning_checked AND cleaning_error IS NOT NULL
    UNION ALL SELECT record_id FROM subs WHERE cleaning_checked AND cleaning_error IS NOT NULL)
),
err_lenient AS (
  SELECT DISTINCT record_id FROM (
    SELECT record_id FROM attrs WHERE length(cleaning_error) > 0
    UNION ALL SELECT record_id FROM subs WHERE length(cleaning_error) > 0)
)"""


def _err_ctes(sql: str) -> str:
    base = with_model("SELECT 1", "recs", "subs", "groups")
    head = base[: base.rindex("SELECT 1")].rstrip()
    return head + ",\n" + ERR_STRICT.strip() + "\n" + sql.strip()


GROUP_STATS_SQL = _err_ctes("""
SELECT r.record_group_id,
       count(*) AS total_amt,
       count(*) FILTER (WHERE r.review_status IN ('defective', 'reviewed')) AS reviewed_amt,
       count(e.record_id) AS error_amt
FROM recs r LEFT JOIN err_strict e ON e.record_id = r.record_id
GROUP BY r.record_group_id
""")


@query("group_stats", GROUP_STATS_SQL, ops=("S1", "F4", "A1"))
def q_group_stats(spark, sf):
    return V.group_stats(M.load_records(spark, sf))


GROUP_PROGRESS_SQL = _err_ctes("""
, stats AS (
  SELECT r.record_group_id, count(*) AS total_amt,
         count(*) FILTER (WHERE r.review_status IN ('defective', 'reviewed')) AS reviewed_amt,
         count(e.record_id) AS error_amt
  FROM recs r LEFT JOIN err_strict e ON e.record_id = r.record_id
  GROUP BY r.record_group_id)
SELECT g.record_group_id, g.name, g.project_id, g.processor_id, g.team,
       CAST(coalesce(s.total_amt, 0) AS BIGINT) AS total_amt,
       CAST(coalesce(s.reviewed_amt, 0) AS BIGINT) AS reviewed_amt,
       CAST(coalesce(s.error_amt, 0) AS BIGINT) AS error_amt
FROM groups g LEFT JOIN stats s ON s.record_group_id = g.record_group_id
""")


def group_progress(spark, sf):
    return V.group_progress(M.load_record_groups(spark, sf), M.load_records(spark, sf))


query("group_progress", GROUP_PROGRESS_SQL, ops=("J4", "A1", "F4"))(group_progress)


HAS_ERRORS_SQL = _err_ctes("""
SELECT r.record_id, r.record_group_id,
       (l.record_id IS NOT NULL) AS has_errors,
       (e.record_id IS NOT NULL) AS has_errors_strict
FROM recs r LEFT JOIN err_strict e ON e.record_id = r.record_id
            LEFT JOIN err_lenient l ON l.record_id = r.record_id
""")



@query("has_errors", HAS_ERRORS_SQL, ops=("F3", "F4", "Q-2"))
def q_has_errors(spark, sf):
    return V.record_flags(M.load_records(spark, sf))


ATTRIBUTES_LONG_SQL = with_model("""
SELECT a.record_id, r.record_group_id, a.pos AS attr_pos, CAST(NULL AS INTEGER) AS sub_pos, a.key, a.value,
       CAST(NULL AS VARCHAR) AS top_level_attribute, a.cleaning_checked, a.cleaning_error, a.edited, a.user_added
FROM attrs a JOIN recs r ON r.record_id = a.record_id
UNION ALL
SELECT s.record_id, r.record_group_id, s.attr_pos, CAST(s.sub_pos AS INTEGER), s.key, s.value,
       s.top_level_attribute, s.cleaning_checked, s.cleaning_error, FALSE, FALSE
FROM subs s JOIN recs r ON r.record_id = s.record_id
""", "recs", "subs")


@query("attributes_long", ATTRIBUTES_LONG_SQL, ops=("P10",))
def q_attributes_long(spark, sf):
    return V.attributes_long(M.load_records(spark, sf))


SCOPE_GROUPS_SQL = with_model("""
SELECT DISTINCT team, project_id, record_group_id FROM groups WHERE team IS NOT NULL
""", "groups")


@query("scope_groups", SCOPE_GROUPS_SQL, ops=("J1", "U1"))
def q_scope_groups(spark, sf):
    return S.scope_groups(M.load_teams(spark, sf), M.load_projects(spark, sf), M.load_record_groups(spark, sf))


# ---------------------------------------------------------------- filters
FILTER_SPEC = {
    "$and": [
        {"review_status": {"$in": ["reviewed", "defective"]}},
        {"attributesList": {"$elemMatch": {"key": "Field 7", "cleaning_error": "bad value"}}},
        {"$or": [{"api_number": {"$gte": 5000}}, {"name": {"$regex": "^scan_"}}]},
        {"verification_status": {"$ne": "required"}},
        {"attributesList.subattributes.key": {"$nin": ["Nope"]}},
    ]
}
FILTER_WHERE = """
r.review_status IN ('reviewed', 'defective')
AND EXISTS (SELECT 1 FROM attrs a WHERE a.record_id = r.record_id AND a.key = 'Field 7' AND a.cleaning_error = 'bad value')
AND (r.api_number >= 5000 OR regexp_matches(r.name, '^scan_'))
AND (r.verification_status IS NULL OR r.verification_status <> 'required')
"""


def filtered_records(spark, sf):
    recs = M.load_records(spark, sf)
    return recs.where(FL.record_filter(FILTER_SPEC, recs.schema))


@query("filter_records", with_model(f"SELECT r.record_id, r.record_group_id, r.review_status FROM recs r WHERE {FILTER_WHERE}",
                                    "recs", "attrs"), ops=("F1", "F2"))
def q_filter_records(spark, sf):
    return filtered_records(spark, sf).select("record_id", "record_group_id", "review_status")


@query("record_count", with_model(f"SELECT count(*) AS record_count FROM recs r WHERE {FILTER_WHERE}", "recs", "attrs"),
       ops=("A2",))
def q_record_count(spark, sf):
    return V.record_count(filtered_records(spark, sf))


FIRST_VALUE_SQL = with_model("""
SELECT r.record_id,
       coalesce((SELECT a.value FROM attrs a WHERE a.record_id = r.record_id AND a.key = 'T' ORDER BY a.pos LIMIT 1), '') AS first_t,
       (SELECT count(*) FROM attrs a WHERE a.record_id = r.record_id AND a.key = 'Field 7') AS n_field7
FROM recs r
""", "recs", "attrs")


@query("first_value", FIRST_VALUE_SQL, ops=("P4", "F2"))
def q_first_value(spark, sf):
    r = M.load_records(spark, sf)
    return r.select("record_id", A.first_value_of("T").alias("first_t"),
                    F.size(A.attrs_with_key("Field 7")).cast("bigint").alias("n_field7"))


LEADING_NUMBER_SQL = with_model("""
SELECT a.record_id, a.pos AS attr_pos, a.value,
       TRY_CAST(nullif(regexp_extract(a.value, '\\d+'), '') AS BIGINT) AS number
FROM attrs a
""", "attrs")


@query("leading_number", LEADING_NUMBER_SQL, ops=("P5",))
def q_leading_number(spark, sf):
    r = M.load_records(spark, sf)
    return (r.select("record_id", F.posexplode(F.arrays_zip(A.safe_attrs().getField("value"))).alias("attr_pos", "z"))
             .select("record_id", F.col("attr_pos").cast("int").alias("attr_pos"), F.col("z.value").alias("value"),
                     A.leading_number(F.col("z.value")).alias("number")))


HOIST_SQL = _err_ctes("""
, kv AS (
  SELECT record_id, pos AS attr_pos, -1 AS sub_pos, key, value FROM attrs
  UNION ALL SELECT record_id, attr_pos, sub_pos, key, value FROM subs),
last_kv AS (
  SELECT record_id, key, arg_max(value, attr_pos * 1000 + sub_pos) AS value
  FROM kv WHERE key IN ('T', 'Sec') GROUP BY record_id, key)
SELECT r.record_id,
       (l.record_id IS NOT NULL) AS has_errors,
       t.value AS "T", s.value AS "Sec"
FROM recs r
LEFT JOIN (SELECT DISTINCT record_id FROM (
    SELECT record_id FROM attrs WHERE length(cleaning_error) > 0
    UNION ALL SELECT record_id FROM subs WHERE length(cleaning_error) > 0)) l ON l.record_id = r.record_id
LEFT JOIN last_kv t ON t.record_id = r.record_id AND t.key = 'T'
LEFT JOIN last_kv s ON s.record_id = r.record_id AND s.key = 'Sec'
""")


@query("hoist_keys", HOIST_SQL, ops=("P6", "F3"))
def q_hoist_keys(spark, sf):
    r = M.load_records(spark, sf)
    return r.select("record_id", A.has_errors().alias("has_errors"), *A.hoist_keys(("T", "Sec")))


T_NUMBER = """
tnum AS (
  SELECT r.record_id, r.record_group_id, r.date_created,
         TRY_CAST(nullif(regexp_extract(coalesce(
            (SELECT a.value FROM attrs a WHERE a.record_id = r.record_id AND a.key = 'T' ORDER BY a.pos LIMIT 1), ''),
            '\\d+'), '') AS BIGINT) AS sort_key
  FROM recs r
)"""


def _tnum_sql(sql: str) -> str:
    base = with_model("SELECT 1", "recs", "attrs")
    head = base[: base.rindex("SELECT 1")].rstrip()
    return head + ",\n" + T_NUMBER.strip() + "\n" + sql.strip()


@query("sort_by_attribute", _tnum_sql("""
SELECT record_id, sort_key FROM tnum ORDER BY sort_key DESC NULLS LAST, record_id LIMIT 100
"""), ops=("O2", "P4", "P5", "O4"))
def q_sort_by_attribute(spark, sf):
    r = M.load_records(spark, sf)
    out = O.page_records(r, 0, 100, sort=("attributesList.T", -1))
    return out.select("record_id", O.sort_key("attributesList.T").alias("sort_key"))


@query("page_records", with_model("""
SELECT record_id, record_group_id, CAST(date_created AS DATE) AS created
FROM recs ORDER BY date_created DESC, record_id LIMIT 25 OFFSET 75
""", "recs"), ops=("O1", "O4"))
def q_page_records(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    out = O.page_records(r, 3, 25, sort=("dateCreated", -1))
    return out.select("record_id", "record_group_id", F.col("date_created").cast("date").alias("created"))


@query("sort_two_keys", with_model("""
SELECT record_id, review_status, name FROM recs
ORDER BY review_status, name, record_id LIMIT 40
""", "recs"), ops=("O3",))
def q_sort_two_keys(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    out = O.page_records(r, 0, 40, sort=("review_status", 1), secondary="name")
    return out.select("record_id", "review_status", "name")


RANK_SQL = _tnum_sql("""
SELECT record_id, record_group_id,
       row_number() OVER w AS rank,
       lag(record_id) OVER w AS prev_id,
       lead(record_id) OVER w AS next_id,
       first_value(record_id) OVER wf AS first_id,
       last_value(record_id) OVER wf AS last_id
FROM tnum
WINDOW w AS (PARTITION BY record_group_id ORDER BY sort_key ASC NULLS FIRST, record_id),
       wf AS (PARTITION BY record_group_id ORDER BY sort_key ASC NULLS FIRST, record_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")


@query("rank_records", RANK_SQL, ops=("W1", "O2"))
def q_rank_records(spark, sf):
    r = M.load_records(spark, sf)
    out = O.rank_records(r, ["record_group_id"], sort=("attributesList.T", 1))
    return out.select("record_id", "record_group_id", F.col("rank").cast("bigint").alias("rank"),
                      "prev_id", "next_id", "first_id", "last_id")


NAV_SQL = with_model("""
, nav AS (
SELECT record_id, record_group_id,
       row_number() OVER w AS rank,
       coalesce(lag(record_id) OVER w, last_value(record_id) OVER wf) AS prev_id,
       coalesce(lead(record_id) OVER w, first_value(record_id) OVER wf) AS next_id,
       first_value(record_id) OVER wf AS first_id,
       last_value(record_id) OVER wf AS last_id
FROM recs
WINDOW w AS (PARTITION BY record_group_id ORDER BY date_created ASC NULLS FIRST, record_id),
       wf AS (PARTITION BY record_group_id ORDER BY date_created ASC NULLS FIRST, record_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT * FROM nav
""", "recs").replace("\n, nav AS", ",\nnav AS")


@query("navigate_all", NAV_SQL, ops=("W2", "W1"))
def q_navigate_all(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    out = O.navigate_all(r, ["record_group_id"], sort=("dateCreated", 1))
    return out.select("record_id", "record_group_id", F.col("rank").cast("bigint").alias("rank"),
                      "prev_id", "next_id", "first_id", "last_id")


NAV_TARGET = 7


@query("navigate_target", NAV_SQL.replace("SELECT * FROM nav", f"SELECT * FROM nav WHERE record_id = {NAV_TARGET}"),
       ops=("W2",))
def q_navigate_target(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    out = O.navigate(r, NAV_TARGET, ["record_group_id"], sort=("dateCreated", 1))
    return out.select("record_id", "record_group_id", F.col("rank").cast("bigint").alias("rank"),
                      "prev_id", "next_id", "first_id", "last_id")


PROJECT_NESTED_SQL = with_model("""
SELECT r.record_id, r.name,
       coalesce((SELECT string_agg(a.key || '=' || a.value, '|' ORDER BY a.pos) FROM attrs a
                 WHERE a.record_id = r.record_id), '') AS attr_kv,
       coalesce((SELECT string_agg(s.key, '|' ORDER BY s.attr_pos, s.sub_pos) FROM subs s
                 WHERE s.record_id = r.record_id), '') AS sub_keys
FROM recs r
""", "recs", "subs")


@query("project_nested", PROJECT_NESTED_SQL, ops=("P1", "P2", "P3"))
def q_project_nested(spark, sf):
    from ..operators import extract as E
    r = E.project_records(M.load_records(spark, sf), top_level=["name"], attribute_fields=["key", "value", "subattributes"],
                          sub_fields=["key"])
    subs = F.flatten(F.transform("attributes", lambda a: a["subattributes"].getField("key")))
    return r.select("record_id", "name",
                    F.array_join(F.transform("attributes", lambda a: F.concat_ws("=", a["key"], a["value"])), "|")
                    .alias("attr_kv"),
                    F.array_join(subs, "|").alias("sub_keys"))


# ---- the list view as one lazy plan: scope -> filter -> sort -> rank -> page
TABLE_PROJECT = "5"
TABLE_SPEC = {"review_status": {"$in": ["reviewed", "defective", "incomplete"]}}


def _table_view_sql() -> str:
    base = with_model("SELECT 1", "recs", "subs", "groups")
    head = base[: base.rindex("SELECT 1")].rstrip()
    return head + ",\n" + T_NUMBER.strip() + """
, sel AS (
  SELECT t.record_id, t.sort_key FROM tnum t JOIN recs r ON r.record_id = t.record_id
  JOIN groups g ON g.record_group_id = r.record_group_id
  WHERE g.project_id = '5' AND r.review_status IN ('reviewed', 'defective', 'incomplete')),
ranked AS (
  SELECT record_id, row_number() OVER w AS rank, lag(record_id) OVER w AS prev_id, lead(record_id) OVER w AS next_id
  FROM sel WINDOW w AS (ORDER BY sort_key DESC NULLS LAST, record_id)),
kv AS (
  SELECT record_id, pos AS attr_pos, -1 AS sub_pos, key, value FROM attrs
  UNION ALL SELECT record_id, attr_pos, sub_pos, key, value FROM subs),
last_kv AS (
  SELECT record_id, key, arg_max(value, attr_pos * 1000 + sub_pos) AS value
  FROM kv WHERE key IN ('T', 'Sec') GROUP BY record_id, key),
lenient AS (
  SELECT DISTINCT record_id FROM (
    SELECT record_id FROM attrs WHERE length(cleaning_error) > 0
    UNION ALL SELECT record_id FROM subs WHERE length(cleaning_error) > 0))
SELECT k.record_id, k.rank, k.prev_id, k.next_id, (l.record_id IS NOT NULL) AS has_errors,
       t.value AS "T", s.value AS "Sec"
FROM ranked k LEFT JOIN lenient l ON l.record_id = k.record_id
LEFT JOIN last_kv t ON t.record_id = k.record_id AND t.key = 'T'
LEFT JOIN last_kv s ON s.record_id = k.record_id AND s.key = 'Sec'
WHERE k.rank > 20 AND k.rank <= 40
"""


@query("table_view", _table_view_sql(), ops=("F7", "F1", "O2", "W1", "O4", "F3", "P6"))
def q_table_view(spark, sf):
    recs = M.load_records(spark, sf)
    groups = S.groups_for("project", TABLE_PROJECT, M.load_teams(spark, sf), M.load_projects(spark, sf),
                          M.load_record_groups(spark, sf))
    sel = S.records_in_scope(recs, groups)
    sel = sel.where(FL.record_filter(TABLE_SPEC, sel.schema))
    page = O.ranked_page(sel, 20, 20, sort=("attributesList.T", -1))
    view = sel.select("record_id", A.has_errors().alias("has_errors"), *A.hoist_keys(("T", "Sec")))
    return page.join(view, "record_id").select("record_id", F.col("rank").cast("bigint").alias("rank"),
                                               "prev_id", "next_id", "has_errors", "T", "Sec")
