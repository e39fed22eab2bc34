"""Queries over history payloads, append logs and deletions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import history as H
from ..operators import typed_history as TH
from ..operators.log import AppendLog
from ..session import work_folder
from ..sources import model as M
from .oracle_base import with_model
from .registry import query

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TS_FMT = "%Y-%m-%d %H:%M:%S.%f"


def load_nested_history(spark, sf):
    """History with nested payloads: each event's record gives its attributes
    (one JSON text each, values of every JSON type, sub-attributes below); an
    update names one of them, a cleaning lists all before and, in reverse
    order, after.  Other actions keep their own payload."""
    li = M.table(spark, sf, "lineitem")
    m = F.pmod("l_partkey", F.lit(5))
    value = (F.when(m == 0, F.col("l_quantity").cast("bigint").cast("string")).when(m == 1, F.col("l_quantity").cast("decimal(12,2)").cast("string"))
             .when(m == 2, F.when(F.col("l_tax") >= 0.04, F.lit("true")).otherwise(F.lit("false")))
             .when(m == 3, F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('"'))).otherwise(F.lit("null")))
    subs = F.when(F.col("l_linenumber") == 3, F.format_string(', "subattributes": [{"key": "Depth", "value": %s}, {"key": "Sec", "value": %d}]',
                                                             F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.col("l_suppkey"))).otherwise(F.lit(""))
    attr = F.concat(F.lit('{"key": "Field '), F.col("l_linenumber").cast("string"), F.lit('", "value": '), value, subs, F.lit("}"))
    per = (li.select("l_orderkey", *M.POSITION_ORDER, attr.alias("a")).groupBy("l_orderkey")
           .agg(F.array_sort(F.collect_list(F.struct(*M.POSITION_ORDER, "a"))).alias("s"))
           .select(F.col("l_orderkey").alias("record_id"), F.transform("s", lambda x: x["a"]).alias("attrs")))
    h = M.load_history(spark, sf).select("history_id", "action", "user", "record_id", "ts", F.col("query").alias("props"))
    j = h.join(per, "record_id", "left")
    update = (F.col("action") == "updateRecord") & F.col("attrs").isNotNull()
    clean = (F.col("action") == "cleanRecord") & F.col("attrs").isNotNull()
    i = F.pmod("history_id", F.size("attrs")).cast("int")
    one = F.get("attrs", i)
    whole = lambda a: F.concat(F.lit("["), F.array_join(a, ", "), F.lit("]"))
    return j.select(
        "history_id", "action", "user", "record_id", "ts",
        F.when(update, F.concat(F.lit('{"attributesList.'), i.cast("string"), F.lit('": '), one, F.lit(', "review_status": "incomplete", "pages": [1, 2.5]}')))
         .otherwise(F.col("props")).alias("query"),
        F.when(update, F.concat(F.lit('{"was": {"deep": [{"at": '), one, F.lit("}]}}"))).alias("previous_state"),
        F.when(clean, whole(F.col("attrs"))).alias("attributesList_before"),
        F.when(clean, whole(F.reverse("attrs"))).alias("attributesList_after"))


_NESTED = """
, a AS (
  SELECT record_id, pos, '{"key": "Field ' || l_linenumber || '", "value": ' ||
    CASE l_partkey % 5 WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) WHEN 1 THEN CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR)
      WHEN 2 THEN CASE WHEN l_tax >= 0.04 THEN 'true' ELSE 'false' END WHEN 3 THEN '"' || l_returnflag || '"' ELSE 'null' END ||
    CASE WHEN l_linenumber = 3 THEN ', "subattributes": [{"key": "Depth", "value": ' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) ||
      '}, {"key": "Sec", "value": ' || l_suppkey || '}]' ELSE '' END || '}' AS js
  FROM (SELECT l_orderkey AS record_id, *, row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount) - 1 AS pos FROM lineitem)),
per AS (
  SELECT record_id, list(js ORDER BY pos) AS js, '[' || string_agg(js, ', ' ORDER BY pos) || ']' AS before,
    '[' || string_agg(js, ', ' ORDER BY pos DESC) || ']' AS after FROM a GROUP BY record_id),
payloads AS (
  SELECT h.history_id, h.record_id, h.action, h.ts, f.field,
    CASE f.field
      WHEN 'query' THEN CASE WHEN action = 'updateRecord' AND per.js IS NOT NULL THEN '{"attributesList.' || (history_id % len(per.js)) || '": ' ||
        per.js[history_id % len(per.js) + 1] || ', "review_status": "incomplete", "pages": [1, 2.5]}' ELSE h.query END
      WHEN 'previous_state' THEN CASE WHEN action = 'updateRecord' THEN '{"was": {"deep": [{"at": ' || per.js[history_id % len(per.js) + 1] || '}]}}' END
      WHEN 'attributesList_before' THEN CASE WHEN action = 'cleanRecord' THEN per.before END
      ELSE CASE WHEN action = 'cleanRecord' THEN per.after END END AS payload
  FROM history h LEFT JOIN per ON per.record_id = h.record_id,
    (VALUES ('query'), ('previous_state'), ('attributesList_before'), ('attributesList_after')) f(field)),
nodes AS (SELECT p.*, j.key, j.type, j.atom, j.id, j.parent, j.fullkey FROM payloads p, json_tree(p.payload) j WHERE p.payload IS NOT NULL),
objects AS (SELECT DISTINCT history_id, field, parent FROM nodes WHERE key = 'key'),
typed AS (
  SELECT n.history_id, n.record_id, n.action, n.ts, n.field, n.fullkey AS path,
    CASE WHEN type IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN type = 'DOUBLE' THEN 'float' WHEN type = 'BOOLEAN' THEN 'boolean'
         WHEN type = 'VARCHAR' THEN 'string' ELSE 'null' END AS leaf_type,
    CASE WHEN type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(atom AS DOUBLE) END AS value_num,
    CASE WHEN type IN ('VARCHAR', 'BOOLEAN') THEN atom ->> '$' END AS value_text,
    CASE WHEN key = 'value' AND o.parent IS NOT NULL AND (action = 'updateRecord' AND n.field IN ('query', 'previous_state')
              OR action = 'cleanRecord' AND n.field LIKE 'attributesList%')
         THEN CASE WHEN type IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN type = 'DOUBLE' THEN 'float' END END AS num_type
  FROM nodes n LEFT JOIN objects o ON o.history_id = n.history_id AND o.field = n.field AND o.parent = n.parent
  WHERE type NOT IN ('OBJECT', 'ARRAY'))
"""


@query("history_typed", with_model(_NESTED + """
SELECT history_id, record_id, action, field, path, leaf_type, value_num, value_text, num_type FROM typed
""", "history"), ops=("H2",))
def q_history_typed(spark, sf):
    return TH.typed_values(load_nested_history(spark, sf)).drop("ts")


HISTORY_RECORD = 7


@query("record_history_typed", with_model(_NESTED + f"""
, newest AS (SELECT history_id, row_number() OVER (ORDER BY ts DESC, history_id DESC) AS nth FROM history WHERE record_id = {HISTORY_RECORD})
SELECT n.nth, t.history_id, t.action, strftime(t.ts, '{SQL_TS_FMT}') AS ts, t.field, t.path, t.leaf_type, t.value_num, t.value_text, t.num_type
FROM typed t JOIN newest n ON n.history_id = t.history_id
""".replace("\n, newest", ",\nnewest"), "history"), ops=("H2", "O6"))
def q_record_history_typed(spark, sf):
    """One record's history, newest first, with its payloads' typed values."""
    rows = TH.record_history(load_nested_history(spark, sf), HISTORY_RECORD)
    rows = rows.withColumn("nth", F.row_number().over(Window.orderBy(F.col("ts").desc(), F.col("history_id").desc())).cast("long"))
    got = TH.typed_values(rows, keep=("nth", "history_id", "action", "ts"))
    return got.withColumn("ts", F.date_format("ts", TS_FMT))


# ---- append logs

_BULK_TS = "2024-05-06 07:08:09"


def _bulk(spark, sf, op, action):
    """H1 rows of a bulk change: one for each record that the edit batch touches with ``op``."""
    touched = M.load_edits(spark, sf).where(F.col("op") == op).groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    recs = M.load_records(spark, sf, with_attributes=False).select("record_id", F.col("record_group_id").alias("rg_id"))
    return H.history_rows(touched.join(recs, "record_id"), action, "bulk@example.org", F.lit(_BULK_TS).cast("timestamp"), {"n_edits": F.col("n")})


def _bulk_sql(line, action):
    return f"""SELECT '{action}' AS action, 'bulk@example.org' AS "user", r.record_id, r.record_group_id, '{_BULK_TS}.000000' AS ts, count(*) AS n_edits
FROM lineitem l JOIN recs r ON r.record_id = l.l_orderkey WHERE l_partkey % 50 = 0 AND l_linenumber % 3 = {line} GROUP BY r.record_id, r.record_group_id"""


@query("history_log", with_model("\nUNION ALL ".join([_bulk_sql(0, "updateRecord"), _bulk_sql(2, "deleteField")]), "recs"), ops=("H1", "S9"))
def q_history_log(spark, sf):
    """Two bulk changes appended to a history log.  The first is appended
    three times (a retry that failed before its commit, then a whole one), the
    second's first attempt held other rows, a third never commits."""
    replaced, inserted, deleted = (_bulk(spark, sf, op, a) for op, a in
                                   (("replace", "updateRecord"), ("insert", "insertField"), ("delete", "deleteField")))
    log = AppendLog(spark, work_folder(spark, "history"), replaced.schema)
    log.append(replaced, "bulk/1")
    log.append(inserted, "bulk/2")
    log.write(replaced, "bulk/1")
    log.append(replaced, "bulk/1")
    log.append(deleted, "bulk/2")
    log.write(inserted, "bulk/3")
    return log.read().withColumn("ts", F.date_format("ts", TS_FMT))


# ---- deletions

DELETED_BY = "admin@example.org"
DELETE_PROJECT, DELETE_GROUP = "3", "7"


def _deleted_rows(spark, out, tables):
    """(table_name, id, state, deleted_by); the archives come from logs that
    each got its batch twice."""
    rows = None
    for name, key in tables:
        gone = out[f"deleted_{name}"]
        log = AppendLog(spark, work_folder(spark, f"deleted-{name}"), gone.schema)
        for _ in range(2):
            log.append(gone, "deletion")
        for state, df in (("kept", out[name]), ("archived", log.read())):
            by = F.col("deleted_by") if state == "archived" else F.lit(None).cast("string")
            part = df.select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("id"), F.lit(state).alias("state"), by.alias("deleted_by"))
            rows = part if rows is None else rows.unionByName(part)
    return rows


def _deleted_sql(name, key, source, doomed):
    return (f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS id, CASE WHEN {doomed} THEN 'archived' ELSE 'kept' END AS state, "
            f"CASE WHEN {doomed} THEN '{DELETED_BY}' END AS deleted_by FROM {source}")


@query("delete_project_rows", with_model("\nUNION ALL ".join([
    _deleted_sql("records", "r.record_id", "recs r JOIN groups g ON g.record_group_id = r.record_group_id", f"g.project_id = '{DELETE_PROJECT}'"),
    _deleted_sql("record_groups", "record_group_id", "groups", f"project_id = '{DELETE_PROJECT}'"),
    _deleted_sql("projects", "project_id", "projects", f"project_id = '{DELETE_PROJECT}'"),
    f"SELECT 'team_projects', project_id, 'kept', NULL FROM projects WHERE team IS NOT NULL AND project_id <> '{DELETE_PROJECT}'"]),
    "recs", "groups", "projects"), ops=("D1", "D2", "S10"))
def q_delete_project_rows(spark, sf):
    out = H.delete_cascade(DELETE_PROJECT, M.load_projects(spark, sf), M.load_record_groups(spark, sf), M.load_records(spark, sf),
                           M.load_teams(spark, sf), DELETED_BY)
    links = out["teams"].select(F.lit("team_projects").alias("table_name"), F.explode("project_list").alias("id"), F.lit("kept").alias("state"),
                                F.lit(None).cast("string").alias("deleted_by"))
    return _deleted_rows(spark, out, (("records", "record_id"), ("record_groups", "record_group_id"), ("projects", "project_id"))).unionByName(links)


@query("delete_group_rows", with_model("\nUNION ALL ".join([
    _deleted_sql("records", "record_id", "recs", f"record_group_id = '{DELETE_GROUP}'"),
    _deleted_sql("record_groups", "record_group_id", "groups", f"record_group_id = '{DELETE_GROUP}'")]), "recs", "groups"), ops=("D3", "S10"))
def q_delete_group_rows(spark, sf):
    out = H.delete_group(DELETE_GROUP, M.load_record_groups(spark, sf), M.load_records(spark, sf), M.load_projects(spark, sf), DELETED_BY)
    return _deleted_rows(spark, out, (("records", "record_id"), ("record_groups", "record_group_id")))
