"""Edit, status, notes, dimension-update, deletion and history queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import edits as ED
from ..operators import history as H
from ..sources import model as M
from .oracle_base import with_model
from .registry import query

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TS_FMT = "%Y-%m-%d %H:%M:%S.%f"

_EDIT_REC = """
, ed AS (
  SELECT record_id, pos AS seq,
         CASE l_linenumber % 3 WHEN 0 THEN 'replace' WHEN 1 THEN 'insert' ELSE 'delete' END AS op,
         pos AS idx, 'edited_' || CAST(l_partkey AS VARCHAR) AS payload
  FROM attrs WHERE l_partkey % 50 = 0),
ek AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY seq) AS k FROM ed),
base AS (
  SELECT record_id, list(key ORDER BY pos) AS keys, list(value ORDER BY pos) AS vals
  FROM attrs WHERE record_id IN (SELECT record_id FROM ed) GROUP BY record_id),
r AS (
  SELECT record_id, CAST(0 AS BIGINT) AS k, keys, vals, CAST(NULL AS VARCHAR) AS prev,
         CAST(NULL AS VARCHAR) AS op, CAST(NULL AS INTEGER) AS idx, CAST(NULL AS BIGINT) AS seq,
         false AS accepted
  FROM base
  UNION ALL
  SELECT r.record_id, r.k + 1,
    CASE WHEN e.op = 'insert' THEN list_concat(r.keys[1:e.idx + 1], [e.payload], r.keys[e.idx + 2:])
         WHEN e.op = 'delete' AND e.idx < len(r.keys) THEN list_concat(r.keys[1:e.idx], r.keys[e.idx + 2:])
         ELSE r.keys END,
    CASE WHEN e.op = 'insert' THEN list_concat(r.vals[1:e.idx + 1], [''], r.vals[e.idx + 2:])
         WHEN e.op = 'delete' AND e.idx < len(r.vals) THEN list_concat(r.vals[1:e.idx], r.vals[e.idx + 2:])
         WHEN e.op = 'replace' AND e.idx < len(r.vals) THEN list_concat(r.vals[1:e.idx], [e.payload], r.vals[e.idx + 2:])
         ELSE r.vals END,
    CASE WHEN e.op = 'replace' AND e.idx < len(r.vals) THEN r.vals[e.idx + 1] END,
    e.op, e.idx, e.seq, e.op = 'insert' OR e.idx < len(r.keys)
  FROM r JOIN ek e ON e.record_id = r.record_id AND e.k = r.k + 1)
"""


def _recursive(sql):
    return with_model(_EDIT_REC + sql, "attrs").replace("WITH ", "WITH RECURSIVE ", 1)


@query("apply_edits", _recursive("""
SELECT record_id, len(keys) AS n_attrs, array_to_string(keys, '|') AS key_seq, array_to_string(vals, '|') AS value_seq
FROM r WHERE k = (SELECT max(k) FROM r r2 WHERE r2.record_id = r.record_id)
"""), ops=("M1", "M2", "M3", "M8"))
def q_apply_edits(spark, sf):
    new, _ = ED.apply_edits(M.load_records(spark, sf), M.load_edits(spark, sf))
    a = F.col("attributes")
    return new.where("edited_now").select(
        "record_id", F.size(a).cast("bigint").alias("n_attrs"), F.array_join(a.getField("key"), "|").alias("key_seq"),
        F.array_join(a.getField("value"), "|").alias("value_seq"))


@query("edit_history", _recursive("""
SELECT record_id, seq, op, idx, prev AS previous_value FROM r WHERE k > 0 AND accepted
"""), ops=("M8",))
def q_edit_history(spark, sf):
    _, hist = ED.apply_edits(M.load_records(spark, sf), M.load_edits(spark, sf))
    return hist.select("record_id", "seq", "op", "idx", "previous_value")


@query("edit_rejections", _recursive("""
SELECT record_id, seq, op, idx, 'no attribute at that position' AS reason FROM r WHERE k > 0 AND NOT accepted
""").replace("pos AS idx", "CAST(pos + 2 AS INTEGER) AS idx"), ops=("M8",))
def q_edit_rejections(spark, sf):
    """The batch with every position two further on, so that some lie past the end."""
    edits = M.load_edits(spark, sf).withColumn("idx", F.col("idx") + 2)
    return ED.rejected_edits(M.load_records(spark, sf), edits).select("record_id", "seq", "op", "idx", "reason")


@query("reset_records", with_model("""
SELECT r.record_id,
       count(a.key) FILTER (WHERE NOT a.user_added) AS n_attrs,
       count(a.key) FILTER (WHERE NOT a.user_added AND a.l_linenumber = 3) * 2 AS n_subs,
       coalesce(string_agg(a.key, '|' ORDER BY a.pos) FILTER (WHERE NOT a.user_added), '') AS key_seq,
       'unreviewed' AS review_status, CAST(NULL AS VARCHAR) AS verification_status
FROM recs r LEFT JOIN attrs a ON a.record_id = r.record_id
GROUP BY r.record_id
""", "recs", "attrs"), ops=("M6",))
def q_reset_records(spark, sf):
    out = ED.reset_records(M.load_records(spark, sf))
    a = F.col("attributes")
    subs = F.aggregate(a, F.lit(0), lambda acc, x: acc + F.coalesce(F.size(x["subattributes"]), F.lit(0)))
    return out.select("record_id", F.size(a).cast("bigint").alias("n_attrs"), subs.cast("bigint").alias("n_subs"),
                      F.array_join(a.getField("key"), "|").alias("key_seq"), "review_status", "verification_status")


def load_status_changes(spark, sf):
    """Status changes derived from orders (every 13th record), one kind
    per ``o_orderkey % 5``: verification (without review status when
    also divisible by 3), incomplete, defective, reviewed (rejected),
    unreviewed (reset)."""
    o = M.table(spark, sf, "orders").where(F.pmod("o_orderkey", F.lit(13)) == 0)
    m = F.pmod("o_orderkey", F.lit(5))
    rs = (F.when(m == 0, F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.lit(None).cast("string"))
                 .otherwise(F.lit("reviewed")))
          .when(m == 1, F.lit("incomplete")).when(m == 2, F.lit("defective")).when(m == 3, F.lit("reviewed"))
          .otherwise(F.lit("unreviewed")))
    return o.select(F.col("o_orderkey").alias("record_id"), F.lit(1).alias("seq"),
                    F.when(m == 0, F.lit("verification_status")).otherwise(F.lit("review_status")).alias("update_type"),
                    rs.alias("review_status"),
                    F.when(m == 0, F.lit("verified")).alias("verification_status"),
                    F.when(m == 2, F.array(F.lit("stain"))).alias("defective_categories"),
                    F.when(m == 2, F.lit("water damage")).alias("defective_description"))


@query("status_edits", with_model("""
, ch AS (SELECT o_orderkey AS record_id, o_orderkey % 5 AS m, o_orderkey % 3 = 0 AS no_rs FROM orders
         WHERE o_orderkey % 13 = 0),
d AS (
  SELECT record_id, m,
         CASE m WHEN 0 THEN 'verification_status' ELSE 'review_status' END AS update_type,
         CASE m WHEN 0 THEN CASE WHEN no_rs THEN NULL ELSE 'reviewed' END WHEN 1 THEN 'incomplete'
                WHEN 2 THEN 'defective' WHEN 3 THEN 'reviewed' ELSE 'unreviewed' END AS new_rs
  FROM ch),
dec AS (
  SELECT *, CASE WHEN update_type = 'verification_status' AND new_rs IS NULL THEN 'verification_status needs review_status'
                 WHEN update_type = 'review_status' AND new_rs NOT IN ('unreviewed', 'incomplete', 'defective')
                      THEN 'invalid review_status' END AS reason
  FROM d)
SELECT dec.record_id, reason IS NULL AS accepted, reason,
       CASE WHEN reason IS NULL THEN new_rs ELSE r.review_status END AS review_status,
       CASE WHEN reason IS NULL AND m = 0 THEN 'verified'
            WHEN reason IS NULL AND m IN (1, 4) THEN NULL ELSE r.verification_status END AS verification_status,
       (SELECT count(*) FROM attrs a WHERE a.record_id = dec.record_id
          AND (m <> 4 OR reason IS NOT NULL OR NOT a.user_added)) AS n_attrs
FROM dec JOIN recs r ON r.record_id = dec.record_id
""", "recs", "attrs").replace("\n, ch AS", ",\nch AS"), ops=("M5", "M6"))
def q_status_edits(spark, sf):
    recs, dec = ED.status_edits(M.load_records(spark, sf), load_status_changes(spark, sf))
    return (dec.join(recs.select("record_id", "review_status", "verification_status",
                                 F.size("attributes").cast("bigint").alias("n_attrs")), "record_id")
               .select("record_id", "accepted", "reason", "review_status", "verification_status", "n_attrs"))


@query("notes_long", """
WITH c AS (
  SELECT conv_id AS record_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS idx,
         role, text
  FROM conversations),
n AS (SELECT *, role = 'assistant' AND idx > 0 AS is_reply FROM c)
SELECT n.record_id, n.idx, n.role AS creator, n.is_reply,
       CASE WHEN n.is_reply THEN n.idx - 1 END AS replies_to,
       coalesce((SELECT string_agg(CAST(m.idx AS VARCHAR), '|' ORDER BY m.idx) FROM n m
                 WHERE m.record_id = n.record_id AND m.is_reply AND m.idx - 1 = n.idx), '') AS replies,
       n.text
FROM n
""", ops=("M9",))
def q_notes_long(spark, sf):
    c = M.table(spark, sf, "conversations")
    per = c.groupBy(F.col("conv_id").alias("record_id")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_t"))
    ops = F.transform("_t", lambda t, i: F.struct(
        F.when((t["role"] == "assistant") & (i > 0), F.lit("reply")).otherwise(F.lit("add")).alias("op"),
        (i - 1).alias("target"), t["text"].alias("text"), t["role"].alias("user"),
        F.lit(None).cast("timestamp").alias("ts")))
    notes = per.select("record_id", ED.apply_note_edits(F.lit(None), ops).alias("notes"))
    return notes.select("record_id", F.inline("notes")).select(
        "record_id", "idx", "creator", "is_reply", "replies_to",
        F.array_join(F.transform("replies", lambda x: x.cast("string")), "|").alias("replies"), "text")


@query("upsert_groups", with_model("""
SELECT record_group_id,
       CASE WHEN CAST(record_group_id AS BIGINT) % 10 = 0 THEN name || ' (renamed)' ELSE name END AS name,
       CASE WHEN CAST(record_group_id AS BIGINT) % 20 = 0 THEN 'HOUSEHOLD' ELSE processor_id END AS processor_id,
       project_id
FROM groups
""", "groups"), ops=("M10",))
def q_upsert_groups(spark, sf):
    c = M.table(spark, sf, "customer").where(F.pmod("c_custkey", F.lit(10)) == 0)
    changes = c.select(F.col("c_custkey").cast("string").alias("record_group_id"),
                       F.concat("c_name", F.lit(" (renamed)")).alias("name"),
                       F.when(F.pmod("c_custkey", F.lit(20)) == 0, F.lit("HOUSEHOLD")).alias("processor_id"))
    out = ED.upsert_dimension(M.load_record_groups(spark, sf), changes, "record_group_id")
    return out.select("record_group_id", "name", "processor_id", "project_id")


DELETE_PROJECT = "3"


@query("delete_cascade", with_model(f"""
SELECT 'records' AS table_name,
       count(*) FILTER (WHERE g.project_id <> '{DELETE_PROJECT}') AS kept,
       count(*) FILTER (WHERE g.project_id = '{DELETE_PROJECT}') AS archived
FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
UNION ALL
SELECT 'record_groups', count(*) FILTER (WHERE project_id <> '{DELETE_PROJECT}'),
       count(*) FILTER (WHERE project_id = '{DELETE_PROJECT}') FROM groups
UNION ALL
SELECT 'projects', count(*) FILTER (WHERE project_id <> '{DELETE_PROJECT}'),
       count(*) FILTER (WHERE project_id = '{DELETE_PROJECT}') FROM projects
UNION ALL
SELECT 'team_projects', count(*) FILTER (WHERE p.project_id <> '{DELETE_PROJECT}'),
       count(*) FILTER (WHERE p.project_id = '{DELETE_PROJECT}')
FROM projects p WHERE p.team IS NOT NULL
""", "recs", "groups", "projects"), ops=("D1", "D2", "D3", "S10"))
def q_delete_cascade(spark, sf):
    teams = M.load_teams(spark, sf)
    out = H.delete_cascade(DELETE_PROJECT, M.load_projects(spark, sf), M.load_record_groups(spark, sf),
                           M.load_records(spark, sf, with_attributes=False), teams, "admin@example.org")

    def counts(name, kept, archived):
        k = kept.agg(F.count(F.lit(1)).alias("kept"))
        a = archived.agg(F.count(F.lit(1)).alias("archived"))
        return k.crossJoin(a).select(F.lit(name).alias("table_name"), "kept", "archived")

    tp_after = out["teams"].select(F.explode("project_list").alias("p"))
    tp_before = teams.select(F.explode("project_list").alias("p"))
    removed = tp_before.join(tp_after, "p", "left_anti")
    return (counts("records", out["records"], out["deleted_records"])
            .unionByName(counts("record_groups", out["record_groups"], out["deleted_record_groups"]))
            .unionByName(counts("projects", out["projects"], out["deleted_projects"]))
            .unionByName(counts("team_projects", tp_after, removed)))


@query("history_long", with_model("""
SELECT h.history_id, h.record_id, h.action, f.field, j.key AS path,
       CASE WHEN j.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(j.value AS DOUBLE) END AS value_num,
       CASE WHEN j.type = 'VARCHAR' THEN j.value ->> '$' END AS value_text,
       CASE WHEN h.action NOT IN ('updateRecord', 'cleanRecord') THEN NULL
            WHEN j.type IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN j.type = 'DOUBLE' THEN 'float' END AS num_type
FROM history h,
     (SELECT 'query' AS field UNION ALL SELECT 'previous_state') f,
     json_each(CASE f.field WHEN 'query' THEN h.query
                ELSE '{"key": "v", "value": ' || CAST(h.value AS VARCHAR) || '}' END) j
""", "history"), ops=("H2",))
def q_history_long(spark, sf):
    out = H.history_long(M.load_history(spark, sf))
    return out.select("history_id", "record_id", "action", "field", "path", "value_num", "value_text", "num_type")


@query("activity_summary", with_model(f"""
SELECT action, "user", count(*) AS n, strftime(min(ts), '{SQL_TS_FMT}') AS first_ts,
       strftime(max(ts), '{SQL_TS_FMT}') AS last_ts
FROM history GROUP BY action, "user"
""", "history"), ops=("H3", "O6"))
def q_activity_summary(spark, sf):
    out = H.activity_summary(M.load_history(spark, sf))
    return out.select("action", "user", "n", F.date_format("first_ts", TS_FMT).alias("first_ts"),
                      F.date_format("last_ts", TS_FMT).alias("last_ts"))


@query("record_history", with_model(f"""
SELECT history_id, record_id, action, strftime(ts, '{SQL_TS_FMT}') AS ts FROM history
ORDER BY ts DESC, history_id DESC
""", "history"), ops=("O6", "H2"))
def q_record_history(spark, sf):
    h = M.load_history(spark, sf)
    return (h.orderBy(F.col("ts").desc(), F.col("history_id").desc())
             .select("history_id", "record_id", "action", F.date_format("ts", TS_FMT).alias("ts")))



@query("coordinate_edits", with_model("""
SELECT record_id, pos AS attr_pos, CAST(l_linenumber AS INTEGER) AS page, CAST(4 AS INTEGER) AS n_coords,
       TRUE AS edited, 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS last_updated_user
FROM attrs WHERE l_partkey % 50 = 1
""", "attrs"), ops=("M4",))
def q_coordinate_edits(spark, sf):
    li = M.table(spark, sf, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(*M.POSITION_ORDER)
    pos = li.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))
    x = F.col("l_linenumber").cast("double") / 10.0
    edits = pos.where(F.pmod("l_partkey", F.lit(50)) == 1).select(
        F.col("l_orderkey").alias("record_id"), F.col("pos").alias("seq"), F.lit("coordinates").alias("op"),
        F.col("pos").alias("idx"), F.lit(None).cast("string").alias("payload"),
        M.user_email(F.col("l_suppkey")).alias("user"), F.col("l_shipdate").alias("ts"),
        F.array(F.array(x, F.lit(0.1)), F.array(x + 0.1, F.lit(0.1)), F.array(x + 0.1, F.lit(0.2)),
                F.array(x, F.lit(0.2))).alias("coords"),
        F.col("l_linenumber").cast("int").alias("page"))
    new, hist = ED.apply_edits(M.load_records(spark, sf), edits)
    touched = hist.select("record_id", F.col("idx").alias("attr_pos")).distinct()
    rows = new.where("edited_now").select("record_id", F.posexplode_outer("attributes").alias("attr_pos", "a")) \
        .where(F.col("a").isNotNull())
    return (rows.join(touched, ["record_id", "attr_pos"], "left_semi")
                .select("record_id", F.col("attr_pos").cast("int").alias("attr_pos"), F.col("a.page").alias("page"),
                        F.size("a.user_provided_coordinates").alias("n_coords"), F.col("a.edited").alias("edited"),
                        F.col("a.last_updated_user").alias("last_updated_user")))


_RECLEAN_REC = """
, ed AS (
  SELECT record_id, pos AS seq,
         CASE l_linenumber % 3 WHEN 0 THEN 'replace' WHEN 1 THEN 'insert' ELSE 'delete' END AS op,
         pos AS idx, 'edited_' || CAST(l_partkey AS VARCHAR) AS payload
  FROM attrs WHERE l_partkey % 50 = 0),
ek AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY seq) AS k FROM ed),
fns AS (
  SELECT r.record_id, s.name, s.cleaning_function FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
  JOIN processors p ON p.processor_id = g.processor_id CROSS JOIN schema s),
base AS (
  SELECT record_id, list(key ORDER BY pos) AS keys, list(coalesce(cleaning_error, '~') ORDER BY pos) AS errs
  FROM attrs WHERE record_id IN (SELECT record_id FROM ed) GROUP BY record_id),
r AS (
  SELECT record_id, CAST(0 AS BIGINT) AS k, keys, errs FROM base
  UNION ALL
  SELECT r.record_id, r.k + 1,
    CASE WHEN e.op = 'insert' THEN list_concat(r.keys[1:e.idx + 1], [e.payload], r.keys[e.idx + 2:])
         WHEN e.op = 'delete' AND e.idx < len(r.keys) THEN list_concat(r.keys[1:e.idx], r.keys[e.idx + 2:])
         ELSE r.keys END,
    CASE WHEN e.op = 'insert' THEN list_concat(r.errs[1:e.idx + 1], ['~'], r.errs[e.idx + 2:])
         WHEN e.op = 'delete' AND e.idx < len(r.errs) THEN list_concat(r.errs[1:e.idx], r.errs[e.idx + 2:])
         WHEN e.op = 'replace' AND e.idx < len(r.errs) THEN list_concat(r.errs[1:e.idx], [
              coalesce((SELECT CASE WHEN f.cleaning_function IS NULL OR f.cleaning_function = '' THEN '~'
                                    WHEN f.cleaning_function = 'llm_clean' THEN 'llm_clean: not available'
                                    ELSE f.cleaning_function || ': could not clean ''' || e.payload || '''' END
                        FROM fns f WHERE f.record_id = r.record_id AND f.name = r.keys[e.idx + 1]), r.errs[e.idx + 1])],
              r.errs[e.idx + 2:])
         ELSE r.errs END
  FROM r JOIN ek e ON e.record_id = r.record_id AND e.k = r.k + 1)
"""


@query("edit_reclean", with_model(_RECLEAN_REC + """
SELECT record_id, len(keys) AS n_attrs, array_to_string(errs, '|') AS error_seq
FROM r WHERE k = (SELECT max(k) FROM r r2 WHERE r2.record_id = r.record_id)
""", "recs", "attrs", "groups", "processors", "schema").replace("WITH ", "WITH RECURSIVE ", 1), ops=("M7", "C1"))
def q_edit_reclean(spark, sf):
    from ..operators.clean import schema_functions
    fns = schema_functions(M.load_record_groups(spark, sf), M.load_processors(spark, sf))
    new, _ = ED.apply_edits(M.load_records(spark, sf), M.load_edits(spark, sf), clean_with=fns)
    a = F.col("attributes")
    return new.where("edited_now").select(
        "record_id", F.size(a).cast("bigint").alias("n_attrs"),
        F.array_join(F.transform(a.getField("cleaning_error"), lambda e: F.coalesce(e, F.lit("~"))), "|")
        .alias("error_seq"))


# ---- whole attributes, whole lists, many changes a record, edits that must not pass

def _positions(spark, sf):
    """Line items with their position in the record."""
    w = Window.partitionBy("l_orderkey").orderBy(*M.POSITION_ORDER)
    return M.table(spark, sf, "lineitem").withColumn("pos", (F.row_number().over(w) - 1).cast("int"))


def load_whole_edits(spark, sf):
    """Attributes replaced as a whole (line 3: its second sub-attribute), one
    record in four at a position that doesn't exist."""
    li = _positions(spark, sf).where(F.pmod("l_partkey", F.lit(50)) == 2)
    key = F.concat(F.lit("New "), F.col("l_linenumber").cast("string"))
    value = F.concat(F.lit("w"), F.col("l_suppkey").cast("string"))
    sub = F.struct(*[{"key": F.lit("S"), "value": F.lit("x")}.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in ED.SUB_TYPE.fields])
    made = {"key": key, "value": value, "value_type": F.lit("string"), "edited": F.lit(True),
            "subattributes": F.when(F.col("l_linenumber") == 5, F.array(sub))}
    attr = F.struct(*[made.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in ED.ATTR_TYPE.fields]).cast(ED.ATTR_TYPE)
    return li.select(
        F.col("l_orderkey").alias("record_id"), F.col("pos").alias("seq"), F.lit("attribute").alias("op"),
        F.when(F.pmod("l_orderkey", F.lit(4)) == 0, F.col("pos") + 50).otherwise(F.col("pos")).alias("idx"),
        F.when(F.col("l_linenumber") == 3, 1).alias("sub_idx"), F.lit(None).cast("string").alias("payload"),
        M.user_email(F.col("l_suppkey")).alias("user"), F.col("l_shipdate").alias("ts"), attr.alias("attribute"),
        F.when(F.pmod("l_orderkey", F.lit(2)) == 1, F.lit("unreviewed")).otherwise(F.lit("reviewed")).alias("review_status"))


_WHOLE = """
, e AS (SELECT record_id, pos, l_linenumber, l_suppkey FROM attrs WHERE l_partkey % 50 = 2 AND record_id % 4 <> 0),
a AS (
  SELECT t.record_id, t.pos, e.pos IS NOT NULL AND t.l_linenumber <> 3 AS whole, e.pos IS NOT NULL AND t.l_linenumber = 3 AS sub,
    t.l_linenumber, t.l_suppkey, t.key, t.value FROM attrs t LEFT JOIN e ON e.record_id = t.record_id AND e.pos = t.pos),
b AS (
  SELECT record_id, pos, CASE WHEN whole THEN 'New ' || l_linenumber ELSE key END AS key, CASE WHEN whole THEN 'w' || l_suppkey ELSE value END AS value,
    CASE WHEN whole AND l_linenumber = 5 THEN 'S=x' WHEN whole OR l_linenumber <> 3 THEN ''
      ELSE 'Depth=' || (SELECT s.value FROM subs s WHERE s.record_id = a.record_id AND s.attr_pos = a.pos AND s.sub_pos = 0) ||
        CASE WHEN sub THEN ',New 3=w' || l_suppkey ELSE ',Sec=' || l_suppkey END END AS sub
  FROM a)
"""


@query("edit_whole_attribute", with_model(_WHOLE + """
SELECT b.record_id, any_value(CASE WHEN b.record_id % 2 = 1 AND b.record_id IN (SELECT record_id FROM e) THEN 'incomplete' ELSE r.review_status END) AS review_status,
  string_agg(b.key, '|' ORDER BY pos) AS key_seq, string_agg(b.value, '|' ORDER BY pos) AS value_seq, string_agg(b.sub, '|' ORDER BY pos) AS sub_seq
FROM b JOIN recs r ON r.record_id = b.record_id WHERE b.record_id IN (SELECT record_id FROM attrs WHERE l_partkey % 50 = 2) GROUP BY b.record_id
""", "recs", "subs"), ops=("M1",))
def q_edit_whole_attribute(spark, sf):
    new, _ = ED.apply_edits(M.load_records(spark, sf), load_whole_edits(spark, sf))
    a = F.col("attributes")
    subs = F.transform(a, lambda x: F.coalesce(F.array_join(F.transform(x["subattributes"], lambda s: F.concat_ws("=", s["key"], s["value"])), ","), F.lit("")))
    return new.where("edited_now").select(
        "record_id", "review_status", F.array_join(a.getField("key"), "|").alias("key_seq"),
        F.array_join(a.getField("value"), "|").alias("value_seq"), F.array_join(subs, "|").alias("sub_seq"))


@query("whole_attribute_history", with_model("""
SELECT record_id, pos AS seq, pos AS idx, CASE WHEN l_linenumber = 3 THEN 'Sec' ELSE key END AS previous_key,
  CASE WHEN l_linenumber = 3 THEN CAST(l_suppkey AS VARCHAR) ELSE value END AS previous_value
FROM attrs WHERE l_partkey % 50 = 2 AND record_id % 4 <> 0
""", "attrs"), ops=("M1", "M8"))
def q_whole_attribute_history(spark, sf):
    _, hist = ED.apply_edits(M.load_records(spark, sf), load_whole_edits(spark, sf))
    return hist.select("record_id", F.col("seq").cast("int").alias("seq"), "idx", F.get_json_object("previous_value", "$.key").alias("previous_key"),
                       F.get_json_object("previous_value", "$.value").alias("previous_value"))


def _list_changes(spark, sf):
    """Records whose list is replaced twice: by itself without its first
    element, then by that turned round with the last element given twice."""
    r = M.load_records(spark, sf).where(F.pmod("record_id", F.lit(13)) == 5).select("record_id", "attributes")
    rest = F.slice("attributes", 2, F.greatest(F.lit(1), F.size("attributes")))
    second = F.concat(F.reverse(rest), F.slice(rest, 1, 1))
    stamp = [F.lit("lists@example.org").alias("user"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("ts")]
    return r.select("record_id", F.lit(1).alias("seq"), rest.alias("attributes"), *stamp).unionByName(
        r.select("record_id", F.lit(2).alias("seq"), second.alias("attributes"), *stamp))


_LISTS = """
, l0 AS (SELECT record_id, list(pos ORDER BY pos) AS v, list(key ORDER BY pos) AS keys, list(value ORDER BY pos) AS vals
  FROM attrs WHERE record_id % 13 = 5 GROUP BY record_id),
l1 AS (SELECT record_id, keys, vals, v, v[2:] AS w, list_concat(list_reverse(v[2:]), v[2:2]) AS x FROM l0),
steps AS (SELECT record_id, 1 AS seq, v AS old, w AS new, keys, vals FROM l1 UNION ALL SELECT record_id, 2, w, x, keys, vals FROM l1),
pairs AS (SELECT *, CAST(unnest(range(0, greatest(len(old), len(new)))) AS INTEGER) AS idx FROM steps)
"""


@query("status_attributes_list", with_model(_LISTS + """
SELECT record_id, seq, idx, CASE WHEN idx >= len(old) THEN 'added' WHEN idx >= len(new) THEN 'removed' ELSE 'changed' END AS change,
  keys[old[idx + 1] + 1] AS before_key, vals[old[idx + 1] + 1] AS before_value, keys[new[idx + 1] + 1] AS after_key, vals[new[idx + 1] + 1] AS after_value
FROM pairs WHERE old[idx + 1] IS DISTINCT FROM new[idx + 1]
""", "attrs"), ops=("M5", "M8"))
def q_status_attributes_list(spark, sf):
    _, hist = ED.replace_lists(M.load_records(spark, sf), _list_changes(spark, sf))
    get = F.get_json_object
    return hist.select("record_id", F.col("seq").cast("int").alias("seq"), "idx", "change", get("before", "$.key").alias("before_key"), get("before", "$.value").alias("before_value"),
                       get("after", "$.key").alias("after_key"), get("after", "$.value").alias("after_value"))


@query("replaced_lists", with_model(_LISTS + """
SELECT r.record_id, CASE WHEN l1.record_id IS NULL THEN coalesce((SELECT string_agg(key, '|' ORDER BY pos) FROM attrs a WHERE a.record_id = r.record_id), '')
  ELSE array_to_string([keys[i + 1] FOR i IN x], '|') END AS key_seq
FROM recs r LEFT JOIN l1 ON l1.record_id = r.record_id
""", "recs", "attrs"), ops=("M5",))
def q_replaced_lists(spark, sf):
    new, _ = ED.replace_lists(M.load_records(spark, sf), _list_changes(spark, sf))
    return new.select("record_id", F.array_join(F.col("attributes").getField("key"), "|").alias("key_seq"))


@query("record_fields", with_model("""
, ch AS (SELECT record_id, pos AS seq, l_suppkey, l_linenumber FROM attrs),
last AS (
  SELECT record_id, arg_max('renamed ' || l_suppkey, seq) FILTER (WHERE l_linenumber <> 2) AS name, count(*) FILTER (WHERE l_linenumber <> 2) AS n_name,
    arg_max(struct_pack(d := CASE WHEN l_linenumber = 4 THEN NULL ELSE 'd' || l_suppkey END), seq) FILTER (WHERE l_linenumber IN (2, 4)).d AS d,
    count(*) FILTER (WHERE l_linenumber IN (2, 4)) AS n_d FROM ch GROUP BY record_id)
SELECT r.record_id, CASE WHEN n_name > 0 THEN l.name ELSE r.name END AS name, CASE WHEN n_d > 0 THEN l.d END AS defective_description
FROM recs r LEFT JOIN last l ON l.record_id = r.record_id
""", "recs", "attrs"), ops=("M5",))
def q_record_fields(spark, sf):
    """Every line item sets fields of its record: the name (not line 2), the
    description (line 2 a text, line 4 null)."""
    n = F.col("l_linenumber")
    supp = F.col("l_suppkey").cast("string")
    changes = _positions(spark, sf).select(
        F.col("l_orderkey").alias("record_id"), F.col("pos").alias("seq"), F.when(n != 2, F.concat(F.lit("renamed "), supp)).alias("name"),
        F.when(n == 2, F.concat(F.lit("d"), supp)).alias("defective_description"), n.isin(2, 4).alias("set_defective_description"))
    return ED.set_fields(M.load_records(spark, sf, with_attributes=False), changes).select("record_id", "name", "defective_description")


@query("edit_rejections_bad", with_model("""
SELECT record_id, pos AS seq, CASE WHEN record_id % 6 = 3 THEN NULL ELSE 'insert' END AS op,
  CASE record_id % 6 WHEN 0 THEN -2 WHEN 1 THEN -5 WHEN 2 THEN NULL ELSE pos END AS idx,
  CASE record_id % 6 WHEN 3 THEN 'unknown operation' WHEN 4 THEN 'no sub-attribute at that position' ELSE 'no attribute at that position' END AS reason
FROM attrs WHERE l_partkey % 50 = 0 AND record_id % 6 <> 5
""", "attrs"), ops=("M2", "M8"))
def q_edit_rejections_bad(spark, sf):
    """Negative and null positions, null operations, a negative sub-position."""
    m = F.pmod("l_orderkey", F.lit(6))
    edits = _positions(spark, sf).where(F.pmod("l_partkey", F.lit(50)) == 0).select(
        F.col("l_orderkey").alias("record_id"), F.col("pos").alias("seq"), F.when(m != 3, F.lit("insert")).alias("op"),
        F.when(m == 0, -2).when(m == 1, -5).when(m != 2, F.col("pos")).alias("idx"), F.when(m == 4, -1).alias("sub_idx"),
        F.lit("new").alias("payload"), F.lit("u").alias("user"), F.col("l_shipdate").alias("ts"))
    return ED.rejected_edits(M.load_records(spark, sf), edits).select("record_id", F.col("seq").cast("int").alias("seq"), "op", "idx", "reason")


def load_status_batches(spark, sf):
    """A status change for each line item, in list order, of every kind: two
    that don't hold (reviewed, no type at all) among them."""
    m = F.pmod("l_partkey", F.lit(6))
    return _positions(spark, sf).select(
        F.col("l_orderkey").alias("record_id"), F.col("pos").alias("seq"),
        F.when(m == 0, F.lit("verification_status")).when(m != 5, F.lit("review_status")).alias("update_type"),
        F.when(m == 1, F.lit("incomplete")).when(m == 2, F.lit("defective")).when(m == 4, F.lit("unreviewed")).otherwise(F.lit("reviewed")).alias("review_status"),
        F.when(m == 0, F.concat(F.lit("v"), F.col("l_suppkey").cast("string"))).alias("verification_status"),
        F.when(m == 2, F.array(F.lit("stain"))).alias("defective_categories"),
        F.when(m == 2, F.concat(F.lit("d"), F.col("l_suppkey").cast("string"))).alias("defective_description"))


@query("status_edits_multi", with_model("""
, ch AS (SELECT record_id, pos + 1 AS k, l_partkey % 6 AS m, l_suppkey FROM attrs),
f AS (
  SELECT record_id, CAST(0 AS BIGINT) AS k, review_status AS rs, verification_status AS vs, CAST(NULL AS VARCHAR) AS d, false AS reset FROM recs
  UNION ALL
  SELECT f.record_id, ch.k, CASE m WHEN 0 THEN 'reviewed' WHEN 1 THEN 'incomplete' WHEN 2 THEN 'defective' WHEN 4 THEN 'unreviewed' ELSE rs END,
    CASE m WHEN 0 THEN 'v' || l_suppkey WHEN 1 THEN NULL WHEN 4 THEN NULL ELSE vs END, CASE m WHEN 2 THEN 'd' || l_suppkey ELSE d END, reset OR m = 4
  FROM f JOIN ch ON ch.record_id = f.record_id AND ch.k = f.k + 1),
last AS (SELECT record_id, max(k) AS k FROM f GROUP BY record_id)
SELECT f.record_id, rs AS review_status, vs AS verification_status, d AS defective_description,
  (SELECT count(*) FROM attrs a WHERE a.record_id = f.record_id AND NOT (f.reset AND a.user_added)) AS n_attrs,
  coalesce((SELECT string_agg(a.value, '|' ORDER BY a.pos) FROM attrs a WHERE a.record_id = f.record_id AND NOT (f.reset AND a.user_added)), '') AS value_seq
FROM f JOIN last ON last.record_id = f.record_id AND last.k = f.k
""", "recs", "attrs").replace("WITH ", "WITH RECURSIVE ", 1), ops=("M5", "M6"))
def q_status_edits_multi(spark, sf):
    new, _ = ED.status_edits(M.load_records(spark, sf), load_status_batches(spark, sf))
    return new.select("record_id", "review_status", "verification_status", "defective_description", F.size("attributes").cast("bigint").alias("n_attrs"),
                      F.array_join(F.col("attributes").getField("value"), "|").alias("value_seq"))


@query("upsert_groups_multi", with_model("""
, ch AS (SELECT o_custkey AS k, max_by('g' || o_orderkey, o_orderkey) FILTER (WHERE o_orderkey % 3 <> 0) AS name,
  max_by(o_orderpriority, o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS processor_id FROM orders GROUP BY o_custkey)
SELECT g.record_group_id, coalesce(ch.name, g.name) AS name, coalesce(ch.processor_id, g.processor_id) AS processor_id, g.project_id
FROM groups g LEFT JOIN ch ON CAST(ch.k AS VARCHAR) = g.record_group_id
""", "groups"), ops=("M10",))
def q_upsert_groups_multi(spark, sf):
    """Many changes a group: each column takes its own last value."""
    k = F.col("o_orderkey")
    changes = M.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("record_group_id"), k.alias("seq"),
        F.when(F.pmod(k, F.lit(3)) != 0, F.concat(F.lit("g"), k.cast("string"))).alias("name"), F.when(F.pmod(k, F.lit(2)) == 0, F.col("o_orderpriority")).alias("processor_id"))
    return ED.upsert_dimension(M.load_record_groups(spark, sf), changes, "record_group_id").select("record_group_id", "name", "processor_id", "project_id")
