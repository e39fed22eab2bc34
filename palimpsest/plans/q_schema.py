"""Schema queries: catalogue, lookups, reconciliation, obsolete fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import schema as SC
from ..operators import views as V
from ..session import work_folder
from ..sources import model as M
from .oracle_base import with_model
from .registry import query


@query("column_catalog", with_model("""
SELECT g.project_id, s.name AS column_name, CAST(min(s.name_pos) AS INTEGER) AS first_pos,
       count(DISTINCT p.processor_id) AS n_processors
FROM (SELECT DISTINCT project_id, processor_id FROM groups) g
JOIN processors p ON p.processor_id = g.processor_id
CROSS JOIN schema s
GROUP BY g.project_id, s.name
""", "groups", "processors", "schema"), ops=("A3", "U2"))
def q_column_catalog(spark, sf):
    return V.column_catalog(M.load_record_groups(spark, sf), M.load_processors(spark, sf))


@query("schema_by_group", with_model("""
SELECT g.record_group_id, g.processor_id,
       count(s.name) AS n_fields,
       coalesce(string_agg(s.name, '|' ORDER BY s.name_pos), '') AS field_names
FROM groups g LEFT JOIN processors p ON p.processor_id = g.processor_id
LEFT JOIN schema s ON p.processor_id IS NOT NULL
GROUP BY g.record_group_id, g.processor_id
""", "groups", "processors", "schema"), ops=("J6",))
def q_schema_by_group(spark, sf):
    sg = SC.schema_by_group(M.load_record_groups(spark, sf), M.load_processors(spark, sf))
    return sg.select("record_group_id", "processor_id", F.size("schema").cast("bigint").alias("n_fields"),
                     F.array_join(F.col("schema").getField("name"), "|").alias("field_names"))


@query("resolve_processor", with_model("""
SELECT g.record_group_id,
       CASE WHEN p.processor_id IS NULL THEN 'default' ELSE p.processor_id END AS processor_id,
       CASE WHEN p.processor_id IS NULL THEN 'Default Processor' ELSE p.processor_id END AS processor_name,
       CASE WHEN p.processor_id IS NULL THEN NULL ELSE 'model-' || lower(p.processor_id) END AS model_id,
       p.processor_id IS NOT NULL AS has_processor
FROM groups g LEFT JOIN processors p ON p.processor_id = g.processor_id
""", "groups", "processors"), ops=("J7",))
def q_resolve_processor(spark, sf):
    return SC.resolve_processor(M.load_record_groups(spark, sf), M.load_processors(spark, sf))


@query("schema_map", with_model("""
SELECT p.processor_id, s.name, s.data_type, s.cleaning_function
FROM processors p CROSS JOIN schema s
""", "processors", "schema"), ops=("A7",))
def q_schema_map(spark, sf):
    m = SC.schema_map(M.load_processors(spark, sf))
    return m.select("processor_id", F.explode("schema_map").alias("name", "d")) \
            .select("processor_id", "name", F.col("d.data_type").alias("data_type"),
                    F.col("d.cleaning_function").alias("cleaning_function"))


@query("obsolete_counts", with_model("""
SELECT r.record_id, r.record_group_id,
       count(a.key) FILTER (WHERE a.key NOT IN (SELECT name FROM schema)) AS obsolete_count,
       count(a.key) FILTER (WHERE a.key NOT IN (SELECT name FROM schema)) >= 10 AS needs_review
FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
JOIN processors p ON p.processor_id = g.processor_id
LEFT JOIN attrs a ON a.record_id = r.record_id
GROUP BY r.record_id, r.record_group_id
""", "recs", "attrs", "groups", "processors", "schema"), ops=("A6",))
def q_obsolete_counts(spark, sf):
    sg = SC.schema_by_group(M.load_record_groups(spark, sf), M.load_processors(spark, sf)) \
        .where("has_processor").select("record_group_id", F.col("schema").getField("name").alias("names"))
    return V.obsolete_counts(M.load_records(spark, sf), sg)


# ---- reconciliation: the oracle walks the schema rows and the flat attrs
_RECON_BASE = """
, has_proc AS (
  SELECT r.record_id, p.processor_id IS NOT NULL AS hp
  FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
  LEFT JOIN processors p ON p.processor_id = g.processor_id),
old_seq AS (
  SELECT r.record_id, coalesce(string_agg(a.key, '|' ORDER BY a.pos), '') AS seq, count(a.key) AS n
  FROM recs r LEFT JOIN attrs a ON a.record_id = r.record_id GROUP BY r.record_id)
"""

RECON_READ_SQL = with_model(_RECON_BASE + """
, ordered AS (
  SELECT name, row_number() OVER (ORDER BY page_order_sort ASC NULLS LAST, name_pos) AS o
  FROM schema WHERE name NOT LIKE '%::%'),
items AS (
  SELECT h.record_id, o.o, a.pos, a.key, FALSE AS blank
  FROM has_proc h JOIN ordered o ON h.hp JOIN attrs a ON a.record_id = h.record_id AND a.key = o.name
  UNION ALL
  SELECT h.record_id, o.o, -1, o.name, TRUE
  FROM has_proc h JOIN ordered o ON h.hp
  WHERE NOT EXISTS (SELECT 1 FROM attrs a WHERE a.record_id = h.record_id AND a.key = o.name)),
new_seq AS (
  SELECT record_id, string_agg(key, '|' ORDER BY o, pos) AS seq, count(*) AS n, count(*) FILTER (WHERE blank) AS nb
  FROM items GROUP BY record_id)
SELECT h.record_id,
       CASE WHEN h.hp THEN n.n ELSE s.n END AS n_attrs,
       CASE WHEN h.hp THEN n.seq ELSE s.seq END AS key_seq,
       CASE WHEN h.hp THEN n.nb ELSE 0 END AS n_blank,
       CASE WHEN h.hp THEN n.seq <> s.seq ELSE FALSE END AS changed
FROM has_proc h JOIN old_seq s ON s.record_id = h.record_id LEFT JOIN new_seq n ON n.record_id = h.record_id
""", "recs", "attrs", "groups", "processors", "schema")


def _recon_out(df, blank_col):
    a = F.col("attributes")
    return df.select("record_id", F.size(a).cast("bigint").alias("n_attrs"),
                     F.array_join(a.getField("key"), "|").alias("key_seq"),
                     F.size(F.filter(a, blank_col)).cast("bigint").alias("n_blank"),
                     "changed")


@query("reconcile_read", RECON_READ_SQL, ops=("R2", "J12", "O7", "J6"))
def q_reconcile_read(spark, sf):
    out = SC.reconcile(M.load_records(spark, sf), M.load_record_groups(spark, sf), M.load_processors(spark, sf),
                       mode="read")
    return _recon_out(out, lambda x: x["ai_confidence"].isNull())


RECON_INGEST_SQL = with_model(_RECON_BASE + """
, items AS (
  SELECT h.record_id, 0 AS part, s.name_pos AS o, a.pos, a.key, FALSE AS blank
  FROM has_proc h JOIN schema s ON h.hp JOIN attrs a ON a.record_id = h.record_id AND a.key = s.name
  UNION ALL
  SELECT h.record_id, 0, s.name_pos, -1, s.name, TRUE
  FROM has_proc h JOIN schema s ON h.hp
  WHERE s.name NOT LIKE '%::%'
    AND NOT EXISTS (SELECT 1 FROM attrs a WHERE a.record_id = h.record_id AND a.key = s.name)
  UNION ALL
  SELECT h.record_id, 1, min(a.pos) OVER (PARTITION BY a.record_id, a.key), a.pos, a.key, FALSE
  FROM has_proc h JOIN attrs a ON a.record_id = h.record_id AND h.hp
  WHERE a.key NOT IN (SELECT name FROM schema)),
new_seq AS (
  SELECT record_id, string_agg(key, '|' ORDER BY part, o, pos) AS seq, count(*) AS n,
         count(*) FILTER (WHERE blank) AS nb
  FROM items GROUP BY record_id)
SELECT h.record_id,
       CASE WHEN h.hp THEN n.n ELSE s.n END AS n_attrs,
       CASE WHEN h.hp THEN n.seq ELSE s.seq END AS key_seq,
       CASE WHEN h.hp THEN n.nb ELSE 0 END AS n_blank,
       CASE WHEN h.hp THEN n.seq <> s.seq ELSE FALSE END AS changed
FROM has_proc h JOIN old_seq s ON s.record_id = h.record_id LEFT JOIN new_seq n ON n.record_id = h.record_id
""", "recs", "attrs", "groups", "processors", "schema")


@query("reconcile_ingest", RECON_INGEST_SQL, ops=("R1", "J12"))
def q_reconcile_ingest(spark, sf):
    out = SC.reconcile(M.load_records(spark, sf), M.load_record_groups(spark, sf), M.load_processors(spark, sf),
                       mode="ingest")
    return _recon_out(out, lambda x: x["ai_confidence"].isNull())



def _schema_files(spark, sf, fmt: str) -> str:
    """Write each processor's schema as the upload files the reference
    accepts (CSV with the legacy headers, or a JSON list of objects) under
    the checkpoint directory, and return the folder."""
    rows = M.load_processors(spark, sf).select("processor_id", F.posexplode("attributes").alias("pos", "a"))
    path = work_folder(spark, f"schema-files-{fmt}")
    if fmt == "csv":
        out = rows.select("processor_id", F.col("a.name").alias("Name"),
                          F.col("a.data_type").alias("Google Data Type"),
                          F.col("a.database_data_type").alias("Database Data Type"),
                          F.col("a.page_order_sort").cast("string").alias("Page Order Sort"),
                          F.col("a.cleaning_function").alias("Cleaning Function"))
        out.write.partitionBy("processor_id").option("header", True).csv(path)
    else:
        # one JSON array per processor, as a schema upload file holds
        objs = rows.groupBy("processor_id").agg(F.to_json(F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "a"))), lambda x: x["a"])).alias("value"))
        objs.select("processor_id", "value").write.partitionBy("processor_id").text(path)
    return path


_SCHEMA_FILE_SQL = with_model("""
SELECT p.processor_id, s.name, s.data_type, s.page_order_sort, s.cleaning_function
FROM processors p CROSS JOIN schema s
""", "processors", "schema")


@query("read_schema_csv", _SCHEMA_FILE_SQL, ops=("S2", "P12"))
def q_read_schema_csv(spark, sf):
    path = _schema_files(spark, sf, "csv")
    return SC.read_schema_csv(spark, path).select("processor_id", "name", "data_type", "page_order_sort",
                                                  "cleaning_function")


@query("read_schema_json", _SCHEMA_FILE_SQL, ops=("S3",))
def q_read_schema_json(spark, sf):
    path = _schema_files(spark, sf, "json")
    return SC.read_schema_json(spark, path).select("processor_id", "name", "data_type", "page_order_sort",
                                                   "cleaning_function")


def load_schema_edits(spark, sf, one_in=97):
    """A batch of schema edits derived from ``part`` (one part in ``one_in``):
    processor by ``(p_partkey / 97) % 4``; op by ``p_size % 3`` -- add a
    new field (database type missing when ``p_size`` is odd), delete a
    field (one of ten names, one of which does not exist), update a field
    (drop its cleaning function and set an alias; an unknown field name
    when ``p_partkey % 7 = 0``)."""
    p = M.table(spark, sf, "part").where(F.pmod("p_partkey", F.lit(one_in)) == 0)
    segs = F.array(*[F.lit(x) for x in M.PROCESSOR_SEGMENTS])
    names = F.array(*[F.lit(r[0]) for r in M.SCHEMA_ROWS], F.lit("Field 8"))
    m = F.pmod("p_size", F.lit(3))
    k = F.col("p_partkey")
    add_fields = F.create_map(F.lit("data_type"), F.lit("text"), F.lit("database_data_type"),
                              F.when(F.pmod("p_size", F.lit(2)) == 0, F.lit("varchar")).otherwise(F.lit("")))
    upd_fields = F.when(F.pmod(k, F.lit(7)) == 0, F.create_map(F.lit("bogus"), F.lit("x"))) \
        .otherwise(F.create_map(F.lit("cleaning_function"), F.lit(""), F.lit("alias"), F.col("p_brand")))
    return p.select(
        F.element_at(segs, (F.pmod((k / 97).cast("bigint"), F.lit(4)) + 1).cast("int")).alias("processor_id"),
        k.alias("seq"),
        F.when(m == 0, F.lit("add")).when(m == 1, F.lit("delete")).otherwise(F.lit("update")).alias("op"),
        F.when(m == 0, F.concat(F.lit("Field "), (F.lit(10) + F.pmod(k, F.lit(3))).cast("string")))
         .when(m == 1, F.element_at(names, (F.pmod(k, F.lit(10)) + 1).cast("int")))
         .otherwise(F.element_at(names, (F.pmod(k, F.lit(9)) + 1).cast("int"))).alias("name"),
        F.when(m == 0, add_fields).when(m == 2, upd_fields)
         .otherwise(F.create_map().cast("map<string,string>")).alias("fields"))


def _schema_rows(spark, sf):
    return M.load_processors(spark, sf).select("processor_id", F.posexplode("attributes").alias("pos", "a")) \
        .select("processor_id", F.col("pos").cast("int").alias("pos"), "a.*")


_SCHEMA_EDITS_SQL = """
, sch AS (
  SELECT p.processor_id, CAST(s.name_pos AS INTEGER) AS pos, s.name, CAST(NULL AS VARCHAR) AS alias, s.data_type,
         CASE WHEN s.data_type = 'table' THEN 'table' ELSE 'varchar' END AS database_data_type,
         s.page_order_sort, s.cleaning_function
  FROM processors p CROSS JOIN schema s),
ed0 AS (
  SELECT p_partkey AS seq,
         (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'])[(p_partkey // 97) % 4 + 1] AS processor_id,
         CASE p_size % 3 WHEN 0 THEN 'add' WHEN 1 THEN 'delete' ELSE 'update' END AS op,
         CASE p_size % 3 WHEN 0 THEN 'Field ' || CAST(10 + p_partkey % 3 AS VARCHAR)
              WHEN 1 THEN (['T', 'Sec', 'Field 3', 'Field 4', 'Field 5', 'Field 6', 'Field 9', 'Field 3::Depth',
                            'Field 3::Sec', 'Field 8'])[p_partkey % 10 + 1]
              ELSE (['T', 'Sec', 'Field 3', 'Field 4', 'Field 5', 'Field 6', 'Field 9', 'Field 3::Depth',
                     'Field 3::Sec'])[p_partkey % 9 + 1] END AS name,
         p_size % 2 = 0 AS has_dbt, p_partkey % 7 = 0 AS bogus, p_brand
  FROM part WHERE p_partkey % 97 = 0),
ed AS (SELECT *, row_number() OVER (PARTITION BY processor_id ORDER BY seq) AS k FROM ed0),
f AS (
  SELECT processor_id, CAST(0 AS BIGINT) AS k, max(pos) + 1 AS next_pos, list(struct_pack(pos := pos, name := name, alias := alias,
           data_type := data_type, dbt := database_data_type, po := page_order_sort, cf := cleaning_function) ORDER BY pos) AS fields,
         CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS op, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS reason
  FROM sch GROUP BY processor_id
  UNION ALL
  SELECT processor_id, k, CASE WHEN reason IS NULL AND op = 'add' THEN next_pos + 1 ELSE next_pos END,
    CASE WHEN reason IS NOT NULL THEN fields
         WHEN op = 'add' THEN list_concat(fields, [struct_pack(pos := next_pos, name := name, alias := CAST(NULL AS VARCHAR),
           data_type := 'text', dbt := 'varchar', po := CAST(NULL AS DOUBLE), cf := CAST(NULL AS VARCHAR))])
         WHEN op = 'delete' THEN [x FOR x IN fields IF x.name <> name]
         ELSE [CASE WHEN x.name = name THEN struct_pack(pos := x.pos, name := x.name, alias := p_brand, data_type := x.data_type,
           dbt := x.dbt, po := x.po, cf := CAST(NULL AS VARCHAR)) ELSE x END FOR x IN fields] END,
    seq, op, name, reason
  FROM (
    SELECT f.processor_id, e.k, f.next_pos, f.fields, e.seq, e.op, e.name, e.p_brand,
      CASE WHEN e.op = 'add' AND list_contains([x.name FOR x IN f.fields], e.name) THEN 'name already exists'
           WHEN e.op = 'add' AND NOT e.has_dbt THEN 'data_type and database_data_type are required'
           WHEN e.op <> 'add' AND NOT list_contains([x.name FOR x IN f.fields], e.name) THEN 'no attribute with that name'
           WHEN e.op = 'update' AND e.bogus THEN 'field not allowed' END AS reason
    FROM f JOIN ed e ON e.processor_id = f.processor_id AND e.k = f.k + 1))
"""


def _schema_edits_sql(select: str, one_in: int = 97) -> str:
    sql = with_model(_SCHEMA_EDITS_SQL.replace("p_partkey % 97 = 0", f"p_partkey % {one_in} = 0") + select, "processors", "schema")
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


_EDITED_ROWS = """
SELECT processor_id, x.pos AS pos, x.name AS name, x.alias AS alias, x.data_type AS data_type, x.dbt AS database_data_type,
       x.po AS page_order_sort, x.cf AS cleaning_function
FROM (SELECT processor_id, unnest(fields) AS x FROM f WHERE k = (SELECT max(k) FROM f g WHERE g.processor_id = f.processor_id))
"""
_EDITED_COLS = ["processor_id", "pos", "name", "alias", "data_type", "database_data_type", "page_order_sort", "cleaning_function"]


@query("apply_schema_edits", _schema_edits_sql(_EDITED_ROWS), ops=("R3", "U3"))
def q_apply_schema_edits(spark, sf):
    new, _ = SC.apply_schema_edits(_schema_rows(spark, sf), load_schema_edits(spark, sf))
    return new.select(*_EDITED_COLS)


@query("apply_schema_edits_multi", _schema_edits_sql(_EDITED_ROWS, 5), ops=("R3", "U3"))
def q_apply_schema_edits_multi(spark, sf):
    """Many edits a name: re-added, updated twice, updated once deleted."""
    new, _ = SC.apply_schema_edits(_schema_rows(spark, sf), load_schema_edits(spark, sf, 5))
    return new.select(*_EDITED_COLS)


_REJECTED = """
SELECT processor_id, seq, op, name, reason FROM f WHERE reason IS NOT NULL
"""


@query("schema_edit_rejections_multi", _schema_edits_sql(_REJECTED, 5), ops=("R3", "U3"))
def q_schema_edit_rejections_multi(spark, sf):
    _, rej = SC.apply_schema_edits(_schema_rows(spark, sf), load_schema_edits(spark, sf, 5))
    return rej.select("processor_id", "seq", "op", "name", "reason")


@query("schema_edit_rejections", _schema_edits_sql(_REJECTED), ops=("R3", "U3"))
def q_schema_edit_rejections(spark, sf):
    _, rej = SC.apply_schema_edits(_schema_rows(spark, sf), load_schema_edits(spark, sf))
    return rej.select("processor_id", "seq", "op", "name", "reason")


# ---- many processors: one a customer, edits by orders

def _customer_schema(spark, sf):
    """Each customer's processor: one to seven fields."""
    c = M.table(spark, sf, "customer")
    rows = c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("processor_id"),
                    F.explode(F.sequence(F.lit(0), F.pmod("c_custkey", F.lit(7)).cast("int"))).alias("pos"))
    text = F.lit(None).cast("string")
    return rows.select("processor_id", "pos", F.concat(F.lit("F"), F.col("pos").cast("string")).alias("name"), text.alias("alias"),
                       F.lit("text").alias("data_type"), F.lit("varchar").alias("database_data_type"), text.alias("occurrence"), text.alias("grouping"),
                       F.col("pos").cast("double").alias("page_order_sort"), F.lit("clean_date").alias("cleaning_function"))


def load_order_schema_edits(spark, sf):
    """An edit an order, to its customer's processor: adds (some by a name of
    their own, some without types, some with an order that is no number),
    deletes, updates (some of fields that don't exist), renames, operations
    that don't exist, edits without a name, processors that don't exist."""
    o = M.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    fifth = (k - F.pmod(k, F.lit(5))) / 5
    nth = lambda d: F.concat(F.lit("F"), F.pmod(F.floor(k / d), F.lit(9)).cast("string"))
    m = F.pmod(k, F.lit(5))
    when = lambda mod: F.pmod(k, F.lit(mod)) == 0
    order = F.when(when(35), F.lit("abc")).otherwise(F.pmod(F.floor(k / 45), F.lit(9)).cast("string"))
    add = F.map_concat(F.create_map(F.lit("data_type"), F.lit("text"), F.lit("database_data_type"), F.when(when(15), F.lit("")).otherwise(F.lit("varchar")),
                                    F.lit("page_order_sort"), order),
                       F.when(F.pmod(fifth.cast("bigint"), F.lit(2)) == 0, F.create_map(F.lit("name"), nth(45))).otherwise(F.create_map().cast("map<string,string>")))
    change = F.map_concat(F.create_map(F.lit("alias"), F.col("o_orderpriority"), F.lit("cleaning_function"), F.lit("")),
                          F.when(when(7), F.create_map(F.lit("bogus"), F.lit("x"))).otherwise(F.create_map().cast("map<string,string>")))
    return o.select(
        F.concat(F.when(when(101), F.lit("X")).otherwise(F.lit("P")), F.col("o_custkey").cast("string")).alias("processor_id"), k.alias("seq"),
        F.when(m == 0, F.lit("add")).when(m == 1, F.lit("delete")).when(F.pmod(k, F.lit(10)) == 4, F.lit("patch")).otherwise(F.lit("update")).alias("op"),
        F.when(F.pmod(k, F.lit(10)) == 9, F.lit(None)).otherwise(nth(5)).alias("name"),
        F.when(m == 0, add).when(m == 2, change).when(m == 3, F.create_map(F.lit("name"), nth(45))).alias("fields"))


_ORDER_EDITS_SQL = """WITH RECURSIVE
ed0 AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE 'P' END || o_custkey AS processor_id, o_orderkey AS seq, o_orderpriority AS clerk,
    CASE WHEN o_orderkey % 5 = 0 THEN 'add' WHEN o_orderkey % 5 = 1 THEN 'delete' WHEN o_orderkey % 10 = 4 THEN 'patch' ELSE 'update' END AS op,
    CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE 'F' || (o_orderkey // 5) % 9 END AS name, 'F' || (o_orderkey // 45) % 9 AS other,
    o_orderkey % 5 = 3 AS renames, o_orderkey % 5 = 0 AND (o_orderkey // 5) % 2 = 0 AS own_name, o_orderkey % 15 <> 0 AS typed,
    o_orderkey % 5 = 2 AND o_orderkey % 7 = 0 AS bogus, o_orderkey % 35 = 0 AS no_number, CAST((o_orderkey // 45) % 9 AS DOUBLE) AS ord
  FROM orders),
ed AS (SELECT *, CASE WHEN own_name THEN other ELSE name END AS target, row_number() OVER (PARTITION BY processor_id ORDER BY seq) AS k FROM ed0),
f AS (
  SELECT 'P' || c_custkey AS processor_id, CAST(0 AS BIGINT) AS k, c_custkey % 7 + 1 AS next_pos,
    [struct_pack(pos := p, name := 'F' || p, alias := CAST(NULL AS VARCHAR), ord := CAST(p AS DOUBLE), cf := CAST('clean_date' AS VARCHAR)) FOR p IN range(0, c_custkey % 7 + 1)] AS fields,
    CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS op, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS reason
  FROM customer
  UNION ALL
  SELECT processor_id, k, CASE WHEN reason IS NULL AND op = 'add' THEN next_pos + 1 ELSE next_pos END,
    CASE WHEN reason IS NOT NULL THEN fields
      WHEN op = 'add' THEN list_concat(fields, [struct_pack(pos := next_pos, name := target, alias := CAST(NULL AS VARCHAR), ord := ord, cf := CAST(NULL AS VARCHAR))])
      WHEN op = 'delete' THEN [x FOR x IN fields IF x.name <> target]
      ELSE list_concat(list_concat(fields[1:found - 1], [CASE WHEN renames THEN struct_pack(pos := fields[found].pos, name := other, alias := fields[found].alias, ord := fields[found].ord, cf := fields[found].cf)
        ELSE struct_pack(pos := fields[found].pos, name := fields[found].name, alias := clerk, ord := fields[found].ord, cf := CAST(NULL AS VARCHAR)) END]), fields[found + 1:]) END,
    seq, op, name, reason
  FROM (
    SELECT f.processor_id, e.k, f.next_pos, f.fields, e.seq, e.op, e.name, e.target, e.other, e.renames, e.clerk, e.ord,
      list_position([x.name FOR x IN f.fields], e.target) AS found,
      CASE WHEN e.op = 'patch' THEN 'unknown operation' WHEN e.target IS NULL THEN 'name is required'
           WHEN e.op = 'add' AND list_contains([x.name FOR x IN f.fields], e.target) THEN 'name already exists'
           WHEN e.op = 'add' AND NOT e.typed THEN 'data_type and database_data_type are required'
           WHEN e.op <> 'add' AND NOT list_contains([x.name FOR x IN f.fields], e.target) THEN 'no attribute with that name'
           WHEN e.bogus THEN 'field not allowed' WHEN e.op = 'add' AND e.no_number THEN 'page_order_sort is not a number' END AS reason
    FROM f JOIN ed e ON e.processor_id = f.processor_id AND e.k = f.k + 1))
"""


@query("processor_edits", _ORDER_EDITS_SQL + """
SELECT processor_id, CAST(x.pos AS INTEGER) AS pos, x.name AS name, x.alias AS alias, x.ord AS page_order_sort, x.cf AS cleaning_function
FROM (SELECT processor_id, unnest(arg_max(fields, k)) AS x FROM f GROUP BY processor_id)
""", ops=("R3", "U3"))
def q_processor_edits(spark, sf):
    new, _ = SC.apply_schema_edits(_customer_schema(spark, sf), load_order_schema_edits(spark, sf))
    return new.select("processor_id", "pos", "name", "alias", "page_order_sort", "cleaning_function")


@query("processor_edit_rejections", _ORDER_EDITS_SQL + """
SELECT processor_id, seq, op, name, reason FROM f WHERE reason IS NOT NULL
UNION ALL SELECT processor_id, seq, op, name, 'unknown processor' FROM ed WHERE processor_id LIKE 'X%'
""", ops=("R3", "U3"))
def q_processor_edit_rejections(spark, sf):
    return SC.apply_schema_edits(_customer_schema(spark, sf), load_order_schema_edits(spark, sf))[1]


def _processor_changes(spark, sf):
    """Processors of two customers in three, and a change an order."""
    c = M.table(spark, sf, "customer").where(F.pmod("c_custkey", F.lit(3)) != 0)
    name = lambda k: F.concat(F.lit("P"), F.col(k).cast("string"))
    have = c.select(name("c_custkey").alias("name"), F.lit("m0").alias("model_id"), F.col("c_mktsegment").alias("document_type"))
    k = F.col("o_orderkey")
    m = F.pmod(k, F.lit(4))
    changes = M.table(spark, sf, "orders").select(
        name("o_custkey").alias("name"), k.alias("seq"), F.when(m == 0, F.lit("upsert")).when(m == 2, F.lit("delete")).otherwise(F.lit("update")).alias("op"),
        F.when(F.pmod(k, F.lit(7)) != 0, F.concat(F.lit("m"), k.cast("string"))).alias("model_id"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.col("o_orderpriority")).alias("document_type"))
    return have, changes


_PROCESSORS_SQL = """WITH RECURSIVE
ch AS (
  SELECT 'P' || o_custkey AS name, o_orderkey AS seq, CASE o_orderkey % 4 WHEN 0 THEN 'upsert' WHEN 2 THEN 'delete' ELSE 'update' END AS op,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'm' || o_orderkey END AS model_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS document_type,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
f AS (
  SELECT n.name, CAST(0 AS BIGINT) AS k, c_custkey IS NOT NULL AS there, CASE WHEN c_custkey IS NOT NULL THEN 'm0' END AS model_id, c_mktsegment AS document_type,
    CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS op, true AS accepted
  FROM (SELECT name FROM ch UNION SELECT 'P' || c_custkey FROM customer WHERE c_custkey % 3 <> 0) n
  LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON n.name = 'P' || c_custkey
  UNION ALL
  SELECT f.name, ch.k, CASE ch.op WHEN 'upsert' THEN true WHEN 'delete' THEN false ELSE f.there END,
    CASE WHEN ch.op = 'delete' THEN NULL WHEN ch.op = 'update' AND NOT f.there THEN NULL ELSE coalesce(ch.model_id, f.model_id) END,
    CASE WHEN ch.op = 'delete' THEN NULL WHEN ch.op = 'update' AND NOT f.there THEN NULL ELSE coalesce(ch.document_type, f.document_type) END,
    ch.seq, ch.op, ch.op = 'upsert' OR f.there
  FROM f JOIN ch ON ch.name = f.name AND ch.k = f.k + 1)
"""


@query("whole_processor_edits", _PROCESSORS_SQL + """
SELECT name, model_id, document_type FROM (
  SELECT name, arg_max(there, k) AS there, max_by(struct_pack(m := model_id), k).m AS model_id, max_by(struct_pack(d := document_type), k).d AS document_type
  FROM f GROUP BY name) WHERE there
""", ops=("R3",))
def q_whole_processor_edits(spark, sf):
    return SC.edit_processors(*_processor_changes(spark, sf))[0]


@query("whole_processor_outcomes", _PROCESSORS_SQL + """
SELECT name, seq, op, accepted, CASE WHEN NOT accepted THEN 'unknown processor' END AS reason FROM f WHERE k > 0
""", ops=("R3",))
def q_whole_processor_outcomes(spark, sf):
    return SC.edit_processors(*_processor_changes(spark, sf))[1]
