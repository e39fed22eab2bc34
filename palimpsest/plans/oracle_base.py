"""Flat SQL views of the record model, for the DuckDB oracle.

Written apart from the Spark builder (``sources/model.py``): the Spark
side nests line items into arrays and works inside them, the oracle
works on these flat rows.  Agreement of the two paths is the check.

``with_model(sql, *views)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

CTES: dict[str, str] = {}

CTES["attrs"] = """
attrs AS (
  SELECT l_orderkey AS record_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount) - 1 AS INTEGER) AS pos,
         CASE l_linenumber WHEN 1 THEN 'T' WHEN 2 THEN 'Sec' ELSE 'Field ' || CAST(l_linenumber AS VARCHAR) END AS key,
         CASE (l_partkey + l_linenumber) % 5
              WHEN 0 THEN 'T' || CAST(l_partkey AS VARCHAR)
              WHEN 1 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
              WHEN 2 THEN CAST(l_partkey AS VARCHAR) || ' 3/4'
              WHEN 3 THEN strftime(l_shipdate, '%Y-%m-%d')
              ELSE '' END AS value,
         l_returnflag IN ('R', 'A') AS cleaning_checked,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 5 THEN ''
              WHEN l_returnflag = 'R' THEN 'bad value' END AS cleaning_error,
         l_quantity > 45 AS edited,
         l_tax >= 0.08 AS user_added,
         round(1.0 - l_discount, 2) AS ai_confidence,
         l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax, l_shipdate
  FROM lineitem
)"""

CTES["subs"] = """
subs AS (
  SELECT record_id, pos AS attr_pos, key AS top_level_attribute, 0 AS sub_pos, 'Depth' AS key,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS value,
         TRUE AS cleaning_checked, CAST(NULL AS VARCHAR) AS cleaning_error
  FROM attrs WHERE l_linenumber = 3
  UNION ALL
  SELECT record_id, pos, key, 1, 'Sec', CAST(l_suppkey AS VARCHAR), TRUE,
         CASE WHEN l_suppkey % 7 = 0 THEN 'bad value' END
  FROM attrs WHERE l_linenumber = 3
)"""

CTES["recs"] = """
recs0 AS (
  SELECT o_orderkey AS record_id,
         CAST(o_custkey AS VARCHAR) AS record_group_id,
         CASE WHEN o_orderkey % 5 = 0 THEN 'scan_' || CAST(o_custkey AS VARCHAR)
              ELSE CAST(o_orderkey AS VARCHAR) || '_' || CAST(o_custkey AS VARCHAR) END AS name,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'defective'
              WHEN o_orderstatus = 'F' THEN 'reviewed'
              WHEN o_orderstatus = 'P' THEN 'incomplete'
              ELSE 'unreviewed' END AS review_status,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'required'
              WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'verified' END AS verification_status,
         o_orderkey % 3 AS m3, o_orderkey % 4 AS n_pages, o_orderkey % 11 = 0 AS bad_page,
         o_orderdate AS date_created
  FROM orders
),
recs AS (
  SELECT *,
         CASE m3 WHEN 0 THEN name || '.png' WHEN 1 THEN name || '.pdf.png' ELSE name END AS filename,
         TRY_CAST(trim(split_part(name, '_', 1)) AS BIGINT) AS api_number
  FROM recs0
)"""

CTES["groups"] = """
groups AS (
  SELECT CAST(c_custkey AS VARCHAR) AS record_group_id, c_name AS name,
         CAST(c_nationkey AS VARCHAR) AS project_id, c_mktsegment AS processor_id, r_name AS team
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""

CTES["projects"] = """
projects AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS project_id, n_name AS name, r_name AS team
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

CTES["users"] = """
users AS (
  SELECT s_name AS email, r_name AS default_team,
         CASE s_suppkey % 3 WHEN 0 THEN 'admin' WHEN 1 THEN 'reviewer' ELSE 'viewer' END AS team_role,
         CASE s_suppkey % 3 WHEN 0 THEN 'sys_admin' WHEN 2 THEN 'exporter' END AS system_role
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""

CTES["role_perms"] = """
role_perms AS (
  SELECT * FROM (VALUES
    ('admin', 'team', 'view_record'), ('admin', 'team', 'edit_record'), ('admin', 'team', 'verify_record'),
    ('admin', 'team', 'delete_record'), ('admin', 'team', 'manage_team'),
    ('reviewer', 'team', 'view_record'), ('reviewer', 'team', 'edit_record'), ('reviewer', 'team', 'verify_record'),
    ('viewer', 'team', 'view_record'),
    ('sys_admin', 'system', 'manage_system'), ('sys_admin', 'system', 'view_record'),
    ('exporter', 'system', 'download_records')
  ) AS t(role, category, permission)
)"""

# schema shared by the four processors: one row per schema attribute
CTES["schema"] = """
schema0 AS (
  SELECT * FROM (VALUES
    ('T', 'number', 'string_to_int', 9.0, 0),
    ('Sec', 'number', 'string_to_float', 8.0, 1),
    ('Field 3', 'table', 'convert_hole_size_to_decimal', 7.0, 2),
    ('Field 4', 'date', 'string_to_date', 6.0, 3),
    ('Field 5', 'date', 'clean_date', 5.0, 4),
    ('Field 6', 'boolean', 'clean_bool', 4.0, 5),
    ('Field 9', 'text', 'llm_clean', 1.0, 6),
    ('Field 3::Depth', 'number', 'string_to_float', NULL, 7),
    ('Field 3::Sec', 'number', 'string_to_int', NULL, 8)
  ) AS t(name, data_type, cleaning_function, page_order_sort_dec, name_pos)
),
schema AS (
  SELECT name, data_type, cleaning_function, CAST(page_order_sort_dec AS DOUBLE) AS page_order_sort, name_pos
  FROM schema0
)"""

CTES["processors"] = """
processors AS (
  SELECT DISTINCT c_mktsegment AS processor_id FROM customer
  WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
)"""

CTES["history"] = """
history AS (
  SELECT event_id AS history_id,
         CASE event_type WHEN 'click' THEN 'updateRecord' WHEN 'purchase' THEN 'cleanRecord' ELSE event_type END AS action,
         'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS "user",
         event_id % 1500 AS record_id, ts, props AS query, value
  FROM events
)"""

CTES["uploads"] = """
uploads AS (
  SELECT o.o_orderkey AS upload_id,
         CASE WHEN o.o_orderkey % 91 = 0 THEN 'g' || CAST(o.o_custkey AS VARCHAR) ELSE CAST(o.o_custkey AS VARCHAR) END
           AS record_group_id,
         CASE WHEN o.o_orderkey % 7 = 0 THEN r.filename
              ELSE 'upload_' || CAST(o.o_orderkey AS VARCHAR) ||
                   CASE o.o_orderkey % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.TIF' WHEN 2 THEN '.jpg'
                                         WHEN 3 THEN '.docx' ELSE '.png' END END AS upload_name
  FROM orders o JOIN recs r ON r.record_id = o.o_orderkey
  WHERE o.o_orderkey % 7 <= 1
)"""

DEPENDS = {
    "subs": ["attrs"],
    "uploads": ["recs"],
}


def with_model(sql: str, *views: str) -> str:
    seen: list[str] = []

    def add(v):
        for d in DEPENDS.get(v, []):
            add(d)
        if v not in seen:
            seen.append(v)

    for v in views:
        add(v)
    return "WITH " + ",\n".join(CTES[v].strip() for v in seen) + "\n" + sql.strip()
