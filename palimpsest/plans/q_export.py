"""Export and upload queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import export as X
from ..operators import extract as E
from ..operators import schema as SC
from ..operators import uploads as U
from ..session import work_folder
from ..sources import model as M
from .oracle_base import with_model
from .registry import query

EXPORT_PROJECT = "5"
ORIGIN = "https://example.org"


def _export_cells(spark, sf, selected=None):
    recs = M.load_records(spark, sf)
    groups = M.load_record_groups(spark, sf)
    scoped = X.records_of(recs, groups.where(F.col("project_id") == EXPORT_PROJECT))
    scoped = E.project_records(scoped, ["record_group_id", "filename"], ["key", "value", "subattributes"], ["key", "value"])
    sg = SC.schema_by_group(groups, M.load_processors(spark, sf)).select(
        "record_group_id",
        F.transform(F.filter("schema", lambda s: F.lower(s["database_data_type"]) == "table"),
                    lambda s: F.regexp_replace(s["name"], " ", "")).alias("table_names"))
    j = scoped.join(sg, "record_group_id", "left")
    return X.export_cells(j, F.coalesce(F.col("table_names"), F.array().cast("array<string>")), selected, ORIGIN)


_CELLS_SQL = f"""
, sel AS (
  SELECT r.record_id, r.record_group_id, r.filename FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
  WHERE g.project_id = '{EXPORT_PROJECT}'),
tbl AS (
  SELECT g.record_group_id, replace(s.name, ' ', '') AS sname
  FROM groups g JOIN processors p ON p.processor_id = g.processor_id CROSS JOIN schema s
  WHERE s.data_type = 'table'),
a1 AS (
  SELECT a.record_id, a.pos, replace(a.key, ' ', '') AS nm, a.value, a.l_linenumber = 3 AS has_subs,
         EXISTS (SELECT 1 FROM tbl t WHERE t.record_group_id = s.record_group_id AND t.sname = replace(a.key, ' ', ''))
           AS is_table
  FROM attrs a JOIN sel s ON s.record_id = a.record_id),
a2 AS (
  SELECT *, row_number() OVER (PARTITION BY record_id, nm ORDER BY pos) AS ord
  FROM a1 WHERE has_subs OR NOT is_table),
a3 AS (SELECT *, CASE WHEN ord = 1 THEN nm ELSE nm || '_' || CAST(ord AS VARCHAR) END AS col FROM a2),
cells AS (
  SELECT record_id, col, value AS val, 1 AS kind, pos FROM a3 WHERE NOT has_subs
  UNION ALL
  SELECT a3.record_id, a3.col || '[' || sb.key || ']', sb.value, 2, a3.pos
  FROM a3 JOIN subs sb ON sb.record_id = a3.record_id AND sb.attr_pos = a3.pos WHERE a3.has_subs
  UNION ALL
  SELECT record_id, 'file', filename, 0, -1 FROM sel
  UNION ALL
  SELECT record_id, 'URL', '{ORIGIN}/record/' || CAST(record_id AS VARCHAR), 3, -1 FROM sel)
"""


@query("export_cells", with_model(_CELLS_SQL + "SELECT record_id, col AS column_name, val AS value FROM cells",
                                  "recs", "subs", "groups", "processors", "schema"), ops=("X1", "W3", "P10", "Q-6"))
def q_export_cells(spark, sf):
    return _export_cells(spark, sf).select("record_id", F.inline_outer("cells")).where(F.col("col").isNotNull()) \
        .select("record_id", F.col("col").alias("column_name"), F.col("val").alias("value"))


@query("export_columns", with_model(_CELLS_SQL + """
SELECT col AS column_name, CAST(row_number() OVER (ORDER BY min(kind), arg_min(record_id, (kind, record_id, pos)),
                                                     min((kind, record_id, pos)), col) AS INTEGER) AS column_pos
FROM cells GROUP BY col
""", "recs", "subs", "groups", "processors", "schema"), ops=("X2",))
def q_export_columns(spark, sf):
    cols = X.export_columns(_export_cells(spark, sf))
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(cols)], "column_name string, column_pos int")


#: the caller's choice: attribute names, each with all of its repeats and sub-attributes
SELECTED = ["T", "Sec", "Field3", "Field4", "Field5", "Field6", "Field7"]


def _selected_columns(repeats: int = 5) -> list[str]:
    """Columns that the wide export has at any rate: every key and its first
    repeats (the columns of the SQL, which can't name what the data hold)."""
    nth = ["", *(f"_{i}" for i in range(2, repeats + 1))]
    flat = [f"{k}{n}" for k in ("T", "Sec", "Field4", "Field5", "Field6", "Field7") for n in nth]
    return ["file", *flat, *(f"Field3{n}[{sub}]" for n in nth for sub in ("Depth", "Sec")), "URL"]


@query("export_wide", with_model(
    _CELLS_SQL + "SELECT record_id, " + ", ".join(f"max(val) FILTER (WHERE col = '{c}') AS \"{c}\"" for c in _selected_columns())
    + " FROM cells GROUP BY record_id", "recs", "subs", "groups", "processors", "schema"), ops=("X1",))
def q_export_wide(spark, sf):
    cells = _export_cells(spark, sf, SELECTED)
    return X.export_wide(cells, X.with_occurring(_selected_columns(), cells))


@query("export_wide_cells", with_model(
    _CELLS_SQL + "SELECT record_id, col AS column_name, max(val) AS value FROM cells GROUP BY record_id, col HAVING max(val) IS NOT NULL",
    "recs", "subs", "groups", "processors", "schema"), ops=("X1",))
def q_export_wide_cells(spark, sf):
    """The wide rows turned back into (column, value): its SQL has no list of
    columns, so a cell that the wide rows lack shows."""
    wide = q_export_wide(spark, sf)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in wide.columns if c != "record_id"])
    return wide.select("record_id", F.inline(cells)).where(F.col("value").isNotNull())


@query("export_json", with_model("""
, lastv AS (SELECT record_id, key, arg_max(value, pos) AS value FROM attrs GROUP BY record_id, key)
SELECT r.record_id, l.key, l.value FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
JOIN lastv l ON l.record_id = r.record_id WHERE g.project_id = '5'
UNION ALL
SELECT r.record_id, 'file', r.filename FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
WHERE g.project_id = '5'
""", "recs", "attrs", "groups").replace("\\n, lastv AS", ",\\nlastv AS"), ops=("X3", "S8"))
def q_export_json(spark, sf):
    recs = M.load_records(spark, sf)
    groups = M.load_record_groups(spark, sf)
    scoped = recs.join(groups.where(F.col("project_id") == EXPORT_PROJECT).select("record_group_id"),
                       "record_group_id", "left_semi")
    j = X.export_json(scoped)
    kv = j.select("record_id", F.explode_outer("entries").alias("key", "a")).where(F.col("key").isNotNull()) \
        .select("record_id", "key",
                                                                             F.col("a.value").alias("value"))
    return kv.unionByName(j.select("record_id", F.lit("file").alias("key"), F.col("file").alias("value")))


IMAGES_SQL = """
, pages AS (
  SELECT record_id, record_group_id, name, filename, bad_page, g.k,
         CASE WHEN g.k = 1 THEN name || '.png' ELSE name || '_' || CAST(g.k AS VARCHAR) || '.png' END AS f
  FROM recs, LATERAL (SELECT unnest(range(1, CAST(n_pages AS BIGINT) + 1)) AS k) g),
images AS (
  SELECT record_id, record_group_id, name, f, k AS p FROM pages
  UNION ALL SELECT record_id, record_group_id, name, 'x', 0 FROM recs WHERE bad_page)
"""


@query("export_manifest", with_model(IMAGES_SQL + """
SELECT 'uploads/' || record_group_id || '/' || CAST(record_id AS VARCHAR) || '/' || f AS blob_key,
       'documents/' || name || '/' || f AS arcname, record_id
FROM images
""", "recs"), ops=("J13", "X4"))
def q_export_manifest(spark, sf):
    return X.export_manifest(M.load_records(spark, sf, with_attributes=False))


@query("image_keys", with_model(IMAGES_SQL + """
SELECT r.record_id, coalesce(i.key, 'uploads/' || r.record_group_id || '/' || CAST(r.record_id AS VARCHAR) || '/' || r.filename)
         AS image_key
FROM recs r LEFT JOIN (SELECT record_id, 'uploads/' || record_group_id || '/' || CAST(record_id AS VARCHAR) || '/' || f AS key
                       FROM images WHERE length(f) > 2) i ON i.record_id = r.record_id
""", "recs"), ops=("P8", "F5", "P11"))
def q_image_keys(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    return r.select("record_id", F.explode(N.image_keys(F.col("record_group_id"), F.col("record_id"),
                                                        F.col("image_files"), F.col("filename"))).alias("image_key"))


@query("download_size", with_model(IMAGES_SQL + """
, sel AS (SELECT i.* FROM images i JOIN groups g ON g.record_group_id = i.record_group_id WHERE g.project_id = '5'),
stored AS (SELECT record_id, f, 1000 + (record_id % 1000) * 10 + (k - 1) AS length FROM pages WHERE record_id % 17 <> 0)
SELECT CAST(coalesce(sum(s.length), 0) AS BIGINT) AS total_bytes, count(s.length) AS files_found,
       count(*) FILTER (WHERE s.length IS NULL) AS files_missing
FROM sel LEFT JOIN stored s ON s.record_id = sel.record_id AND s.f = sel.f
""", "recs", "groups").replace("\\n, sel AS", ",\\nsel AS"), ops=("A4", "S5", "J13"))
def q_download_size(spark, sf):
    recs = M.load_records(spark, sf, with_attributes=False)
    groups = M.load_record_groups(spark, sf)
    scoped = recs.join(groups.where(F.col("project_id") == EXPORT_PROJECT).select("record_group_id"),
                       "record_group_id", "left_semi")
    return X.download_size(X.export_manifest(scoped), M.load_storage_listing(spark, sf))


@query("by_document_type", with_model("""
SELECT r.record_id, CASE WHEN p.processor_id IS NULL THEN 'Default Processor' ELSE p.processor_id END AS document_type
FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
LEFT JOIN processors p ON p.processor_id = g.processor_id
""", "recs", "groups", "processors"), ops=("A5", "J7"))
def q_by_document_type(spark, sf):
    pg = SC.resolve_processor(M.load_record_groups(spark, sf), M.load_processors(spark, sf))
    out = X.by_document_type(M.load_records(spark, sf, with_attributes=False), pg)
    return out.select("record_id", "document_type")


@query("api_number", with_model("SELECT record_id, name, api_number FROM recs", "recs"), ops=("P7",))
def q_api_number(spark, sf):
    return M.load_records(spark, sf, with_attributes=False).select("record_id", "name", "api_number")


@query("classify_documents", with_model("""
SELECT upload_id, upload_name,
       CASE WHEN contains(lower(upload_name), '.pdf') THEN '.pdf' WHEN contains(lower(upload_name), '.tif') THEN '.tif'
            WHEN contains(lower(upload_name), '.png') THEN '.png' WHEN contains(lower(upload_name), '.jpg') THEN '.jpg'
            WHEN contains(lower(upload_name), '.jpeg') THEN '.jpeg' END AS doc_type
FROM uploads
""", "uploads"), ops=("F6",))
def q_classify_documents(spark, sf):
    return U.classify_documents(M.load_uploads(spark, sf)).select("upload_id", "upload_name", "doc_type")


@query("existing_bases", with_model("""
SELECT DISTINCT u.record_group_id, split_part(u.upload_name, '.', 1) AS base_name FROM uploads u
WHERE EXISTS (SELECT 1 FROM recs r WHERE r.record_group_id = u.record_group_id
              AND split_part(r.filename, '.', 1) = split_part(u.upload_name, '.', 1))
""", "uploads"), ops=("J10", "P9"))
def q_existing_bases(spark, sf):
    return U.existing_bases(M.load_uploads(spark, sf), M.load_records(spark, sf, with_attributes=False))


PENDING = """
, typed AS (
  SELECT * FROM uploads
  WHERE contains(lower(upload_name), '.pdf') OR contains(lower(upload_name), '.tif')
     OR contains(lower(upload_name), '.png') OR contains(lower(upload_name), '.jpg')
     OR contains(lower(upload_name), '.jpeg')),
new AS (
  SELECT t.* FROM typed t
  WHERE NOT EXISTS (SELECT 1 FROM recs r WHERE r.record_group_id = t.record_group_id AND r.filename = t.upload_name))
"""


def _pending_sql(select: str) -> str:
    return with_model(PENDING + select, "uploads").replace("\n, typed AS", ",\ntyped AS")


@query("pending_uploads", _pending_sql("SELECT upload_id, record_group_id, upload_name FROM new"), ops=("J11", "U4", "Q-13"))
def q_pending_uploads(spark, sf):
    out = U.pending_uploads(M.load_uploads(spark, sf), M.load_records(spark, sf, with_attributes=False))
    return out.select("upload_id", "record_group_id", "upload_name")


@query("pending_uploads_capped", _pending_sql("""SELECT upload_id, record_group_id, upload_name FROM (
  SELECT *, row_number() OVER (PARTITION BY record_group_id ORDER BY upload_name, upload_id) AS rn FROM new) WHERE rn <= 2"""), ops=("J11", "O8"))
def q_pending_uploads_capped(spark, sf):
    out = U.pending_uploads(M.load_uploads(spark, sf), M.load_records(spark, sf, with_attributes=False), cap=2)
    return out.select("upload_id", "record_group_id", "upload_name")


# ---- the export as one job, read back from its files

def _export(spark, sf, **more):
    path = work_folder(spark, "download")
    listing = M.load_storage_listing(spark, sf)
    manifest = X.export_job(M.load_records(spark, sf), M.load_record_groups(spark, sf), M.load_processors(spark, sf), path,
                            "project", EXPORT_PROJECT, origin=ORIGIN, listing=listing, **more)
    return path, manifest


_JOB_SQL = _CELLS_SQL + """
, typed AS (
  SELECT s.record_id, s.filename, CASE WHEN p.processor_id IS NULL THEN 'Default Processor' ELSE p.processor_id END AS document_type
  FROM sel s JOIN groups g ON g.record_group_id = s.record_group_id LEFT JOIN processors p ON p.processor_id = g.processor_id),
lastv AS (SELECT a.record_id, a.key, arg_max(a.value, a.pos) AS value, arg_max(CASE WHEN a.l_linenumber = 3 THEN 2 ELSE 0 END, a.pos) AS n_subs
  FROM attrs a JOIN sel s ON s.record_id = a.record_id GROUP BY a.record_id, a.key)
"""


def _job_sql(select: str, *views: str) -> str:
    return with_model(_JOB_SQL + select, "recs", "subs", "groups", "processors", "schema", *views)


@query("export_job_csv", _job_sql("""
SELECT t.document_type, CAST(c.record_id AS VARCHAR) AS record_id, c.col AS column_name, max(c.val) AS value
FROM cells c JOIN typed t ON t.record_id = c.record_id GROUP BY t.document_type, c.record_id, c.col HAVING max(c.val) <> ''
"""), ops=("X4", "X1", "A5", "S7"))
def q_export_job_csv(spark, sf):
    """Every cell of the CSV files of an export, read back (a file tells no
    empty cell from a missing one: both are null)."""
    path, _ = _export(spark, sf, formats=("csv",))
    wide = X.read_export(spark, path, "csv")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in wide.columns if c != "document_type"])
    return wide.select("document_type", F.substring_index("URL", "/", -1).alias("record_id"), F.inline(cells)).where(F.col("value").isNotNull())


@query("export_job_json", _job_sql("""
SELECT t.filename AS file, l.key, l.value, CAST(l.n_subs AS INTEGER) AS n_subs FROM typed t JOIN lastv l ON l.record_id = t.record_id
UNION ALL SELECT filename, 'file', filename, NULL FROM typed
"""), ops=("X4", "X3", "S8"))
def q_export_job_json(spark, sf):
    """Every entry of the JSON objects of an export, read back."""
    path, _ = _export(spark, sf, formats=("json",))
    entries = X.read_export(spark, path, "json").select(F.from_json("value", "map<string,string>").alias("m"))
    rows = entries.select(F.col("m.file").alias("file"), F.explode("m").alias("key", "v"))
    plain = F.col("key") == "file"
    return rows.select("file", "key", F.when(plain, F.col("v")).otherwise(F.get_json_object("v", "$.value")).alias("value"),
                       F.when(~plain, F.coalesce(F.json_array_length(F.get_json_object("v", "$.subattributes")), F.lit(0))).alias("n_subs"))


@query("export_job_selected", _job_sql("""
SELECT t.filename AS file, l.key, l.value FROM typed t JOIN lastv l ON l.record_id = t.record_id WHERE l.key IN ('T', 'Field 3')
UNION ALL SELECT filename, 'file', filename FROM typed
"""), ops=("X4", "X3"))
def q_export_job_selected(spark, sf):
    """The JSON objects of an export of two chosen columns."""
    path, _ = _export(spark, sf, formats=("csv", "json"), columns=["T", "Field 3"])
    entries = X.read_export(spark, path, "json").select(F.from_json("value", "map<string,string>").alias("m"))
    rows = entries.select(F.col("m.file").alias("file"), F.explode("m").alias("key", "v"))
    return rows.select("file", "key", F.when(F.col("key") == "file", F.col("v")).otherwise(F.get_json_object("v", "$.value")).alias("value"))


@query("export_job_manifest", with_model(IMAGES_SQL + """
, sel AS (
  SELECT r.record_id, CASE WHEN p.processor_id IS NULL THEN 'Default Processor' ELSE p.processor_id END AS document_type
  FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id LEFT JOIN processors p ON p.processor_id = g.processor_id WHERE g.project_id = '5'),
img AS (SELECT i.* FROM images i JOIN sel s ON s.record_id = i.record_id)
SELECT 'csv' AS kind, document_type, count(*) AS n FROM sel GROUP BY document_type
UNION ALL SELECT 'json', NULL, count(*) FROM sel
UNION ALL SELECT 'images', NULL, count(*) FROM img
UNION ALL SELECT 'image bytes', NULL, CAST(sum(1000 + (record_id % 1000) * 10 + (p - 1)) AS BIGINT) FROM img WHERE p > 0 AND record_id % 17 <> 0
""", "recs", "groups", "processors").replace("\n, sel AS", ",\nsel AS"), ops=("X4", "J13", "A5"))
def q_export_job_manifest(spark, sf):
    """The manifest of a whole export, by kind and document type, and the
    bytes of the images that it found in storage."""
    path, manifest = _export(spark, sf)
    rows = manifest.groupBy("kind", "document_type").agg(F.sum("rows").alias("n"))
    size = X.read_export(spark, path, "images").agg(F.sum("bytes").alias("n"))
    return rows.unionByName(size.select(F.lit("image bytes").alias("kind"), F.lit(None).cast("string").alias("document_type"), "n"))
