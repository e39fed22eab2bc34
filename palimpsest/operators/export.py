"""Exports (X1-X4, W3, A4, A5, J13, S5, S7, S8).

The wide CSV export is built **without a shuffle**: each record's cells
are computed inside the record row (W3 naming, sub-attribute columns,
last wins) into one map, and the wide row is ``map[column]`` for the
given column list.  Only the column list needs a pass over the data: a
``groupBy(column)`` aggregate whose output is the (small, schema-bound)
catalogue of export columns; it is the one thing collected to the driver.

O5 (download mode drops sort and window stages): the export functions take
the scoped selection as it is and never sort or rank it; row order of the
files is not part of the contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import attrs as A
from ..session import hadoop_path, work_folder
from . import schema as SC
from .extract import project_records
from .scope import records_in_scope

CELL_TYPE = T.StructType([T.StructField("col", T.StringType()), T.StructField("val", T.StringType()),
                          T.StructField("kind", T.IntegerType()), T.StructField("pos", T.IntegerType())])


def _last_wins(cells: Column) -> Column:
    """Keep the last cell of each column name (dict semantics).  ``cells``
    should be a column reference: it is read once per element."""
    return F.filter(cells, lambda c, i: ~F.exists(F.slice(cells, i + 2, F.size(cells)),
                                                  lambda x: x["col"] == c["col"]))


def export_cells(records: DataFrame, table_names: Column | None = None, selected: list[str] | None = None,
                 origin: str = "", carry: tuple[str, ...] = ()) -> DataFrame:
    """X1 + W3: per record an array of (column, value, kind, position); columns named in ``carry`` pass.

    ``table_names``: ARRAY<STRING> column of space-stripped schema names
    whose database type is ``table`` (parents).  An attribute is emitted
    when selected (all when ``selected`` is None) and it either has
    sub-attributes (-> ``name[sub]`` columns) or is not table-typed
    (-> ``name``).  Repeated names among emitted attributes get the
    first of ``_2``, ``_3`` ... that no earlier attribute has.

    Built in stages (one projection each) so that every intermediate
    array is computed once per record and referenced, not re-inlined
    into the later lambdas."""
    tn = table_names if table_names is not None else F.array().cast("array<string>")
    sel = F.array(*[F.lit(s) for s in selected]) if selected else None

    def info(x):
        nm = F.regexp_replace(x["key"], " ", "")
        has_subs = F.coalesce(F.size(x["subattributes"]) > 0, F.lit(False))
        chosen = F.lit(True) if sel is None else F.array_contains(sel, nm)
        return F.struct(nm.alias("nm"), has_subs.alias("has_subs"),
                        (chosen & (has_subs | ~F.array_contains(F.col("_tn"), nm))).alias("emit"),
                        x["value"].alias("value"), x["subattributes"].alias("subs"))

    s1 = records.select("record_id", "record_group_id", "filename", *carry, tn.alias("_tn"),
                        F.transform(F.coalesce(F.col("attributes"), F.array()), info).alias("_i"))

    def used(taken, name):
        return F.coalesce(F.array_contains(taken, name), F.lit(False))

    def take(taken, z):
        tries = F.transform(F.sequence(F.lit(2), F.size(taken) + 2), lambda k: F.concat(z["nm"], F.lit("_"), k.cast("string")))
        free = F.get(F.filter(tries, lambda n: ~used(taken, n)), 0)
        return F.concat(taken, F.array(F.when(z["emit"], F.when(used(taken, z["nm"]), free).otherwise(z["nm"]))))

    names = F.aggregate("_i", F.array().cast("array<string>"), take)
    s1 = s1.select("*", names.alias("_names"))

    def named(y, i):
        return y.withField("col", F.get(F.col("_names"), i)).withField("pos", i)

    s2 = s1.select("record_id", "record_group_id", "filename", *carry, F.transform("_i", named).alias("_n"))
    cell_arr = T.ArrayType(CELL_TYPE)

    def cells_of(y):
        subs = F.transform(y["subs"],  # null only where has_subs is false
                           lambda s: F.struct(F.concat(y["col"], F.lit("["), s["key"], F.lit("]")).alias("col"),
                                              s["value"].alias("val"), F.lit(2).alias("kind"), y["pos"].alias("pos")))
        plain = F.array(F.struct(y["col"].alias("col"), y["value"].alias("val"), F.lit(1).alias("kind"),
                                 y["pos"].alias("pos")))
        return F.when(~y["emit"], F.array().cast(cell_arr)).when(y["has_subs"], subs.cast(cell_arr)) \
            .otherwise(plain.cast(cell_arr))

    file_cell = F.array(F.struct(F.lit("file").alias("col"), F.coalesce(F.col("filename"), F.lit("")).alias("val"),
                                 F.lit(0).alias("kind"), F.lit(-1).alias("pos")).cast(CELL_TYPE))
    url_cell = F.array(F.struct(F.lit("URL").alias("col"),
                                F.concat(F.lit(origin + "/record/"), F.col("record_id").cast("string")).alias("val"),
                                F.lit(3).alias("kind"), F.lit(-1).alias("pos")).cast(CELL_TYPE))
    s3 = s2.select("record_id", "record_group_id", *carry,
                   F.concat(file_cell, F.flatten(F.transform("_n", cells_of)), url_cell).alias("_c"))
    return s3.select("record_id", "record_group_id", *carry, _last_wins(F.col("_c")).alias("cells"))


def export_columns(cells: DataFrame) -> list[str]:
    """Column order = file, attributes in first-seen order, sub
    columns in first-seen order, URL.  First seen = smallest (record id,
    position).  The aggregate output is one row per distinct column."""
    # outer generator: the non-outer one makes Spark infer a size(cells) > 0
    # filter that inlines the whole cell expression into the scan filter
    c = cells.select("record_id", F.inline_outer("cells")).where(F.col("col").isNotNull())
    order = (c.groupBy("col").agg(F.min(F.struct("kind", "record_id", "pos")).alias("o"))
              .orderBy("o.kind", "o.record_id", "o.pos", "col"))
    return [r["col"] for r in order.select("col").collect()]


def with_occurring(columns: list[str], cells: DataFrame) -> list[str]:
    """``columns`` and all others that occur in ``cells``, such as further
    repeats of a name: file, attributes, sub columns, URL."""
    def kind(c):
        return {"file": 0, "URL": 3}.get(c, 2 if c.endswith("]") else 1)

    return sorted(dict.fromkeys([*columns, *export_columns(cells)]), key=kind)


def export_wide(cells: DataFrame, columns: list[str] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One wide row per record with the given column list (computed
    by ``export_columns`` when omitted); absent cells are NULL."""
    cols = columns if columns is not None else export_columns(cells)
    m = F.map_from_entries(F.transform("cells", lambda c: F.struct(c["col"], c["val"])))
    return cells.select("record_id", *carry, *[F.element_at(m, F.lit(c)).alias(c) for c in cols])


#: fixed values: the fields of a record, an attribute and a sub-attribute that a download holds
EXPORT_FIELDS = ["name", "filename", "image_files", "record_group_id"]
EXPORT_ATTRIBUTE_FIELDS = ["key", "value", "normalized_vertices", "subattributes", "page"]
EXPORT_SUB_FIELDS = ["key", "value", "normalized_vertices", "page"]
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd", "dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"}


def export_json(records: DataFrame, selected: list[str] | None = None) -> DataFrame:
    """Per record a map raw key -> attribute (last wins; all keys or the
    ``selected`` ones), ``file``, and the record's JSON text: one object with
    the keys and ``file`` side by side (an attribute of that name gives way to
    it), nulls written out, dates as ISO dates."""
    a = F.coalesce(F.col("attributes"), F.array())
    idx = F.transform(a, lambda x, i: F.struct(x["key"].alias("k"), i.alias("i")))
    last = F.filter(a, lambda x, i: (x["key"] != "file") & ~F.exists(idx, lambda y: (y["k"] == x["key"]) & (y["i"] > i)))
    if selected:
        last = F.filter(last, lambda x: x["key"].isin(*selected))
    m = F.map_from_entries(F.transform(last, lambda x: F.struct(x["key"], x)))
    got = records.select("record_id", F.coalesce(F.col("filename"), F.lit("")).alias("file"), m.alias("entries"))
    file, body = F.to_json(F.struct("file")), F.to_json("entries", JSON_OPTIONS)
    # two objects joined: {keys} and {file}
    return got.withColumn("json", F.when(F.size("entries") == 0, file).otherwise(
        F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(","), F.substring(file, 2, 1 << 30))))


def export_manifest(records: DataFrame) -> DataFrame:
    """Record x page -> (blob key, archive name).  The blob key holds
    the record id, so duplicate keys can only come from one record's own
    page list: they collapse inside the array (``array_distinct``), no
    shuffle."""
    files = F.array_distinct(F.coalesce("image_files", F.array().cast("array<string>")))
    pages = records.select("record_id", "record_group_id",
                           F.coalesce("name", F.col("record_id").cast("string")).alias("record_name"),
                           F.explode_outer(files).alias("f")).where(F.col("f").isNotNull())
    return pages.select(
        F.concat_ws("/", F.lit("uploads"), "record_group_id", F.col("record_id").cast("string"), "f").alias("blob_key"),
        F.concat(F.lit("documents/"), F.col("record_name"), F.lit("/"),
                 F.substring_index(F.col("f"), "/", -1)).alias("arcname"),
        "record_id")


def list_documents(spark, path: str) -> DataFrame:
    """File listing under a prefix with sizes.  Selecting only
    ``path`` and ``length`` of the binaryFile source does not read the
    file contents."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                 .select("path", "length"))


def download_size(manifest: DataFrame, listing: DataFrame, key_col: str = "blob_key",
                  path_col: str = "path") -> DataFrame:
    """A4: total bytes of the manifest's files; missing files ignored."""
    j = manifest.join(listing.select(F.col(path_col).alias(key_col), "length"), key_col, "left")
    return j.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("total_bytes"),
                 F.count("length").alias("files_found"),
                 F.count(F.when(F.col("length").isNull(), 1)).alias("files_missing"))


def by_document_type(records: DataFrame, processors_by_group: DataFrame) -> DataFrame:
    """A5: tag each record with its document type (processor name of its
    group, default name when none) -- the column to partition files by.
    Plain partitioning by type (Q-4: no set is restarted)."""
    p = processors_by_group.select("record_group_id", F.col("processor_name").alias("document_type"))
    return records.join(p, "record_group_id", "left")


def write_csv_export(wide: DataFrame, path: str, partition_col: str | None = "document_type") -> None:
    """CSV files with a header, one directory per document type."""
    w = wide.write.mode("overwrite").option("header", True)
    (w.partitionBy(partition_col) if partition_col else w).csv(path)


def write_json_export(df: DataFrame, path: str, partition_col: str | None = "document_type") -> None:
    """JSON lines; timestamps written as ISO dates."""
    w = df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd").option("dateFormat", "yyyy-MM-dd")
    (w.partitionBy(partition_col) if partition_col else w).json(path)


# ---------------------------------------------------------------- the whole export
def records_of(records: DataFrame, groups: DataFrame) -> DataFrame:
    """the records of ``groups``.  The group ids are written first, so that
    the planner knows their true size: where they are few, the records meet
    them as they are read, and only those in scope travel."""
    spark, path = records.sparkSession, work_folder(records.sparkSession, "scope")
    ids = groups.select("record_group_id").where(F.col("record_group_id").isNotNull()).distinct()
    ids.write.parquet(path)
    return records_in_scope(records, spark.read.schema(ids.schema).parquet(path))


MARKER = "_EXPORTED"
FORMATS = ("csv", "json", "images")
MANIFEST = "kind string, document_type string, file string, rows long, bytes long"
_LOCATIONS = {"project": "project_id", "record_group": "record_group_id", "team": "team"}


def export_job(records: DataFrame, record_groups: DataFrame, processors: DataFrame, path: str, location: str, key: str,
               formats: tuple[str, ...] = FORMATS, columns: list[str] | None = None, origin: str = "",
               condition: Column | None = None, listing: DataFrame | None = None) -> DataFrame:
    """Download a project, a record group or a team as files below ``path``.

    1. scope: the records of the location's groups, ``condition`` on them (F1),
       the exported fields only (P1-P3), each with its document type (A5); read
       once from the record table and kept in the shared work folder;
    2. ``csv/document_type=.../``: one wide row a record (X1, X2), the same
       header everywhere: ``columns`` with all their repeats, or every column;
    3. ``json/``: one object a line (X3);
    4. ``images/``: the image files by archive name (J13), with their sizes
       where ``listing`` (path, length) has them;
    5. the files are read back: ``manifest/`` says what each really holds;
    6. ``_EXPORTED`` is made last.  A reader (``read_export``) takes nothing
       without it, so an export that was cut off, or is being made again, never
       counts; a retry starts over below the same path.

    Returns the manifest.  No sort or rank is done on the way (O5)."""
    if location not in _LOCATIONS:
        raise ValueError(f"location must be one of {', '.join(_LOCATIONS)}")
    if wrong := set(formats) - set(FORMATS):
        raise ValueError(f"unknown formats: {', '.join(sorted(wrong))}")
    spark, path = records.sparkSession, path.rstrip("/")
    fs, root = hadoop_path(spark, path)
    fs.delete(hadoop_path(spark, f"{path}/{MARKER}")[1], False)
    fs.delete(root, True)

    groups = record_groups.where(F.col(_LOCATIONS[location]) == F.lit(key))
    scoped = records_of(records if condition is None else records.where(condition), groups)
    kept = project_records(scoped, EXPORT_FIELDS, EXPORT_ATTRIBUTE_FIELDS, EXPORT_SUB_FIELDS)
    tables = SC.schema_by_group(groups, processors).select(
        "record_group_id", F.transform(F.filter("schema", lambda x: F.lower(x["database_data_type"]) == "table"),
                                       lambda x: F.regexp_replace(x["name"], " ", "")).alias("table_names"))
    kept = by_document_type(kept, SC.resolve_processor(groups, processors)).join(tables, "record_group_id", "left")
    work = work_folder(spark, "export")
    kept.write.parquet(work)
    kept = spark.read.parquet(work)

    if "csv" in formats:
        names = [c.replace(" ", "") for c in columns] if columns else None
        cells = export_cells(kept, F.coalesce("table_names", F.array().cast("array<string>")), names, origin, ("document_type",))
        write_csv_export(export_wide(cells, with_occurring(["file", "URL"], cells), ("document_type",)).drop("record_id"), f"{path}/csv")
    if "json" in formats:
        export_json(kept, columns).select(F.col("json").alias("value")).write.text(f"{path}/json")
    if "images" in formats:
        files = export_manifest(kept)
        if listing is not None:
            files = files.join(listing.select(F.col("path").alias("blob_key"), F.col("length").alias("bytes")), "blob_key", "left")
        files.write.json(f"{path}/images")
    manifest = written_files(spark, path, formats)
    manifest.write.json(f"{path}/manifest")
    fs.create(hadoop_path(spark, f"{path}/{MARKER}")[1], False).close()
    return read_export(spark, path, "manifest")


def written_files(spark, path: str, formats: tuple[str, ...]) -> DataFrame:
    """(kind, document_type, file, rows, bytes) of every file of an export, counted by reading it."""
    found = spark.createDataFrame([], MANIFEST)
    meta = F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("bytes")
    for kind in formats:
        folder = f"{path}/{kind}"
        if kind == "csv":
            # rows as CSV has them: a quoted cell may hold line ends
            rows = _csv(spark, folder)
            if rows is None:
                continue
            lines = rows.select(*meta)
        else:
            lines = spark.read.text(folder).select(*meta)
        got = lines.groupBy("p", "bytes").agg(F.count(F.lit(1)).alias("rows"))
        found = found.unionByName(got.select(
            F.lit(kind).alias("kind"), F.nullif(F.url_decode(F.regexp_extract("p", "/document_type=([^/]*)/", 1)), F.lit("")).alias("document_type"),
            F.concat(F.lit(f"{kind}/"), F.regexp_extract("p", f"/{kind}/((?:document_type=[^/]*/)?[^/]*)$", 1)).alias("file"), "rows", "bytes"))
    return found


def _csv(spark, folder: str) -> DataFrame | None:
    """The rows of CSV files in folders by document type; None where no file was written."""
    fs, p = hadoop_path(spark, folder)
    if not any(x.isDirectory() for x in fs.listStatus(p)):
        return None
    return spark.read.option("header", True).option("multiLine", True).csv(folder)


def read_export(spark, path: str, kind: str) -> DataFrame:
    """What an export holds: ``csv`` rows, ``json`` texts (value), ``images``
    or the ``manifest``.  An error where the export isn't complete."""
    fs, mark = hadoop_path(spark, f"{path.rstrip('/')}/{MARKER}")
    if not fs.exists(mark):
        raise ValueError(f"no complete export at {path}")
    if kind == "csv":
        rows = _csv(spark, f"{path}/csv")
        return spark.createDataFrame([], "file string, URL string, document_type string") if rows is None else rows
    if kind == "json":
        return spark.read.text(f"{path}/json")
    return spark.read.schema(MANIFEST if kind == "manifest" else "blob_key string, arcname string, record_id long, bytes long").json(f"{path}/{kind}")
