"""Document-type schemas.

The declared schema is data (``processors.attributes``); it is joined to
records at run time so one job handles every document type at once.
Records reach their schema through their group: records -> groups is a
join on the group id (both large: shuffle, or AQE's choice), and so is
groups -> processors: Spark broadcasts the processors where their size in
bytes allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import attrs as A
from ..session import work_folder
from ..sources.model import ATTR_TYPE, ATTRS_TYPE, DEFAULT_PROCESSOR, SCHEMA_ATTR_TYPE
from .graph import components

SCHEMA_ARR = T.ArrayType(SCHEMA_ATTR_TYPE)

# fixed values: legacy header renames (P12); headers not listed are kept
LEGACY_KEY_MAP = {
    "Page Order Sort": "page_order_sort",
    "Name": "name",
    "Alias": "alias",
    "Google Data Type": "google_data_type",
    "Occurrence": "occurrence",
    "Database Data Type": "database_data_type",
    "Cleaning Function": "cleaning_function",
    "Model Enabled": "model_enabled",
}
# fixed values: CSV schema upload headers that are kept (S2); data_type comes
# from "Data Type" when that column exists, else from "Google Data Type"
CSV_KEY_MAP = {
    "Name": "name",
    "Database Data Type": "database_data_type",
    "Occurrence": "occurrence",
    "Grouping": "grouping",
    "Page Order Sort": "page_order_sort",
    "Cleaning Function": "cleaning_function",
}
CSV_TYPE_HEADERS = ["Data Type", "Google Data Type"]
# fixed values: keys kept from JSON schema files (S3) and the alternative
# keys read for data_type when it is absent
JSON_KEYS = ["name", "data_type", "database_data_type", "occurrence", "grouping", "page_order_sort",
             "cleaning_function"]
JSON_TYPE_ALIASES = ["google_data_type", "Google Data type"]
SCHEMA_FIELDS = ["name", "alias", "data_type", "database_data_type", "occurrence", "grouping",
                 "page_order_sort", "cleaning_function"]


def remap_legacy_keys(df: DataFrame) -> DataFrame:
    """Rename legacy headers; unknown columns are kept."""
    return df.withColumnsRenamed({k: v for k, v in LEGACY_KEY_MAP.items() if k in df.columns})


# ---------------------------------------------------------------- sources
def read_schema_csv(spark, path: str) -> DataFrame:
    """Schema rows from CSV files; the first row is the header.  Only
    the mapped headers are kept (no alias); ``data_type`` from ``Data
    Type`` when present, else ``Google Data Type``."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    have = set(raw.columns)
    src = {v: k for k, v in CSV_KEY_MAP.items()}
    type_col = next((h for h in CSV_TYPE_HEADERS if h in have), None)

    def c(name):
        h = src.get(name)
        if name == "data_type":
            h = type_col
        return F.col(f"`{h}`") if h in have else F.lit(None).cast("string")

    part = [F.col("processor_id")] if "processor_id" in have else []   # folder partition column
    return raw.select(*part, *[
        (c(f).try_cast("double") if f == "page_order_sort" else c(f)).alias(f) for f in SCHEMA_FIELDS])


def read_schema_json(spark, path: str) -> DataFrame:
    """S3: a JSON file holding a list of objects (anything else is an
    error); non-objects are skipped, only the allowed keys are kept,
    ``data_type`` falls back to the alias keys when absent."""
    fields = JSON_KEYS + JSON_TYPE_ALIASES
    st = T.StructType([T.StructField(k, T.StringType()) for k in fields])
    text = spark.read.option("wholetext", True).text(path)
    part = [c for c in text.columns if c == "processor_id"]      # partition column of a folder of files
    items = F.from_json(F.col("value"), T.ArrayType(T.StringType()))
    checked = F.when(items.isNull(), F.raise_error(F.lit("schema json must be a list of objects"))) \
        .otherwise(items)
    rows = text.select(*part, F.explode(checked).alias("item")).where(F.ltrim("item").startswith("{"))
    parsed = rows.select(*part, F.from_json("item", st).alias("s")).select(*part, "s.*")
    return parsed.select(
        *part, "name", F.lit(None).cast("string").alias("alias"),
        F.coalesce(F.col("data_type"), *[F.col(f"`{k}`") for k in JSON_TYPE_ALIASES]).alias("data_type"),
        "database_data_type", "occurrence", "grouping",
        F.col("page_order_sort").try_cast("double").alias("page_order_sort"),
        "cleaning_function",
    )


# ---------------------------------------------------------------- lookups
def resolve_processor(record_groups: DataFrame, processors: DataFrame) -> DataFrame:
    """Processor of each group, falling back to the built-in default
    processor when the group's processor is unknown."""
    p = processors.select("processor_id", F.col("name").alias("_pname"), F.col("model_id").alias("_mid"),
                          F.lit(True).alias("_found"))
    d_id, d_name, d_model, _ = DEFAULT_PROCESSOR
    j = record_groups.join(p, "processor_id", "left")
    found = F.coalesce("_found", F.lit(False))
    return j.select(
        "record_group_id",
        F.when(found, F.col("processor_id")).otherwise(F.lit(d_id)).alias("processor_id"),
        F.when(found, F.col("_pname")).otherwise(F.lit(d_name)).alias("processor_name"),
        F.when(found, F.col("_mid")).otherwise(F.lit(d_model).cast("string")).alias("model_id"),
        found.alias("has_processor"),
    )


def schema_by_group(record_groups: DataFrame, processors: DataFrame) -> DataFrame:
    """Each group with its processor's schema array; a group without
    processor gets an empty schema."""
    p = processors.select("processor_id", F.col("attributes").alias("schema"))
    return (record_groups.select("record_group_id", "processor_id").join(p, "processor_id", "left")
            .select("record_group_id", "processor_id", (F.col("schema").isNotNull()).alias("has_processor"),
                    F.coalesce("schema", F.array().cast(SCHEMA_ARR)).alias("schema")))


def own_processor(records: DataFrame, record_groups: DataFrame, name: str) -> DataFrame:
    """``records`` plus the short id of their group's processor as ``name``."""
    g = record_groups.select("record_group_id", F.col("processor_id").alias(name))
    return records.join(g, "record_group_id", "left")


def processor_column(records: DataFrame, per_processor: DataFrame, column: str, own: str) -> DataFrame:
    """``records``, which have their processor's id as ``own``, plus a column of
    that processor (null without one) in the place of the id."""
    p = per_processor.select(F.col("processor_id").alias("_processor"), column)
    return records.join(p, F.col(own) == F.col("_processor"), "left").drop(own, "_processor")


def with_processor(records: DataFrame, record_groups: DataFrame, per_processor: DataFrame, column: str) -> DataFrame:
    """``records`` plus a column that depends on their processor only (null
    without one).  Records meet their group for the processor's short id, and
    the column, which may be a whole schema, once a processor: it isn't copied
    for every group nor shuffled with them."""
    return processor_column(own_processor(records, record_groups, "_own_processor"), per_processor, column, "_own_processor")


def schema_map(processors: DataFrame) -> DataFrame:
    """Per processor a map ``name`` -> definition.  ``map_from_entries``
    fails on duplicate keys, so the last definition of a name is kept
    first (last wins, as in the reference)."""
    def keep_last(arr):
        idx = F.transform(arr, lambda a, i: F.struct(a["name"].alias("k"), i.alias("i")))
        return F.filter(arr, lambda a, i: ~F.exists(idx, lambda x: (x["k"] == a["name"]) & (x["i"] > i)))
    dedup = keep_last(F.col("attributes"))
    return processors.select("processor_id", F.map_from_entries(
        F.transform(dedup, lambda a: F.struct(a["name"].alias("key"), a.alias("value")))).alias("schema_map"))


def schema_order(schema: Column) -> Column:
    """Schema attributes by ``page_order_sort`` ascending, missing last,
    stable (original position breaks ties) -- Q-8 decided numeric."""
    keyed = F.transform(schema, lambda s, i: F.struct(s["page_order_sort"].isNull().alias("n"),
                                                      s["page_order_sort"].alias("o"), i.alias("p"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])


def _blank(name: Column, ingest: bool) -> Column:
    """A blank attribute for a schema name missing from the record: empty
    texts on ingest (R1), NULLs on read (R2)."""
    txt = F.lit("" if ingest else None).cast("string")
    return F.struct(
        name.alias("key"), txt.alias("value"), F.lit(None).cast("string").alias("value_type"),
        txt.alias("raw_text"), txt.alias("text_value"), F.lit(None).cast("string").alias("normalized_value"),
        F.lit(None).cast("double").alias("ai_confidence"), F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("array<array<double>>").alias("normalized_vertices"),
        F.lit(None).cast("array<array<double>>").alias("user_provided_coordinates"),
        F.lit(None).cast("int").alias("page"), F.lit(False).alias("edited"),
        F.lit(None).cast("boolean").alias("user_added"), F.lit(False).alias("is_subattribute"),
        F.lit(None).cast("string").alias("top_level_attribute"), F.lit(None).cast("boolean").alias("cleaned"),
        F.lit(None).cast("boolean").alias("cleaning_checked"), F.lit(None).cast("string").alias("cleaning_error"),
        F.lit(None).cast("string").alias("uncleaned_value"), F.lit(None).cast("timestamp").alias("last_cleaned"),
        F.lit(None).cast("timestamp").alias("last_updated"), F.lit(None).cast("string").alias("last_updated_user"),
        F.lit(None).cast("array<" + ATTR_TYPE["subattributes"].dataType.elementType.simpleString() + ">")
         .alias("subattributes"),
    ).cast(ATTR_TYPE)


def reconcile_attributes(attrs: Column, schema: Column, mode: str = "read", keep_all: bool = False) -> Column:
    """R1 (``mode="ingest"``) / R2 (``mode="read"``) as one array expression.

    ingest: walk the schema in stored order; emit every attribute with that
    key (original order), else a blank when the name has no ``::``; then
    the keys not in the schema, in first-seen order, grouped by key.
    read: walk the schema by page order, skipping ``::`` names; missing ->
    blank; attributes not in the schema are dropped (or appended when
    ``keep_all``).  An empty schema leaves the list unchanged."""
    a = A.safe_attrs(attrs)
    names = schema.getField("name")
    ingest = mode == "ingest"
    walk = schema if ingest else F.filter(schema_order(schema), lambda s: ~F.contains(s["name"], F.lit("::")))

    def emit(s):
        hits = F.filter(a, lambda x: x["key"] == s["name"])
        blank = F.array(_blank(s["name"], ingest))
        if ingest:
            return F.when(F.size(hits) > 0, hits).when(F.contains(s["name"], F.lit("::")), F.array().cast(ATTRS_TYPE)) \
                .otherwise(blank)
        return F.when(F.size(hits) > 0, hits).otherwise(blank)

    body = F.flatten(F.transform(walk, emit))
    if ingest or keep_all:
        extra_keys = F.filter(F.array_distinct(a.getField("key")), lambda k: ~F.array_contains(names, k))
        extras = F.flatten(F.transform(extra_keys, lambda k: F.filter(a, lambda x: x["key"] == k)))
        body = F.concat(body, extras) if ingest else F.concat(body, F.filter(a, lambda x: ~F.array_contains(names, x["key"])))
    return F.when(F.size(schema) > 0, body).otherwise(a)


def schemas(processors: DataFrame) -> DataFrame:
    return processors.select("processor_id", F.col("attributes").alias("schema"))


def reconcile(records: DataFrame, record_groups: DataFrame, processors: DataFrame, mode: str = "read",
              keep_all: bool = False) -> DataFrame:
    """Records with reconciled ``attributes`` and ``changed``."""
    return reconcile_by_schema(with_processor(records, record_groups, schemas(processors), "schema"), mode, keep_all)


def reconcile_by_schema(records: DataFrame, mode: str = "read", keep_all: bool = False) -> DataFrame:
    """J12 on records that have their ``schema`` with them."""
    schema = F.coalesce(F.col("schema"), F.array().cast(SCHEMA_ARR))
    new = reconcile_attributes(F.col("attributes"), schema, mode, keep_all)
    return (records.withColumn("_new", new)
             .withColumn("changed", ~F.col("_new").eqNullSafe(A.safe_attrs("attributes")))
             .withColumn("attributes", F.col("_new")).drop("_new", "schema"))


# ---------------------------------------------------------------- schema edits
EDITABLE = ["name", "alias", "data_type", "database_data_type", "occurrence", "grouping",
            "page_order_sort", "cleaning_function"]


def invalid_schema_updates(edits: DataFrame) -> DataFrame:
    """Update edits naming fields outside the allowed set."""
    allowed = F.array(*[F.lit(f) for f in EDITABLE])
    return edits.where(F.col("op") == "update").withColumn(
        "bad_fields", F.array_except(F.map_keys(F.col("fields")), allowed)).where(F.size("bad_fields") > 0)


#: fixed values: why a schema edit is rejected
UNKNOWN_PROCESSOR, UNKNOWN_OPERATION, NO_NAME = "unknown processor", "unknown operation", "name is required"
NAME_TAKEN, NO_ATTRIBUTE = "name already exists", "no attribute with that name"
TYPES_NEEDED, BAD_FIELD, BAD_ORDER = "data_type and database_data_type are required", "field not allowed", "page_order_sort is not a number"

_TEXT_FIELDS = [f for f in EDITABLE if f != "page_order_sort"]
ROW_TYPE = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("added", T.LongType())]
                        + [T.StructField(f, T.DoubleType() if f == "page_order_sort" else T.StringType()) for f in EDITABLE])
EDIT_TYPE = T.StructType([T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()), T.StructField("name", T.StringType()),
                          T.StructField("fields", T.MapType(T.StringType(), T.StringType()))])
LOG_TYPE = T.ArrayType(T.StructType([T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()),
                                     T.StructField("name", T.StringType()), T.StructField("reason", T.StringType())]))
FOLD_TYPE = T.StructType([T.StructField("rows", T.ArrayType(ROW_TYPE)), T.StructField("log", LOG_TYPE)])


def _given(text: Column) -> Column:
    """The text, null where empty."""
    return F.when(text != "", text)


def _target(e) -> Column:
    """The name that an edit looks for: an added field's own, else the edit's."""
    return F.when(e["op"] == "add", F.coalesce(_given(F.try_element_at(e["fields"], F.lit("name"))), _given(e["name"]))).otherwise(_given(e["name"]))


def _order_value(fields: Column) -> Column:
    return _given(F.try_element_at(fields, F.lit("page_order_sort"))).try_cast("double")


def _schema_step(acc: Column, e: Column) -> Column:
    """One edit applied to (rows, log)."""
    rows, op, fields, target = acc["rows"], e["op"], e["fields"], _target(e)
    taken = F.exists(rows, lambda r: F.coalesce(r["name"] == target, F.lit(False)))
    has = lambda f: F.coalesce(_given(F.try_element_at(fields, F.lit(f))).isNotNull(), F.lit(False))
    known = op.isin("add", "delete", "update") & op.isNotNull()
    bad_field = F.exists(F.map_keys(fields), lambda k: ~k.isin(*EDITABLE))
    bad_order = has("page_order_sort") & _order_value(fields).isNull()
    reason = (F.when(~F.coalesce(known, F.lit(False)), F.lit(UNKNOWN_OPERATION))
              .when(target.isNull(), F.lit(NO_NAME))
              .when((op == "add") & taken, F.lit(NAME_TAKEN))
              .when((op == "add") & ~(has("data_type") & has("database_data_type")), F.lit(TYPES_NEEDED))
              .when((op != "add") & ~taken, F.lit(NO_ATTRIBUTE))
              .when((op != "delete") & bad_field, F.lit(BAD_FIELD))
              .when((op != "delete") & bad_order, F.lit(BAD_ORDER)))

    def value(f):
        return _order_value(fields) if f == "page_order_sort" else _given(F.try_element_at(fields, F.lit(f)))

    new = F.struct(F.lit(None).cast("int").alias("pos"), e["seq"].alias("added"),
                   *[(target if f == "name" else value(f)).alias(f) for f in EDITABLE]).cast(ROW_TYPE)
    # the first row of that name; the others stay
    at = F.array_position(F.transform(rows, lambda r: F.coalesce(r["name"] == target, F.lit(False))), F.lit(True)) - 1

    def updated(r):
        return F.struct(r["pos"].alias("pos"), r["added"].alias("added"),
                        *[F.when(F.map_contains_key(fields, F.lit(f)), value(f)).otherwise(r[f]).alias(f) for f in EDITABLE]).cast(ROW_TYPE)

    done = (F.when(op == "add", F.concat(rows, F.array(new)))
            .when(op == "delete", F.filter(rows, lambda r: ~F.coalesce(r["name"] == target, F.lit(False))))
            .otherwise(F.transform(rows, lambda r, i: F.when(i == at, updated(r)).otherwise(r))))
    line = F.array(F.struct(e["seq"].alias("seq"), op.alias("op"), e["name"].alias("name"), reason.alias("reason")))
    return F.struct(F.when(reason.isNotNull(), rows).otherwise(done).cast(T.ArrayType(ROW_TYPE)).alias("rows"),
                    F.concat(acc["log"], line).cast(LOG_TYPE).alias("log"))


def apply_schema_edits(schema_rows: DataFrame, edits: DataFrame, processors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply a batch of attribute edits to flat schema rows.

    ``schema_rows``: (processor_id, pos, name, <EDITABLE fields>).
    ``edits``: (processor_id, seq, op in add/delete/update, name,
    fields MAP<STRING,STRING>).  All edits of a processor are applied in the
    order of ``seq``, each to what the earlier ones left.

    * add: the new name is that in ``fields``, else the edit's; needs
      ``data_type`` and ``database_data_type`` and a name not in use; empty
      values are dropped; appended after the last position.
    * delete: removes every row with that name; error when there is none.
    * update: first row with that name; a NULL/"" value removes the field;
      may rename.
    * fields outside the allowed set (U3), an order that is no number, an
      unknown processor, operation or no name at all are rejected.
      ``processors`` (processor_id) are the known ones, by default those with
      schema rows.

    Returns (new schema rows, rejected edits with a reason).

    Edits depend on one another only through names: a batch falls into chains,
    the components of names that renames link within a processor.  Each chain
    is folded on its own by a native ordered aggregate, so one processor's
    batch is as many groups as it has unrelated names, and a group holds one
    chain's edits.  New rows are numbered after the folds."""
    spark = schema_rows.sparkSession
    rows = schema_rows.select("processor_id", F.col("name").alias("node"), F.struct(
        F.col("pos").cast("int").alias("pos"), F.lit(None).cast("long").alias("added"),
        *[F.col(f).cast("double" if f == "page_order_sort" else "string").alias(f) for f in EDITABLE]).cast(ROW_TYPE).alias("row"))
    edits = edits.select("processor_id", F.struct(
        F.col("seq").cast("bigint").alias("seq"), "op", "name",
        F.coalesce("fields", F.create_map().cast("map<string,string>")).alias("fields")).cast(EDIT_TYPE).alias("e"))
    known = (schema_rows if processors is None else processors).select("processor_id").distinct()
    known = known.select("processor_id", F.lit(True).alias("known"))
    work = work_folder(spark, "schema-edits")
    edits.join(known, "processor_id", "left").withColumn("node", _target(F.col("e"))).write.parquet(f"{work}/edits")
    batch = spark.read.parquet(f"{work}/edits")
    lost = batch.where("known is null").select("processor_id", "e.seq", "e.op", "e.name", F.lit(UNKNOWN_PROCESSOR).alias("reason"))
    batch = batch.where("known").drop("known")
    operation = F.coalesce(F.col("e.op").isin("add", "delete", "update"), F.lit(False))
    lost = lost.unionByName(batch.where("node is null").select(
        "processor_id", "e.seq", "e.op", "e.name", F.when(operation, F.lit(NO_NAME)).otherwise(F.lit(UNKNOWN_OPERATION)).alias("reason")))
    batch = batch.where("node is not null")
    new_name = _given(F.try_element_at(F.col("e.fields"), F.lit("name")))
    renames = batch.where((F.col("e.op") == "update") & (new_name != F.col("node")))
    both = lambda a, b: (F.struct("processor_id", a.alias("name")).alias("a"), F.struct("processor_id", b.alias("name")).alias("b"))
    chain = components(renames.select(*both(F.col("node"), new_name)))
    chain = chain.select(F.col("node.processor_id").alias("processor_id"), F.col("node.name").alias("node"), F.col("label.name").alias("chain"))
    chained = lambda df: df.join(chain, ["processor_id", "node"], "left").withColumn("chain", F.coalesce("chain", "node"))
    # one list a chain; rows without a name are a chain that no edit reaches
    parts = (chained(rows).select("processor_id", "chain", "row", F.lit(None).cast(EDIT_TYPE).alias("e"))
             .unionByName(chained(batch).select("processor_id", "chain", F.lit(None).cast(ROW_TYPE).alias("row"), "e")))
    order = F.collect_list(F.when(F.col("e").isNotNull(), F.struct(
        F.col("e.seq").alias("seq"), F.col("e.op").alias("op"), F.col("e.name").alias("name"), F.map_entries("e.fields").alias("f"))))
    lists = parts.groupBy("processor_id", "chain").agg(F.array_sort(F.collect_list("row")).alias("rows"), F.array_sort(order).alias("edits"))
    init = F.struct(F.col("rows").alias("rows"), F.array().cast(LOG_TYPE).alias("log")).cast(FOLD_TYPE)
    step = lambda acc, x: _schema_step(acc, F.struct(x["seq"].alias("seq"), x["op"].alias("op"), x["name"].alias("name"),
                                                     F.map_from_entries(x["f"]).alias("fields")))
    lists.select("processor_id", F.aggregate("edits", init, step).alias("f")).write.parquet(f"{work}/folded")
    folded = spark.read.parquet(f"{work}/folded")
    log = folded.select("processor_id", F.inline("f.log"))
    rejected = log.where("reason is not null").unionByName(lost)
    # a new row stands after all old ones, in the order in which rows were added (deleted ones keep their place)
    last = schema_rows.groupBy("processor_id").agg(F.max("pos").alias("last"))
    w = Window.partitionBy("processor_id").orderBy("seq", "op", "name")
    added = log.where("op = 'add' and reason is null").withColumn("nth", F.row_number().over(w)).select(
        "processor_id", F.col("seq").alias("added"), "nth")
    flat = folded.select("processor_id", F.inline("f.rows"))
    new = (flat.where("added is not null").join(added, ["processor_id", "added"]).join(last, "processor_id", "left")
           .withColumn("pos", (F.coalesce("last", F.lit(-1)) + F.col("nth")).cast("int")))
    cols = ["processor_id", "pos", *EDITABLE]
    return flat.where("added is null").select(*cols).unionByName(new.select(*cols)), rejected.select("processor_id", "seq", "op", "name", "reason")


# ---------------------------------------------------------------- whole processors
PROCESSOR_FIELDS = ["model_id", "document_type", "attributes"]


def edit_processors(processors: DataFrame, changes: DataFrame, key: str = "name") -> tuple[DataFrame, DataFrame]:
    """R3 on whole processors: (new processors, outcome of every change).

    ``changes``: (name, seq, op in upsert/update/delete and some of the other
    columns of ``processors``), any number a name, applied by ``seq``; a null
    column is left as it is.  An upsert makes the processor where it is absent;
    an update or a delete of an absent one changes nothing, with a reason.

    A name exists before a change if its last upsert or delete before was an
    upsert (or if there was none and it existed at first), and a column ends as
    its last accepted writer since the last delete left it: both are native
    windows and aggregates by name, no list is gathered."""
    cols = [c for c in processors.columns if c != key and c in changes.columns]
    first = processors.select(key, F.lit(True).alias("_first"))
    c = changes.join(first, key, "left").withColumn("_first", F.coalesce("_first", F.lit(False)))
    before = Window.partitionBy(key).orderBy("seq", "op").rowsBetween(Window.unboundedPreceding, -1)
    makes = F.when(F.col("op") == "upsert", F.lit(True)).when(F.col("op") == "delete", F.lit(False))
    there = F.coalesce(F.last(makes, ignorenulls=True).over(before), F.col("_first"))
    known = F.coalesce(F.col("op").isin("upsert", "update", "delete"), F.lit(False))
    c = c.withColumn("reason", F.when(F.col(key).isNull(), F.lit(NO_NAME)).when(~known, F.lit(UNKNOWN_OPERATION))
                     .when((F.col("op") != "upsert") & ~there, F.lit(UNKNOWN_PROCESSOR)))
    gone = F.sum(F.when((F.col("op") == "delete") & F.col("reason").isNull(), 1).otherwise(0)).over(
        Window.partitionBy(key).orderBy(F.col("seq").desc(), F.col("op").desc()))
    work = work_folder(processors.sparkSession, "processor-edits")
    c.select(key, "seq", "op", "reason", *cols, (gone == 0).alias("_holds")).write.parquet(work)
    c = processors.sparkSession.read.parquet(work)
    at = F.struct("seq", "op")
    writes = F.col("_holds") & F.col("reason").isNull() & F.col("op").isin("upsert", "update")
    end = c.where(F.col("reason").isNull()).groupBy(key).agg(
        F.bool_or(F.col("op") == "delete").alias("_cleared"), F.bool_or(writes).alias("_there"),
        *[F.max_by(x, F.when(writes & F.col(x).isNotNull(), at)).alias(f"_new_{x}") for x in cols])
    j = processors.withColumn("_old", F.lit(True)).join(end, key, "full")
    cleared = F.coalesce("_cleared", F.lit(False))
    keeps = (F.col("_old").isNotNull() & ~cleared) | F.coalesce("_there", F.lit(False))
    out = j.where(keeps).select(*[F.col(x) if x == key else F.coalesce(F.col(f"_new_{x}"), F.when(~cleared, F.col(x))).alias(x) if x in cols
                                  else F.when(~cleared, F.col(x)).alias(x) for x in processors.columns])
    return out, c.select(key, "seq", "op", F.col("reason").isNull().alias("accepted"), "reason")
