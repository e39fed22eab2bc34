"""The record model and how it is derived from the driver's tables.

Storage model (one nested row per scanned document, as the source system
keeps it) with fixed Spark types, plus the flat dimension tables.  The
``load_*`` functions derive every table from the parquet files in a test
data directory so that the work of each query grows with the data:

* ``records``    <- orders, with ``attributes`` nested from lineitem
* ``record_groups`` <- customer, ``projects`` <- nation, ``teams`` <- region
* ``users``      <- supplier, ``history`` / locks <- events
* ``notes``      <- conversations, page pixels <- embeddings

``records`` are built from flat rows: one exchange by order key nests line
items and meets orders, one more lays the rows out by group.  The wide nested
structs are made after both, so no exchange, sort or buffer holds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N
from ..session import hadoop_path

_S, _D, _I, _B, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.TimestampType()
_POLY = T.ArrayType(T.ArrayType(_D))


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SUB_TYPE: T.StructType = _struct(
    ("key", _S), ("value", _S), ("value_type", _S), ("raw_text", _S), ("text_value", _S),
    ("normalized_value", _S), ("ai_confidence", _D), ("confidence", _D),
    ("normalized_vertices", _POLY), ("user_provided_coordinates", _POLY),
    ("page", _I), ("edited", _B), ("user_added", _B), ("is_subattribute", _B),
    ("top_level_attribute", _S), ("cleaned", _B), ("cleaning_checked", _B),
    ("cleaning_error", _S), ("uncleaned_value", _S), ("last_cleaned", _TS),
    ("last_updated", _TS), ("last_updated_user", _S),
)
SUBS_TYPE = T.ArrayType(SUB_TYPE)
ATTR_TYPE: T.StructType = T.StructType(list(SUB_TYPE.fields) + [T.StructField("subattributes", SUBS_TYPE, True)])
ATTRS_TYPE = T.ArrayType(ATTR_TYPE)

NOTE_TYPE = _struct(
    ("idx", _I), ("text", _S), ("creator", _S), ("ts", _TS), ("resolved", _B), ("deleted", _B),
    ("last_updated", _TS), ("last_updated_user", _S), ("is_reply", _B), ("replies_to", _I),
    ("replies", T.ArrayType(_I)),
)
SCHEMA_ATTR_TYPE = _struct(
    ("name", _S), ("alias", _S), ("data_type", _S), ("database_data_type", _S), ("occurrence", _S),
    ("grouping", _S), ("page_order_sort", _D), ("cleaning_function", _S),
)

# --- fixed values of the fixture model (ours, see FIXTURES.md part B) -------
# Document-type schema shared by the four processors: (name, data type,
# cleaning function).  page_order_sort = 10 - field number; the two
# "parent::child" rows describe sub-attributes of "Field 3".
SCHEMA_ROWS = [
    ("T", "number", "string_to_int", 9.0),
    ("Sec", "number", "string_to_float", 8.0),
    ("Field 3", "table", "convert_hole_size_to_decimal", 7.0),
    ("Field 4", "date", "string_to_date", 6.0),
    ("Field 5", "date", "clean_date", 5.0),
    ("Field 6", "boolean", "clean_bool", 4.0),
    ("Field 9", "text", "llm_clean", 1.0),
    ("Field 3::Depth", "number", "string_to_float", None),
    ("Field 3::Sec", "number", "string_to_int", None),
]
PROCESSOR_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
# Roles: (id, category, permissions)
ROLE_ROWS = [
    ("admin", "team", ["view_record", "edit_record", "verify_record", "delete_record", "manage_team"]),
    ("reviewer", "team", ["view_record", "edit_record", "verify_record"]),
    ("viewer", "team", ["view_record"]),
    ("sys_admin", "system", ["manage_system", "view_record"]),
    ("exporter", "system", ["download_records"]),
]
# Built-in fallback processor used when a group's processor is unknown.
DEFAULT_PROCESSOR = ("default", "Default Processor", None, "default")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# attributes from line items
# --------------------------------------------------------------------------

def _null(dt: str) -> Column:
    return F.lit(None).cast(dt)


def _attr_key(li) -> Column:
    linenumber = li.l_linenumber
    return (F.when(linenumber == 1, F.lit("T"))
            .when(linenumber == 2, F.lit("Sec"))
            .otherwise(F.concat(F.lit("Field "), linenumber.cast("string"))))


def _attr_value(li) -> Column:
    sel = F.pmod(li.l_partkey + li.l_linenumber, F.lit(5))
    return (F.when(sel == 0, F.concat(F.lit("T"), li.l_partkey.cast("string")))
            .when(sel == 1, li.l_quantity.cast("bigint").cast("string"))
            .when(sel == 2, F.concat(li.l_partkey.cast("string"), F.lit(" 3/4")))
            .when(sel == 3, F.date_format(li.l_shipdate, "yyyy-MM-dd"))
            .otherwise(F.lit("")))


def _sub(key: str, value: Column, parent_key: Column, ai_conf: Column, conf: Column,
         err: Column) -> Column:
    return F.struct(
        F.lit(key).alias("key"), value.alias("value"), F.lit("string").alias("value_type"),
        value.alias("raw_text"), value.alias("text_value"), _null("string").alias("normalized_value"),
        ai_conf.alias("ai_confidence"), conf.alias("confidence"),
        _null("array<array<double>>").alias("normalized_vertices"),
        _null("array<array<double>>").alias("user_provided_coordinates"),
        F.lit(1).alias("page"), F.lit(False).alias("edited"), F.lit(False).alias("user_added"),
        F.lit(True).alias("is_subattribute"), parent_key.alias("top_level_attribute"),
        F.lit(False).alias("cleaned"), F.lit(True).alias("cleaning_checked"),
        err.alias("cleaning_error"), _null("string").alias("uncleaned_value"),
        _null("timestamp").alias("last_cleaned"), _null("timestamp").alias("last_updated"),
        _null("string").alias("last_updated_user"),
    ).cast(SUB_TYPE)


def attribute_struct(li: Column) -> Column:
    """One attribute struct of a line item (the fixture rules)."""
    key, value = li["key"], li["value"]
    conf = F.round(F.lit(1.0) - li.l_discount, 2)
    err = (F.when((li.l_returnflag == "R") & (li.l_linestatus == "F") & (li.l_linenumber == 5), F.lit(""))
           .when(li.l_returnflag == "R", F.lit("bad value")))
    subs = F.when(
        li.l_linenumber == 3,
        F.array(
            _sub("Depth", li.l_extendedprice.cast("decimal(12,2)").cast("string"), key, conf,
                 F.round(F.lit(1.0) - li.l_tax, 2), _null("string")),
            _sub("Sec", li.l_suppkey.cast("string"), key, conf, F.round(F.lit(1.0) - li.l_tax, 2),
                 F.when(F.pmod(li.l_suppkey, F.lit(7)) == 0, F.lit("bad value"))),
        ))
    return F.struct(
        key.alias("key"), value.alias("value"), F.lit("string").alias("value_type"),
        value.alias("raw_text"), value.alias("text_value"), _null("string").alias("normalized_value"),
        conf.alias("ai_confidence"), conf.alias("confidence"),
        _null("array<array<double>>").alias("normalized_vertices"),
        _null("array<array<double>>").alias("user_provided_coordinates"),
        F.lit(1).alias("page"), (li.l_quantity > 45).alias("edited"),
        (li.l_tax >= 0.08).alias("user_added"), F.lit(False).alias("is_subattribute"),
        _null("string").alias("top_level_attribute"), F.lit(False).alias("cleaned"),
        li.l_returnflag.isin("R", "A").alias("cleaning_checked"), err.alias("cleaning_error"),
        _null("string").alias("uncleaned_value"), _null("timestamp").alias("last_cleaned"),
        _null("timestamp").alias("last_updated"), _null("string").alias("last_updated_user"),
        subs.alias("subattributes"),
    ).cast(ATTR_TYPE)


#: what a record takes from its order
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate"]

# Position of a line item inside its record: these six columns are unique
# per line item in the generated data.
POSITION_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]


#: bytes of input files that a task of a nesting shuffle takes at most, so that its sort stays in memory
BYTES_A_TASK = 16 << 20


def tasks_for(spark: SparkSession, *paths: str) -> int:
    """Shuffle partitions for a job over these files: the session's count, more
    where the input is so large that a task would get over ``BYTES_A_TASK``."""
    total = 0
    for path in paths:
        fs, p = hadoop_path(spark, path)
        total += fs.getContentSummary(p).getLength()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BYTES_A_TASK))


def spread(df: DataFrame, tasks: int, *keys) -> DataFrame:
    """``df`` hashed on ``keys``; the count is only fixed where it's above the
    session's own, so that adaptive execution can merge small partitions."""
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(tasks, *keys)
    return df.repartition(*keys)


def even_tasks(spark: SparkSession, *paths: str) -> int:
    """``tasks_for`` where the work after the exchange is heavy: some a core
    (unless the files are small), as about one a core may come to two rounds."""
    size = sum(fs.getContentSummary(p).getLength() for fs, p in (hadoop_path(spark, path) for path in paths))
    return max(tasks_for(spark, *paths), min(3 * spark.sparkContext.defaultParallelism, -(-size // (1 << 20))))


def line_items(li: DataFrame, tasks: int | None = None, item=None, fixed: bool = False) -> DataFrame:
    """(l_orderkey, items): the line items of each order as they are, or
    ``item(li)`` of each (flat columns, made by the row after the exchange).
    ``fixed``: of ``tasks`` partitions, which adaptive execution won't merge.

    Only the flat columns are shuffled, before any aggregate buffer; the wide
    structs made of them come after the last exchange (``in_position``).  The
    group size is one document (bounded by the source system's document size
    limit)."""
    keys = ["l_orderkey"]
    rows = li.repartition(tasks, *keys) if fixed else spread(li, tasks or 0, *keys)
    made = item(rows) if item else [F.col(c) for c in li.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.collect_list(F.struct(*made)).alias("items"))


def in_position(items: Column, made) -> Column:
    """``made(item)`` of each item, which has its ``key`` and ``value`` by then,
    in position order.  ``collect_list`` has no order of its own: (sort key,
    made) is sorted, then the key dropped."""
    named = F.transform(items, lambda s: s.withField("key", _attr_key(s)).withField("value", _attr_value(s)))
    keyed = F.transform(named, lambda s: F.struct(*[s[c].alias(c) for c in POSITION_ORDER], made(s).alias("a")))
    return F.transform(F.array_sort(keyed), lambda s: s["a"])


def records_from(orders: DataFrame, lineitem: DataFrame | None, layout=None, tasks: int | None = None) -> DataFrame:
    """Records of ``orders`` with the attributes of ``lineitem``.  ``layout``
    gets the joined flat rows and the expressions of (record_group_id,
    record_id), so that whatever it shuffles is flat as well."""
    o = orders
    if lineitem is not None:
        nested = line_items(lineitem, tasks)
        o = spread(orders.select(*ORDER_COLUMNS), tasks or 0, "o_orderkey")
        o = o.join(nested, o.o_orderkey == nested.l_orderkey, "left").drop("l_orderkey")
        if layout:
            o = layout(o, o.o_custkey.cast("string"), o.o_orderkey)
    oid = o.o_orderkey
    name = F.when(F.pmod(oid, F.lit(5)) == 0, F.concat(F.lit("scan_"), o.o_custkey.cast("string"))) \
        .otherwise(F.concat(oid.cast("string"), F.lit("_"), o.o_custkey.cast("string")))
    m3 = F.pmod(oid, F.lit(3))
    review = (F.when(o.o_orderpriority == "1-URGENT", F.lit("defective"))
              .when(o.o_orderstatus == "F", F.lit("reviewed"))
              .when(o.o_orderstatus == "P", F.lit("incomplete"))
              .otherwise(F.lit("unreviewed")))
    verification = (F.when((o.o_orderstatus == "F") & (o.o_orderpriority == "2-HIGH"), F.lit("required"))
                    .when((o.o_orderstatus == "F") & (o.o_orderpriority == "5-LOW"), F.lit("verified")))
    base = o.select(
        oid.alias("record_id"),
        o.o_custkey.cast("string").alias("record_group_id"),
        name.alias("name"),
        F.when(m3 == 0, F.concat(name, F.lit(".png"))).when(m3 == 1, F.concat(name, F.lit(".pdf.png")))
         .otherwise(name).alias("filename"),
        F.when(m3 == 0, F.concat(name, F.lit(".png"))).when(m3 == 1, F.concat(name, F.lit(".pdf")))
         .otherwise(name).alias("original_filename"),
        F.lit("digitized").alias("status"),
        _null("string").alias("error_message"),
        review.alias("review_status"),
        verification.alias("verification_status"),
        F.when(review == "defective", F.array(F.lit("illegible"))).otherwise(F.array().cast("array<string>"))
         .alias("defective_categories"),
        _null("string").alias("defective_description"),
        F.pmod(oid, F.lit(4)).cast("int").alias("_pages"),
        (F.pmod(oid, F.lit(11)) == 0).alias("_bad_page"),
        o.o_orderdate.alias("date_created"),
        *([o["items"]] if lineitem is not None else []),
    )
    base = base.withColumn("api_number", N.api_number(F.col("name")))
    pages = N.page_names(F.col("name"), F.col("_pages"))
    base = base.withColumn(
        "image_files", F.when(F.col("_bad_page"), F.concat(F.array(F.lit("x")), pages)).otherwise(pages)
    ).drop("_pages", "_bad_page")
    if lineitem is None:
        return base.withColumn("attributes", F.array().cast(ATTRS_TYPE))
    return (base.withColumn("attributes", F.coalesce(in_position(F.col("items"), attribute_struct), F.array().cast(ATTRS_TYPE)))
                .drop("items"))


def load_records(spark: SparkSession, sf_dir: str, with_attributes: bool = True) -> DataFrame:
    """The records table.  With attributes it is the stored nested table
    (built once per input fingerprint, see ``store``); without, the flat
    record rows straight from orders."""
    orders = table(spark, sf_dir, "orders")
    if not with_attributes:
        return records_from(orders, None)
    from . import store
    if not store.enabled():
        return build_records(spark, sf_dir)
    d = sf_dir.rstrip("/")
    return store.stored_table(spark, "records", [f"{d}/orders.parquet", f"{d}/lineitem.parquet"],
                              lambda: build_records(spark, sf_dir, store.cluster_by))


def build_records(spark: SparkSession, sf_dir: str, layout=None) -> DataFrame:
    """Derive the nested records from orders and lineitem: one shuffle of flat
    rows, and one more of them for a ``layout``."""
    d = sf_dir.rstrip("/")
    tasks = tasks_for(spark, f"{d}/orders.parquet", f"{d}/lineitem.parquet")
    return records_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                        layout and (lambda df, *keys: layout(df, tasks, *keys)), tasks)


# --------------------------------------------------------------------------
# dimension tables
# --------------------------------------------------------------------------

def load_record_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation and region are dimension tables of 25 / 5 rows by definition
    nr = F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("team")))
    return (c.join(nr, c.c_nationkey == nr.n_nationkey, "left")
             .select(c.c_custkey.cast("string").alias("record_group_id"),
                     c.c_name.alias("name"),
                     c.c_nationkey.cast("string").alias("project_id"),
                     c.c_mktsegment.alias("processor_id"),
                     F.col("team")))


def load_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects from nation.  The project -> groups link is kept flat, as
    ``record_groups.project_id`` (never gathered into one row per project)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
             .select(n.n_nationkey.cast("string").alias("project_id"), n.n_name.alias("name"),
                     F.col("r_name").alias("team")))


def load_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams from region with their project list (a team document's list:
    the nations of the region).  Membership is read from ``users``
    (default team, team roles), not from a per-team member array."""
    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation")
    plist = n.groupBy(F.col("n_regionkey").alias("_pr")).agg(
        F.array_sort(F.collect_list(F.col("n_nationkey").cast("string"))).alias("project_list"))
    return (r.join(plist, r.r_regionkey == plist._pr, "left")
             .select(F.col("r_name").alias("name"), F.col("r_name").alias("display_name"),
                     F.coalesce("project_list", F.array().cast("array<string>")).alias("project_list")))


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nr = F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    m = F.pmod(s.s_suppkey, F.lit(3))
    team_role = F.when(m == 0, F.lit("admin")).when(m == 1, F.lit("reviewer")).otherwise(F.lit("viewer"))
    system = (F.when(m == 0, F.array(F.lit("sys_admin")))
              .when(m == 2, F.array(F.lit("exporter")))
              .otherwise(F.array().cast("array<string>")))
    return (s.join(nr, s.s_nationkey == nr.n_nationkey, "left")
             .select(s.s_name.alias("email"), s.s_name.alias("name"), F.col("r_name").alias("default_team"),
                     F.when(F.col("r_name").isNotNull(),
                            F.create_map(F.col("r_name"), F.array(team_role))).alias("roles_team"),
                     system.alias("roles_system")))


def load_roles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROLE_ROWS, "id STRING, category STRING, permissions ARRAY<STRING>")


def schema_array() -> Column:
    return F.array(*[
        F.struct(F.lit(n).alias("name"), _null("string").alias("alias"), F.lit(dt).alias("data_type"),
                 F.lit("table" if dt == "table" else "varchar").alias("database_data_type"), F.lit("single").alias("occurrence"),
                 _null("string").alias("grouping"), F.lit(pos).cast("double").alias("page_order_sort"),
                 F.lit(fn).alias("cleaning_function"))
        for n, dt, fn, pos in SCHEMA_ROWS
    ]).cast(T.ArrayType(SCHEMA_ATTR_TYPE))


def load_processors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processor catalogue (stored once: it is a small table that many
    queries join, and its row-count check before a broadcast then reads
    one small file instead of re-deriving it)."""
    from . import store
    if not store.enabled():
        return build_processors(spark, sf_dir)
    return store.stored_table(spark, "processors", [f"{sf_dir.rstrip('/')}/customer.parquet"],
                              lambda: build_processors(spark, sf_dir).coalesce(1))


def build_processors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One processor per market segment present in customer, except
    MACHINERY (the fallback case)."""
    c = table(spark, sf_dir, "customer")
    seg = c.select("c_mktsegment").distinct().where(F.col("c_mktsegment").isin(*PROCESSOR_SEGMENTS))
    return seg.select(
        F.col("c_mktsegment").alias("processor_id"),
        F.col("c_mktsegment").alias("name"),
        F.concat(F.lit("model-"), F.lower("c_mktsegment")).alias("model_id"),
        F.lower("c_mktsegment").alias("document_type"),
        schema_array().alias("attributes"),
    )


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_from(table(spark, sf_dir, "events"))


def history_from(e: DataFrame) -> DataFrame:
    """History rows from an events frame (batch or streaming)."""
    action = (F.when(e.event_type == "click", F.lit("updateRecord"))
              .when(e.event_type == "purchase", F.lit("cleanRecord"))
              .otherwise(e.event_type))
    return e.select(
        e.event_id.alias("history_id"), action.alias("action"),
        user_email(e.user_id).alias("user"),
        F.pmod(e.event_id, F.lit(1500)).alias("record_id"),
        e.ts.alias("ts"),
        e.props.alias("query"),
        F.concat(F.lit('{"key": "v", "value": '), e.value.cast("string"), F.lit("}")).alias("previous_state"),
    )


def user_email(user_id: Column) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(user_id.cast("string"), 9, "0"))


def load_locks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user = the lock that user holds (record, time).

    ``max_by`` is an ordinary aggregate, so a hot user is pre-aggregated
    map-side before the shuffle."""
    e = table(spark, sf_dir, "events")
    latest = e.groupBy("user_id").agg(F.max_by(F.struct("ts", "event_id"), F.struct("ts", "event_id")).alias("l"))
    return latest.select(F.pmod(F.col("l.event_id"), F.lit(1500)).alias("record_id"),
                         user_email(F.col("user_id")).alias("user"),
                         F.col("l.ts").alias("timestamp"))


def load_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat notes: one row per conversation turn (record_id = conv_id)."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        c.conv_id.alias("record_id"), c.turn.cast("int").alias("idx"), c.text.alias("text"),
        c.role.alias("creator"), (c.role == "assistant").alias("is_reply"),
        F.when(c.role == "assistant", (c.turn - 1).cast("int")).alias("replies_to"),
    )


def load_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit batch: line items with ``l_partkey % 50 = 0``, one edit each.

    op by ``l_linenumber % 3`` (0 replace, 1 insert after, 2 delete), index =
    the line item's position in its record, applied in position order."""
    li = table(spark, sf_dir, "lineitem")
    from pyspark.sql import Window
    w = Window.partitionBy("l_orderkey").orderBy(*POSITION_ORDER)
    pos = li.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))
    m = F.pmod(F.col("l_linenumber"), F.lit(3))
    return (pos.where(F.pmod(F.col("l_partkey"), F.lit(50)) == 0)
               .select(F.col("l_orderkey").alias("record_id"), F.col("pos").alias("seq"),
                       F.when(m == 0, F.lit("replace")).when(m == 1, F.lit("insert")).otherwise(F.lit("delete"))
                        .alias("op"),
                       F.col("pos").alias("idx"),
                       F.concat(F.lit("edited_"), F.col("l_partkey").cast("string")).alias("payload"),
                       user_email(F.col("l_suppkey")).alias("user"),
                       F.col("l_shipdate").alias("ts")))


def load_model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "records": load_records(spark, sf_dir),
        "record_groups": load_record_groups(spark, sf_dir),
        "projects": load_projects(spark, sf_dir),
        "teams": load_teams(spark, sf_dir),
        "users": load_users(spark, sf_dir),
        "roles": load_roles(spark),
        "processors": load_processors(spark, sf_dir),
        "history": load_history(spark, sf_dir),
        "locks": load_locks(spark, sf_dir),
        "notes": load_notes(spark, sf_dir),
        "edits": load_edits(spark, sf_dir),
    }


# fixed values: extensions given to new upload candidates, by o_orderkey % 5
UPLOAD_EXTS = [".pdf", ".TIF", ".jpg", ".docx", ".png"]


def load_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload candidates derived from orders: every 7th record offers its
    own stored filename again (a duplicate), the next one a new file; one
    in 91 names a group that does not exist."""
    o = table(spark, sf_dir, "orders")
    recs = records_from(o, None).select("record_id", "filename")
    m7 = F.pmod(F.col("o_orderkey"), F.lit(7))
    ext = F.element_at(F.array(*[F.lit(e) for e in UPLOAD_EXTS]), (F.pmod(F.col("o_orderkey"), F.lit(5)) + 1).cast("int"))
    cand = o.where(m7 <= 1).select(
        "o_orderkey", m7.alias("_m7"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(91)) == 0, F.concat(F.lit("g"), F.col("o_custkey").cast("string")))
         .otherwise(F.col("o_custkey").cast("string")).alias("record_group_id"),
        F.concat(F.lit("upload_"), F.col("o_orderkey").cast("string"), ext).alias("_new"))
    j = cand.join(recs, cand.o_orderkey == recs.record_id)
    return j.select(F.col("o_orderkey").alias("upload_id"), "record_group_id",
                    F.when(F.col("_m7") == 0, F.col("filename")).otherwise(F.col("_new")).alias("upload_name"))


def load_storage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored page images (path, length) as a storage listing would give
    them: every valid page of every record, except the records with
    ``o_orderkey % 17 = 0`` whose files are missing; sizes derived from
    the order key and page position."""
    recs = records_from(table(spark, sf_dir, "orders"), None)
    pages = recs.where(F.pmod(F.col("record_id"), F.lit(17)) != 0).select(
        "record_id", "record_group_id", F.posexplode(N.valid_images(F.col("image_files"))).alias("p", "f"))
    return pages.select(
        F.concat_ws("/", F.lit("uploads"), "record_group_id", F.col("record_id").cast("string"), "f").alias("path"),
        (F.lit(1000) + F.pmod(F.col("record_id"), F.lit(1000)) * 10 + F.col("p")).cast("bigint").alias("length"))


def load_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extraction responses as stored files (derived once, see
    ``store``); the service's output is a file per document in practice."""
    from . import store
    if not store.enabled():
        return build_payloads(spark, sf_dir)
    return spark.read.parquet(payloads_path(spark, sf_dir))


def payloads_path(spark: SparkSession, sf_dir: str) -> str:
    """Directory of the stored payload files (a file-stream source)."""
    from . import store
    return store.stored_path(spark, "payloads", [f"{sf_dir.rstrip('/')}/lineitem.parquet"],
                             lambda: build_payloads(spark, sf_dir))


def build_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction-service responses derived from line items: one JSON
    document per order listing its entities (type, mention text,
    normalised text for dates, confidence, a five-vertex polygon, and two
    properties for line 3).  Even orders use the ``{"attributes_list":
    [...]}`` form; every 97th payload is not JSON at all."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    per = line_items(table(spark, sf_dir, "lineitem"), even_tasks(spark, path), _entity_fields, fixed=True)
    # the items' first fields are their order
    ents = F.transform(F.sort_array("items"), _entity)
    oid = F.col("l_orderkey")
    payload = (F.when(F.pmod(oid, F.lit(97)) == 0, F.lit("not json"))
               .when(F.pmod(oid, F.lit(2)) == 0, F.to_json(F.struct(ents.alias("attributes_list"))))
               .otherwise(F.to_json(ents)))
    return per.select(oid.alias("record_id"), payload.alias("payload"))


def _entity_fields(li) -> list[Column]:
    """What an entity takes from its line item, worked out while that is a
    flat row (a lambda over nested items is interpreted).  Position comes
    first, then what entities of one position can differ in."""
    value = _attr_value(li)
    is_date = F.pmod(li.l_partkey + li.l_linenumber, F.lit(5)) == 3
    third = li.l_linenumber == 3
    return [
        *[li[c] for c in POSITION_ORDER],
        F.when(is_date, F.regexp_replace(value, "-", "/")).otherwise(value).alias("mention"),
        F.when(third, F.round(F.lit(1.0) - li.l_tax, 2)).alias("part_conf"),
        F.when(is_date, value).otherwise(F.lit("")).alias("norm"),
        _attr_key(li).alias("key"), F.round(F.lit(1.0) - li.l_discount, 2).alias("conf"),
        (li.l_linenumber.cast("double") / 10.0).alias("x"),
        F.when(third, li.l_extendedprice.cast("decimal(12,2)").cast("string")).alias("depth"),
    ]


def _entity(s: Column) -> Column:
    """One entity of an extraction response from its ``_entity_fields``."""
    verts = F.array(*[F.struct((s["x"] + dx).alias("x"), F.lit(dy).alias("y"))
                      for dx, dy in ((0.0, 0.1), (0.05, 0.1), (0.05, 0.2), (0.0, 0.2), (0.0, 0.15))])
    page_anchor = F.struct(F.array(F.struct(F.lit(1).alias("page"),
                                            F.struct(verts.alias("normalized_vertices")).alias("bounding_poly")))
                           .alias("page_refs"))

    def prop(t, v):
        return F.struct(F.lit(t).alias("type"), v.alias("mention_text"),
                        F.struct(v.alias("content")).alias("text_anchor"),
                        F.struct(F.lit("").alias("text")).alias("normalized_value"),
                        s["part_conf"].alias("confidence"), page_anchor.alias("page_anchor"))

    props = F.when(s["l_linenumber"] == 3, F.array(prop("Depth", s["depth"]), prop("Sec", s["l_suppkey"].cast("string"))))
    return F.struct(
        s["key"].alias("type"), s["mention"].alias("mention_text"), F.struct(s["mention"].alias("content")).alias("text_anchor"),
        F.struct(s["norm"].alias("text")).alias("normalized_value"),
        s["conf"].alias("confidence"), page_anchor.alias("page_anchor"), props.alias("properties"))
