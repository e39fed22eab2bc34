"""Schema-driven cleaning of whole record tables.

Records meet their schema through their group (one join on the group
id; AQE's skew-join handling splits a hot group's partition) and each
attribute and sub-attribute is cleaned inside its array with
``transform``: every record of every document type in one job.
Sub-attributes are cleaned exactly once, under ``parent::child`` (Q-10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import attrs as A
from ..functions.cleaning import clean_state, error_message, run_cleaner
from ..sources.model import SUBS_TYPE
from .schema import SCHEMA_ARR, with_processor


def _prepare(x: Column, lookup_key: Column, fns: Column, only=None) -> Column:
    """Pass 1 per element: look the function up and run it once."""
    fn = F.element_at(fns, lookup_key)
    hit = F.map_contains_key(fns, lookup_key)
    if only is not None:
        hit = hit & only(x)
    return F.struct(x.alias("x"), hit.alias("in_schema"), fn.alias("fn"),
                    run_cleaner(fn, x["value"]).alias("res"))


def _outcome(p: Column) -> Column:
    """Pass 2 per element: its state, worked out once, not once a field that reads it."""
    return F.struct(p["x"].alias("x"), p["fn"].alias("fn"), p["res"].alias("res"), p["in_schema"].alias("in_schema"),
                    F.when(p["in_schema"], clean_state(p["fn"], p["x"]["value"], p["res"])).alias("st"))


def _apply(p: Column, now: Column) -> Column:
    """Pass 3 per element: C1's outcome table applied to the struct."""
    x, r, fn, st = p["x"], p["res"], p["fn"], p["st"]
    act = p["in_schema"] & (st != "skip")
    ok = st == "ok"
    err = st == "error"
    return (x.withField("value", F.when(ok, r["value"]).otherwise(x["value"]))
             .withField("value_type", F.when(ok, r["value_type"]).otherwise(x["value_type"]))
             .withField("normalized_value", F.when(ok, r["value"]).otherwise(x["normalized_value"]))
             .withField("uncleaned_value", F.when(ok, x["value"]).otherwise(x["uncleaned_value"]))
             .withField("cleaned", F.when(act, ok).otherwise(x["cleaned"]))
             .withField("cleaning_checked", F.when(act, F.lit(True)).otherwise(x["cleaning_checked"]))
             .withField("cleaning_error", F.when(err, error_message(fn, x["value"]))
                        .when(act, F.lit(None).cast("string")).otherwise(x["cleaning_error"]))
             .withField("last_cleaned", F.when(ok, now).otherwise(x["last_cleaned"])))


def clean_attributes(attrs: Column, fns: Column, now: Column | None = None, only=None) -> Column:
    """C2 over one attribute array; ``fns`` is MAP<name, cleaning_function>.

    Three passes of ``transform``: the first runs each element's cleaner
    once, the second tells its state, the third applies the outcome, so no
    regex runs twice and no state is worked out once a field."""
    now = F.current_timestamp() if now is None else now

    def prep(a):
        subs = F.transform(a["subattributes"], lambda s: _prepare(
            s, F.concat(F.coalesce(s["top_level_attribute"], a["key"]), F.lit("::"), s["key"]), fns, only))
        return F.struct(_prepare(a, a["key"], fns, only).alias("p"), subs.alias("subs"))

    def state(q):
        return F.struct(_outcome(q["p"]).alias("p"), F.transform(q["subs"], _outcome).alias("subs"))

    def fin(q):
        return _apply(q["p"], now).withField("subattributes", F.transform(q["subs"], lambda s: _apply(s, now)))

    return F.transform(F.transform(F.transform(A.safe_attrs(attrs), prep), state), fin)


def processor_functions(processors: DataFrame) -> DataFrame:
    """(processor_id, fns MAP<name, cleaning_function>); the last definition
    of a name wins (A7)."""
    entries = F.transform(F.coalesce("attributes", F.array().cast(SCHEMA_ARR)),
                          lambda s: F.struct(s["name"].alias("k"), s["cleaning_function"].alias("v")))
    # keep the last occurrence of each name before building the map
    idx = F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i")))
    last = F.filter(entries, lambda e, i: ~F.exists(idx, lambda x: (x["k"] == e["k"]) & (x["i"] > i)))
    return processors.select("processor_id", F.map_from_entries(last).alias("fns"))


def schema_functions(record_groups: DataFrame, processors: DataFrame) -> DataFrame:
    """(record_group_id, fns) for groups with a schema."""
    return with_processor(record_groups.select("record_group_id"), record_groups, processor_functions(processors), "fns").where("fns is not null")


def clean_records(records: DataFrame, record_groups: DataFrame, processors: DataFrame,
                  now: Column | None = None) -> DataFrame:
    """Every record cleaned against its group's schema, with the
    before/after (key, value) lists the history needs (``audit_before``,
    ``audit_after``).  Records of groups without schema are unchanged."""
    return clean_by_functions(with_processor(records, record_groups, processor_functions(processors), "fns"), now)


def clean_by_functions(j: DataFrame, now: Column | None = None) -> DataFrame:
    """C2 on records that have their ``fns`` with them."""
    empty = F.create_map().cast("map<string,string>")
    new = clean_attributes(F.col("attributes"), F.coalesce(F.col("fns"), empty), now)

    def kv(arr):
        return F.transform(A.safe_attrs(arr), lambda a: F.struct(
            a["key"].alias("key"), a["value"].alias("value"),
            F.transform(F.coalesce(a["subattributes"], F.array().cast(SUBS_TYPE)),
                        lambda s: F.struct(s["key"].alias("key"), s["value"].alias("value"))).alias("subattributes")))

    return (j.withColumn("audit_before", kv(F.col("attributes")))
             .withColumn("attributes", new)
             .withColumn("audit_after", kv(F.col("attributes")))
             .drop("fns"))


def clean_long(records: DataFrame, record_groups: DataFrame, processors: DataFrame,
               now: Column | None = None) -> DataFrame:
    """C2 in long form: one row per attribute and sub-attribute with its
    cleaned state.  Same rules as ``clean_records``, but the cleaner runs on
    a flat column (whole-stage code generation) instead of inside a
    higher-order function, which Spark evaluates without codegen.  Use it
    when rows are the answer (audits, summaries, exports)."""
    from .views import attributes_long
    now = F.current_timestamp() if now is None else now
    # records meet their functions before they become rows, and bring no more than these rows show
    slim = records.select("record_id", "record_group_id", A.with_fields_only(
        "attributes", "key", "value", "top_level_attribute", "value_type", "cleaned", "cleaning_checked", "cleaning_error").alias("attributes"))
    j = attributes_long(with_processor(slim, record_groups, processor_functions(processors), "fns"),
                        keep=("record_group_id", "fns"), extra=("value_type", "cleaned"))
    lookup = F.when(F.col("sub_pos").isNull(), F.col("key")) \
        .otherwise(F.concat(F.col("top_level_attribute"), F.lit("::"), F.col("key")))
    fmap = F.coalesce(F.col("fns"), F.create_map().cast("map<string,string>"))
    # two projections: the cleaner result is computed once into a column,
    # then read several times (one CASE per output column would otherwise
    # repeat it)
    j = j.select("*", F.element_at(fmap, lookup).alias("_fn"), F.map_contains_key(fmap, lookup).alias("_in"))
    j = j.select("*", run_cleaner(F.col("_fn"), F.col("value")).alias("_res"))
    fn, res = F.col("_fn"), F.col("_res")
    st = clean_state(fn, F.col("value"), res)
    act = F.col("_in") & (st != "skip")
    ok = act & (st == "ok")
    err = act & (st == "error")
    return j.select(
        "record_id", "record_group_id", "attr_pos", "sub_pos", "key",
        F.col("value").alias("value_before"),
        F.when(ok, res["value"]).otherwise(F.col("value")).alias("value"),
        F.when(ok, res["value_type"]).otherwise(F.col("value_type")).alias("value_type"),
        F.when(act, ok).otherwise(F.col("cleaned")).alias("cleaned"),
        F.when(act, F.lit(True)).otherwise(F.col("cleaning_checked")).alias("cleaning_checked"),
        F.when(err, error_message(fn, F.col("value"))).when(act, F.lit(None).cast("string"))
         .otherwise(F.col("cleaning_error")).alias("cleaning_error"),
        F.when(ok, now).alias("last_cleaned"))
