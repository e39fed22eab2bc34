"""Group progress and catalogue views.

Aggregations are plain ``groupBy().agg()``: Spark runs them as partial
(map-side) + final hash aggregates, so a record group holding a third of
all records is pre-aggregated on every executor before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import attrs as A
from ..sources.model import SUBS_TYPE

REVIEWED = ["defective", "reviewed"]


def group_stats(records: DataFrame, group_col: str = "record_group_id") -> DataFrame:
    """A1: per record group ``total_amt``, ``reviewed_amt`` and ``error_amt``
    (strict error rule F4)."""
    return (records
            .select(group_col, "review_status", A.has_errors_strict("attributes").alias("_err"))
            .groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("total_amt"),
                 F.count(F.when(F.col("review_status").isin(*REVIEWED), 1)).alias("reviewed_amt"),
                 F.count(F.when(F.col("_err"), 1)).alias("error_amt")))


def group_progress(record_groups: DataFrame, records: DataFrame) -> DataFrame:
    """Every record group with its progress, zeros where it has no
    records.  The aggregate output is already hash-partitioned on the
    group id, so only the (dimension-sized) group table is exchanged."""
    stats = group_stats(records)
    out = record_groups.join(stats, "record_group_id", "left")
    return out.select(
        *record_groups.columns,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("total_amt", "reviewed_amt", "error_amt")],
    )


def record_flags(records: DataFrame) -> DataFrame:
    """F3 / F4 per record: lenient (list view) and strict (statistics)."""
    return records.select("record_id", "record_group_id",
                          A.has_errors("attributes").alias("has_errors"),
                          A.has_errors_strict("attributes").alias("has_errors_strict"))


def record_count(records: DataFrame, cond: Column | None = None) -> DataFrame:
    """A2: count of records under a filter, independent of paging."""
    df = records if cond is None else records.where(cond)
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def attributes_long(records: DataFrame, keep=("record_group_id",), extra=()) -> DataFrame:
    """P10: one row per attribute and per sub-attribute.

    A single generator over one array per record (attribute row followed by
    its sub-attribute rows) instead of two explodes and a union: one pass,
    no shuffle."""
    def rows(a: Column, i: Column) -> Column:
        me = F.array(F.struct(i.alias("attr_pos"), F.lit(None).cast("int").alias("sub_pos"),
                              a["key"].alias("key"), a["value"].alias("value"),
                              F.lit(None).cast("string").alias("top_level_attribute"),
                              a["cleaning_checked"].alias("cleaning_checked"),
                              a["cleaning_error"].alias("cleaning_error"),
                              a["edited"].alias("edited"), a["user_added"].alias("user_added"),
                              *[a[c].alias(c) for c in extra]))
        subs = F.transform(F.coalesce(a["subattributes"], F.array().cast(SUBS_TYPE)),
                           lambda s, j: F.struct(i.alias("attr_pos"), j.alias("sub_pos"),
                                                 s["key"].alias("key"), s["value"].alias("value"),
                                                 s["top_level_attribute"].alias("top_level_attribute"),
                                                 s["cleaning_checked"].alias("cleaning_checked"),
                                                 s["cleaning_error"].alias("cleaning_error"),
                                                 s["edited"].alias("edited"), s["user_added"].alias("user_added"),
                                                 *[s[c].alias(c) for c in extra]))
        return F.concat(me, subs)

    flat = F.flatten(F.transform(A.safe_attrs("attributes"), rows))
    # outer generator + filter: the plain one makes Spark infer a
    # size(...) > 0 filter that re-inlines the whole array expression
    return records.select("record_id", *keep, F.inline_outer(flat)).where(F.col("attr_pos").isNotNull())


def column_catalog(record_groups: DataFrame, processors: DataFrame) -> DataFrame:
    """A3: distinct attribute names over the processors of the groups in
    scope (per project here); ``name_pos`` gives the schema order."""
    procs = processors.select("processor_id", F.posexplode("attributes").alias("name_pos", "a"))
    scoped = record_groups.select("project_id", "processor_id").distinct()
    return (scoped.join(procs, "processor_id")
                  .groupBy("project_id", F.col("a.name").alias("column_name"))
                  .agg(F.min("name_pos").cast("int").alias("first_pos"),
                       F.count(F.lit(1)).alias("n_processors")))


def obsolete_counts(records: DataFrame, schema_by_group: DataFrame, threshold: int = 10) -> DataFrame:
    """Per record, attributes whose key is not in its group's schema,
    and the flag at ``threshold``.  Records of a group without schema are
    not counted (nothing to compare with).

    ``schema_by_group`` is (record_group_id, names ARRAY<STRING>): one row
    per group, joined on the group id."""
    j = records.select("record_id", "record_group_id", A.safe_attrs("attributes").getField("key").alias("_keys")) \
        .join(schema_by_group, "record_group_id")
    n = F.size(F.filter("_keys", lambda k: ~F.array_contains(F.col("names"), k)))
    return j.select("record_id", "record_group_id", n.cast("bigint").alias("obsolete_count"),
                    (n >= threshold).alias("needs_review"))


def enrich_records(records: DataFrame, record_groups: DataFrame, projects: DataFrame) -> DataFrame:
    """Record + group name + project (name, id), through the group's
    project (left joins on the group id, then the project id)."""
    g = record_groups.select("record_group_id", F.col("name").alias("record_group_name"), "project_id")
    p = projects.select("project_id", F.col("name").alias("project_name"))
    return (records.join(g, "record_group_id", "left")
                   .join(p, "project_id", "left")
                   .select(*records.columns, "record_group_name", "project_name", "project_id"))
