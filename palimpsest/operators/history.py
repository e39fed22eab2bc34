"""History and deletion (H1-H3, D1-D3).  Logs that history rows and archives
are appended to (S9, S10) are in ``log``; nested payloads in ``typed_history``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_folder

TAGGED_ACTIONS = ["updateRecord", "cleanRecord"]


def history_rows(df: DataFrame, action: str, user: Column | str, ts: Column | None = None,
                 extra: dict[str, Column] | None = None) -> DataFrame:
    """H1: history rows for a bulk change; ``rg_id`` becomes
    ``record_group_id``; one time stamp for the whole bulk."""
    u = F.lit(user) if isinstance(user, str) else user
    cols = {
        "action": F.lit(action), "user": u,
        "record_id": F.col("record_id") if "record_id" in df.columns else F.lit(None).cast("bigint"),
        "record_group_id": (F.col("record_group_id") if "record_group_id" in df.columns
                            else F.col("rg_id") if "rg_id" in df.columns else F.lit(None).cast("string")),
        "ts": F.current_timestamp() if ts is None else ts,
    }
    cols.update(extra or {})
    return df.select(*[v.alias(k) for k, v in cols.items()])


def history_long(history: DataFrame) -> DataFrame:
    """H2: one row per top-level value of ``query`` and ``previous_state``,
    with the numeric tag the reference adds for ``updateRecord`` and
    ``cleanRecord`` (``int`` / ``float``, never for booleans).

    Tagging reads the variant type before any round trip: a JSON ``1.0``
    is DECIMAL (float) while printing it back would give ``1``."""
    parts = []
    for col in ("query", "previous_state"):
        m = F.try_variant_get(F.try_parse_json(F.col(col)), "$", "map<string,variant>")
        parts.append(history.select("history_id", "record_id", "action", "ts", F.lit(col).alias("field"),
                                    F.explode_outer(m).alias("path", "_v")).where(F.col("path").isNotNull()))
    u = parts[0].unionByName(parts[1])
    vt = F.schema_of_variant("_v")
    numeric = vt.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | vt.startswith("DECIMAL") | vt.isin("DOUBLE", "FLOAT")
    tag = (F.when(~F.col("action").isin(*TAGGED_ACTIONS), F.lit(None).cast("string"))
           .when(vt.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("int"))
           .when(vt.startswith("DECIMAL") | vt.isin("DOUBLE", "FLOAT"), F.lit("float")))
    return u.select("history_id", "record_id", "action", "ts", "field", "path",
                    F.when(numeric, F.try_variant_get("_v", "$", "double")).alias("value_num"),
                    F.when(vt == "STRING", F.try_variant_get("_v", "$", "string")).alias("value_text"),
                    tag.alias("num_type"))


def activity_summary(history: DataFrame, by=("action", "user")) -> DataFrame:
    """H3: counts per action and user with first / last time."""
    return history.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                                    F.max("ts").alias("last_ts"))


def tag_deleted(rows: DataFrame, doomed_keys: DataFrame, key: str, deleted_by: str) -> DataFrame:
    """``rows`` plus ``deleted_by``, null for those that stay.  One join
    with the doomed keys; null keys stay."""
    k = doomed_keys.select(F.col(key).alias("_doomed")).where(F.col("_doomed").isNotNull()).distinct()
    tagged = rows.join(k, F.col(key) == F.col("_doomed"), "left")
    return tagged.withColumn("deleted_by", F.when(F.col("_doomed").isNotNull(), F.lit(deleted_by))).drop("_doomed")


def split(tagged: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, archived) of tagged rows.  The tagged rows are computed once and
    written to two folders of the shared file system in that pass; both
    results read their own folder only."""
    spark = tagged.sparkSession
    path = path or work_folder(spark, "split")
    tagged.withColumn("_deleted", F.col("deleted_by").isNotNull()).write.mode("overwrite").partitionBy("_deleted").parquet(path)
    both = spark.read.schema(T.StructType([*tagged.schema.fields, T.StructField("_deleted", T.BooleanType())])).parquet(path)
    return (both.where(~F.col("_deleted")).drop("_deleted", "deleted_by"), both.where("_deleted").drop("_deleted"))


def delete_records(records: DataFrame, doomed_keys: DataFrame, key: str, deleted_by: str) -> tuple[DataFrame, DataFrame]:
    """(kept, archived); archived rows carry ``deleted_by``."""
    return split(tag_deleted(records, doomed_keys, key, deleted_by))


def _delete_where(rows: DataFrame, doomed: Column, deleted_by: str) -> tuple[DataFrame, DataFrame]:
    return split(rows.withColumn("deleted_by", F.when(F.coalesce(doomed, F.lit(False)), F.lit(deleted_by))))


def delete_cascade(project_id: str, projects: DataFrame, record_groups: DataFrame, records: DataFrame,
                   teams: DataFrame, deleted_by: str) -> dict[str, DataFrame]:
    """Delete a project, its groups and their records (archived with
    ``deleted_by``), and unlink the project from its team."""
    mine = F.col("project_id") == F.lit(project_id)
    kept_p, arch_p = _delete_where(projects, mine, deleted_by)
    kept_g, arch_g = _delete_where(record_groups, mine, deleted_by)
    kept_r, arch_r = delete_records(records, arch_g, "record_group_id", deleted_by)
    new_teams = teams.withColumn("project_list", F.array_remove("project_list", F.lit(project_id)))
    return {"projects": kept_p, "deleted_projects": arch_p, "record_groups": kept_g,
            "deleted_record_groups": arch_g, "records": kept_r, "deleted_records": arch_r, "teams": new_teams}


def delete_group(record_group_id: str, record_groups: DataFrame, records: DataFrame, projects: DataFrame,
                 deleted_by: str) -> dict[str, DataFrame]:
    """D3: delete a group, archive it and its records (by the right key,
    Q-5), unlink it from its project."""
    mine = F.col("record_group_id") == F.lit(record_group_id)
    kept_g, arch_g = _delete_where(record_groups, mine, deleted_by)
    kept_r, arch_r = _delete_where(records, mine, deleted_by)
    # the project -> group and team -> group links are columns of the group row:
    # archiving it unlinks it (no per-project array to rewrite)
    return {"record_groups": kept_g, "deleted_record_groups": arch_g, "records": kept_r,
            "deleted_records": arch_r, "projects": projects}
