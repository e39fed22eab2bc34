"""Scope and permission joins.

The reference walks these one document at a time (N+1 lookups).  Here
each is a join plan over whole tables.  Team / project / role tables are
dimension-sized; they are joined without hints so that AQE can pick a
broadcast from runtime statistics when they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scope_groups(teams: DataFrame, projects: DataFrame, record_groups: DataFrame) -> DataFrame:
    """(team, project_id, record_group_id) reachable through the team's
    project list and the groups' project.  Projects that do not exist are
    skipped (inner join); duplicates collapse.

    The project -> groups side is the flat ``record_groups.project_id``
    relation (a hash join), never an array of all of a project's groups, so
    a project holding a third of all groups is never one row."""
    # duplicates can only come from a team listing a project twice: collapse
    # them on the small (team, project) side, not on the joined output
    tp = teams.select(F.col("name").alias("team"), F.explode("project_list").alias("project_id")).distinct()
    tp = tp.join(projects.select("project_id"), "project_id", "left_semi")
    pg = record_groups.select("project_id", "record_group_id")
    return tp.join(pg, "project_id").select("team", "project_id", "record_group_id")


def records_in_scope(records: DataFrame, groups: DataFrame) -> DataFrame:
    """records whose group is in ``groups`` (a one-column frame of
    ``record_group_id``): a left-semi join, so records are never
    duplicated and only the group keys travel."""
    return records.join(groups.select("record_group_id"), "record_group_id", "left_semi")


def groups_for(level: str, key: str, teams: DataFrame, projects: DataFrame,
               record_groups: DataFrame) -> DataFrame:
    """Record groups of one team, project or record group (F7's scope)."""
    if level == "team":
        return (scope_groups(teams.where(F.col("name") == key), projects, record_groups)
                .select("record_group_id").distinct())
    if level == "project":
        ok = projects.where(F.col("project_id") == key).select("project_id")
        return record_groups.join(ok, "project_id", "left_semi").select("record_group_id")
    if level in ("record_group", "recordGroup"):
        return record_groups.where(F.col("record_group_id") == key).select("record_group_id")
    raise ValueError(f"unknown scope level {level!r}")


def visible_groups(users: DataFrame, teams: DataFrame, projects: DataFrame,
                   record_groups: DataFrame) -> DataFrame:
    """User -> default team -> its projects -> their record groups.
    A user without a default team sees nothing (inner joins)."""
    u = users.where(F.col("default_team").isNotNull()).select("email", F.col("default_team").alias("team"))
    tg = scope_groups(teams, projects, record_groups)
    # every user of a team meets every group of it, and teams are few: groups are dealt into shares by their
    # id, users meet each share, so that the pairs of one team are spread over many tasks of a fixed count.
    # There are several shares a task and several tasks a core, so that a task that gets more shares than others
    # doesn't hold up the rest, and users are spread first: their copies would all be made where their one file is read
    spark = users.sparkSession
    n = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
    shares = max(n, 768)
    tg = tg.withColumn("_share", F.pmod(F.xxhash64("record_group_id"), F.lit(shares))).repartition(n, "team", "_share")
    u = u.repartition(spark.sparkContext.defaultParallelism, "email")
    u = u.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))).repartition(n, "team", "_share")
    return u.hint("merge").join(tg, ["team", "_share"]).select("email", "team", "project_id", "record_group_id")


def accessible_records(records: DataFrame, users: DataFrame, teams: DataFrame, projects: DataFrame,
                       record_groups: DataFrame, email: str, allowed: bool = True) -> DataFrame:
    """Records of ``email``'s visible groups (left-semi), or with
    ``allowed=False`` the ones the user may not open (left-anti)."""
    vis = visible_groups(users.where(F.col("email") == email), teams, projects, record_groups) \
        .select("record_group_id")
    return records.join(vis, "record_group_id", "left_semi" if allowed else "left_anti")


def effective_permissions(users: DataFrame, roles: DataFrame) -> DataFrame:
    """System roles plus the roles held in the default team, mapped to
    their permissions, distinct per user."""
    sys_roles = users.select("email", F.explode("roles_system").alias("role"))
    team_roles = users.select(
        "email", F.explode(F.coalesce(F.element_at(F.col("roles_team"), F.col("default_team")),
                                      F.array().cast("array<string>"))).alias("role"))
    held = sys_roles.unionByName(team_roles)
    perms = roles.select(F.col("id").alias("role"), F.explode("permissions").alias("permission"))
    return held.join(perms, "role").select("email", "permission").distinct()


def has_permission(users: DataFrame, roles: DataFrame, permission: str) -> DataFrame:
    """Users holding ``permission`` (semi join on J8)."""
    p = effective_permissions(users, roles).where(F.col("permission") == permission).select("email")
    return users.join(p, "email", "left_semi")


def team_users(users: DataFrame, caller_email: str) -> DataFrame:
    """Users whose default team is the caller's default team."""
    team = users.where(F.col("email") == caller_email).select(F.col("default_team").alias("_t"))
    return users.join(team, users.default_team == team._t, "left_semi")


def user_teams(teams: DataFrame, users: DataFrame, email: str) -> DataFrame:
    """Teams the user belongs to -- the default team and every team in
    which the user holds roles (membership read from the user's row, not
    from a per-team member array)."""
    u = users.where(F.col("email") == email)
    names = u.select(F.explode_outer(F.array_union(
        F.coalesce(F.map_keys("roles_team"), F.array().cast("array<string>")),
        F.when(F.col("default_team").isNotNull(), F.array("default_team"))
         .otherwise(F.array().cast("array<string>")))).alias("_t")).where(F.col("_t").isNotNull())
    return teams.join(names, teams.name == names._t, "left_semi")


def roles_in(roles: DataFrame, categories) -> DataFrame:
    """Roles of the given categories."""
    return roles.where(F.col("category").isin(*categories))


def validate_refs(refs: DataFrame, ref_col: str, targets: DataFrame, target_col: str) -> DataFrame:
    """tag each reference with whether its target exists.  Semi and
    anti halves of one left join against the distinct target keys."""
    t = targets.select(F.col(target_col).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return (refs.join(t, refs[ref_col] == t._k, "left")
                .withColumn("valid", F.coalesce("_hit", F.lit(False)))
                .drop("_k", "_hit"))
