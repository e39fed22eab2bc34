"""Access queries: visibility, permissions, enrichment, review gate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import filters as FL
from ..operators import scope as S
from ..sources import model as M
from .oracle_base import with_model
from .registry import query

CALLER = "Supplier#000000002"
AS_OF = datetime(2024, 1, 30, 23, 58, 0)


@query("visible_groups", with_model("""
SELECT u.email, u.default_team AS team, g.project_id, g.record_group_id
FROM users u JOIN groups g ON g.team = u.default_team
""", "users", "groups"), ops=("J2", "J1", "U1"))
def q_visible_groups(spark, sf):
    return S.visible_groups(M.load_users(spark, sf), M.load_teams(spark, sf), M.load_projects(spark, sf),
                            M.load_record_groups(spark, sf))


@query("accessible_records", with_model(f"""
SELECT r.record_id, r.record_group_id FROM recs r
WHERE r.record_group_id IN (SELECT g.record_group_id FROM groups g JOIN users u ON g.team = u.default_team
                            WHERE u.email = '{CALLER}')
""", "recs", "groups", "users"), ops=("J3",))
def q_accessible_records(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    out = S.accessible_records(r, M.load_users(spark, sf), M.load_teams(spark, sf), M.load_projects(spark, sf),
                               M.load_record_groups(spark, sf), CALLER)
    return out.select("record_id", "record_group_id")


@query("denied_records", with_model(f"""
SELECT count(*) AS denied FROM recs r
WHERE r.record_group_id NOT IN (SELECT g.record_group_id FROM groups g JOIN users u ON g.team = u.default_team
                                WHERE u.email = '{CALLER}')
""", "recs", "groups", "users"), ops=("J3",))
def q_denied_records(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    out = S.accessible_records(r, M.load_users(spark, sf), M.load_teams(spark, sf), M.load_projects(spark, sf),
                               M.load_record_groups(spark, sf), CALLER, allowed=False)
    return out.agg(F.count(F.lit(1)).alias("denied"))


@query("records_in_scope", with_model("""
SELECT r.record_id, r.record_group_id FROM recs r JOIN groups g ON g.record_group_id = r.record_group_id
WHERE g.team = 'ASIA'
""", "recs", "groups"), ops=("F7", "J1"))
def q_records_in_scope(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    groups = S.groups_for("team", "ASIA", M.load_teams(spark, sf), M.load_projects(spark, sf),
                          M.load_record_groups(spark, sf))
    return S.records_in_scope(r, groups).select("record_id", "record_group_id")


@query("enrich_records", with_model("""
SELECT r.record_id, g.name AS record_group_name, p.name AS project_name, p.project_id
FROM recs r LEFT JOIN groups g ON g.record_group_id = r.record_group_id
            LEFT JOIN projects p ON p.project_id = g.project_id
""", "recs", "groups", "projects"), ops=("J5",))
def q_enrich_records(spark, sf):
    from ..operators.views import enrich_records
    r = M.load_records(spark, sf, with_attributes=False)
    out = enrich_records(r, M.load_record_groups(spark, sf), M.load_projects(spark, sf))
    return out.select("record_id", "record_group_name", "project_name", "project_id")


@query("effective_permissions", with_model("""
SELECT DISTINCT u.email, rp.permission
FROM users u JOIN role_perms rp ON rp.role = u.team_role OR rp.role = u.system_role
WHERE (rp.role = u.team_role AND u.default_team IS NOT NULL) OR rp.role = u.system_role
""", "users", "role_perms"), ops=("J8",))
def q_effective_permissions(spark, sf):
    return S.effective_permissions(M.load_users(spark, sf), M.load_roles(spark))


@query("team_users", with_model(f"""
SELECT u.email, u.default_team FROM users u
WHERE u.default_team = (SELECT default_team FROM users WHERE email = '{CALLER}')
""", "users"), ops=("J9",))
def q_team_users(spark, sf):
    return S.team_users(M.load_users(spark, sf), CALLER).select("email", "default_team")


@query("user_teams", with_model(f"""
SELECT DISTINCT u.default_team AS name FROM users u WHERE u.email = '{CALLER}' AND u.default_team IS NOT NULL
""", "users"), ops=("J9",))
def q_user_teams(spark, sf):
    return S.user_teams(M.load_teams(spark, sf), M.load_users(spark, sf), CALLER).select("name")


@query("roles_in", with_model("""
SELECT u.email, rp.role, rp.category FROM users u
JOIN (SELECT DISTINCT role, category FROM role_perms) rp ON rp.role = u.system_role
WHERE rp.category = 'system'
""", "users", "role_perms"), ops=("J9",))
def q_roles_in(spark, sf):
    roles = S.roles_in(M.load_roles(spark), ["system"])
    users = M.load_users(spark, sf).select("email", F.explode("roles_system").alias("role"))
    return users.join(roles.select(F.col("id").alias("role"), "category"), "role").select("email", "role", "category")


LOCKS_SQL = """
locks AS (
  SELECT event_id % 1500 AS record_id, 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS "user", ts AS "timestamp"
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1
)"""


def _with_locks(sql, *views):
    base = with_model("SELECT 1", *views)
    head = base[: base.rindex("SELECT 1")].rstrip()
    return head + ",\n" + LOCKS_SQL.strip() + "\n" + sql.strip()


@query("active_locks", _with_locks(f"""
SELECT record_id, "user", strftime("timestamp" + INTERVAL 120 SECOND, '%Y-%m-%d %H:%M:%S.%f') AS expires_at,
       ("timestamp" + INTERVAL 120 SECOND >= TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}') AS active
FROM locks
""", "recs"), ops=("F8",))
def q_active_locks(spark, sf):
    out = FL.active_locks(M.load_locks(spark, sf), AS_OF)
    return out.select("record_id", "user", F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("expires_at"),
                      "active")


@query("review_gate", _with_locks(f"""
, held AS (
  SELECT DISTINCT record_id FROM locks
  WHERE "user" <> '{CALLER}' AND "timestamp" + INTERVAL 120 SECOND >= TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'),
can AS (
  SELECT count(*) > 0 AS v FROM users u JOIN role_perms rp ON rp.role = u.team_role OR rp.role = u.system_role
  WHERE u.email = '{CALLER}' AND rp.permission = 'verify_record'
    AND ((rp.role = u.team_role AND u.default_team IS NOT NULL) OR rp.role = u.system_role)),
gate AS (
  SELECT r.record_id,
    CASE WHEN h.record_id IS NOT NULL THEN '{FL.GATE_LOCKED}'
         WHEN r.verification_status = 'required' AND NOT (SELECT v FROM can) THEN '{FL.GATE_REQUIRED}'
         WHEN r.verification_status = 'verified' AND NOT (SELECT v FROM can)
              THEN replace('{FL.GATE_VERIFIED}', '{{review_status}}', coalesce(r.review_status, 'None'))
    END AS lock_message
  FROM recs r LEFT JOIN held h ON h.record_id = r.record_id)
SELECT record_id, lock_message IS NOT NULL AS locked, lock_message FROM gate
""", "recs", "users", "role_perms"), ops=("F9", "J8", "F8"))
def q_review_gate(spark, sf):
    r = M.load_records(spark, sf, with_attributes=False)
    locks = FL.active_locks(M.load_locks(spark, sf), AS_OF)
    held = (locks.where(F.col("active") & (F.col("user") != CALLER))
                 .select("record_id").distinct().withColumn("_held", F.lit(True)))
    can = (S.has_permission(M.load_users(spark, sf).where(F.col("email") == CALLER), M.load_roles(spark),
                            "verify_record").agg((F.count(F.lit(1)) > 0).alias("_can")))
    # `can` is a one-row aggregate: a proven size bound for the broadcast
    j = r.join(held, "record_id", "left").crossJoin(F.broadcast(can))
    g = FL.review_gate(F.col("verification_status"), F.col("review_status"), F.col("_can"), F.col("_held"))
    return j.select("record_id", g["locked"].alias("locked"), g["lock_message"].alias("lock_message"))


@query("validate_refs", with_model("""
SELECT u.upload_id, u.record_group_id, (g.record_group_id IS NOT NULL) AS valid
FROM uploads u LEFT JOIN groups g ON g.record_group_id = u.record_group_id
""", "uploads", "groups"), ops=("F10",))
def q_validate_refs(spark, sf):
    up = M.load_uploads(spark, sf)
    out = S.validate_refs(up, "record_group_id", M.load_record_groups(spark, sf), "record_group_id")
    return out.select("upload_id", "record_group_id", "valid")
