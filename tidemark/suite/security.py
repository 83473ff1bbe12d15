"""IAM, change-plan, edge and audit analyses (AG51-AG54, AG63-AG64, PF13,
PF15, WI9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import security as sec
from ..registry import register
from ..sources.fixtures import v_audit, v_bindings, v_requests
from ..sources.tables import Tables

# Sizes of the non-basic roles in the bindings view (fixture inputs).
OTHER_ROLE_SIZES = {"roles/iam.serviceAccountUser": 6, "roles/storage.admin": 40}
SIZES_SQL = ("(VALUES ('roles/owner', 9999), ('roles/editor', 3812), ('roles/viewer', 2600), "
             "('roles/iam.serviceAccountUser', 6), ('roles/storage.admin', 40)) s(role, permissions)")


def _t(spark, sf):
    return Tables(spark, sf)


@register("pf15_classify_bindings", """
SELECT role, member, CASE WHEN role IN ('roles/owner', 'roles/editor', 'roles/viewer') THEN 'basic'
                          WHEN starts_with(role, 'projects/') OR starts_with(role, 'organizations/') THEN 'custom'
                          ELSE 'predefined' END AS tier,
       split_part(member, ':', 1) AS principal_type, has_condition
FROM v_bindings""")
def pf15(spark, sf):
    return sec.classify_bindings(v_bindings(_t(spark, sf))).select("role", "member", "tier", "principal_type",
                                                                   "has_condition")


_RADIUS_SQL = f"""b AS (SELECT split_part(member, ':', 2) AS email, v.role, coalesce(s.permissions, 1) AS permissions
      FROM v_bindings v LEFT JOIN {SIZES_SQL} ON v.role = s.role WHERE starts_with(member, 'serviceAccount:')),
rad AS (SELECT email, CAST(sum(permissions) AS BIGINT) AS permission_count,
               array_to_string(list_sort(list_distinct(list(role))), ', ') AS roles FROM b GROUP BY email)"""


@register("ag51_blast_radius", f"WITH {_RADIUS_SQL} SELECT * FROM rad")
def ag51(spark, sf):
    return sec.blast_radius(v_bindings(_t(spark, sf)), sec.role_sizes(spark, OTHER_ROLE_SIZES))


@register("wi9_rank_accounts", f"""
WITH {_RADIUS_SQL}
SELECT *, row_number() OVER (ORDER BY permission_count DESC, email) AS rank FROM rad""")
def wi9(spark, sf):
    return sec.rank_accounts(sec.blast_radius(v_bindings(_t(spark, sf)), sec.role_sizes(spark, OTHER_ROLE_SIZES)))


@register("ag52_iam_findings", """
WITH u AS (
  SELECT 'HIGH' AS severity, 'service-account-user granted at project level to ' || member AS message
  FROM v_bindings WHERE role = 'roles/iam.serviceAccountUser'
  UNION ALL
  SELECT CASE WHEN role = 'roles/owner' THEN 'CRITICAL' ELSE 'HIGH' END,
         'basic role ' || role || ' granted to ' || member || CASE WHEN has_condition THEN ' (conditional)' ELSE '' END
  FROM v_bindings WHERE role IN ('roles/owner', 'roles/editor', 'roles/viewer')
  UNION ALL
  SELECT 'CRITICAL', 'unconditional owner granted to ' || member FROM v_bindings WHERE role = 'roles/owner' AND NOT has_condition),
r AS (SELECT message, severity, CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 1 ELSE 0 END AS k FROM u)
SELECT message, arg_max(severity, k) AS severity, max(k) AS severity_rank FROM r GROUP BY message""")
def ag52(spark, sf):
    return sec.iam_findings(v_bindings(_t(spark, sf)))


def _plans(t):
    """One change plan (JSON text) per order: one resource change per line."""
    li = t.lineitem
    ln = F.col("l_linenumber")
    actions = (F.when(ln == 7, F.array(F.lit("delete")))
               .when(F.col("l_returnflag") == "R",
                     F.when(ln % 2 == 0, F.array(F.lit("delete"), F.lit("create")))
                      .otherwise(F.array(F.lit("create"), F.lit("delete"))))
               .when(F.col("l_returnflag") == "A", F.array(F.lit("create")))
               .when(F.col("l_linestatus") == "O", F.array(F.lit("update")))
               .otherwise(F.array(F.lit("no-op"))))
    rc = F.struct(F.concat(F.lit("res_"), ln.cast("string")).alias("address"),
                  F.struct(actions.alias("actions")).alias("change"))
    return (li.groupBy(F.col("l_orderkey").alias("plan_id"))
            .agg(F.to_json(F.struct(F.collect_list(rc).alias("resource_changes"))).alias("plan_json")))


@register("ag53_plan_summary", """
SELECT l_orderkey AS plan_id,
       count(*) FILTER (WHERE l_linenumber <> 7 AND l_returnflag IN ('R', 'A')) AS add,
       count(*) FILTER (WHERE l_linenumber <> 7 AND l_returnflag NOT IN ('R', 'A') AND l_linestatus = 'O') AS change,
       count(*) FILTER (WHERE l_linenumber = 7 OR l_returnflag = 'R') AS destroy,
       count(*) FILTER (WHERE l_linenumber <> 7 AND l_returnflag = 'R') AS replacements
FROM lineitem GROUP BY l_orderkey""")
def ag53(spark, sf):
    return sec.plan_summary(_plans(_t(spark, sf)))


def _edge_log(t):
    r = v_requests(t)
    name = F.when(F.col("status") == 503, "rate-limit").when(F.col("status") == 500, "sqli-block").otherwise("default")
    d = r.select("request_id", "tenant_id", name.alias("name"))
    d = d.withColumn("priority", F.when(F.col("name") == "rate-limit", 900)
                     .when(F.col("name") == "sqli-block", 1000).otherwise(2147483647))
    d = d.withColumn("configured_action", F.when(F.col("name") == "default", "allow").otherwise("deny(403)"))
    d = d.withColumn("preview", F.col("name") == "sqli-block")
    return d.withColumn("outcome", F.when(F.col("configured_action").startswith("deny") & ~F.col("preview"), "DENY")
                        .otherwise("ACCEPT"))


_EDGE_SQL = """e AS (SELECT request_id, tenant_id, name,
       CASE name WHEN 'rate-limit' THEN 900 WHEN 'sqli-block' THEN 1000 ELSE 2147483647 END AS priority,
       CASE name WHEN 'default' THEN 'allow' ELSE 'deny(403)' END AS configured_action,
       name = 'sqli-block' AS preview,
       CASE WHEN name <> 'default' AND name <> 'sqli-block' THEN 'DENY' ELSE 'ACCEPT' END AS outcome
  FROM (SELECT request_id, tenant_id, CASE WHEN status = 503 THEN 'rate-limit' WHEN status = 500 THEN 'sqli-block'
               ELSE 'default' END AS name FROM v_requests))"""


@register("ag54_edge_decisions", f"""
WITH {_EDGE_SQL}
SELECT name, priority, configured_action, outcome, preview, count(*) AS requests,
       count(*) FILTER (WHERE preview AND starts_with(configured_action, 'deny')) AS would_deny
FROM e GROUP BY ALL""")
def ag54(spark, sf):
    return sec.edge_decisions(_edge_log(_t(spark, sf)))


@register("pf13_deny_log_filter", f"""
WITH {_EDGE_SQL} SELECT request_id, tenant_id, name FROM e WHERE outcome = 'DENY' AND priority = 900""")
def pf13(spark, sf):
    return sec.deny_log(_edge_log(_t(spark, sf)), 900).select("request_id", "tenant_id", "name")


@register("ag63_perimeter_violations", """
SELECT principal, violation_reason, service, count(*) AS violations, min(ts) AS first_seen, max(ts) AS last_seen,
       count(*) >= 2 AS recurring
FROM v_audit WHERE dry_run_denied GROUP BY 1, 2, 3""")
def ag63(spark, sf):
    return sec.perimeter_violations(v_audit(_t(spark, sf)))


@register("ag64_access_by_principal", """
WITH p AS (SELECT DISTINCT 'user' || CAST(c_custkey % 40 AS VARCHAR) || '@example.com' AS principal FROM customer),
g AS (SELECT principal, method, count(*) AS accesses FROM v_audit GROUP BY 1, 2)
SELECT p.principal, g.method, coalesce(g.accesses, 0) AS accesses FROM p LEFT JOIN g ON p.principal = g.principal""")
def ag64(spark, sf):
    t = _t(spark, sf)
    principals = t.customer.select(
        F.concat(F.lit("user"), (F.col("c_custkey") % 40).cast("string"), F.lit("@example.com")).alias("principal"))
    return sec.access_by_principal(v_audit(t), principals)
