"""Access and change audits over policy, plan, edge and audit-log tables
(AG51-AG54, AG63-AG64, PF13, PF15, WI9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# ---- fixed values that must equal the reference's ---------------------------
# Basic roles and the permission counts the audit assigns to them.
BASIC_ROLE_PERMISSIONS = {"roles/owner": 9999, "roles/editor": 3812, "roles/viewer": 2600}
# A role whose size cannot be read contributes 1.
UNKNOWN_ROLE_PERMISSIONS = 1
SEVERITY_RANK = {"CRITICAL": 3, "HIGH": 2, "MEDIUM": 1, "LOW": 0}


def role_sizes(spark: SparkSession, other: dict[str, int] | None = None) -> DataFrame:
    """Role -> permission count table: the basic roles plus known others
    (small, literal; safe to broadcast)."""
    rows = list(BASIC_ROLE_PERMISSIONS.items()) + list((other or {}).items())
    return spark.createDataFrame(rows, "role string, permissions int")


def classify_bindings(bindings: DataFrame, role: str = "role", member: str = "member") -> DataFrame:
    """PF15: role tier (basic / custom / predefined) and principal type."""
    r = F.col(role)
    tier = (F.when(r.isin(*BASIC_ROLE_PERMISSIONS), "basic")
            .when(r.startswith("projects/") | r.startswith("organizations/"), "custom")
            .otherwise("predefined"))
    return bindings.withColumn("tier", tier).withColumn("principal_type", F.split(F.col(member), ":")[0])


def blast_radius(bindings: DataFrame, sizes: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """AG51: permission sum per service account.  Sums per binding (an
    account holding a role in two bindings counts it twice) while the role
    list is a set; accounts with no binding keep 0."""
    b = (bindings.where(F.col("member").startswith("serviceAccount:"))
         .withColumn("email", F.split(F.col("member"), ":", 2)[1])
         .join(sizes, "role", "left")
         .withColumn("permissions", F.coalesce("permissions", F.lit(UNKNOWN_ROLE_PERMISSIONS))))
    g = b.groupBy("email").agg(F.sum("permissions").cast("bigint").alias("permission_count"),
                               F.array_join(F.array_sort(F.collect_set("role")), ", ").alias("roles"))
    if accounts is not None:
        g = accounts.select("email").join(g, "email", "left").select(
            "email", F.coalesce("permission_count", F.lit(0)).cast("bigint").alias("permission_count"),
            F.coalesce("roles", F.lit("(none)")).alias("roles"))
    return g


def rank_accounts(radius: DataFrame) -> DataFrame:
    """WI9: rank by permission count, ties by account name.  One row per
    account: the global order runs over the (small) per-account table."""
    w = Window.orderBy(F.desc("permission_count"), F.asc("email"))
    return radius.withColumn("rank", F.row_number().over(w).cast("bigint"))


def iam_findings(bindings: DataFrame) -> DataFrame:
    """AG52: findings from three rules, de-duplicated by message, with their
    severity rank (sort by it, highest first):

    * project-level service-account-user grant to any member   -> HIGH
    * a basic role granted (owner CRITICAL, editor/viewer HIGH)  -> as stated
    * owner granted without a condition                          -> CRITICAL
    """
    r, m, c = F.col("role"), F.col("member"), F.col("has_condition")
    sa_user = bindings.where(r == "roles/iam.serviceAccountUser").select(
        F.lit("HIGH").alias("severity"),
        F.concat(F.lit("service-account-user granted at project level to "), m).alias("message"))
    basic = bindings.where(r.isin(*BASIC_ROLE_PERMISSIONS)).select(
        F.when(r == "roles/owner", "CRITICAL").otherwise("HIGH").alias("severity"),
        F.concat(F.lit("basic role "), r, F.lit(" granted to "), m,
                 F.when(c, F.lit(" (conditional)")).otherwise(F.lit(""))).alias("message"))
    owner = bindings.where((r == "roles/owner") & ~c).select(
        F.lit("CRITICAL").alias("severity"), F.concat(F.lit("unconditional owner granted to "), m).alias("message"))
    rank = F.create_map(*[x for k, v in SEVERITY_RANK.items() for x in (F.lit(k), F.lit(v))])
    u = sa_user.unionByName(basic).unionByName(owner)
    return (u.groupBy("message").agg(F.max_by("severity", rank[F.col("severity")]).alias("severity"))
            .withColumn("severity_rank", rank[F.col("severity")]))


PLAN_SCHEMA = "struct<resource_changes: array<struct<address: string, change: struct<actions: array<string>>>>>"


def plan_summary(plans: DataFrame, plan_id: str = "plan_id", text: str = "plan_json") -> DataFrame:
    """AG53: per plan JSON: resources to add, change, destroy and replace.
    A replacement (create and delete, either order) counts as one add and one
    destroy as well.  Per-row array functions: no explode, no shuffle."""
    p = plans.select(plan_id, F.from_json(text, PLAN_SCHEMA).alias("_p"))
    acts = F.transform(F.col("_p.resource_changes"), lambda rc: F.array_sort(rc["change"]["actions"]))

    def count(pred):
        return F.size(F.filter(acts, pred)).cast("bigint")

    return p.select(
        plan_id,
        count(lambda a: F.array_contains(a, "create")).alias("add"),
        count(lambda a: (F.size(a) == 1) & F.array_contains(a, "update")).alias("change"),
        count(lambda a: F.array_contains(a, "delete")).alias("destroy"),
        count(lambda a: F.array_contains(a, "create") & F.array_contains(a, "delete")).alias("replacements"))


def edge_decisions(log: DataFrame) -> DataFrame:
    """AG54: decisions by rule, configured action and outcome; rules in
    preview mode show what they would have denied."""
    return log.groupBy("name", "priority", "configured_action", "outcome", "preview").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("preview") & F.col("configured_action").startswith("deny")).alias("would_deny"))


def deny_log(log: DataFrame, priority: int) -> DataFrame:
    """PF13: enforced denials by one rule priority."""
    return log.where((F.col("outcome") == "DENY") & (F.col("priority") == priority))


def perimeter_violations(audit: DataFrame, min_repeats: int = 2) -> DataFrame:
    """AG63: dry-run perimeter denials by principal, reason and service,
    first/last seen, and whether the caller is recurring."""
    return (audit.where("dry_run_denied")
            .groupBy("principal", "violation_reason", "service")
            .agg(F.count(F.lit(1)).alias("violations"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
            .withColumn("recurring", F.col("violations") >= min_repeats))


def access_by_principal(audit: DataFrame, principals: DataFrame) -> DataFrame:
    """AG64: accesses per principal and method; principals with no access
    appear once with method NULL and 0."""
    g = audit.groupBy("principal", "method").agg(F.count(F.lit(1)).alias("accesses"))
    j = principals.select("principal").distinct().join(g, "principal", "left")
    return j.select("principal", "method", F.coalesce("accesses", F.lit(0)).alias("accesses"))
