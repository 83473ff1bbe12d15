"""SQL text of the analysis views (FIXTURES.md section 2), used as CTEs of
the DuckDB oracle queries.  ``with_views`` prepends exactly the views a
query mentions.
"""

from __future__ import annotations

import re

VIEW_SQL = {
    "v_events": """
SELECT event_id, ts, CAST(ts AS DATE) AS event_date,
       CONCAT('tenant_', CAST(user_id % 20 AS STRING)) AS tenant_id,
       user_id, event_type, value AS amount,
       CASE WHEN event_id % 1000 = 0 THEN 37000
            WHEN event_id % 20 = 0 THEN 45 + event_id % 166
            ELSE event_id % 5 END AS skew_s
FROM events""",
    "v_requests": """
SELECT event_id AS request_id, ts, CONCAT('tenant_', CAST(user_id % 20 AS STRING)) AS tenant_id,
       event_type AS endpoint, value AS latency_ms,
       CASE WHEN event_id % 997 = 0 THEN 500
            WHEN event_type = 'error' AND EXTRACT(day FROM ts) IN (10, 11) THEN 503
            ELSE 200 END AS status,
       event_id % 3 = 0 AND event_type <> 'purchase' AS cache_hit
FROM events""",
    "v_logs": """
SELECT event_id AS log_id, ts, CAST(ts AS DATE) AS log_date,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS severity,
       CASE WHEN event_type = 'error' THEN CONCAT('E_', CAST(event_id % 7 AS STRING)) END AS error_code,
       CONCAT('tenant_', CAST(user_id % 20 AS STRING)) AS tenant_id
FROM events""",
    "v_trips": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS trip_id, l.l_shipdate AS pickup_datetime,
       l.l_linenumber % 2 + 1 AS vendor_id, l.l_partkey % 4 + 1 AS payment_type,
       l.l_extendedprice AS fare_amount, l.l_extendedprice * l.l_discount AS tip_amount,
       l.l_extendedprice * (1 + l.l_tax) AS total_amount, r.r_name AS currency
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
     JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN nation n ON c.c_nationkey = n.n_nationkey
     JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_fx_rates": """
SELECT r.r_name AS currency, d.rate_date,
       CAST(1 + r.r_regionkey * 0.1 + EXTRACT(day FROM d.rate_date) * 0.001 AS DOUBLE) AS rate
FROM region r CROSS JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS rate_date FROM lineitem) d""",
    "v_billing": """
SELECT p.p_type AS service, p.p_brand AS sku, l.l_shipdate AS usage_start_time,
       l.l_extendedprice AS cost, -l.l_extendedprice * l.l_discount AS credit_amount,
       CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE c.c_mktsegment END AS cost_center
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
     JOIN orders o ON l.l_orderkey = o.o_orderkey
     JOIN customer c ON o.o_custkey = c.c_custkey""",
    "v_jobs": """
SELECT o.o_orderkey AS job_id, c.c_name AS user_email, o.o_orderdate AS creation_time,
       CONCAT('SELECT ', o.o_orderpriority, '  FROM  t') AS query,
       CAST(FLOOR(o.o_totalprice) AS BIGINT) * 1000000 AS total_bytes_billed,
       o.o_orderkey % 97 * 1000 AS total_slot_ms, CAST(FLOOR(o.o_totalprice) AS BIGINT) * 999000 AS total_bytes_processed,
       CASE WHEN o.o_orderkey % 11 = 0 THEN 'LOAD' ELSE 'QUERY' END AS job_type,
       CASE WHEN o.o_orderkey % 13 = 0 THEN 'RUNNING' ELSE 'DONE' END AS state,
       o.o_orderdate + to_seconds(o.o_orderkey % 5) AS start_time,
       o.o_orderdate + to_seconds(o.o_orderkey % 5 + o.o_orderkey % 301) AS end_time
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "v_job_stages": """
SELECT l_orderkey AS job_id, l_linenumber AS stage_id,
       CAST(l_quantity AS BIGINT) * (l_partkey % 3) * 100 AS records_read,
       CAST(FLOOR(l_extendedprice) AS BIGINT) AS records_written,
       l_suppkey % 13 * 100 AS slot_ms, l_linenumber <= 2 AS reads_from_table
FROM lineitem""",
    "v_source": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(FLOOR(o_totalprice * 100) AS BIGINT) AS total_cents FROM orders""",
    "v_target": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(FLOOR(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 333 = 0 THEN 1 ELSE 0 END AS total_cents
FROM orders WHERE o_orderkey % 500 <> 0""",
    "v_changes": """
SELECT o_orderkey % 1000 AS id, o_orderkey AS version, o_orderdate AS commit_ts,
       CASE WHEN o_orderkey % 17 = 0 THEN 'D' WHEN o_orderkey < 1000 THEN 'I' ELSE 'U' END AS op,
       o_totalprice AS payload FROM orders""",
    "v_spans": """
SELECT CAST(FLOOR(event_id / 4) AS BIGINT) AS trace_id, event_id AS span_id,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id - 1 END AS parent_span_id,
       ts AS start_time, value AS duration_ms,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status FROM events""",
    "v_probes": """
SELECT event_id AS seq, ts, NOT (event_id % 100 BETWEEN 40 AND 55) AS ok,
       value AS latency_ms FROM events""",
    "v_attempts": """
SELECT event_id AS attempt_id, event_id % 500 AS message_id,
       CONCAT('acct-', CAST(event_id % 25 AS STRING)) AS ordering_key, ts,
       event_id % 500 % 50 <> 0 AS acked FROM events""",
    "v_bindings": """
SELECT CASE c_custkey % 6 WHEN 0 THEN 'roles/owner' WHEN 1 THEN 'roles/editor' WHEN 2 THEN 'roles/viewer'
            WHEN 3 THEN 'roles/iam.serviceAccountUser' WHEN 4 THEN 'roles/storage.admin' ELSE 'projects/p/roles/custom' END AS role,
       CONCAT(CASE WHEN c_custkey % 4 = 0 THEN 'group:g' ELSE 'serviceAccount:sa' END, CAST(c_custkey % 40 AS STRING)) AS member,
       c_custkey % 9 = 0 AS has_condition FROM customer""",
    "v_calls": """
SELECT event_id AS call_id, ts,
       CASE user_id % 3 WHEN 0 THEN 'endpoint' WHEN 1 THEN 'api' ELSE 'self_hosted' END AS option_name,
       value AS latency_ms, 40 + event_id % 10 AS input_tokens, 50 + event_id % 20 AS output_tokens,
       event_type = 'error' AS failed FROM events""",
    "v_audit": """
SELECT event_id AS entry_id, ts, CONCAT('user', CAST(user_id % 30 AS STRING), '@example.com') AS principal,
       CASE WHEN event_id % 2 = 0 THEN 'bigquery' ELSE 'storage' END AS service, event_type AS method,
       event_id % 40 = 0 AS dry_run_denied,
       CASE WHEN event_id % 40 = 0 THEN CASE WHEN event_id % 80 = 0 THEN 'NO_MATCHING_ACCESS_LEVEL' ELSE 'NETWORK_NOT_IN_SAME_PERIMETER' END END AS violation_reason
FROM events""",
}

_NAME = re.compile(r"\bv_[a-z_]+\b")


def with_views(sql: str) -> str:
    """Prefix ``sql`` with ``WITH`` definitions of every view it mentions."""
    used = [n for n in VIEW_SQL if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in used)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
