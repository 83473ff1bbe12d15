"""Job-history analyses (AG19-AG21, AG31-AG33, AG69)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import jobs as jo
from ..operators.finops import price_table
from ..registry import register
from ..sources.fixtures import v_jobs
from ..sources.tables import Tables

USD = "CAST({b} AS DOUBLE) / CAST(1099511627776 AS DOUBLE) * CAST(6.25 AS DOUBLE)"
SNIP = "substr(regexp_replace({q}, '\\s+', ' ', 'g'), 1, {n})"
FILTER_COLUMNS = ["event_time", "tenant_id", "event_type", "user_id"]


def _t(spark, sf):
    return Tables(spark, sf)


@register("ag19_job_cost_top", f"""
SELECT job_id, user_email, total_bytes_processed, total_bytes_billed AS bytes_billed, {USD.format(b='total_bytes_billed')} AS usd,
       total_slot_ms, epoch_ms(end_time) - epoch_ms(start_time) AS elapsed_ms, {SNIP.format(q='query', n=60)} AS snippet
FROM v_jobs WHERE job_type = 'QUERY' AND state = 'DONE' AND creation_time >= TIMESTAMP '1997-01-01' AND creation_time < TIMESTAMP '1998-01-01'
ORDER BY bytes_billed DESC, job_id LIMIT 20""")
def ag19(spark, sf):
    return jo.job_cost_top(v_jobs(_t(spark, sf)), 20, lo="1997-01-01", hi="1998-01-01")


@register("ag20_user_spend_7d", f"""
WITH d AS (SELECT * FROM v_jobs WHERE creation_time >= TIMESTAMP '1998-03-01' AND creation_time < TIMESTAMP '1998-03-08'),
r AS (SELECT user_email, query, row_number() OVER (PARTITION BY user_email ORDER BY total_bytes_billed DESC, job_id) AS rn FROM d),
g AS (SELECT user_email, CAST(sum(total_bytes_billed) AS BIGINT) AS bytes_billed, count(*) AS jobs FROM d GROUP BY user_email)
SELECT g.user_email, bytes_billed, {USD.format(b='bytes_billed')} AS usd, jobs, {SNIP.format(q='r.query', n=80)} AS top_query
FROM g JOIN r ON g.user_email = r.user_email AND r.rn = 1""")
def ag20(spark, sf):
    return jo.user_spend(v_jobs(_t(spark, sf)), "1998-03-01", "1998-03-08")


@register("ag21_monthly_billing_free_tier", f"""
WITH g AS (SELECT strftime(creation_time, '%Y%m') AS month, count(*) AS jobs,
                  CAST(sum(greatest(total_bytes_billed, 10485760)) AS BIGINT) AS billed_bytes FROM v_jobs GROUP BY 1)
SELECT month, jobs, billed_bytes, least(billed_bytes, 1099511627776) AS free_bytes,
       greatest(billed_bytes - 1099511627776, 0) AS billable_bytes,
       {USD.format(b='greatest(billed_bytes - 1099511627776, 0)')} AS usd FROM g""")
def ag21(spark, sf):
    return jo.monthly_billing(v_jobs(_t(spark, sf)))


@register("ag31_scan_stage", """
SELECT j.job_id, s.stage_id AS scan_stage_id, s.records_read AS scan_records_read
FROM v_jobs j LEFT JOIN (
  SELECT job_id, stage_id, records_read,
         row_number() OVER (PARTITION BY job_id ORDER BY records_read DESC, stage_id) AS rn
  FROM v_job_stages WHERE reads_from_table) s ON j.job_id = s.job_id AND s.rn = 1""")
def ag31(spark, sf):
    return jo.scan_stage(v_jobs(_t(spark, sf), nested=True))


@register("ag32_fanout_stages", """
SELECT job_id, stage_id, records_read, records_written, records_written / greatest(records_read, 1) AS ratio,
       records_read = 0 AS zero_read_producer
FROM v_job_stages WHERE records_written / greatest(records_read, 1) >= 4""")
def ag32(spark, sf):
    return jo.fanout_stages(v_jobs(_t(spark, sf), nested=True), 4.0)


@register("ag33_slot_fingerprint", """
WITH d AS (SELECT job_id, total_slot_ms / greatest(total_bytes_billed, 10485760) AS v FROM v_jobs),
r AS (SELECT v, row_number() OVER (ORDER BY v) AS rn, count(*) OVER () AS n FROM d),
p AS (SELECT max(v) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.9) AS BIGINT))) AS cut FROM r)
SELECT job_id, v AS slot_ms_per_byte, percent_rank() OVER (ORDER BY v) AS pct_rank,
       v >= (SELECT cut FROM p) AS high_slot FROM d""")
def ag33(spark, sf):
    return jo.slot_fingerprint(v_jobs(_t(spark, sf)), 0.9)


@register("ag69_layout_advice", """
WITH e AS (SELECT unnest(list_distinct([l[job_id % 4 + 1], l[job_id % 3 + 1]])) AS column_name, total_bytes_billed AS b
           FROM v_jobs, (SELECT ['event_time', 'tenant_id', 'event_type', 'user_id'] AS l) c),
g AS (SELECT column_name, count(*) AS uses, CAST(sum(b) AS BIGINT) AS bytes FROM e GROUP BY 1),
t(column_name, data_type) AS (VALUES ('event_time', 'TIMESTAMP'), ('tenant_id', 'STRING'), ('event_type', 'STRING'), ('user_id', 'INT64')),
r AS (SELECT g.column_name, t.data_type, uses, bytes, CAST(uses AS DOUBLE) * CAST(bytes AS DOUBLE) AS score
      FROM g LEFT JOIN t ON g.column_name = t.column_name),
k AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, column_name) AS BIGINT) AS rank FROM r),
p AS (SELECT min(rank) AS pr FROM k WHERE data_type IN ('TIMESTAMP', 'DATE', 'INT64')),
c AS (SELECT k.*, rank = coalesce((SELECT pr FROM p), -1) AS is_part FROM k),
ci AS (SELECT *, sum(CASE WHEN NOT is_part THEN 1 ELSE 0 END) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cidx FROM c)
SELECT column_name, data_type, uses, bytes, score, rank,
       CASE WHEN is_part THEN 'partition' WHEN cidx <= 4 THEN 'cluster_' || CAST(cidx AS VARCHAR) ELSE 'none' END AS role
FROM ci""")
def ag69(spark, sf):
    j = v_jobs(_t(spark, sf)).withColumn("filter_columns", jo.filter_columns_expr("job_id", FILTER_COLUMNS))
    types = price_table(spark, [("event_time", "TIMESTAMP"), ("tenant_id", "STRING"), ("event_type", "STRING"),
                                ("user_id", "INT64")], "column_name string, data_type string")
    return jo.layout_advice(j, types)
