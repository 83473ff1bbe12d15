"""Job history from Spark's own event log (SURVEY 3, E2: run a query, read
its stage tree, judge it with AG31/AG32, price it with AG19).

The event log (``spark.eventLog.enabled`` / ``spark.eventLog.dir``, a
shared folder on a cluster; ``spark.eventLog.compress=false`` or a codec
Hadoop reads) is JSON lines; it is read as text and only the
fields needed are extracted, so heterogeneous event types need no schema
inference.  The result has the shape of the job-history view: one row per
SQL execution with ``job_stages ARRAY<STRUCT<...>>``, ready for
``operators.jobs.scan_stage`` / ``fanout_stages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACC_SCHEMA = "array<struct<Name:string,Value:string>>"
METRICS = {
    "input_records": "internal.metrics.input.recordsRead",
    "shuffle_records_read": "internal.metrics.shuffle.read.recordsRead",
    "output_records": "internal.metrics.output.recordsWritten",
    "shuffle_records_written": "internal.metrics.shuffle.write.recordsWritten",
    "shuffle_output_bytes": "internal.metrics.shuffle.write.bytesWritten",
    "run_ms": "internal.metrics.executorRunTime",
}


def _events(spark: SparkSession, log_dir: str) -> DataFrame:
    # rolling logs are folders of event files; read them all (uncompressed
    # logs, or a compression codec Hadoop recognises by file extension)
    return spark.read.option("recursiveFileLookup", "true").text(log_dir).select(F.col("value").alias("e"),
                                           F.get_json_object("value", "$.Event").alias("kind"))


def stage_metrics(spark: SparkSession, log_dir: str) -> DataFrame:
    """One row per completed stage: ids, name, task count and the record
    and shuffle metrics summed over its tasks."""
    ev = _events(spark, log_dir).where(F.col("kind") == "SparkListenerStageCompleted")
    acc = F.from_json(F.get_json_object("e", "$['Stage Info']['Accumulables']"), ACC_SCHEMA)
    base = ev.select(
        F.get_json_object("e", "$['Stage Info']['Stage ID']").cast("int").alias("stage_id"),
        F.get_json_object("e", "$['Stage Info']['Stage Name']").alias("stage_name"),
        F.get_json_object("e", "$['Stage Info']['Number of Tasks']").cast("int").alias("tasks"),
        acc.alias("acc"))
    def metric(name: str):
        hits = F.filter("acc", lambda a: a["Name"] == F.lit(name))
        return F.coalesce(F.aggregate(hits, F.lit(0).cast("bigint"),
                                      lambda s, a: s + F.coalesce(a["Value"].try_cast("bigint"), F.lit(0))),
                          F.lit(0))

    cols = [metric(m).alias(k) for k, m in METRICS.items()]
    return base.select("stage_id", "stage_name", "tasks", *cols)


def job_stage_map(spark: SparkSession, log_dir: str) -> DataFrame:
    """Stage ids of every job and the SQL execution the job belongs to."""
    ev = _events(spark, log_dir).where(F.col("kind") == "SparkListenerJobStart")
    return ev.select(
        F.get_json_object("e", "$['Job ID']").cast("int").alias("spark_job_id"),
        F.get_json_object("e", "$['Properties']['spark.sql.execution.id']").cast("bigint").alias("execution_id"),
        F.explode(F.from_json(F.get_json_object("e", "$['Stage IDs']"), "array<int>")).alias("stage_id"))


def execution_history(spark: SparkSession, log_dir: str) -> DataFrame:
    """Job-history rows: per SQL execution, its description and the stage
    tree as ``job_stages`` (records read = table input + shuffle input,
    written = output + shuffle output, slot_ms = task run time), plus the
    totals used for pricing."""
    st = stage_metrics(spark, log_dir)
    jm = job_stage_map(spark, log_dir).where(F.col("execution_id").isNotNull())
    sx = (_events(spark, log_dir)
          .where(F.col("kind") == "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart")
          .select(F.get_json_object("e", "$.executionId").cast("bigint").alias("execution_id"),
                  F.get_json_object("e", "$.description").alias("query")))
    s = jm.join(st, "stage_id").dropDuplicates(["execution_id", "stage_id"])
    stage = F.struct(
        F.col("stage_id"), (F.col("input_records") + F.col("shuffle_records_read")).alias("records_read"),
        (F.col("output_records") + F.col("shuffle_records_written")).alias("records_written"),
        F.col("run_ms").alias("slot_ms"), (F.col("input_records") > 0).alias("reads_from_table"))
    g = s.groupBy("execution_id").agg(
        F.collect_list(stage).alias("job_stages"), F.sum("run_ms").alias("total_slot_ms"),
        F.sum("shuffle_output_bytes").alias("shuffle_bytes"))
    return g.join(sx, "execution_id", "left").withColumnRenamed("execution_id", "job_id")
