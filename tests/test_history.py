"""Query history from Spark's event log, read with DataFrames and judged by
the job-stage operators (E2 of SURVEY 3: scan stage, fan-out stages)."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tidemark.operators import jobs as jo
from tidemark.plans.history import execution_history, stage_metrics


def test_event_log_history_feeds_stage_operators(spark):
    log_dir = spark.sparkContext.getConf().get("spark.eventLog.dir")
    left = spark.range(0, 20000).withColumn("k", F.col("id") % 10)
    right = spark.range(0, 2000).withColumn("k", F.col("id") % 10)
    spark.sparkContext.setJobDescription("fan-out self join")
    left.join(right.withColumnRenamed("id", "rid"), "k").repartition(4).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    time.sleep(2)   # let the listener bus flush to the log
    st = stage_metrics(spark, log_dir)
    assert st.where(F.col("shuffle_records_written") > 0).count() > 0
    hist = execution_history(spark, log_dir)
    fan = jo.fanout_stages(hist, 4.0)
    # 20000 x 2000 rows meet in 10 keys: 4,000,000 rows out of 22,000 read
    assert fan.where(F.col("records_written") >= 4_000_000).count() >= 1
    scans = jo.scan_stage(hist).where(F.col("scan_stage_id").isNotNull())
    assert scans.count() >= 1
