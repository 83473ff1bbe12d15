"""Session construction and cluster-facing settings.

The library never builds a session behind the caller's back: every operator
takes DataFrames.  ``get_session`` is for tests, the bench and the CLI entry
points; on a cluster the job's own session is used and only the settings the
library relies on (UTC session zone, AQE) are asserted by ``tune``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on for correct results (event time is UTC) and
# for scale (AQE re-plans joins from runtime sizes and splits skewed shuffle
# partitions; the broadcast ceiling is an explicit, checked size bound).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings for a large cluster (100 TB inputs, ~1000 executors): many
# initial shuffle partitions that AQE coalesces towards ~256 MB each, scan
# splits of 256 MB, skew splitting from 256 MB, and a shared checkpoint
# folder supplied by the cluster (``spark.checkpoint.dir``).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark") -> SparkSession:
    """Local/test session. ``master`` defaults to ``local[$BENCH_CPUS or 8]``."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "16g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus))))
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop FileSystem of its path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tune(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply the runtime-settable core settings to an existing session
    (and, with ``cluster=True``, the large-cluster sizing above)."""
    conf = dict(CORE_CONF, **(CLUSTER_CONF if cluster else {}))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (distributed) folder and is used
    as is.  Only where it is unset -- local tests -- a scratch folder is made
    and set.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not cur:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        cur = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    # setCheckpointDir makes a fresh sub-folder on every call: do it once
    # per context (and again only if the setting changed)
    if getattr(sc, "_tidemark_ckpt_dir", None) != cur or sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
        sc._tidemark_ckpt_dir = cur
    return cur


def ship_code(spark: SparkSession) -> str | None:
    """Make this package importable on every executor (Python workers
    unpickle rules, processors and UDFs by module name).

    The package is zipped in memory, written through the Hadoop FileSystem
    into the shared checkpoint folder and added with ``addPyFile``; done once
    per SparkContext."""
    import hashlib
    import io
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", None):
        return sc._tidemark_shipped
    root = Path(__file__).resolve().parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"tidemark/{f.relative_to(root)}")
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:12]
    dest = scratch_path(spark, f"code/tidemark-{digest}.zip")
    jvm = sc._jvm
    hp = jvm.org.apache.hadoop.fs.Path(dest)
    fs = hp.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        out = fs.create(hp, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(dest)
    sc._tidemark_shipped = dest
    return dest


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate
    tables (lineage cuts that must survive executor loss)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
