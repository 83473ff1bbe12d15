"""Table layout: partitioned and sorted writes, pruned scans, partition
retention and partition statistics (SO3-SO9, PF1-PF3, AG34, AG35).

Writes range-partition by (partition column, cluster keys) and sort within
each task, so files hold disjoint, sorted cluster-key ranges; row-group
min/max statistics then let range filters on the cluster keys skip row
groups, and partition filters prune whole folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import range_bucket, trunc_partition, ts_range

NULL_PARTITION = "__NULL__"


def scan(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Column-pruned, predicate-filtered scan (SO3, PF1)."""
    out = df.select(*columns) if where is None else df.where(where).select(*columns)
    return out


def day_range(df: DataFrame, ts_col: str, date_col: str, d0: str, d1: str) -> DataFrame:
    """Half-open day range ``[d0, d1)`` that prunes partitions (PF2).

    A range on the timestamp alone only reaches the parquet row groups; the
    same bounds on the derived partition column prune folders, so both are
    added."""
    return df.where(ts_range(ts_col, d0, d1)
                    & (F.col(date_col) >= F.lit(d0).cast("date"))
                    & (F.col(date_col) < F.lit(d1).cast("date")))


def read_shards(spark: SparkSession, root: str, prefix: str, day_from: str, day_to: str,
                fmt: str = "parquet") -> DataFrame:
    """SO4 (path form): date-sharded tables ``<root>/<prefix>YYYYMMDD`` read
    for a bounded suffix range ``[day_from, day_to]`` (inclusive, like a
    wildcard table with a suffix filter).  Only the shard folder names are
    listed (Hadoop ``globStatus``); the shards are read as one DataFrame with
    the suffix as ``shard_date``.  A single table partitioned by date with a
    partition filter is the better layout (SO3/SO5); this reads existing
    shards."""
    import datetime as dt
    jvm = spark.sparkContext._jvm
    pat = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{prefix}*")
    fs = pat.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    lo, hi = dt.date.fromisoformat(day_from), dt.date.fromisoformat(day_to)
    paths = []
    for st in fs.globStatus(pat) or []:
        suffix = st.getPath().getName()[len(prefix):]
        try:
            d = dt.datetime.strptime(suffix, "%Y%m%d").date()
        except ValueError:
            continue
        if lo <= d <= hi:
            paths.append(st.getPath().toString())
    if not paths:
        raise FileNotFoundError(f"no shards {prefix}YYYYMMDD in [{day_from}, {day_to}] under {root}")
    df = spark.read.format(fmt).load(paths)
    return df.withColumn("shard_date", F.to_date(F.regexp_extract(F.input_file_name(), rf"{prefix}(\d{{8}})", 1),
                                                 "yyyyMMdd"))


def with_partition(df: DataFrame, ts_col: str, unit: str = "DAY", name: str = "event_date",
                   keep_nulls: bool = True) -> DataFrame:
    """Add the partition column for DAY/HOUR/MONTH/YEAR granularity (SO6).
    NULL event times either stay (Hive default partition) or are excluded
    (SO8)."""
    out = df.withColumn(name, trunc_partition(ts_col, unit))
    return out if keep_nulls else out.where(F.col(ts_col).isNotNull())


def with_int_range(df: DataFrame, col_name: str, start: int, end: int, step: int,
                   name: str = "bucket") -> DataFrame:
    """Integer-range partition label (SO7)."""
    return df.withColumn(name, range_bucket(col_name, start, end, step))


def null_partition(df: DataFrame, part_col: str, name: str = "partition_id") -> DataFrame:
    """Partition label with NULLs named ``__NULL__`` (SO8)."""
    return df.withColumn(name, F.coalesce(F.col(part_col).cast("string"), F.lit(NULL_PARTITION)))


def write_partitioned(df: DataFrame, path: str, partition_col: str,
                      cluster: Sequence[str] = (), mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000) -> None:
    """CTAS into day (or other) partitions, sorted by up to 4 cluster keys (SO5).

    ``repartitionByRange(partition_col, *cluster)`` samples the data and cuts
    it into ranges of (partition value, cluster keys): a day holding a third
    of the rows is split over many tasks, and each task writes files whose
    cluster-key ranges do not overlap, which is what row-group min/max
    skipping needs.  ``sortWithinPartitions`` orders rows inside each file;
    ``maxRecordsPerFile`` bounds file size; dynamic partition overwrite
    replaces only the partitions present in ``df``.
    """
    if len(cluster) > 4:
        raise ValueError("at most 4 cluster keys")
    # the hash breaks ties, so a range can end inside equal cluster keys
    tie = F.xxhash64(*[c for c in df.columns if c != partition_col])
    d = df.repartitionByRange(F.col(partition_col), *[F.col(c) for c in cluster], tie)
    d = d.sortWithinPartitions(partition_col, *cluster)
    (d.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def partition_stats(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows per partition, NULL partition kept under ``__NULL__`` (AG34)."""
    return (null_partition(df, partition_col)
            .groupBy("partition_id").agg(F.count(F.lit(1)).alias("total_rows")))


def column_metadata(spark: SparkSession, df: DataFrame, partition_cols: Sequence[str] = (),
                    cluster: Sequence[str] = ()) -> DataFrame:
    """Column list with partitioning flag and clustering ordinal (AG35).

    Reads the schema only; no data is scanned."""
    rows = []
    for i, f in enumerate(df.schema.fields, start=1):
        rows.append((f.name, i, f.dataType.simpleString(), f.nullable,
                     f.name in partition_cols,
                     (list(cluster).index(f.name) + 1) if f.name in cluster else None))
    return spark.createDataFrame(
        rows, "column_name string, ordinal_position int, data_type string, is_nullable boolean, "
              "is_partitioning_column boolean, clustering_ordinal_position int")
