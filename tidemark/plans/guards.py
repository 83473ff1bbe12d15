"""Plan inspection and guards (PF4, PF6, PF7, JO5, SL4).

All checks read Spark's own plans (the optimized logical plan and the
physical plan chosen for execution) or parquet footers; none parses SQL
text.  A byte estimate takes the files after partition pruning and the columns
to be read from the scan nodes, without running the query, and reads the
footers of those files in tasks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class GuardError(RuntimeError):
    """A query failed a cost or safety guard."""


def physical_plan(df: DataFrame) -> str:
    """Text of the physical plan Spark will execute (AQE initial plan)."""
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def scan_nodes(df: DataFrame) -> list[str]:
    """The file-scan lines of the physical plan (one per scanned relation)."""
    return [ln for ln in physical_plan(df).splitlines() if "FileScan" in ln or "BatchScan" in ln]


def partition_filters(df: DataFrame) -> list[str]:
    """``PartitionFilters`` of every file scan (empty list entries when a
    scan has none)."""
    out = []
    for ln in scan_nodes(df):
        m = re.search(r"PartitionFilters: \[(.*?)\]", ln)
        out.append(m.group(1) if m else "")
    return out


def _file_scans(df: DataFrame) -> list:
    """File scan nodes of the physical plan (before adaptive execution)."""
    out, todo = [], [df._jdf.queryExecution().sparkPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            out.append(node)
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _seq(df: DataFrame, items: list):
    return df.sparkSession._jvm.PythonUtils.toSeq(items)


def _bounds(expr, cols: Sequence[str]) -> bool:
    """Whether a filter expression bounds one of the columns (being not null
    is no bound)."""
    refs = expr.references().toSeq()
    names = {a.name() for a in _items(refs)}
    return bool(names & set(cols)) and expr.getClass().getSimpleName() != "IsNotNull"


def require_partition_filter(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """PF4: refuse a query that scans a table partitioned by
    ``partition_cols`` without a filter that bounds one of them (the table
    option "require partition filter").  Scans of other tables pass.
    Returns ``df`` unchanged when it passes."""
    found = False
    for scan in _file_scans(df):
        parts = set(scan.relation().partitionSchema().fieldNames())
        if not parts & set(partition_cols):
            continue
        found = True
        if not any(_bounds(e, partition_cols) for e in _items(scan.partitionFilters())):
            raise GuardError(f"scan without a partition filter on {list(partition_cols)}")
    if not found:
        raise GuardError(f"no scan of a table partitioned by {list(partition_cols)}")
    return df


def forbid_cartesian(df: DataFrame) -> DataFrame:
    """JO5: refuse a plan that contains a Cartesian product or a nested-loop
    join (a comma join or a join without an equality condition)."""
    plan = physical_plan(df)
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if op in plan:
            raise GuardError(f"plan contains {op}: add an equality join condition")
    return df


def join_on(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """JO5 helper: a join that must have a condition, checked on the plan."""
    if on is None or (isinstance(on, (list, tuple)) and not on):
        raise GuardError("join without a condition is a Cartesian product")
    return forbid_cartesian(left.join(right, on, how))


def _footer_bytes(paths: pd.Series, columns: list[list[str] | None]) -> pd.DataFrame:
    import pyarrow.parquet as pq
    from pyarrow import fs
    rows = []
    for p, cols in zip(paths, columns):
        store, where = fs.FileSystem.from_uri(p)
        md = pq.ParquetFile(store.open_input_file(where)).metadata
        sizes: dict[str, int] = {}
        for rg in range(md.num_row_groups):
            g = md.row_group(rg)
            for ci in range(g.num_columns):
                c = g.column(ci)
                name = c.path_in_schema.split(".")[0]
                if cols is None or name in cols:
                    sizes[name] = sizes.get(name, 0) + c.total_compressed_size
        for name, b in sizes.items():
            rows.append((p, name, int(b), int(md.num_rows)))
    return pd.DataFrame(rows, columns=["path", "column_name", "bytes", "file_rows"])


def planned_files(df: DataFrame) -> DataFrame:
    """Files that the scans of a query would open after partition pruning,
    with the columns read from each: (path, columns).  Taken from the plan;
    the query does not run."""
    rows = []
    for scan in _file_scans(df):
        cols = list(scan.requiredSchema().fieldNames())
        static = [e for e in _items(scan.partitionFilters()) if "subquery" not in e.toString().lower()]
        listed = scan.relation().location().listFiles(_seq(df, static), _seq(df, []))
        for part in _items(listed):
            rows += [(f.getPath().toString(), cols) for f in _items(part.files())]
    return df.sparkSession.createDataFrame(rows, "path string, columns array<string>")


def estimate_scan_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """PF7: bytes a query would read, per column, after partition pruning:
    the compressed column chunks of every column its scans need (filter
    columns too), or of ``columns`` only, summed from the footers in tasks.
    Row-group skipping by min/max is not modelled, so clustered tables are
    over-estimated, as the reference notes for its dry run.  Returns
    (column_name, bytes, files)."""
    spark = df.sparkSession
    only = set(columns) if columns is not None else None
    fl = planned_files(df).repartition(spark.sparkContext.defaultParallelism * 4)

    def read(it):
        for pdf in it:
            yield _footer_bytes(pdf["path"], [[c for c in x if only is None or c in only] for x in pdf["columns"]])

    per = fl.mapInPandas(read, "path string, column_name string, bytes long, file_rows long")
    return per.groupBy("column_name").agg(F.sum("bytes").alias("bytes"), F.countDistinct("path").alias("files"))


def partition_storage(df: DataFrame, partition_col: str) -> DataFrame:
    """AG34 (storage side): rows, files and compressed bytes per partition
    of a partitioned parquet table, from the footers of its files (the file
    list comes from the plan, footers are read in ``mapInPandas`` tasks).  The partition value is taken from the file path
    (``col=value``); NULL partitions are Hive's default partition name."""
    spark = df.sparkSession
    fl = planned_files(df).select("path").distinct().repartition(spark.sparkContext.defaultParallelism * 4)

    def read(it):
        for pdf in it:
            per = _footer_bytes(pdf["path"], [None] * len(pdf))
            yield per.groupby("path", as_index=False).agg(bytes=("bytes", "sum"), file_rows=("file_rows", "max"))

    per = fl.mapInPandas(read, "path string, bytes long, file_rows long")
    part = F.regexp_extract("path", rf"{partition_col}=([^/]+)/", 1)
    return (per.groupBy(part.alias("partition_id"))
            .agg(F.sum("file_rows").alias("total_rows"), F.sum("bytes").alias("total_bytes"),
                 F.count(F.lit(1)).alias("files")))


def total_scan_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> int:
    est = estimate_scan_bytes(df, columns)
    v = est.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return int(v)


def max_bytes_guard(df: DataFrame, limit_bytes: int, columns: Sequence[str] | None = None) -> DataFrame:
    """PF6: refuse a query whose estimated scan exceeds ``limit_bytes``."""
    b = total_scan_bytes(df, columns)
    if b > limit_bytes:
        raise GuardError(f"query would read {b} bytes, over the {limit_bytes} byte ceiling")
    return df


def scan_signature(df: DataFrame) -> list[tuple[str, str, str]]:
    """(ReadSchema, PartitionFilters, PushedFilters) of every file scan."""
    out = []
    for ln in scan_nodes(df):
        parts = []
        for key in ("ReadSchema: ", "PartitionFilters: ", "PushedFilters: "):
            m = re.search(re.escape(key) + r"(\S+(?:, \S+)*?)(?:, [A-Z][A-Za-z]+: |$)", ln)
            parts.append(m.group(1) if m else "")
        out.append(tuple(parts))
    return out


def limit_does_not_cut_scan(df: DataFrame, n: int) -> bool:
    """SL4: ``LIMIT n`` on top of a query leaves its scans unchanged -- same
    columns, same partition and pushed filters -- so the bytes the scan is
    planned to read (``estimate_scan_bytes`` of the query) do not shrink.
    (At run time Spark may stop a plain limit early; with an ``ORDER BY``
    the whole pruned input is read, as in the reference.)"""
    return scan_signature(df) == scan_signature(df.limit(n))


def has_pushed_filters(df: DataFrame) -> bool:
    return any("PushedFilters: [" in ln and "PushedFilters: []" not in ln for ln in scan_nodes(df))


def read_schema(df: DataFrame) -> list[str]:
    """``ReadSchema`` column lists of the scans (column pruning check)."""
    out = []
    for ln in scan_nodes(df):
        m = re.search(r"ReadSchema: struct<(.*?)>(,|$| )", ln)
        out.append(m.group(1) if m else "")
    return out

