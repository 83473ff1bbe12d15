"""Replacing a table, or some partitions of one, so that a crash loses nothing.

The new content is written beside the table first and renamed to its ready
name only when it is complete; that rename is the commit.  Moving it into
place is then rolled forward, again by the next writer if the first one dies
in between: what is ready is never thrown away, and what is not ready never
counts.  All paths go through the Hadoop FileSystem of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WHOLE, PARTS, DRAFT = ".__whole", ".__parts", ".__draft"
BATCH = "_batch="


def _fs(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def _rename(spark: SparkSession, a: str, b: str) -> None:
    if not _fs(spark, a).rename(_path(spark, a), _path(spark, b)):
        raise OSError(f"cannot rename {a} to {b}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, whole or not at all: under another name first."""
    fs, target = _fs(spark, path), _path(spark, path)
    draft = _path(spark, str(target.getParent().toString()) + f"/.{target.getName()}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    _rename(spark, draft.toString(), path)


def children(spark: SparkSession, path: str) -> list[str]:
    fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(_path(spark, path)) if s.isDirectory()]


def files(spark: SparkSession, path: str) -> list[str]:
    fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(_path(spark, path)) if s.isFile()]


def recover(spark: SparkSession, path: str) -> None:
    """Finish a commit that was ready when its writer died."""
    path = path.rstrip("/")
    if exists(spark, path + WHOLE):
        delete(spark, path)
        _rename(spark, path + WHOLE, path)
    if exists(spark, path + PARTS):
        _fs(spark, path).mkdirs(_path(spark, path))
        for name in children(spark, path + PARTS):
            if name.startswith(BATCH):
                _fs(spark, path).mkdirs(_path(spark, path + "_applied"))
                target = f"{path}_applied/{name}"
            else:
                target = f"{path}/{name}"
            delete(spark, target)
            _rename(spark, f"{path}{PARTS}/{name}", target)
        delete(spark, path + PARTS)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where there is none yet.  Every other error of the
    read is the caller's to see."""
    recover(spark, path)
    return spark.read.parquet(path) if exists(spark, path) else None


def replace(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Replace the whole table by ``df``, which may read that very table."""
    _commit(df, path.rstrip("/"), WHOLE, partition_col, None, ())


def replace_partitions(df: DataFrame, path: str, partition_col: str, emptied: tuple[str, ...] = (),
                       batch: str | None = None) -> None:
    """Replace the partitions of ``df`` and empty those named in ``emptied``
    that it has no rows of; ``batch`` is noted as applied in the same commit."""
    _commit(df, path.rstrip("/"), PARTS, partition_col, batch, emptied)


def applied(spark: SparkSession, path: str, batch: str) -> bool:
    recover(spark, path)
    return exists(spark, f"{path.rstrip('/')}_applied/{BATCH}{batch}")


def _commit(df: DataFrame, path: str, kind: str, partition_col, batch, emptied) -> None:
    spark = df.sparkSession
    recover(spark, path)
    delete(spark, path + DRAFT)
    w = df.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path + DRAFT)
    fs = _fs(spark, path)
    for value in emptied:
        # an empty folder takes the place of the partition
        fs.mkdirs(_path(spark, f"{path}{DRAFT}/{partition_col}={value}"))
    if batch is not None:
        fs.mkdirs(_path(spark, f"{path}{DRAFT}/{BATCH}{batch}"))
    _rename(spark, path + DRAFT, path + kind)
    recover(spark, path)
