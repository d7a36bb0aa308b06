"""Existence, listing and replacement of files through Hadoop's file systems (any store Spark reaches)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; an unreadable store raises instead of counting as absent."""
    p, fs = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder (none when the folder is absent)."""
    p, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove_tree(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"could not remove {path}")


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def replace_object(spark: SparkSession, source: str, target: str) -> None:
    """Put one file in place of another (or of none): readers see the old or the new one."""
    jvm = spark._jvm.org.apache.hadoop.fs
    overwrite = spark._sc._gateway.new_array(jvm.Options.Rename, 1)
    overwrite[0] = jvm.Options.Rename.OVERWRITE
    jvm.FileContext.getFileContext(jvm.Path(target).toUri(), spark._jsc.hadoopConfiguration()).rename(jvm.Path(source), jvm.Path(target), overwrite)


_REWRITE = "_rewrite-"           # folders that readers of a table skip


def rewrite_partitions(spark: SparkSession, new: DataFrame, path: str, part_col: str, order: list[str]) -> None:
    """Replace the partitions of a parquet table that ``new`` has rows of; other partitions stay.

    The rows are written in full to a staged copy in the table's folder, which readers skip; then Spark's dynamic
    partition overwrite takes them from there. The copy goes last, so that a run which breaks off while
    partitions are replaced is repeated from it (:func:`finish_rewrites`). A table has one writer at a time."""
    finish_rewrites(spark, path, part_col, order)
    copy = f"{path.rstrip('/')}/{_REWRITE}{uuid.uuid4().hex[:12]}"
    new.write.partitionBy(part_col).parquet(copy)                # its _SUCCESS says that the copy is whole
    _overwrite(spark, copy, path, part_col, order)


def finish_rewrites(spark: SparkSession, path: str, part_col: str, order: list[str]) -> None:
    """Repeat rewrites that broke off after their copy was whole; drop copies that never were."""
    for name in child_names(spark, path):
        if name.startswith(_REWRITE):
            copy = f"{path.rstrip('/')}/{name}"
            if path_exists(spark, f"{copy}/_SUCCESS"):
                _overwrite(spark, copy, path, part_col, order)
            else:
                remove_tree(spark, copy)


def _overwrite(spark: SparkSession, copy: str, path: str, part_col: str, order: list[str]) -> None:
    if any(n.startswith(f"{part_col}=") for n in child_names(spark, copy)):
        rows = spark.read.option("basePath", copy).parquet(copy).withColumn(part_col, _text(part_col))
        rows.sortWithinPartitions(part_col, *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)
    remove_tree(spark, copy)


def _text(part_col: str):
    from pyspark.sql import functions as F
    return F.col(part_col).cast("string")
