"""Parquet tables of the layers: read with pushed-down day ranges, append with the
month layout, and rewrite safely (S6, S7, S13, D1, D3).

A table is a folder of parquet files partitioned by ``month`` (``yyyyMM``)
and sorted by ``(wmo_index, day)`` inside each file, so a day range prunes
partitions and row groups. Rewrites stage the touched partitions in full and then
overwrite exactly these with Spark's dynamic partition overwrite; one that breaks off
is repeated from its copy. A table has one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.metrics import between_days
from skyledger.sources.paths import finish_rewrites, path_exists, rewrite_partitions


def month_of(day_col: str) -> F.Column:
    """``yyyyMM`` month bucket."""
    return F.date_format(F.col(day_col), "yyyyMM")


def layout(df: DataFrame, day_col: str = "day", key: str = "wmo_index") -> DataFrame:
    """Add the ``month`` partition column; range-partition on ``(month, key, day)``
    so a large month is split over many tasks/files, each a contiguous key range
    sorted by ``(key, day)`` (row-group min/max then skip by key and day)."""
    return df.withColumn("month", month_of(day_col)).repartitionByRange("month", key, day_col) \
        .sortWithinPartitions(key, day_col)


def read_table(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None,
               day_col: str = "day", schema: T.StructType | None = None) -> DataFrame:
    """Table read with the inclusive range pushed to the scan (and month pruning).

    With ``schema`` (the table's columns; ``month`` is added as a string) the
    read needs no footer inference and works on a table with no rows yet."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + [T.StructField("month", T.StringType())]))
    df = reader.parquet(path)
    if date_from is None and date_to is None:
        return df
    return between_days(df, date_from, date_to, day_col)


def append_layer(df: DataFrame, path: str, day_col: str = "day") -> None:
    """Append in the month layout (newest-wins reads make re-runs idempotent)."""
    layout(df, day_col).write.mode("append").partitionBy("month").parquet(path)


def append_as_laid(df: DataFrame, path: str, day_col: str = "day") -> None:
    """S7/D1 for rows that already lie in the month layout: append without another shuffle."""
    df.withColumn("month", month_of(day_col)).write.mode("append").partitionBy("month").parquet(path)


ROW_ORDER = ["wmo_index", "day"]


def replace_days(spark: SparkSession, new: DataFrame, path: str, day_col: str = "day") -> None:
    """D3 (delete day, then insert): every day present in ``new`` is replaced wholly;
    other days of the touched months are carried over from the current table. Only an
    absent table counts as empty; any other read error is raised."""
    order = [ROW_ORDER[0], day_col]
    fresh = new.withColumn("month", month_of(day_col))
    finish_rewrites(spark, path, "month", order)
    if path_exists(spark, path):
        old = _with_text_month(spark.read.parquet(path))
        months = fresh.select("month").distinct()
        kept = old.join(months, "month", "left_semi").join(fresh.select(day_col).distinct(), day_col, "left_anti")
        fresh = kept.unionByName(fresh.select(*kept.columns))
    rewrite_partitions(spark, fresh.repartitionByRange("month", *order).sortWithinPartitions("month", *order), path, "month", order)


def compact_current(spark: SparkSession, path: str, keys: list[str], version: str, tie: str | None = None,
                    touched_months: DataFrame | None = None, day_col: str = "day") -> None:
    """Rewrite touched months keeping only the newest version per key."""
    from skyledger.operators.current import current
    order = [ROW_ORDER[0], day_col]
    finish_rewrites(spark, path, "month", order)
    df = _with_text_month(spark.read.parquet(path))
    if touched_months is not None:
        df = df.join(touched_months.select("month").distinct(), "month", "left_semi")
    newest = current(df, keys + ["month"], version, tie)
    rewrite_partitions(spark, newest.repartitionByRange("month", *order).sortWithinPartitions("month", *order), path, "month", order)


def _with_text_month(df: DataFrame) -> DataFrame:
    """``month`` is text, also in a session that infers types of partition values."""
    return df.withColumn("month", F.col("month").cast("string"))


STATE_SCHEMA = "pipeline_name string, key string, value string, updated_at timestamp"


def upsert_state(spark: SparkSession, path: str, updates: DataFrame) -> None:
    """Pipeline state ``(pipeline_name, key) -> value``; a newer update replaces the old value.

    The table lies by pipeline, and only the pipelines that the updates name are rewritten. Several updates of
    one key in a call: the newest by ``updated_at``, then ``value``. Only an absent table counts as empty."""
    finish_rewrites(spark, path, "pipeline_name", ["key"])
    fresh = updates.select("pipeline_name", "key", "value", "updated_at").withColumn("_src", F.lit(1))
    if path_exists(spark, path):
        old = spark.read.schema(STATE_SCHEMA).parquet(path).join(fresh.select("pipeline_name").distinct(), "pipeline_name", "left_semi")
        fresh = old.withColumn("_src", F.lit(0)).unionByName(fresh)
    newest = fresh.groupBy("pipeline_name", "key").agg(F.max(F.struct("_src", "updated_at", "value")).alias("u")).select("pipeline_name", "key", "u.value", "u.updated_at")
    rewrite_partitions(spark, newest.repartition("pipeline_name"), path, "pipeline_name", ["key"])


def read_jdbc_table(spark: SparkSession, url: str, table: str, date_from: str | None = None,
                    date_to: str | None = None, day_col: str = "day", partition_column: str | None = None,
                    lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 1,
                    **properties) -> DataFrame:
    """S6 over JDBC (a warehouse driver jar must be on the classpath). The day range
    is a filter Catalyst pushes into the SQL sent to the database; with a numeric
    ``partition_column`` the read is split into ``num_partitions`` parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound) \
            .option("upperBound", upper_bound).option("numPartitions", num_partitions)
    return between_days(reader.load(), date_from, date_to, day_col)


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **properties) -> None:
    """S7 over JDBC: append in batches from every task (newest-wins reads keep re-runs idempotent)."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size) \
        .options(**properties).mode("append").save()
