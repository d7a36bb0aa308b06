"""Shared DataFrame helpers of the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import scratch_dir
from skyledger.sources.paths import remove_tree

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"       # else they stay until the driver collects its garbage
BATCHES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
READS, READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize", 512      # the reader holds a batch's texts as one array, doubled as it fills
# Parquet looks at the size of pages and row groups after 100 rows only, and compresses and reads them whole
LARGE_ROWS = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.page.row.count.limit": "1", "parquet.page.size.row.check.min": "1",
              "parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1"}

_passing: ContextVar[str | None] = ContextVar("passing", default=None)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str, lasting: bool = False, large_rows: bool = False) -> DataFrame:
    """Write `df` once to the cluster's shared folder and read it back: cuts the lineage, and
    lost executors cost no recomputation of what lies before. The shuffle files of the write go when it ends.
    `large_rows`: rows of some megabytes, compressed already; few of them are held at once by who writes or reads."""
    spark, under = df.sparkSession, None if lasting else _passing.get()
    path = scratch_dir(spark, purpose)
    if under:
        path = f"{under}/{path.rsplit('/', 1)[1]}"
    with _setting(spark, CLEANUP, "true"):
        df.write.options(**LARGE_ROWS if large_rows else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of BATCH_BYTES at most (a longer row alone), where the session allows more: a batch is held by
    the executor and, some times over, by the worker. Parquet files are read READ_ROWS rows at a time."""
    allowed = re.fullmatch(r"(\d+)([kmgtp]?)b?", str(spark.conf.get(BATCHES, None)).strip().lower())
    if not allowed or int(allowed[1]) << 10 * " kmgtp".find(allowed[2] or " ") > BATCH_BYTES:
        spark.conf.set(BATCHES, BATCH_BYTES)
    if int(spark.conf.get(READS)) > READ_ROWS:
        spark.conf.set(READS, READ_ROWS)


@contextmanager
def passing(spark: SparkSession, purpose: str) -> Iterator[None]:
    """Tables staged inside are removed at the end, so that they don't lie beside a later stage's; what is read after it is
    staged as `lasting`."""
    path = scratch_dir(spark, purpose)
    token = _passing.set(path)
    try:
        yield
    finally:
        _passing.reset(token)
        remove_tree(spark, path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_rank_in(df: DataFrame, keys: list[str], spread_by: list[Column], order: list[Column], name: str,
                  rows_per_cell: int = 200_000) -> DataFrame:
    """Add `name`: a gapless number from 0 within `keys`, without gathering a key in one task.

    Rows of a key are dealt by hash to cells, the cells are counted, and a row's number is the
    count of the cells before its own plus its place in its cell. The table of cells has one row
    per key and `rows_per_cell` rows at most, as many as there are cells.
    """
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__cells", F.ceil(F.col("__n") / F.lit(rows_per_cell)).cast("long")).drop("__n")
    dealt = _joined(df, totals, keys).withColumn("__cell", F.pmod(F.xxhash64(*spread_by), F.col("__cells"))).drop("__cells")
    cells = dealt.groupBy(*keys, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = cells.withColumn("__before", F.sum("__n").over(
        Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))).drop("__n")
    place = F.row_number().over(Window.partitionBy(*keys, "__cell").orderBy(*order))
    return _joined(dealt.withColumn("__place", place), before, [*keys, "__cell"]).withColumn(
        name, (F.coalesce("__before", F.lit(0)) + F.col("__place") - 1).cast("long")).drop("__before", "__place", "__cell")


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    other = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    match = [left[k].eqNullSafe(other[f"__r_{k}"]) for k in keys]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    return left.join(other, condition).drop(*[f"__r_{k}" for k in keys])
