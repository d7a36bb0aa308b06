"""Data checks (Q1-Q4): landing checks of the end-to-end harness and the
declared key / NOT NULL constraints, as DataFrames of findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unexpected_stations(documents: DataFrame, requested: DataFrame, doc_col: str = "day") -> DataFrame:
    """Q1: per document, the stations present that were not requested."""
    return documents.select(doc_col, "wmo_index").distinct() \
        .join(requested.select("wmo_index").distinct(), "wmo_index", "left_anti")


def landing_counts(documents: DataFrame, by: Sequence[str], expected_rows: Column | None = None,
                   doc_col: str = "day") -> DataFrame:
    """Q2: keys (documents) and station rows per manifest, against an expectation
    (default: every station of the manifest on every day of it)."""
    agg = documents.groupBy(*by).agg(
        F.count_distinct(doc_col).cast("long").alias("n_keys"),
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count_distinct("wmo_index").cast("long").alias("n_stations"))
    exp = expected_rows if expected_rows is not None else F.col("n_keys") * F.col("n_stations")
    return agg.withColumn("expected_rows", exp.cast("long")) \
        .withColumn("rows_ok", F.col("n_rows") == F.col("expected_rows"))


def manifest_errors(events: DataFrame, expected_type: Column, expected_source: Column,
                    expected_bucket: Column) -> DataFrame:
    """Q3: wrong event type / source / bucket as a list of messages (empty list = fine)."""
    def check(col: str, want: Column, label: str) -> Column:
        return F.when(~F.coalesce(F.col(col) == want, F.lit(False)),
                      F.format_string(f"{label}: expected %s, got %s", want, F.coalesce(F.col(col), F.lit("null"))))
    problems = F.array_compact(F.array(check("event_type", expected_type, "event_type"),
                                       check("source_name", expected_source, "source_name"),
                                       check("bucket", expected_bucket, "bucket")))
    return events.withColumn("errors", problems)


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q4: keys occurring more than once, with their count."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n_rows")).filter("n_rows > 1")


def required_nulls(table: DataFrame, required: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Q4: number of nulls in each required column (one row, or one per ``by`` group)."""
    aggs = [F.count_if(F.col(c).isNull()).cast("long").alias(f"{c}_nulls") for c in required]
    return table.groupBy(*by).agg(*aggs) if by else table.agg(*aggs)
