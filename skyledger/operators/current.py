"""Versioned tables: newest-wins reads and rewrite-based maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _version_key(version: str, tie: str | None) -> Column:
    return F.struct(F.col(version), F.col(tie)) if tie else F.struct(F.col(version))


def current(df: DataFrame, keys: Sequence[str], version: str, tie: str | None = None) -> DataFrame:
    """The newest row per key; on equal ``version`` the larger ``tie`` wins.

    Expressed as one aggregation (``max_by`` over a struct) rather than a
    window: the aggregation is combined map-side, so a key holding a third of
    all versions is reduced to one row per map task before the shuffle, and
    the output stays hash-partitioned on ``keys`` for a following join on the
    same keys. Rows whose version is null lose to any versioned row.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = f"struct({version}, {tie})" if tie else f"struct({version})"
    picked = df.groupBy(*keys).agg(F.expr(f"max_by(struct({', '.join(rest)}), {order}) AS _row"))
    return picked.selectExpr(*keys, *[f"_row.{c} AS {c}" for c in rest])


def insert_if_absent(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``target`` (conflict -> do nothing).

    ``new`` is first reduced to one row per key (first writer by column order
    is not defined in SQL; the smallest full row is taken for determinism)."""
    keys = list(keys)
    rest = [c for c in new.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")) \
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]) if rest else new.dropDuplicates(keys)
    return one.join(target.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Conflict -> the new row replaces the old one; other rows are kept.

    Source rank (0 = target, 1 = new) is the version, so the result is the
    union reduced by W1 — one shuffle on the key."""
    both = target.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)))
    cols = target.columns
    return current(both, keys, "_src").select(*cols)


def replace_partitions(target: DataFrame, new: DataFrame, part_col: str) -> DataFrame:
    """D3 as a plan: every partition value present in ``new`` is replaced wholly by ``new``."""
    kept = target.join(new.select(part_col).distinct(), part_col, "left_anti").select(*target.columns)
    return kept.unionByName(new.select(*target.columns))
