"""Sharding by minimax contiguous partition (operator 10), DataFrame and SQL functions only.

Rows with equal texts form one atomic group. Groups are ordered by a digest of their text (so that
any stretch of the order holds about as much as any other), and the order is cut into contiguous
shards. The capacity is the smallest one for which greedy filling needs no more shards than there
are, found by binary search; the cuts are the greedy ones at that capacity.

The driver never sees the groups. It works on sums over digest ranges, 2^BITS of a level at most,
and looks into a range (the sums by the next BITS digest bits) only where a cut may fall.

Law: `bytes`. Defined results: a null text has no bytes (size 1) and is in the group of the empty
texts; repeated rows are kept; fewer groups than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import dense_rank_in, register, staged, table

SHARDS = 8
BITS = 12                       # digest bits per level: at most 4096 sums of a range at once
_LEVELS = 5                     # 60 of the 128 digest bits order the groups


def greedy(sizes: list[int], capacity: int) -> list[int]:
    """How many sizes each shard takes in order, filled one after another (a size over the capacity fits nowhere: [])."""
    cuts, load, count = [], 0, 0
    for size in sizes:
        if size > capacity:
            return []
        if load + size > capacity:
            cuts.append(count)
            load = count = 0
        load += size
        count += 1
    return [*cuts, count]


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search for the least capacity at which greedy filling needs at most `shards` shards."""
    low, high = max([*sizes, 0]), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        need = greedy(sizes, middle)
        if need and len(need) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def _prefix(level: int):
    """The first `level` * BITS digest bits as a number (the digest is hexadecimal)."""
    return F.conv(F.substring("digest", 1, level * BITS // 4), 16, 10).cast("long")


class _Node:
    """A range of digests: its size, and whether it holds one group only."""

    __slots__ = ("level", "value", "size", "whole")

    def __init__(self, level: int, value: int, size: int, whole: bool):
        self.level, self.value, self.size, self.whole = level, value, size, whole


def _children(groups: DataFrame, nodes: list[_Node]) -> dict[int, list[_Node]]:
    level = nodes[0].level + 1
    rows = groups.filter(_prefix(level - 1).isin([n.value for n in nodes])) if level > 1 else groups
    got = rows.groupBy(_prefix(level).alias("v")).agg(F.sum("group_size").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    out: dict[int, list[_Node]] = {}
    for r in sorted(got, key=lambda r: r["v"]):
        whole = r["n"] == 1 or level == _LEVELS              # at the last level equal prefixes stay together
        out.setdefault(r["v"] >> BITS if level > 1 else 0, []).append(_Node(level, r["v"], r["s"], whole))
    return out


def contiguous_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[list[str], int]:
    """(the first digest prefix of shards 1, 2, ... as hexadecimal text of any length; the capacity)."""
    nodes = [_Node(0, 0, 0, False)]
    while True:
        divisible = [n for n in nodes if not n.whole]
        if nodes[0].level == 0 and not nodes[0].size:
            nodes = _children(groups, nodes).get(0, [])
            if not nodes:
                return [], 0
            continue
        total = sum(n.size for n in nodes)
        sure = smallest_capacity([n.size for n in nodes], shards)                  # feasible whatever the ranges hold
        least = max([-(-total // shards), *(n.size for n in nodes if n.whole)])    # no capacity below is feasible
        opened = _where_cuts_fall(nodes, least, sure, shards) if divisible else []
        if not opened:
            break
        by_level: dict[int, list[_Node]] = {}
        for i in opened:
            by_level.setdefault(nodes[i].level, []).append(nodes[i])
        inner = {(level, value): kids for level, own in by_level.items() for value, kids in _children(groups, own).items()}
        nodes = [k for i, n in enumerate(nodes) for k in (inner.get((n.level, n.value), [n]) if not n.whole else [n])]
    capacity = smallest_capacity([n.size for n in nodes], shards)
    cuts, at = [], 0
    for count in greedy([n.size for n in nodes], capacity)[:-1]:
        at += count
        cuts.append(f"{nodes[at].value:0{nodes[at].level * BITS // 4}x}")
    return cuts, capacity


def _where_cuts_fall(nodes: list[_Node], least: int, sure: int, shards: int) -> list[int]:
    """Ranges to look into: those over `least` first (they may hold a large group); when there are
    none, those that a greedy cut may fall into for some capacity from `least` to `sure`.

    With ranges indivisible at the capacity `least`, each greedy cut lies no later than with the
    groups themselves at any capacity considered; shard j ends at j * `sure` at the latest.
    """
    large = [i for i, n in enumerate(nodes) if not n.whole and n.size > least]
    if large:
        return large
    earliest, load, filled = [], 0, 0
    for n in nodes:
        if load + n.size > least:
            earliest.append(filled)
            load = 0
        load += n.size
        filled += n.size
    open_, start = [], 0
    for i, n in enumerate(nodes):
        end = start + n.size
        if not n.whole and any(end > low and start < (j + 1) * sure for j, low in enumerate(earliest[:shards - 1])):
            open_.append(i)
        start = end
    return open_


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under `bytes`)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest")), "shard-rows")
    groups = staged(rows.groupBy("digest").agg(F.sum("size").alias("group_size")), "shard-groups")
    cuts, _ = contiguous_cuts(groups, shards)
    shard = F.lit(0)
    for cut in cuts:                                         # hexadecimal text of one length orders as the digests do
        shard = shard + F.when(F.col("digest") >= F.lit(cut), 1).otherwise(0)
    placed = rows.withColumn("shard", shard.cast("int"))
    numbered = dense_rank_in(placed, ["shard"], [F.col("doc_id"), F.col("digest")], [F.col("doc_id"), F.col("digest")], "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"))


@register("op10_sharding")
def op10_sharding(spark, sf_dir):
    return sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))
