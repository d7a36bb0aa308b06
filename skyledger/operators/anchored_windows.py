"""T12 batch form, and the chains of fetch locks (T5): windows anchored at a key's first hit.

A key's window opens at its first hit and lasts ``width``; the next hit at or after its end opens the
next one. Starts form a chain ``s, next(s), next(next(s)), ...`` with ``next(t)`` the key's first
instant at or after ``t + width``. It is found by joins and windows over *stretches* of the time axis, as
long as a window, so that a key with very many hits is spread over its stretches:

1. equal instants of a key are one; a stretch keeps its first and last instant;
2. a hit that follows a gap of a window or more always opens one: the chains fall into segments there, and only
   segments longer than a window are looked at further;
3. ``next`` of an instant lies in the following stretch, or is the first one of a later stretch;
4. starts are reached from the segments' first instants by pointer doubling: after round ``k`` the first
   ``2^k`` starts of every segment are known.

A window reaches into the following stretch at most, so each hit finds its start in its own stretch or the one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import staged


def stretch_of(t: str, width: int) -> Column:
    """The number of the stretch of ``width`` that holds an instant (exact, also before 1970)."""
    return F.expr(f"({t} - pmod({t}, {width}L)) div {width}L")


def window_starts(points: DataFrame, keys: list[str], width: int, under: str | None = None) -> DataFrame:
    """``keys, t``: the instants that open a window. ``points``: distinct ``keys, t`` (microseconds). ``under``: see :func:`staged`."""
    points = points.select(*keys, "t", stretch_of("t", width).alias("stretch"))
    whole = points.groupBy(*keys, "stretch").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    by_time = Window.partitionBy(*keys).orderBy("stretch")          # a row per stretch: bounded by time, not by hits
    opens = F.coalesce(F.col("first") - F.lag("last").over(by_time) >= width, F.lit(True))
    goes_on = F.coalesce(F.lead("first").over(by_time) - F.col("last") < width, F.lit(False))
    whole = staged(whole.select("*", opens.alias("opens"), goes_on.alias("goes_on"), F.lead("first").over(by_time).alias("after")), "stretches", under)
    heads = whole.filter("opens").select(*keys, F.col("first").alias("t"))
    # a segment of one stretch is shorter than a window: its first instant is all
    long = whole.filter("NOT opens OR goes_on")
    if long.limit(1).count() == 0:
        return heads
    inner = points.join(long.select(*keys, "stretch"), [*keys, "stretch"])
    jumps = staged(_next_instants(inner, long, keys, width), "anchors", under)
    starts, reached = [heads], heads.join(jumps.select(*keys), keys, "left_semi")
    while True:
        reached = staged(reached.join(jumps, [*keys, "t"]).select(*keys, F.col("next").alias("t")), "anchors", under)
        if reached.limit(1).count() == 0:
            break
        starts.append(reached)
        known = starts[0]
        for more in starts[1:]:
            known = known.unionByName(more)
        then = jumps.select(*keys, F.col("t").alias("next"), F.col("next").alias("then"))
        jumps = staged(jumps.join(then, [*keys, "next"]).select(*keys, "t", F.col("then").alias("next")), "anchors", under)
        reached = known
    out = starts[0]
    for more in starts[1:]:
        out = out.unionByName(more)
    return out


def _next_instants(points: DataFrame, whole: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``keys, t, next``: for each instant the first one of its segment at or after ``t + width``."""
    targets = points.select(*keys, "stretch", F.col("t").alias("at"), F.col("t").alias("target"), F.lit(None).cast("long").alias("t"))
    asked = points.select(*keys, (F.col("stretch") + 1).alias("stretch"), (F.col("t") + width).alias("at"), F.lit(None).cast("long").alias("target"), "t")
    later_first = Window.partitionBy(*keys, "stretch").orderBy(F.desc("at"), F.desc_nulls_last("target")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = targets.unionByName(asked).withColumn("next", F.min("target").over(later_first)).filter("t IS NOT NULL").select(*keys, "stretch", "t", "next")
    # a following stretch that opens a segment leads to that segment's own first instant; where it has none late enough, the
    # stretch after it goes on, if it is of the same segment. An empty one ends the segment: it is a gap of a window.
    rows = whole.select(*keys, "stretch", "opens", "after", "goes_on")
    then = F.expr("CASE WHEN next IS NULL THEN CASE WHEN goes_on THEN after END WHEN NOT opens THEN next END")
    return near.join(rows, [*keys, "stretch"]).select(*keys, "t", then.alias("next")).filter("next IS NOT NULL")


def in_windows(points: DataFrame, starts: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``keys, t, start``: each distinct instant with the start of its window."""
    flagged = points.select(*keys, "t").join(starts.select(*keys, "t", F.col("t").alias("start")), [*keys, "t"], "left").withColumn("stretch", stretch_of("t", width))
    running = Window.partitionBy(*keys, "stretch").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = starts.groupBy(*keys, (stretch_of("t", width) + 1).alias("stretch")).agg(F.max("t").alias("before"))
    found = flagged.withColumn("start", F.max("start").over(running)).join(before, [*keys, "stretch"], "left")
    return found.select(*keys, "t", F.coalesce("start", "before").alias("start"))


def anchored_windows(hits: DataFrame, window_s: int, limit: int, identity_col: str = "identity", ts_col: str = "ts") -> DataFrame:
    """Every window per identity: start, hit count, breach flag (> limit) and the first breaching hit.

    Hits without an identity or an instant are left out; equal hits all count."""
    width, keys = int(window_s) * 1_000_000, ["identity"]
    points = hits.select(F.col(identity_col).cast("string").alias("identity"), F.unix_micros(F.col(ts_col).cast("timestamp")).alias("t")) \
        .filter("identity IS NOT NULL AND t IS NOT NULL").groupBy(*keys, "t").agg(F.count(F.lit(1)).alias("n"))
    points = staged(points, "hits")
    starts = window_starts(points, keys, width)
    placed = points.join(in_windows(points, starts, keys, width), [*keys, "t"])
    so_far = F.sum("n").over(Window.partitionBy("identity", "start").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = placed.withColumn("so_far", so_far).groupBy("identity", "start").agg(
        F.sum("n").alias("n_hits"), F.min(F.when(F.col("so_far") > limit, F.col("t"))).alias("breach"))
    return out.select("identity", F.timestamp_micros("start").alias("window_start"), "n_hits", (F.col("n_hits") > limit).alias("breached"),
                      F.timestamp_micros("breach").alias("first_breach_at"))
