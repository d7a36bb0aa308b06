"""Request state from event streams.

State is an append-only log of outcome events on shared storage, and a
request's status is a fold over it (A11 + T4): failure wins over everything, a
timeout over later successes, and ``ready`` needs every waited-on trace
resolved. The fold goes by the instants of the events, so duplicates, replays and
the order of arrival change nothing; the stream only has to land parsed events,
no per-request mutable state is kept in memory, a hot request is reduced by
partial aggregates like any other, and a lost executor only replays a batch.

T5 (suppress duplicate fetches) keeps one lock per ``(dataset, station, day)``
with the trace that owns it. Neither events, locks nor answers are held by the day: a row is a stretch of days,
cut only where another event or lock of its station begins or ends, so that stretches of a station are equal
or have no day in common, and what holds for one holds for each of its days. Stretches lie within blocks of ``BLOCK``
days, whose bounds are bits of one number. A batch's stretches are joined with the lock table, its own locks
are the starts of windows anchored at the first open cell, and owners come by a join; no
Python runs per cell. No cell is dropped for being late: each one either
takes the lock or is answered with its owner, whose trace the new request waits on.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.timefmt import iso_instant_to_ts
from skyledger.operators import requests as rq
from skyledger.operators.anchored_windows import in_windows, window_starts
from skyledger.operators.current import current
from skyledger.schemas import ANY_EVENT
from skyledger.session import scratch_dir, staged
from skyledger.sources.events import parse_events
from skyledger.sources.paths import child_names, path_exists, remove_tree

LOCK_TTL_SECONDS = 600
SNAPSHOT_EVERY = 16              # every so many batches the whole lock table is written, not only what the batch touched
ROUNDS = 4                       # locks after one another that a batch settles one by one
BLOCK = 64                       # days: a bit each
BLOCK_KEYS = ["dataset_type", "wmo_index", "block"]
LOCK_KEYS = ["dataset_type", "wmo_index", "first_day", "last_day"]           # equal or without a common day
LOCK_TABLE = "dataset_type string, wmo_index string, first_day date, last_day date, owner string, locked long, seen timestamp, epoch long"
LOCK_OUTPUT = ("dataset_type string, wmo_index string, first_day date, last_day date, event_id string, trace_id string, created_ts timestamp, "
               "acquired boolean, owner_trace_id string")


def land_outcomes(raw_values: DataFrame, log_path: str, checkpoint: str, available_now: bool = True):
    """T3 input: parse ``dm.ready`` / ``pipeline.failed`` values and append them to the outcome log.

    Unparsable values go to ``<log>_quarantine`` (T11) instead of stopping the stream; an event
    whose ``created_at`` is no instant lands without one and still resolves its trace."""
    parsed, quarantine = parse_events(raw_values, ANY_EVENT)
    events = parsed.withColumn("created_at", iso_instant_to_ts(F.col("created_at"))) \
        .withColumn("event_type", F.coalesce(F.col("event_type"), F.col("topic"))) \
        .select("event_id", "trace_id", "event_type", "created_at", "stage", "reason", "details")
    trig = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    main = events.writeStream.format("parquet").option("path", log_path) \
        .option("checkpointLocation", f"{checkpoint}/outcomes").trigger(**trig).start()
    bad = quarantine.writeStream.format("json").option("path", f"{log_path}_quarantine") \
        .option("checkpointLocation", f"{checkpoint}/quarantine").trigger(**trig).start()
    return main, bad


def request_status(waiters: DataFrame, outcome_log: DataFrame, now: Column | None = None,
                   timeout_s: int = rq.TIMEOUT_SECONDS) -> DataFrame:
    """T3 + T4: status of every request from its waited-on traces and the outcome log.

    With ``now`` the timeout sweep is applied to what is still pending (idle longer than the
    timeout -> failed)."""
    status = rq.request_status_rollup(waiters, outcome_log, timeout_s)
    return rq.request_timeouts(status, now, timeout_s) if now is not None else status


def waiter_rows(requests: DataFrame) -> DataFrame:
    """Requests with their pending trace list -> one ``(trace_id, request_id)`` row each."""
    return requests.select("request_id", F.explode("pending_trace_ids").alias("trace_id")).distinct()


def by_block(ranges: DataFrame) -> DataFrame:
    """``first_day, last_day`` cut at the bounds of blocks: ``block`` and the places ``low`` to ``high`` in it."""
    number = lambda c: F.unix_date(F.col(c))
    first, last = (F.floor(number(c) / BLOCK).cast("int") for c in ("first_day", "last_day"))
    blocks = ranges.filter("first_day <= last_day").withColumn("block", F.explode(F.sequence(first, last)))
    place = lambda c, edge: F.when(F.floor(number(c) / BLOCK) == F.col("block"), F.pmod(number(c), F.lit(BLOCK))).otherwise(F.lit(edge)).cast("int")
    return blocks.withColumn("low", place("first_day", 0)).withColumn("high", place("last_day", BLOCK - 1)).drop("first_day", "last_day")


def bounds_of(*blocked: DataFrame) -> DataFrame:
    """By station and block the places where something begins, or begins to lack, as bits."""
    bits = F.expr(f"shiftleft(1L, low) | CASE WHEN high < {BLOCK - 1} THEN shiftleft(1L, high + 1) ELSE 0L END")
    every = [b.select(*BLOCK_KEYS, bits.alias("bits")) for b in blocked]
    rows = every[0]
    for more in every[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*BLOCK_KEYS).agg(F.bit_or("bits").alias("bounds"))


def in_pieces(blocked: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows cut at all bounds of their block: ``first_day, last_day`` of a station are then equal or have no day in common."""
    cut = blocked.join(bounds, BLOCK_KEYS).withColumn("starts", F.expr("filter(sequence(low, high), i -> getbit(bounds, i) = 1)"))
    piece = F.expr("explode(transform(starts, (x, i) -> struct(x AS low, coalesce(get(starts, i + 1) - 1, high) AS high)))")
    day = lambda at: F.expr(f"date_from_unix_date(block * {BLOCK} + {at})")
    kept = [c for c in blocked.columns if c not in ("block", "low", "high")]
    return cut.select(*kept, "block", piece.alias("piece")).select(*kept, day("piece.low").alias("first_day"), day("piece.high").alias("last_day"))


def answer_cells(cells: DataFrame, locks: DataFrame, ttl_s: int = LOCK_TTL_SECONDS, under: str | None = None) -> tuple[DataFrame, DataFrame]:
    """T5 for a batch: ``(answers, taken)``, every cell with its owner and the locks that cells of the batch took.

    A cell within ``ttl_s`` seconds of its key's lock, stamped before it or without an instant is answered with the
    lock's owner. Of the others the first, by ``(created_ts, event_id, trace_id)``, takes the lock, and the rest of its
    ``ttl_s`` seconds wait on its trace; what comes later does the same among itself. After ``ROUNDS`` such rounds, of
    which each is one aggregation and one join, longer chains are found as anchored windows all at once. Without a lock,
    cells of no instant come first. ``locks``: ``owner, locked`` (microseconds) by key, as they were before the batch.
    Stretches of days of both sides are equal or have no day in common (:func:`in_pieces`). ``under``: see :func:`staged`."""
    ttl = ttl_s * 1_000_000
    named = cells.withColumn("t", F.unix_micros("created_ts")).withColumn("cell", F.monotonically_increasing_id())
    held = staged(named.join(locks.select(*LOCK_KEYS, "owner", "locked"), LOCK_KEYS, "left"), "cells", under)
    free = F.expr(f"owner IS NULL OR coalesce(t >= locked + {ttl}, false)")
    columns = [*LOCK_KEYS, "event_id", "trace_id", "created_ts"]
    answers = held.filter(~free).select(*columns, F.lit(False).alias("acquired"), F.col("owner").alias("owner_trace_id"))
    rest, taken = held.filter(free).drop("owner", "locked").withColumn("t", F.coalesce("t", F.lit(0))), None
    own = rest.columns
    for last in [*[False] * ROUNDS, True]:
        if last:
            points = rest.select(*LOCK_KEYS, "t").distinct()
            rest = rest.join(in_windows(points, window_starts(points, LOCK_KEYS, ttl, under), LOCK_KEYS, ttl), [*LOCK_KEYS, "t"])
        by = [*LOCK_KEYS, "start"] if last else LOCK_KEYS
        first = rest.groupBy(*by).agg(F.min(F.struct("t", "event_id", "trace_id", "cell")).alias("first"))
        joined = staged(rest.join(first, by).select(*own, "first"), "locks", under)
        now = joined.filter(F.col("t") < F.col("first.t") + ttl)
        answers = answers.unionByName(now.select(*columns, (F.col("cell") == F.col("first.cell")).alias("acquired"), F.col("first.trace_id").alias("owner_trace_id")))
        fresh = now.filter(F.col("cell") == F.col("first.cell")).select(*LOCK_KEYS, F.col("t").alias("locked"), F.col("trace_id").alias("owner"))
        taken = fresh if taken is None else taken.unionByName(fresh)
        rest = joined.filter(F.col("t") >= F.col("first.t") + ttl).select(*own)
        if last or rest.isEmpty():
            break
    return answers, taken


def stored_locks(spark: SparkSession, path: str, before_epoch: int) -> DataFrame:
    """What batches before this one wrote of locks: the last full table and what the batches after it touched."""
    first = max(before_epoch - 1, 0) // SNAPSHOT_EVERY * SNAPSHOT_EVERY
    folders = [f for e in range(first, before_epoch) if path_exists(spark, f := f"{path.rstrip('/')}/epoch={e}")]
    return spark.read.schema(LOCK_TABLE).parquet(*folders) if folders else spark.createDataFrame([], LOCK_TABLE)


def newest_locks(rows: DataFrame, now: Column, ttl_s: int = LOCK_TTL_SECONDS) -> DataFrame:
    """The newest lock of every key. A lock is forgotten after ``ttl_s`` seconds of processing time without a cell: a late
    cell then is fetched again, never lost."""
    return current(rows, LOCK_KEYS, "epoch").filter(F.col("seen") > now - F.make_dt_interval(secs=F.lit(ttl_s)))


def process_lock_batch(batch: DataFrame, epoch_id: int, *, lock_path: str, answer_path: str, ttl_s: int = LOCK_TTL_SECONDS,
                       now: Column | None = None) -> None:
    """``foreachBatch`` body. Answers and locks of a batch have folders of their own, so a batch that is tried again
    replaces what it left, and it looks only at the locks of the batches before it. ``batch``: ``first_day, last_day``, or a
    ``day`` for both. What the batch stages goes when it is done."""
    spark = batch.sparkSession
    now = F.lit(datetime.now(timezone.utc)) if now is None else now            # one instant for the batch
    under = scratch_dir(spark, "lock batch")
    if "day" in batch.columns:
        batch = batch.withColumn("first_day", F.col("day")).withColumn("last_day", F.col("day"))
    asked = staged(by_block(batch.select(*LOCK_KEYS, "event_id", "trace_id", "created_ts")), "batch", under)
    stored = by_block(stored_locks(spark, lock_path, epoch_id))
    bounds = staged(bounds_of(asked, stored), "bounds", under)
    cells = staged(in_pieces(asked, bounds), "pieces", under)
    locks = staged(newest_locks(in_pieces(stored, bounds), now, ttl_s), "lock-pieces", under)
    answers, taken = answer_cells(cells, locks, ttl_s, under)
    answers.write.mode("overwrite").parquet(f"{answer_path.rstrip('/')}/epoch={epoch_id}")
    touched = cells.select(*LOCK_KEYS).distinct().withColumn("seen", now)
    prior = locks.select(*LOCK_KEYS, "owner", "locked", F.col("seen").alias("last_seen"))
    held = prior.join(touched, LOCK_KEYS, "left")
    if epoch_id % SNAPSHOT_EVERY:
        held = held.filter("seen IS NOT NULL")
    kept = held.select(*LOCK_KEYS, "owner", "locked", F.coalesce("seen", "last_seen").alias("seen"))
    every = kept.unionByName(taken.withColumn("seen", now))
    newest = every.groupBy(*LOCK_KEYS).agg(F.max(F.struct("locked", "owner", "seen")).alias("lock"))
    newest.select(*LOCK_KEYS, "lock.owner", "lock.locked", "lock.seen", F.lit(epoch_id).cast("long").alias("epoch")) \
        .write.mode("overwrite").parquet(f"{lock_path.rstrip('/')}/epoch={epoch_id}")
    for old in _outdated(spark, lock_path, epoch_id):
        remove_tree(spark, old)
    remove_tree(spark, under)


def _outdated(spark: SparkSession, lock_path: str, epoch_id: int) -> list[str]:
    """Folders before the full table that a repeated run of this batch would begin at."""
    first = max(epoch_id - 1, 0) // SNAPSHOT_EVERY * SNAPSHOT_EVERY
    names = [n for n in child_names(spark, lock_path) if n.startswith("epoch=")]
    return [f"{lock_path.rstrip('/')}/{n}" for n in names if int(n.split("=")[1]) < first]


def run_fetch_locks(cells: DataFrame, *, lock_path: str, answer_path: str, checkpoint: str, ttl_s: int = LOCK_TTL_SECONDS,
                    available_now: bool = True):
    """T5: start the stream that answers need-info cells; returns the running query."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    return cells.writeStream.foreachBatch(
        lambda df, epoch: process_lock_batch(df, epoch, lock_path=lock_path, answer_path=answer_path, ttl_s=ttl_s)) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_answers(spark: SparkSession, answer_path: str, by_day: bool = True) -> DataFrame:
    """T5: every need-info cell with ``acquired`` and the trace that owns its lock; those that acquired are fetched.
    Without ``by_day`` the cells stay in their stretches (``first_day, last_day``), as they are written."""
    rows = spark.read.schema(LOCK_OUTPUT).parquet(answer_path).drop("epoch")
    if not by_day:
        return rows
    return rows.select("dataset_type", "wmo_index", F.explode(F.sequence("first_day", "last_day")).alias("day"),
                       "event_id", "trace_id", "created_ts", "acquired", "owner_trace_id")


def need_info_cells(need_info: DataFrame) -> DataFrame:
    """Need-info events as ``(dataset_type, wmo_index)`` cells of the days ``first_day`` to ``last_day`` (range capped upstream).
    Events whose dates are no dates, or in the wrong order, have no cells (P12 reports them); neither have nulls in a station list."""
    d_from, d_to = F.col("date_from").try_cast("date"), F.col("date_to").try_cast("date")
    return need_info.select(
        "event_id", "trace_id", "dataset_type", iso_instant_to_ts(F.col("created_at")).alias("created_ts"),
        F.explode("wmo_indexes").alias("wmo_index"), d_from.alias("first_day"), d_to.alias("last_day")) \
        .filter("first_day <= last_day AND dataset_type IS NOT NULL AND wmo_index IS NOT NULL")


def read_outcome_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema("event_id string, trace_id string, event_type string, created_at timestamp, "
                             "stage string, reason string, details string").parquet(log_path)
