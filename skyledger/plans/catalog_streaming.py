"""Registered queries, part 3: the streaming paths run to completion over event
files that Spark derives from the driver tables (``availableNow``), then read
back. Each one equals its batch form, so the batch oracle SQL applies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators import requests as rq
from skyledger.plans import fixtures as fx
from skyledger.plans.catalog import ORACLE, register
from skyledger.plans.write_path import read_current_errors
from skyledger.schemas import ERROR_FIELDS
from skyledger.session import scratch_dir, staged
from skyledger.sources import documents as docs
from skyledger.sources import driver_tables as dt
from skyledger.sources.driver_tables import oracle_with
from skyledger.sources.events import read_events, to_event_values
from skyledger.streaming import manifests as sm
from skyledger.streaming import rate_limits as rl
from skyledger.streaming import request_state as rs


_TOPIC_FILES = 4                 # of a delivery, at most: each is a micro-batch, which reads a large one by many tasks


def _publish(df: DataFrame, root: str, topic: str, copies: int = 1) -> None:
    """Write event values as JSON lines under ``<root>/topic=<topic>/`` (a file-based topic);
    ``copies > 1`` redelivers every event."""
    values = to_event_values(df).coalesce(_TOPIC_FILES)
    for i in range(copies):
        values.write.mode("append").text(f"{root}/topic={topic}")


def _await(*queries) -> None:
    for q in queries:
        q.awaitTermination()


# -- T3/T4/T6/T10/T11: outcome stream -> request status ----------------------------------------

@register("stream_request_status", ORACLE["request_status"])
def q_stream_request_status(spark, sf):
    root = scratch_dir(spark, "outcomes")
    waiters, outcomes = fx.lineitem_requests(spark, sf)
    ready = outcomes.filter(F.col("event_type") == rq.TOPIC_DM_READY)
    failed = outcomes.filter(F.col("event_type") == rq.TOPIC_FAILED)
    _publish(ready, f"{root}/in", rq.TOPIC_DM_READY, copies=2)            # at-least-once delivery
    _publish(failed, f"{root}/in", rq.TOPIC_FAILED)
    spark.createDataFrame([("not json",), ('{"trace_id": ',), ('{"trace_id": "none", "created_at": "yesterday"}',), ("{}",)],
                          "value string") \
        .write.mode("append").text(f"{root}/in/topic={rq.TOPIC_FAILED}")     # poison messages
    raw = read_events(spark, "text", f"{root}/in", maxFilesPerTrigger=1)
    _await(*rs.land_outcomes(raw, f"{root}/log", f"{root}/ckpt"))
    log = rs.read_outcome_log(spark, f"{root}/log")
    return rs.request_status(waiters, log).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


# -- T1/T2/T9: manifest stream -> write path -> mart -------------------------------------------

def _side_documents(spark, sf, dataset):
    side = fx.current_side(spark, sf, dataset)
    return side.select(F.col("day").alias("date"), "wmo_index", F.lit(None).cast("string").alias("name"),
                       F.lit(None).cast("string").alias("country"), F.col("temp_min").alias("min_temp"),
                       F.col("temperature").alias("avg_temp"), F.col("temp_max").alias("max_temp"),
                       F.col("precipitation_mm").alias("precipitation"))


_MART_COLS = ["wmo_index", "day", *ERROR_FIELDS]


@register("stream_mart", oracle_with("err") + f"SELECT {', '.join(_MART_COLS)} FROM err")
def q_stream_mart(spark, sf):
    root = scratch_dir(spark, "mart")
    bounds = fx.weather_rows(spark, sf).agg(F.min("day").cast("string").alias("f"),
                                            F.max("day").cast("string").alias("t")).first()
    manifests = []
    for i, ds in enumerate(("forecast", "actual")):                 # forecast lands first
        docs.write_daily_documents(_side_documents(spark, sf, ds), f"{root}/raw", ds)
        manifests.append((f"ev-{ds}", f"tr-{ds}", "weather.raw.created", 1, f"2026-07-06T12:2{i}:00Z",
                          "fetcher", "weather-raw", [f"{ds}/date={bounds.f}"], bounds.f, bounds.t, ds))
    schema = ("event_id string, trace_id string, event_type string, schema_version int, created_at string, "
              "source_name string, bucket string, object_keys array<string>, date_from string, date_to string, "
              "ds string")
    ev = spark.createDataFrame(manifests, schema)
    for ds in ("actual", "forecast"):
        _publish(ev.filter(F.col("ds") == ds).drop("ds"), f"{root}/in", rq.TOPIC_RAW_CREATED[ds], copies=2)
    raw = read_events(spark, "text", f"{root}/in", maxFilesPerTrigger=1)   # one topic file per batch
    _await(*sm.run_manifest_stream(spark, raw, raw_root=f"{root}/raw", table_root=f"{root}/tables",
                                   outcome_path=f"{root}/outcomes", checkpoint=f"{root}/ckpt",
                                   layout="partitioned"))
    return read_current_errors(spark, f"{root}/tables").select(*_MART_COLS)


# -- T2: redelivered manifests are dropped --------------------------------------------------------

@register("stream_manifest_dedup", "WITH " + fx.ORACLE_ORDER_EVENTS.strip() + """
    , ok AS (SELECT CASE WHEN topic = 'weather.forecast.raw.created' THEN 'forecast' ELSE 'actual' END AS dataset_type,
                    trace_id, event_id FROM oe WHERE bucket IS NOT NULL AND n_ids > 0)
    SELECT dataset_type, trace_id FROM ok
    UNION ALL
    SELECT dataset_type, trace_id FROM ok WHERE trim(event_id) = ''""")
def q_stream_manifest_dedup(spark, sf):
    """Every manifest is delivered twice, in files whose event times go back and forth over years.
    One with an id runs once; one without gets a fresh id each time it is delivered."""
    root = scratch_dir(spark, "dedup")
    ev = fx.order_events(spark, sf)
    manifests = ev.select("event_id", "trace_id", F.lit("weather.raw.created").alias("event_type"),
                          F.lit(1).alias("schema_version"),
                          F.date_format(F.to_timestamp("date_from"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
                          "source_name", "bucket", F.col("wmo_indexes").alias("object_keys"), "date_from", "date_to",
                          "topic")
    for topic in rq.TOPIC_RAW_CREATED.values():
        _publish(manifests.filter(F.col("topic") == topic).drop("topic"), f"{root}/in", topic, copies=2)
    valid, _failures, _bad = sm.prepare_manifests(read_events(spark, "text", f"{root}/in", maxFilesPerTrigger=1))

    def batch(df, epoch_id):
        held = staged(sm.with_ids(df).select("dataset_type", "event_id", "trace_id"), "manifests")
        sm.new_manifests(held, f"{root}/finished", epoch_id).write.mode("overwrite").parquet(f"{root}/runs/batch={epoch_id}")
        sm.mark_finished(spark.read.parquet(f"{root}/runs/batch={epoch_id}"), f"{root}/finished", epoch_id)

    _await(valid.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    return spark.read.schema("dataset_type string, trace_id string").parquet(f"{root}/runs").select("dataset_type", "trace_id")


# -- T8/T10: the outcome events of batches that are tried again -------------------------------------

@register("stream_outcomes_replayed", oracle_with("cur").rstrip() + """
    , days AS (SELECT dataset_type, day, count(*) AS n FROM cur GROUP BY 1, 2)
    SELECT 'ready-' || dataset_type || '-ev-' || day AS event_id, 'tr-' || day AS trace_id, 'weather.dm.ready' AS event_type, dataset_type,
           CAST(day AS VARCHAR) AS date_from, CAST(day AS VARCHAR) AS date_to, CAST(n AS BIGINT) AS record_count, CAST(NULL AS VARCHAR) AS stage,
           CAST(NULL AS VARCHAR) AS reason, '2026-07-06T12:20:00Z' AS created_at
    FROM days WHERE dataset_type = 'actual' AND day IN (SELECT DISTINCT day FROM days ORDER BY day LIMIT 6)
    UNION ALL
    SELECT 'failed-actual-ev-none', 'tr-none', 'weather.pipeline.failed', NULL, NULL, NULL, NULL, 'dm', 'dag_task_failed', '2026-07-06T12:20:00Z'
    """)
def q_stream_outcomes_replayed(spark, sf):
    """One manifest per day (the first six days) and one for a day without a document, in two batches that are each run twice, the
    second one with redeliveries of the first: every column of the outcome events."""
    root = scratch_dir(spark, "replayed")
    side = _side_documents(spark, sf, "actual")
    docs.write_daily_documents(side, f"{root}/raw", "actual")
    days = [r.day for r in fx.weather_rows(spark, sf).select("day").distinct().orderBy("day").limit(6).collect()]
    rows = [("actual", str(d), str(d), f"tr-{d}", f"ev-{d}", "weather-raw", "fetcher", "2026-07-06T12:20:00Z") for d in days]
    rows.append(("actual", "1901-01-01", "1901-01-01", "tr-none", "ev-none", "weather-raw", "fetcher", "2026-07-06T12:20:00Z"))
    schema = "dataset_type string, date_from string, date_to string, trace_id string, event_id string, bucket string, source_name string, created_at string"
    for epoch, batch in enumerate((rows[:4], rows[2:])):
        for _ in range(2):
            sm.process_manifest_batch(spark.createDataFrame(batch, schema), epoch, raw_root=f"{root}/raw", table_root=f"{root}/tables",
                                      outcome_path=f"{root}/outcomes", layout="partitioned")
    out = spark.read.schema(sm.OUTCOME_SCHEMA).json(f"{root}/outcomes")
    return out.select("event_id", "trace_id", "event_type", "dataset_type", "date_from", "date_to", "record_count", "stage", "reason", "created_at")


# -- T5: one fetch per (dataset, station, day) within the lock lifetime ---------------------------

_LOCK_BATCHES, _LOCK_SECONDS = 3, 2_500

_LOCKS_SQL = "WITH RECURSIVE " + fx.ORACLE_ORDER_EVENTS.strip() + f"""
    , ok AS (SELECT *, CAST(substr(trace_id, 4) AS BIGINT) AS k FROM oe
             WHERE dataset_type IS NOT NULL AND trim(event_id) <> '' AND n_ids > 0 AND CAST(date_from AS DATE) <= CAST(date_to AS DATE)),
    cells AS (SELECT dataset_type, first_id AS wmo_index, CAST(d AS DATE) AS day, event_id, trace_id, k % {_LOCK_BATCHES} AS batch,
                     CASE WHEN k % 11 = 0 THEN NULL ELSE (k * 7919) % {_LOCK_SECONDS} END AS t
              FROM ok, generate_series(CAST(date_from AS TIMESTAMP), CAST(date_to AS TIMESTAMP), INTERVAL 1 DAY) x(d)),
    lined AS (SELECT *, row_number() OVER (PARTITION BY dataset_type, wmo_index, day ORDER BY batch, t NULLS FIRST, event_id, trace_id) AS rn FROM cells),
    -- cell after cell: a lock ends {600} s after its instant; one taken by a cell of no instant ends with the next instant
    fold AS (
        SELECT dataset_type, wmo_index, day, rn, trace_id, true AS acquired, trace_id AS owner, coalesce(t, -1000000) AS locked FROM lined WHERE rn = 1
        UNION ALL
        SELECT l.dataset_type, l.wmo_index, l.day, l.rn, l.trace_id, coalesce(l.t >= f.locked + 600, false),
               CASE WHEN coalesce(l.t >= f.locked + 600, false) THEN l.trace_id ELSE f.owner END,
               CASE WHEN coalesce(l.t >= f.locked + 600, false) THEN l.t ELSE f.locked END
        FROM fold f JOIN lined l ON l.dataset_type = f.dataset_type AND l.wmo_index = f.wmo_index AND l.day = f.day AND l.rn = f.rn + 1)
"""


def _lock_stream(spark, sf, by_day):
    """Need-info events derived from ``orders`` (the valid ones; ranges are under a year), delivered in three micro-batches
    whose instants overlap, so that cells come late and locks expire; every eleventh event has no instant."""
    root = scratch_dir(spark, "locks")
    ev = fx.order_events(spark, sf)
    k = "CAST(substr(trace_id, 4) AS BIGINT)"
    at = F.expr(f"CASE WHEN {k} % 11 <> 0 THEN date_format(timestampadd(SECOND, CAST(({k} * 7919) % {_LOCK_SECONDS} AS INT), "
                "TIMESTAMP '2026-07-06 12:20:00'), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END")
    ev = rq.valid_need_info(ev.filter(F.col("dataset_type").isNotNull())) \
        .select("event_id", "trace_id", "dataset_type", at.alias("created_at"), "date_from", "date_to", "wmo_indexes")
    for i in range(_LOCK_BATCHES):                                  # one delivery after another: a micro-batch takes all files of one
        ev.filter(F.expr(f"{k} % {_LOCK_BATCHES} = {i}")).write.mode("append").json(f"{root}/in")
        src = spark.readStream.schema(ev.schema).json(f"{root}/in")
        _await(rs.run_fetch_locks(rs.need_info_cells(src), lock_path=f"{root}/table", answer_path=f"{root}/out", checkpoint=f"{root}/ckpt"))
    return rs.read_answers(spark, f"{root}/out", by_day)


@register("stream_fetch_locks", _LOCKS_SQL + "SELECT dataset_type, wmo_index, day, trace_id FROM fold WHERE acquired")
def q_stream_fetch_locks(spark, sf):
    """The ``(dataset, station, day)`` cells to fetch: those that took their lock."""
    return _lock_stream(spark, sf, by_day=True).filter("acquired").select("dataset_type", "wmo_index", "day", "trace_id")


@register("stream_lock_owners", _LOCKS_SQL + """
    SELECT owner AS owner_trace_id, CAST(count(*) AS BIGINT) AS n_cells, CAST(count(*) FILTER (WHERE acquired) AS BIGINT) AS n_acquired,
           CAST(count(DISTINCT trace_id) AS BIGINT) AS n_waiting, min(day) AS first_day, max(day) AS last_day
    FROM fold GROUP BY owner""")
def q_stream_lock_owners(spark, sf):
    """What waits on each owner's trace: every asking cell is answered with one."""
    days = F.datediff("last_day", "first_day").cast("long") + 1
    return _lock_stream(spark, sf, by_day=False).groupBy("owner_trace_id").agg(
        F.sum(days).alias("n_cells"), F.sum(F.when(F.col("acquired"), days).otherwise(F.lit(0))).alias("n_acquired"),
        F.countDistinct("trace_id").alias("n_waiting"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


# -- T12 stream form: hits over the limit ---------------------------------------------------------

_HIT_LIMIT, _HIT_WINDOW = 2, 86_400           # of this query: two hits a day


@register("stream_rate_breaches", f"""
    WITH RECURSIVE
    h AS (SELECT CAST(user_id AS VARCHAR) AS identity, epoch_us(CAST(ts AS TIMESTAMP)) AS t FROM events),
    r AS (SELECT identity, t, row_number() OVER (PARTITION BY identity ORDER BY t) AS rn,
                 count(*) OVER (PARTITION BY identity) AS n FROM h),
    nx AS (SELECT a.identity, a.rn, min(b.rn) AS nrn
           FROM r a LEFT JOIN r b ON b.identity = a.identity AND b.t >= a.t + {_HIT_WINDOW * 1_000_000}
           GROUP BY a.identity, a.rn),
    starts(identity, rn) AS (
        SELECT identity, rn FROM r WHERE rn = 1
        UNION ALL
        SELECT s.identity, nx.nrn FROM starts s JOIN nx ON nx.identity = s.identity AND nx.rn = s.rn
        WHERE nx.nrn IS NOT NULL)
    SELECT r.identity, make_timestamp(w.t) AS window_start, make_timestamp(r.t) AS ts, CAST(r.rn - s.rn + 1 AS BIGINT) AS hit_no
    FROM starts s JOIN nx ON nx.identity = s.identity AND nx.rn = s.rn
    JOIN r w ON w.identity = s.identity AND w.rn = s.rn
    JOIN r ON r.identity = s.identity AND r.rn >= s.rn + {_HIT_LIMIT} AND r.rn < coalesce(nx.nrn, r.n + 1)""")
def q_stream_rate_breaches(spark, sf):
    """Hits in three micro-batches, one after another in time, each in any order."""
    root = scratch_dir(spark, "hits")
    hits = dt.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("identity"), F.col("ts").cast("timestamp").alias("ts"))
    third = F.ntile(3).over(Window.partitionBy(F.lit(0)).orderBy("day"))
    days = hits.select(F.to_date("ts").alias("day")).distinct().withColumn("part", third)       # one row per day
    days = staged(days, "hit-days")
    for i in (1, 2, 3):                                             # one delivery after another: a micro-batch takes all files of one
        now = F.broadcast(days.filter(F.col("part") == i).select("day"))
        hits.withColumn("day", F.to_date("ts")).join(now, "day", "left_semi").drop("day").write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(hits.schema).parquet(f"{root}/in")
        _await(rl.write_breaches(rl.rate_breaches_stream(src, _HIT_LIMIT, _HIT_WINDOW), f"{root}/out", f"{root}/ckpt"))
    out = spark.read.schema(rl.OUTPUT_SCHEMA).parquet(f"{root}/out")
    return out.select("identity", F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("ts").cast("timestamp_ntz").alias("ts"), "hit_no")


# -- D6: the write path without the stream, actual landing first ------------------------------------

@register("order_independence", oracle_with("err") + f"SELECT {', '.join(_MART_COLS)} FROM err")
def q_order_independence(spark, sf):
    """Manifests run directly through the write path with the actual side first (the
    stream query lands the forecast first); both give the same mart."""
    from skyledger.plans.write_path import Manifest, run_manifest
    root = scratch_dir(spark, "order")
    bounds = fx.weather_rows(spark, sf).agg(F.min("day").cast("string").alias("f"),
                                            F.max("day").cast("string").alias("t")).first()
    for ds in ("actual", "forecast"):
        docs.write_daily_documents(_side_documents(spark, sf, ds), f"{root}/raw", ds)
        run_manifest(spark, f"{root}/raw", f"{root}/tables",
                     Manifest(ds, bounds.f, bounds.t, f"tr-{ds}", f"ev-{ds}", "weather-raw", "fetcher",
                              "2026-07-06T12:20:00Z"), layout="partitioned")
    return read_current_errors(spark, f"{root}/tables").select(*_MART_COLS)
