"""Event and request tables in batch form.

The streaming operators in :mod:`skyledger.streaming` apply the same
functions per micro-batch; here they run over whole tables of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import monthbits as mb
from skyledger.schemas import DATASET_TABLES

# Fixed values of the event contract.
TOPIC_NEED_INFO = "weather.need_info"
TOPIC_RAW_CREATED = {"actual": "weather.actual.raw.created", "forecast": "weather.forecast.raw.created"}
TOPIC_DM_READY = "weather.dm.ready"
TOPIC_FAILED = "weather.pipeline.failed"
INVALID_MANIFEST_REASON = "dm_trigger_invalid_event"
INVALID_MANIFEST_DETAILS = "missing trace_id/bucket/object_keys/date_from/date_to in %s event"
TRIGGER_STAGE = TRIGGER_SOURCE = "dm_trigger"
JOB_STAGE, JOB_SOURCE, JOB_REASON = "dm", "dm_pipeline", "dag_task_failed"
FAILURE_MESSAGE = "upstream failure (%s): %s — %s"
TIMEOUT_SECONDS = 600
TIMEOUT_MESSAGE = "timed out waiting for upstream data"
ERROR_TEXT_MAX = 1000            # of a job's exception text only


def topic_to_dataset(topic: Column) -> Column:
    """P10: raw-created topic -> dataset type (default ``actual``)."""
    return F.when(topic == F.lit(TOPIC_RAW_CREATED["forecast"]), F.lit("forecast")).otherwise(F.lit("actual"))


def _non_blank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def route_need_info(events: DataFrame, dataset: str) -> DataFrame:
    """Keep the events of one dataset type (null type drops by itself)."""
    return events.filter(F.col("dataset_type") == F.lit(dataset))


def valid_need_info(events: DataFrame) -> DataFrame:
    """Non-blank ``event_id``, non-empty station list, both dates, ``from <= to``.
    Text that is no date counts as missing."""
    d_from, d_to = F.col("date_from").try_cast("date"), F.col("date_to").try_cast("date")
    return events.filter(_non_blank(F.col("event_id")) & (F.coalesce(F.size("wmo_indexes"), F.lit(0)) > 0)
                         & d_from.isNotNull() & d_to.isNotNull() & (d_from <= d_to))


def split_manifests(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, failures)``. Valid when trace id, bucket, keys and both dates are
    present and non-empty; each invalid manifest yields one failure envelope (T7)."""
    ok = _non_blank(F.col("trace_id")) & _non_blank(F.col("bucket")) \
        & (F.coalesce(F.size("object_keys"), F.lit(0)) > 0) \
        & _non_blank(F.col("date_from")) & _non_blank(F.col("date_to"))
    flagged = events.withColumn("_ok", ok)
    valid = flagged.filter("_ok").drop("_ok")
    topic = F.col("topic") if "topic" in events.columns else F.lit("raw.created")
    failures = flagged.filter(~F.col("_ok")).select(
        F.coalesce(F.col("trace_id"), F.lit("")).alias("trace_id"),
        *[c for c in ("event_id", "created_at") if c in events.columns],
        *failure_envelope(F.lit(TRIGGER_STAGE), F.lit(TRIGGER_SOURCE), F.lit(INVALID_MANIFEST_REASON),
                          F.format_string(INVALID_MANIFEST_DETAILS, topic)))
    return valid, failures


def failure_envelope(stage: Column, source_name: Column, reason: Column, details: Column) -> list[Column]:
    """The one failure contract of every stage."""
    return [F.lit(TOPIC_FAILED).alias("event_type"), stage.alias("stage"), source_name.alias("source_name"),
            reason.alias("reason"), details.alias("details")]


def failure_message(stage: Column, reason: Column, details: Column) -> Column:
    """``upstream failure (<stage>): <reason> — <details>`` with the contract's defaults."""
    return F.format_string(FAILURE_MESSAGE, F.coalesce(stage, F.lit("?")),
                           F.coalesce(reason, F.lit("unknown")), F.coalesce(details, F.lit("")))


def resolve_waiters(outcomes: DataFrame, waiters: DataFrame) -> DataFrame:
    """Every outcome event fans out to all requests waiting on its ``trace_id``."""
    return outcomes.filter(_non_blank(F.col("trace_id"))).join(waiters, "trace_id", "inner")


def request_status_rollup(waiters: DataFrame, outcomes: DataFrame, timeout_s: int = TIMEOUT_SECONDS) -> DataFrame:
    """A11 + T4: request state from the pending traces and the outcome events, in time order.

    A request is touched when it is created and when a waited-on trace first succeeds. If two
    touches lie more than ``timeout_s`` apart while it is pending, it has timed out, and what
    succeeds later cannot revive it. ``failed`` if any waited-on trace failed (a failure
    overrides ready and a timeout) or it timed out; ``ready`` when no trace is left
    unresolved; otherwise ``pending``. The message is that of the latest failure by
    ``(created_at, event_id)``, else the timeout's; ``updated_at`` is the latest of the
    request's creation (``waiters.created_at`` when given) and its outcomes.

    The result depends on the instants of the events, not on their order of arrival. Partial
    aggregates keep a request with very many traces off one task: touches are reduced to the
    first and last of each stretch of ``timeout_s`` before gaps are looked for. Waiters and outcomes are joined
    once; counts, the latest failure and the touches go through the same two aggregations."""
    created = "created_at" in waiters.columns
    w = waiters.groupBy("request_id", "trace_id").agg(
        F.expr("min(created_at)" if created else "CAST(NULL AS TIMESTAMP)").alias("created_at"))
    o = outcomes.filter("trace_id IS NOT NULL AND trim(trace_id) <> ''")
    per_trace = o.groupBy("trace_id").agg(
        F.expr(f"min(CASE WHEN event_type = '{TOPIC_DM_READY}' THEN created_at END) AS _ready"),
        F.expr(f"count_if(event_type = '{TOPIC_DM_READY}') > 0 AS _is_ready"),
        F.expr(f"max(CASE WHEN event_type = '{TOPIC_FAILED}' THEN struct(created_at, event_id, stage, reason, details) END) AS _fail"),
        F.expr("max(created_at) AS _last"))
    joined = w.join(per_trace, "trace_id", "left")
    width = timeout_s * 1_000_000
    # one row per waited-on trace, and one more for its success if it is touched by both; counts go with the first
    touched = joined.selectExpr("request_id", f"""explode(array_compact(array(
        struct(CAST(created_at AS TIMESTAMP) AS at, 1L AS traces, CAST(NOT coalesce(_is_ready, false) AND _fail IS NULL AS BIGINT) AS open, _fail AS fail, greatest(_last, created_at) AS last),
        CASE WHEN _ready IS NOT NULL THEN struct(CAST(_ready AS TIMESTAMP) AS at, 0L AS traces, 0L AS open, NULL AS fail, NULL AS last) END))) AS x""")
    stretches = touched.selectExpr("request_id", "x.*", f"unix_micros(x.at) div {width} AS stretch").groupBy("request_id", "stretch").agg(
        F.expr("min(at) AS first"), F.expr("max(at) AS end"), F.expr("sum(traces) AS traces"), F.expr("sum(open) AS open"), F.expr("max(fail) AS fail"), F.expr("max(last) AS last"))
    before = F.lag("end").over(Window.partitionBy("request_id").orderBy(F.asc_nulls_first("stretch")))
    gap = F.expr(f"coalesce(unix_micros(first) - unix_micros(before) > {width}, false) AS gap")
    return stretches.withColumn("before", before).select("*", gap).groupBy("request_id").agg(
        F.expr("CAST(sum(traces) AS BIGINT) AS n_traces"), F.expr("CAST(sum(open) AS BIGINT) AS n_pending"),
        F.expr("max(fail) AS _fail"), F.expr("max(last) AS updated_at"), F.expr("max(gap) AS _gap")).select(
        "request_id", "n_traces", "n_pending",
        F.when(F.col("_fail").isNotNull(), failure_message(F.col("_fail.stage"), F.col("_fail.reason"), F.col("_fail.details")))
        .when(F.col("_gap"), F.lit(TIMEOUT_MESSAGE)).alias("error_message"),
        "updated_at",
        F.expr("CASE WHEN _fail IS NOT NULL OR _gap THEN 'failed' WHEN n_pending = 0 THEN 'ready' ELSE 'pending' END AS status"))


def request_timeouts(status: DataFrame, now: Column, timeout_s: int = TIMEOUT_SECONDS) -> DataFrame:
    """T4 batch / F8: pending requests whose last update is older than the timeout -> failed."""
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col("updated_at"))
    flagged = status.withColumn("_late", F.coalesce((F.col("status") == "pending") & (age > timeout_s), F.lit(False)))
    return flagged.withColumn("status", F.when(F.col("_late"), F.lit("failed")).otherwise(F.col("status"))) \
        .withColumn("error_message", F.when(F.col("_late"), F.lit(TIMEOUT_MESSAGE)).otherwise(F.col("error_message"))) \
        .drop("_late")


def request_lookup(status: DataFrame, asked: DataFrame) -> DataFrame:
    """One record per asked id; unknown ids carry ``error_code = NOT_FOUND``."""
    out = asked.select("request_id").distinct().join(status, "request_id", "left")
    return out.withColumn("error_code", F.when(F.col("status").isNull(), F.lit("NOT_FOUND")))


def pending_requests(status: DataFrame) -> DataFrame:
    """All pending requests."""
    return status.filter(F.col("status") == "pending")


def written_days(need_info: DataFrame, rows: DataFrame) -> DataFrame:
    """``event_id, days``: the days of each event's range on which one of its stations has a row of its dataset, in order.

    ``rows`` (``dataset_type, wmo_index, day``) become bits per station and month, which meet an event's stations
    by dataset and station, are cut by its range and ORed; neither side is expanded to days. Days of one event: its (capped) range."""
    present = rows.groupBy("dataset_type", "wmo_index", F.expr(f"{mb.month_of('day')} AS month_start")).agg(F.expr(f"bit_or({mb.bit_of('day')}) AS bits"))
    asked = need_info.select("event_id", "dataset_type", F.explode("wmo_indexes").alias("wmo_index"),
                             F.col("date_from").try_cast("date").alias("f"), F.col("date_to").try_cast("date").alias("t"))
    met = asked.join(present, ["dataset_type", "wmo_index"]).filter("month_start <= t AND last_day(month_start) >= f AND f <= t")
    months = met.groupBy("event_id", "month_start").agg(F.expr(f"bit_or(bits & {mb.range_bits('month_start', 'f', 't')}) AS bits")).filter("bits <> 0")
    return _lined_days(months)


def days_by_event(rows: DataFrame) -> DataFrame:
    """``event_id, days``: the days of each event's rows (``event_id, day``), in order."""
    return _lined_days(rows.groupBy("event_id", F.expr(f"{mb.month_of('day')} AS month_start")).agg(F.expr(f"bit_or({mb.bit_of('day')}) AS bits")))


def _lined_days(months: DataFrame) -> DataFrame:
    lined = months.groupBy("event_id").agg(F.sort_array(F.collect_list(F.struct("month_start", "bits"))).alias("months"))
    return lined.selectExpr("event_id", f"flatten(transform(months, m -> {mb.days_of('m.month_start', 'm.bits')})) AS days")


def build_manifests(need_info: DataFrame, written: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keys actually written for each need-info event become one
    ``raw.created`` manifest; an event with nothing written becomes a failure row.

    ``written``: ``event_id, days`` (ordered, without repeats; bounded by the event's capped range)."""
    topic = F.when(F.col("dataset_type") == "forecast", F.lit(TOPIC_RAW_CREATED["forecast"])) \
        .otherwise(F.lit(TOPIC_RAW_CREATED["actual"]))
    joined = need_info.join(written.filter(F.size("days") > 0), "event_id", "left")
    manifests = joined.filter(F.col("days").isNotNull()).select(
        "event_id", "trace_id", topic.alias("event_type"),
        F.transform("days", lambda day: object_key_of(F.col("dataset_type"), day)).alias("object_keys"), "date_from", "date_to", "dataset_type")
    empty = joined.filter(F.col("days").isNull()).select(
        "trace_id", *failure_envelope(F.lit("fetch"), F.lit("fetcher"), F.lit("nothing_written"),
                                      F.format_string("no documents written for event %s", F.col("event_id"))))
    return manifests, empty


def object_key_of(dataset: Column, day: Column) -> Column:
    """``<prefix>/date=<day>.json``."""
    prefix = F.when(dataset == "forecast", F.lit(DATASET_TABLES["forecast"]["prefix"])) \
        .otherwise(F.lit(DATASET_TABLES["actual"]["prefix"]))
    return F.format_string("%s/date=%s.json", prefix, F.date_format(day, "yyyy-MM-dd"))
