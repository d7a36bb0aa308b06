"""Manifest stream -> write path.

``raw.created`` events arrive on a topic (or as JSON-lines files). Each
micro-batch: parse with an explicit schema (garbage -> quarantine), split
valid/invalid manifests (P13), then ``foreachBatch`` drops redeliveries of a
``(dataset_type, event_id)`` that a durable table of finished runs has (T2),
runs the write path for every new manifest, writes one outcome event per
manifest (``dm.ready`` or ``pipeline.failed``) under ``<outcomes>/batch=<epoch>`` and
then the batch's ids to the table; invalid manifests land under ``<outcomes>/batch=invalid``.
No manifest is dropped for its time, however late it is.

The finished table lies by a prefix of the id's hash, with Bloom filters on the id: a batch reads
only the prefixes of its own ids. Every ``COMPACT_EVERY`` batches its partitions become one file each.

At-least-once (T10): the checkpoint commits a batch only after the function
returned. A batch that is tried again looks only at ids finished by earlier batches, so it runs the same manifests,
and its outcomes replace those that it left; rows that it re-appends, newest-wins reads collapse. Only
faults of the input (missing or unreadable documents, bad dates) become failure
events; any other error stops the batch, which is then tried again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import requests as rq
from skyledger.functions.timefmt import run_instant
from skyledger.plans.write_path import Manifest, append_staged, recompute_mart, stage_manifest
from skyledger.schemas import DATASETS, RAW_CREATED_EVENT
from skyledger.session import staged
from skyledger.sources.documents import BadDates, MissingDays
from skyledger.sources.events import parse_events
from skyledger.sources.paths import finish_rewrites, path_exists, remove_tree, rewrite_partitions

AT_ONCE = 8                      # manifests that land side by side
FINISHED_SCHEMA = "dataset_type string, event_id string, epoch long, prefix string"
PREFIX_DIGITS = 2                # hexadecimal: 256 partitions of finished ids
COMPACT_EVERY = 64               # batches
# Error classes of documents that are not there or not readable as documents.
INPUT_ERRORS = ("PATH_NOT_FOUND", "MALFORMED_RECORD_IN_PARSING", "FAILED_READ_FILE.FILE_NOT_EXIST")
OUTCOME_COLUMNS = ["event_id", "trace_id", "event_type", "dataset_type", "date_from", "date_to", "record_count",
                   "stage", "source_name", "reason", "details", "created_at"]
OUTCOME_SCHEMA = ("event_id string, trace_id string, event_type string, dataset_type string, date_from string, "
                  "date_to string, record_count long, stage string, source_name string, reason string, details string, created_at string")


def prefix_of(event_id: str) -> Column:
    return F.substring(F.sha2(F.col(event_id), 256), 1, PREFIX_DIGITS)


def finished_ids(spark: SparkSession, finished_path: str, prefixes: list[str], before_epoch: int) -> DataFrame:
    """The ids under some prefixes that batches before this one finished; only these partitions are read."""
    return spark.read.schema(FINISHED_SCHEMA).parquet(finished_path).filter(F.col("prefix").isin(prefixes) & (F.col("epoch") < before_epoch))


def new_manifests(batch: DataFrame, finished_path: str, epoch_id: int) -> DataFrame:
    """The manifests of a batch whose run is not finished yet, each ``(dataset_type, event_id)`` once.

    A manifest without an id gets a fresh one, so that two of them are two runs. ``batch`` is held (persisted or
    written) by the caller, so that fresh ids stay."""
    spark = batch.sparkSession
    named = batch.withColumn("prefix", prefix_of("event_id"))
    if path_exists(spark, finished_path):
        prefixes = [r.prefix for r in named.select("prefix").distinct().collect()]       # 256 at most
        done = finished_ids(spark, finished_path, prefixes, epoch_id).select("dataset_type", "event_id", "prefix")
        named = named.join(done, ["prefix", "dataset_type", "event_id"], "left_anti")
    return named.drop("prefix").dropDuplicates(["dataset_type", "event_id"])


def with_ids(manifests: DataFrame) -> DataFrame:
    return manifests.withColumn("event_id", F.expr("CASE WHEN trim(event_id) <> '' THEN event_id ELSE uuid() END"))


def mark_finished(manifests: DataFrame, finished_path: str, epoch_id: int) -> None:
    """Add a batch's ids, one file for each prefix it has; every ``COMPACT_EVERY`` batches the partitions become one file each."""
    rows = manifests.select("dataset_type", "event_id", F.lit(epoch_id).cast("long").alias("epoch"), prefix_of("event_id").alias("prefix"))
    rows.repartition("prefix").write.mode("append").option("parquet.bloom.filter.enabled#event_id", "true") \
        .option("parquet.bloom.filter.expected.ndv#event_id", "100000").partitionBy("prefix").parquet(finished_path)
    if epoch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
        compact_finished(manifests.sparkSession, finished_path)


def compact_finished(spark: SparkSession, finished_path: str) -> None:
    """One file per prefix; an id that several tries of a batch added is there once."""
    finish_rewrites(spark, finished_path, "prefix", ["event_id"])
    rows = spark.read.schema(FINISHED_SCHEMA).parquet(finished_path)
    once = rows.groupBy("prefix", "dataset_type", "event_id").agg(F.min("epoch").alias("epoch"))
    rewrite_partitions(spark, once.repartition("prefix"), finished_path, "prefix", ["event_id"])


def is_input_error(exc: BaseException) -> bool:
    """Faults of a manifest's documents and dates, by the classes of errors."""
    if isinstance(exc, (MissingDays, BadDates)):
        return True
    return isinstance(exc, PySparkException) and any(k in f"{exc.getCondition() or ''} {exc}" for k in INPUT_ERRORS)


def prepare_manifests(raw_values: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(valid, invalid_failures, quarantine)`` from raw topic values (``value``, ``topic``)."""
    parsed, quarantine = parse_events(raw_values, RAW_CREATED_EVENT)
    parsed = parsed.withColumn("dataset_type", rq.topic_to_dataset(F.col("topic")))
    valid, failures = rq.split_manifests(parsed)
    return valid, failures, quarantine


def _outcome_row(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(c) for c in OUTCOME_COLUMNS) for r in rows], OUTCOME_SCHEMA)


def process_manifest_batch(batch: DataFrame, epoch_id: int, *, raw_root: str, table_root: str,
                           outcome_path: str, layout: str = "document") -> None:
    """``foreachBatch`` body. Manifests are small control records; they come to the driver one
    partition at a time (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` bounds a batch), and each
    one's data work is distributed. Up to ``AT_ONCE`` of them land side by side; the mart is then
    recomputed once for all days they touched."""
    spark = batch.sparkSession
    finished_path, folder = f"{outcome_path.rstrip('/')}_finished", f"{outcome_path.rstrip('/')}/batch={epoch_id}"
    remove_tree(spark, folder)                                        # what an earlier try of this batch left
    held = staged(with_ids(batch).select(
        "dataset_type", "date_from", "date_to", "trace_id", "event_id", "bucket", "source_name", "created_at"), "manifests")
    fresh = staged(new_manifests(held, finished_path, epoch_id), "manifests")
    rows = fresh.toLocalIterator()
    while group := list(islice(rows, AT_ONCE)):
        manifests = [Manifest(m.dataset_type, m.date_from, m.date_to, m.trace_id, m.event_id, m.bucket,
                              m.source_name or "", m.created_at or "") for m in group]
        stamp = run_instant(spark)
        with ThreadPoolExecutor(AT_ONCE) as pool:
            staged_runs = list(pool.map(lambda m, stamp=stamp: _staged_run(spark, m, raw_root, layout, stamp), manifests))
        outcomes = [outcome for _, outcome in staged_runs]
        for dataset in DATASETS:                                       # one job at a time appends to a table
            if copies := [copy for copy, o in staged_runs if copy and o["dataset_type"] == dataset]:
                append_staged(spark, table_root, dataset, copies)
        landed = [(m.date_from, m.date_to) for m, o in zip(manifests, outcomes) if o["event_type"] == rq.TOPIC_DM_READY]
        recompute_mart(spark, table_root, landed, stamp)
        _outcome_row(spark, outcomes).coalesce(1).write.mode("append").json(folder)
    mark_finished(fresh, finished_path, epoch_id)


def _staged_run(spark: SparkSession, m: Manifest, raw_root: str, layout: str, stamp: Column) -> tuple[str | None, dict]:
    """The staged rows of one manifest, if it has any, and its outcome event."""
    try:
        copy, summary = stage_manifest(spark, raw_root, m, stamp, layout)
    except Exception as exc:  # noqa: BLE001 - only faults of the input become failure events
        if not is_input_error(exc):
            raise
        return None, {"event_id": f"failed-{m.dataset_type}-{m.event_id}", "trace_id": m.trace_id,
                      "event_type": rq.TOPIC_FAILED, "stage": rq.JOB_STAGE, "source_name": rq.JOB_SOURCE,
                      "reason": rq.JOB_REASON, "details": str(exc)[:rq.ERROR_TEXT_MAX], "created_at": m.created_at}
    return copy, {"event_id": f"ready-{m.dataset_type}-{m.event_id}", "trace_id": m.trace_id,
                  "event_type": rq.TOPIC_DM_READY, "dataset_type": m.dataset_type, "date_from": m.date_from,
                  "date_to": m.date_to, "record_count": summary["record_count"], "created_at": m.created_at}


def write_failures(failures: DataFrame, outcome_path: str, checkpoint: str, trigger: dict):
    """Invalid manifests -> ``pipeline.failed`` rows (streaming append), each with an id of its own."""
    out = failures.select(F.expr("concat('invalid-', CASE WHEN trim(event_id) <> '' THEN event_id ELSE uuid() END)").alias("event_id"),
                          "trace_id", "event_type", F.lit(None).cast("string").alias("dataset_type"),
                          F.lit(None).cast("string").alias("date_from"), F.lit(None).cast("string").alias("date_to"),
                          F.lit(None).cast("long").alias("record_count"), "stage", "source_name", "reason", "details",
                          F.coalesce("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("created_at"))
    # Own partition folder: a streaming file sink keeps a metadata log that would
    # hide files other writers add to the same folder.
    return out.writeStream.format("json").option("path", f"{outcome_path}/batch=invalid") \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()


def run_manifest_stream(spark: SparkSession, raw_values: DataFrame, *, raw_root: str, table_root: str,
                        outcome_path: str, checkpoint: str, layout: str = "document", available_now: bool = True):
    """Start the manifest stream; returns the running queries (main, failures, quarantine)."""
    valid, failures, quarantine = prepare_manifests(raw_values)
    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    main = valid.writeStream.foreachBatch(
        lambda df, eid: process_manifest_batch(df, eid, raw_root=raw_root, table_root=table_root,
                                               outcome_path=outcome_path, layout=layout)) \
        .option("checkpointLocation", f"{checkpoint}/manifests").trigger(**trigger).start()
    fail_q = write_failures(failures, outcome_path, f"{checkpoint}/failures", trigger)
    quarantine_q = quarantine.writeStream.format("json").option("path", f"{outcome_path}_quarantine") \
        .option("checkpointLocation", f"{checkpoint}/quarantine").trigger(**trigger).start()
    return main, fail_q, quarantine_q
