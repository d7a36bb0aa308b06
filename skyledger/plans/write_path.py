"""The write path: one manifest (dataset, day range, lineage) -> RAW, ODS, DM -> error mart.

Storage is a folder of parquet tables (``<root>/<table>/month=yyyyMM/``).
The JSON scan and the layout shuffle run once: the run's rows are staged in the shared
scratch folder, counted as they are written, and RAW, ODS and DM are appended from that copy as it
lies (no further shuffle); then the copy goes. The mart is then recomputed for the touched days from the newest DM rows of both datasets, in
one aggregation over their union; arrival order of actual and forecast does
not matter and re-running a manifest leaves the newest-wins reads unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.timefmt import iso_instant_to_ts, run_instant
from skyledger.operators import layers as ly
from skyledger.operators.current import current
from skyledger.schemas import DATASET_TABLES, DATASETS, DM, ERROR, ERROR_TABLE, RAW
from skyledger.sources import documents as docs
from skyledger.sources import tables as tb
from skyledger.session import scratch_dir
from skyledger.sources.paths import path_exists, remove_tree

DM_KEYS = ["wmo_index", "day"]


@dataclass(frozen=True)
class Manifest:
    dataset_type: str
    date_from: str
    date_to: str
    trace_id: str
    event_id: str
    bucket: str
    source_name: str
    created_at: str


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_current_dm(spark: SparkSession, root: str, dataset: str, date_from: str | None = None,
                    date_to: str | None = None) -> DataFrame:
    """The ``*_current`` read of a DM table (W1 on ``(wmo_index, day)``)."""
    df = tb.read_table(spark, table_path(root, DATASET_TABLES[dataset]["dm"]), date_from, date_to, schema=DM)
    return current(df.drop("month"), DM_KEYS, "ingested_at", "trace_id")


def read_current_errors(spark: SparkSession, root: str, date_from: str | None = None,
                        date_to: str | None = None) -> DataFrame:
    """The current error mart (newest recomputation per key wins)."""
    path = table_path(root, ERROR_TABLE)
    if not path_exists(spark, path):
        return spark.createDataFrame([], ERROR)
    df = tb.read_table(spark, path, date_from, date_to, schema=ERROR)
    return current(df.drop("month"), DM_KEYS, "ingested_at", "forecast_trace_id")


def recompute_errors(spark: SparkSession, root: str, date_from: str, date_to: str,
                     ingested_at: Column) -> DataFrame:
    """Mart rows for the touched days, from the newest rows of both DM tables."""
    sides = []
    for ds in DATASETS:
        path = table_path(root, DATASET_TABLES[ds]["dm"])
        if not path_exists(spark, path):
            return spark.createDataFrame([], ERROR)          # the other side has not landed yet
        sides.append(tb.read_table(spark, path, date_from, date_to, schema=DM).drop("month")
                     .withColumn("dataset_type", F.lit(ds)))
    both = sides[0].unionByName(sides[1])
    # Version: ingested_at, ties broken by trace id (later runs carry later stamps).
    pairs = ly.current_pairs(both, DM_KEYS, version="ingested_at", tie="trace_id")
    return ly.forecast_error(pairs, ingested_at=ingested_at)


def stage_manifest(spark: SparkSession, raw_root: str, m: Manifest, stamp: Column, layout: str = "document") -> tuple[str, dict]:
    """S1..S4 -> P1 -> S12 for one manifest: its RAW rows in the table's layout, in a folder of the shared scratch
    space, and what the run reports. Manifests are staged side by side; tables are appended to by one job at a time."""
    stations = docs.explode_stations(docs.scan_daily_documents(spark, raw_root, m.dataset_type, m.date_from,
                                                               m.date_to, layout=layout))
    raw = ly.to_raw(stations, source_name=m.source_name, bucket=m.bucket, event_id=m.event_id,
                    trace_id=m.trace_id, event_created_at=iso_instant_to_ts(F.lit(m.created_at)),
                    ingested_at=stamp)
    rows, copy = Observation(), scratch_dir(spark, "run")
    observe_run(tb.layout(raw, "observation_date").drop("month"), rows, "observation_date").write.parquet(copy)
    return copy, run_summary(rows, m.dataset_type, m.date_from, m.date_to)


def append_staged(spark: SparkSession, table_root: str, dataset: str, copies: list[str]) -> None:
    """RAW -> P2 -> ODS -> P3 -> DM for one or more staged runs of a dataset, as their rows lie; the copies go last."""
    names = DATASET_TABLES[dataset]
    written = spark.read.schema(RAW).parquet(*copies)
    tb.append_as_laid(written, table_path(table_root, names["raw"]), day_col="observation_date")
    ods = ly.to_ods(written)
    tb.append_as_laid(ods, table_path(table_root, names["ods"]), day_col="observation_date")
    tb.append_as_laid(ly.to_dm(ods), table_path(table_root, names["dm"]))
    for copy in copies:
        remove_tree(spark, copy)


def recompute_mart(spark: SparkSession, table_root: str, ranges: list[tuple[str, str]], stamp: Column) -> None:
    """D6 for the touched days of one or more manifests (overlapping ranges once)."""
    merged: list[list[str]] = []
    for first, last in sorted(ranges):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    for first, last in merged:
        tb.append_layer(recompute_errors(spark, table_root, first, last, stamp), table_path(table_root, ERROR_TABLE))


def run_manifest(spark: SparkSession, raw_root: str, table_root: str, m: Manifest,
                 layout: str = "document") -> dict:
    """T1 body for one manifest: land its rows, recompute its days of the mart, return the summary."""
    stamp = run_instant(spark)                                    # F9: one literal per run
    copy, summary = stage_manifest(spark, raw_root, m, stamp, layout)
    append_staged(spark, table_root, m.dataset_type, [copy])
    recompute_mart(spark, table_root, [(m.date_from, m.date_to)], stamp)
    return summary


def observe_run(df: DataFrame, rows: Observation, day_col: str = "day") -> DataFrame:
    """Count a run's rows, and their days, in the job that writes them. Observe last: a range shuffle below would
    run what lies under it twice, once for its sample."""
    return df.observe(rows, F.count(F.lit(1)).alias("record_count"), F.min(day_col).alias("first_day"), F.max(day_col).alias("last_day"))


def run_summary(rows: Observation, dataset: str, date_from: str, date_to: str) -> dict:
    """What a run reports, from the rows observed while they were written; no further scan."""
    seen = rows.get
    return {"dataset_type": dataset, "record_count": seen["record_count"], "date_from": date_from, "date_to": date_to,
            "first_day": seen["first_day"], "last_day": seen["last_day"]}
