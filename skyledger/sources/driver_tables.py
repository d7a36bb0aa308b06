"""Adapter: weather-shaped inputs derived from the driver's generic tables.

The driver's tables carry no weather, so both sides of the pipeline are
derived from ``events`` and the station dimension from ``customer`` x
``nation`` (x ``region`` for names). Every derived frame is a lazy plan over
the parquet scan, so filters and projections still reach the files.

Mapping (fixed; the DuckDB oracle mirrors it column for column):

* dataset_type    even ``event_id`` -> actual, odd -> forecast
* wmo_index       ``user_id`` as string;  day = date of ``ts``
* temperature     null for ``event_type = 'error'``, else ``value``
* temp_min/max    temperature -/+ k/10 with k = ``$.k`` of ``props``
* precipitation   null when ``event_id`` is a multiple of 7, else k/100
* ingested_at     ``ts`` (version);  seq = ``event_id`` (tie-break)
* trace_id        ``<dataset_type>-<event_id>``
* station         ``c_custkey`` -> id, ``c_name`` -> name, region of the nation,
                  lat = nation key, lng = balance/100 (unknown when negative)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy scan of one driver table. The handle (plan + file listing, no data)
    is kept on the session, so repeated queries skip re-listing files and
    re-reading parquet footers; the tables are read-only."""
    handles = getattr(spark, "_skyledger_tables", None)
    if handles is None:
        handles = {}
        setattr(spark, "_skyledger_tables", handles)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in handles:
        handles[path] = spark.read.parquet(path)
    return handles[path]


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All DM-shaped rows of both datasets (before newest-version selection)."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    dataset = F.when(F.col("event_id") % 2 == 0, F.lit("actual")).otherwise(F.lit("forecast"))
    temperature = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value"))
    return ev.select(
        dataset.alias("dataset_type"),
        F.col("user_id").cast("string").alias("wmo_index"),
        F.col("ts").cast("date").alias("day"),
        temperature.alias("temperature"),
        (temperature - k / 10).alias("temp_min"),
        (temperature + k / 10).alias("temp_max"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double")).otherwise(k / 100).alias("precipitation_mm"),
        F.concat(dataset, F.lit("-"), F.col("event_id").cast("string")).alias("trace_id"),
        F.col("ts").alias("ingested_at"),
        F.col("event_id").alias("seq"),
    )


def dm_side(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """DM rows of one dataset, all versions (the appended table)."""
    rows = weather_rows(spark, sf_dir)
    return rows.filter(F.col("dataset_type") == dataset).drop("dataset_type")


def station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``station`` schema: wmo_index, name, region_id, lat, lng."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
    return joined.select(
        F.col("c_custkey").cast("string").alias("wmo_index"),
        F.col("c_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("region_id"),
        F.col("c_nationkey").cast("double").alias("lat"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 100).alias("lng"),
    )


def region_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, name`` region dictionary."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"))


# SQL text of the same mapping for the DuckDB oracle (kept next to the Spark
# form so the two cannot drift apart).
ORACLE_VIEWS = {
    "wx": """
        SELECT CASE WHEN event_id % 2 = 0 THEN 'actual' ELSE 'forecast' END AS dataset_type,
               CAST(user_id AS VARCHAR) AS wmo_index,
               CAST(ts AS DATE) AS day,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS temperature,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END
                   - CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS temp_min,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END
                   + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS temp_max,
               CASE WHEN event_id % 7 = 0 THEN NULL
                    ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 END AS precipitation_mm,
               (CASE WHEN event_id % 2 = 0 THEN 'actual' ELSE 'forecast' END) || '-' || CAST(event_id AS VARCHAR) AS trace_id,
               ts AS ingested_at,
               event_id AS seq
        FROM events""",
    "cur": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY dataset_type, wmo_index, day
                                         ORDER BY ingested_at DESC, seq DESC) AS rn
            FROM wx) WHERE rn = 1""",
    "err": """
        SELECT w.wmo_index, w.day,
               f.temperature - w.temperature AS temperature_error,
               abs(f.temperature - w.temperature) AS temperature_abs_error,
               f.temp_min - w.temp_min AS temp_min_error,
               abs(f.temp_min - w.temp_min) AS temp_min_abs_error,
               f.temp_max - w.temp_max AS temp_max_error,
               abs(f.temp_max - w.temp_max) AS temp_max_abs_error,
               f.precipitation_mm - w.precipitation_mm AS precipitation_mm_error,
               abs(f.precipitation_mm - w.precipitation_mm) AS precipitation_mm_abs_error,
               w.trace_id AS actual_trace_id, f.trace_id AS forecast_trace_id,
               greatest(w.ingested_at, f.ingested_at) AS ingested_at
        FROM (SELECT * FROM cur WHERE dataset_type = 'actual') w
        JOIN (SELECT * FROM cur WHERE dataset_type = 'forecast') f
          ON w.wmo_index = f.wmo_index AND w.day = f.day""",
    "station": """
        SELECT CAST(c_custkey AS VARCHAR) AS wmo_index, c_name AS name,
               CAST(n_regionkey AS VARCHAR) AS region_id,
               CAST(c_nationkey AS DOUBLE) AS lat,
               CASE WHEN c_acctbal >= 0 THEN c_acctbal / 100 END AS lng
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
}


def oracle_with(*views: str) -> str:
    """``WITH`` prefix defining the named adapter views (dependencies included)."""
    order = ["wx", "cur", "err", "station"]
    needed = set(views)
    if "err" in needed:
        needed |= {"cur"}
    if "cur" in needed:
        needed |= {"wx"}
    parts = [f"{name} AS ({ORACLE_VIEWS[name]})" for name in order if name in needed]
    return "WITH " + ",\n".join(parts) + "\n"
