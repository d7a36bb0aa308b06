"""Registered queries, part 2: layers, documents, payloads, acceptance path,
dimension, request state, manifests and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions.timefmt import iso_instant_to_ts
from skyledger.operators import checks as qc
from skyledger.operators import current as cur
from skyledger.operators import dimension as dim
from skyledger.operators import layers as ly
from skyledger.operators import metrics as mx
from skyledger.operators import requests as rq
from skyledger.plans import fixtures as fx
from skyledger.plans.catalog import register
from skyledger.schemas import DATASETS
from skyledger.session import scratch_dir
from skyledger.sources import documents as docs
from skyledger.sources import driver_tables as dt
from skyledger.sources.driver_tables import oracle_with
from skyledger.sources.paths import child_names

MEAS = ["wmo_index", "name", "country", "min_temp", "avg_temp", "max_temp", "precipitation"]


# -- P1/P2/P3 layers (F4, F9, F30) ------------------------------------------------

def _stations(spark, sf):
    """S4-shaped rows (``observation_date, station, raw_object_key``) of the actual side."""
    m = fx.measurements(spark, sf, "actual")
    return m.select(F.col("date").alias("observation_date"), F.struct(*MEAS).alias("station"),
                    rq.object_key_of(F.lit("actual"), F.col("date")).alias("raw_object_key"))


def _raw(spark, sf):
    return ly.to_raw(_stations(spark, sf), source_name="actual_fetcher", bucket="weather-raw",
                     event_id="ev-1", trace_id="tr-1",
                     event_created_at=iso_instant_to_ts(F.lit(fx.EVENT_CREATED_AT)),
                     ingested_at=iso_instant_to_ts(F.lit(fx.RUN_INGESTED_AT)))


_MEAS_SQL = """
    meas AS (
        SELECT w.day AS date, w.wmo_index, c.c_name AS name, n.n_name AS country, w.temp_min AS min_temp,
               w.temperature AS avg_temp, w.temp_max AS max_temp, w.precipitation_mm AS precipitation
        FROM wx w LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = w.wmo_index
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        WHERE w.dataset_type = 'actual')
"""
_RAW_SQL = oracle_with("wx").rstrip() + ",\n" + _MEAS_SQL.strip() + """,
    raw AS (
        SELECT 'actual_fetcher' AS source_name, date AS observation_date, wmo_index, name AS station_name,
               country, min_temp, avg_temp, max_temp, precipitation, 'weather-raw' AS raw_bucket,
               'actual/date=' || strftime(date, '%Y-%m-%d') || '.json' AS raw_object_key,
               'ev-1' AS event_id, 'tr-1' AS trace_id,
               '2026-07-06T12:20:00.000000' AS event_created_at, '2026-07-06T12:20:05.000000' AS ingested_at
        FROM meas)
"""


@register("raw_layer", _RAW_SQL + "SELECT * FROM raw")
def q_raw_layer(spark, sf):
    return mx.to_contract_rows(_raw(spark, sf))


@register("ods_layer", _RAW_SQL + "SELECT wmo_index, station_name, country, observation_date, avg_temp AS temperature, "
          "min_temp AS temp_min, max_temp AS temp_max, precipitation AS precipitation_mm, trace_id, ingested_at FROM raw")
def q_ods_layer(spark, sf):
    return mx.to_contract_rows(ly.to_ods(_raw(spark, sf)))


@register("dm_layer", _RAW_SQL + "SELECT wmo_index, observation_date AS day, avg_temp AS temperature, "
          "min_temp AS temp_min, max_temp AS temp_max, precipitation AS precipitation_mm, trace_id, ingested_at FROM raw")
def q_dm_layer(spark, sf):
    return mx.to_contract_rows(ly.to_dm(ly.to_ods(_raw(spark, sf))))


@register("run_summary", oracle_with("wx") +
          "SELECT dataset_type, CAST(count(*) AS BIGINT) AS record_count, CAST((SELECT min(day) FROM wx) AS VARCHAR) AS date_from, "
          "CAST((SELECT max(day) FROM wx) AS VARCHAR) AS date_to, min(day) AS first_day, max(day) AS last_day FROM wx GROUP BY dataset_type")
def q_run_summary(spark, sf):
    """A run per dataset writes its RAW rows in the table's layout and reports what it wrote."""
    from pyspark.sql import Observation
    from skyledger.plans.write_path import observe_run, run_summary
    from skyledger.sources import tables as tb
    root, out = scratch_dir(spark, "runs"), []
    bounds = fx.weather_rows(spark, sf).agg(F.min("day").cast("string").alias("f"), F.max("day").cast("string").alias("t")).first()
    for ds in DATASETS:
        rows = Observation()
        side = fx.weather_rows(spark, sf).filter(F.col("dataset_type") == ds)
        observe_run(tb.layout(side), rows).write.partitionBy("month").parquet(f"{root}/{ds}")
        out.append(run_summary(rows, ds, bounds.f, bounds.t))
    return spark.createDataFrame(out, "dataset_type string, record_count long, date_from string, date_to string, first_day date, last_day date")


# -- S11 -> S1 -> S4 roundtrip through files -------------------------------------------

@register("documents_roundtrip", oracle_with("wx").rstrip() + ",\n" + _MEAS_SQL.strip() + """
    SELECT date AS observation_date, wmo_index, name, country, min_temp, avg_temp, max_temp, precipitation,
           'actual/date=' || strftime(date, '%Y-%m-%d') AS raw_object_key
    FROM meas""")
def q_documents_roundtrip(spark, sf):
    root = scratch_dir(spark, "documents")
    m = fx.measurements(spark, sf, "actual")
    docs.write_daily_documents(m, root, "actual")
    bounds = m.agg(F.min("date").cast("string"), F.max("date").cast("string")).first()
    back = docs.explode_stations(docs.scan_daily_documents(spark, root, "actual", bounds[0], bounds[1],
                                                           layout="partitioned"))
    return back.select("observation_date", "station.*", "raw_object_key")


@register("documents_scan", oracle_with("wx").rstrip() + ",\n" + _MEAS_SQL.strip() + """
    SELECT date AS observation_date, wmo_index, name, country, min_temp, avg_temp, max_temp, precipitation,
           'actual/date=' || strftime(date, '%Y-%m-%d') || '.json' AS raw_object_key
    FROM meas""")
def q_documents_scan(spark, sf):
    """S11 -> S1 -> S4 over the producers' objects: one per day, every measurement in its list."""
    root = scratch_dir(spark, "objects")
    m = fx.measurements(spark, sf, "actual")
    docs.write_documents(spark, m, root, "actual")
    bounds = m.agg(F.min("date").cast("string"), F.max("date").cast("string")).first()
    back = docs.explode_stations(docs.scan_daily_documents(spark, root, "actual", bounds[0], bounds[1], layout="document"))
    return back.select("observation_date", "station.*", "raw_object_key")


# -- S10 / F24 / F25 provider payloads built from orders x lineitem -------------------------

@fx.per_session()
def _payload_text(spark, sf):
    """One provider response per order: the order's lines are its days (ship date),
    mean = quantity, min = discount, max only for lines 1..3 (a shorter array),
    precipitation = tax. Responses are JSON text (stored once per session, as the
    fetched responses are), parsed with S10."""
    li = dt.table(spark, sf, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", F.col("l_shipdate").cast("date").alias("d"), "l_quantity", "l_discount", "l_tax"))).alias("ls"))
    daily = F.struct(
        F.transform("ls", lambda x: x["d"]).alias("time"),
        F.transform("ls", lambda x: x["l_quantity"]).alias("temperature_2m_mean"),
        F.transform("ls", lambda x: x["l_discount"]).alias("temperature_2m_min"),
        F.transform(F.filter("ls", lambda x: x["l_linenumber"] <= 3), lambda x: x["l_quantity"] + x["l_tax"])
        .alias("temperature_2m_max"),
        F.transform("ls", lambda x: x["l_tax"]).alias("precipitation_sum"))
    payload = F.struct(F.col("l_orderkey").cast("double").alias("latitude"), F.lit(0.0).alias("longitude"),
                       F.lit(None).cast("double").alias("elevation"), F.lit("GMT").alias("timezone"),
                       F.lit(0).alias("utc_offset_seconds"), daily.alias("daily"))
    return fx.store(spark, lines.select(F.col("l_orderkey").alias("order_key"), F.to_json(payload).alias("value")),
                    "payloads")


@register("payload_rows", """
    WITH l AS (
        SELECT l_orderkey AS order_key, CAST(l_shipdate AS DATE) AS date, l_quantity, l_discount, l_tax,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_shipdate AS DATE),
                                  l_quantity, l_discount, l_tax) AS i,
               count(*) FILTER (WHERE l_linenumber <= 3) OVER (PARTITION BY l_orderkey) AS n_max
        FROM lineitem),
    mx AS (
        SELECT l_orderkey AS order_key,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_shipdate AS DATE),
                                  l_quantity, l_discount, l_tax) AS j,
               l_quantity + l_tax AS v
        FROM lineitem WHERE l_linenumber <= 3)
    SELECT l.order_key, CAST(0 AS INTEGER) AS pos, l.date, l.l_quantity AS temperature_2m_mean,
           l.l_discount AS temperature_2m_min, mx.v AS temperature_2m_max, l.l_tax AS precipitation_sum
    FROM l LEFT JOIN mx ON mx.order_key = l.order_key AND mx.j = l.i""")
def q_payload_rows(spark, sf):
    parsed, _rejected = docs.split_payload_text(_payload_text(spark, sf))
    return docs.payload_rows(parsed, keep=["order_key", "pos"])


@register("payload_quarantine", """
    WITH o AS (SELECT DISTINCT l_orderkey AS order_key FROM lineitem),
    k AS (SELECT *, order_key % 11 AS kind FROM o)
    SELECT order_key, CAST(NULL AS INTEGER) AS pos, CASE WHEN kind = 5 THEN 'not_a_payload' ELSE 'malformed' END AS reason FROM k WHERE kind IN (3, 5, 6)
    UNION ALL SELECT order_key, 1, 'wrong_type' FROM k WHERE kind IN (7, 8)
    UNION ALL SELECT order_key, 0, 'wrong_type' FROM k WHERE kind = 9
    UNION ALL SELECT order_key, 0, 'payload' FROM k WHERE kind NOT IN (3, 5, 6, 9)
    UNION ALL SELECT order_key, 2, 'payload' FROM k WHERE kind = 8""")
def q_payload_quarantine(spark, sf):
    """S10 with faults: responses cut short, no text, a bare number, arrays with a number or a payload of other types among good ones.
    Every response and every element is found in one of the two outputs."""
    kind, v = F.col("order_key") % 11, F.col("value")
    bad = F.regexp_replace(v, r'"time":\[[^\]]*\]', '"time":"soon"')
    text = _payload_text(spark, sf).withColumn("value", F.when(kind == 3, F.expr("left(value, length(value) - 9)")).when(kind == 5, F.lit("17"))
                                                .when(kind == 6, F.lit(None)).when(kind == 7, F.concat(F.lit("["), v, F.lit(", 5]")))
                                                .when(kind == 8, F.concat(F.lit("["), v, F.lit(","), bad, F.lit(","), v, F.lit("]"))).when(kind == 9, bad).otherwise(v))
    good, rejected = docs.split_payload_text(text)
    return rejected.select("order_key", "pos", "reason").unionByName(good.select("order_key", "pos", F.lit("payload").alias("reason")))


# -- U4 merge of documents ----------------------------------------------------------------

def _load(spark, sf, first: bool):
    m = fx.measurements(spark, sf, "actual")
    m = m.filter(F.col("ingested_at") < F.lit(fx.FIRST_LOAD_END).cast("timestamp_ntz")) if first else \
        m.filter(F.col("ingested_at") >= F.lit(fx.SECOND_LOAD_START).cast("timestamp_ntz"))
    # A document holds each station once: newest measurement of the load.
    return cur.current(m, ["date", "wmo_index"], "ingested_at", "seq").select("date", *MEAS)


_LOADS_SQL = oracle_with("wx").rstrip() + ",\n" + """
    m AS (
        SELECT w.day AS date, w.wmo_index, c.c_name AS name, n.n_name AS country, w.temp_min AS min_temp,
               w.temperature AS avg_temp, w.temp_max AS max_temp, w.precipitation_mm AS precipitation,
               w.ingested_at, w.seq
        FROM wx w LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = w.wmo_index
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE w.dataset_type = 'actual'),
    first_load AS (
        SELECT * EXCLUDE (rn, ingested_at, seq) FROM (
            SELECT *, row_number() OVER (PARTITION BY date, wmo_index ORDER BY ingested_at DESC, seq DESC) AS rn
            FROM m WHERE ingested_at < TIMESTAMP '2024-01-20') WHERE rn = 1),
    second_load AS (
        SELECT * EXCLUDE (rn, ingested_at, seq) FROM (
            SELECT *, row_number() OVER (PARTITION BY date, wmo_index ORDER BY ingested_at DESC, seq DESC) AS rn
            FROM m WHERE ingested_at >= TIMESTAMP '2024-01-15') WHERE rn = 1)
"""


@register("merge_documents", _LOADS_SQL + """
    SELECT * FROM second_load
    UNION ALL
    SELECT f.* FROM first_load f ANTI JOIN second_load s ON s.date = f.date AND s.wmo_index = f.wmo_index""")
def q_merge_documents(spark, sf):
    return docs.merge_measurements(_load(spark, sf, True), _load(spark, sf, False))


@register("merge_stored_documents", _LOADS_SQL + """,
    merged AS (
        SELECT * FROM second_load
        UNION ALL
        SELECT f.* FROM first_load f ANTI JOIN second_load s ON s.date = f.date AND s.wmo_index = f.wmo_index),
    placed AS (
        SELECT m.*, f.wmo_index IS NULL AS is_new FROM merged m LEFT JOIN first_load f ON f.date = m.date AND f.wmo_index = m.wmo_index)
    SELECT date, CAST(row_number() OVER (PARTITION BY date ORDER BY is_new, wmo_index) - 1 AS INTEGER) AS pos, wmo_index, name, country,
           min_temp, avg_temp, max_temp, precipitation FROM placed""")
def q_merge_stored_documents(spark, sf):
    """U4 on disk: the second load is merged into the first one's documents, day by day; old stations keep their places."""
    root = scratch_dir(spark, "merged objects")
    docs.write_documents(spark, _load(spark, sf, True), root, "actual")
    docs.merge_into_documents(spark, _load(spark, sf, False), root, "actual")
    days = [n[5:15] for n in child_names(spark, f"{root}/actual") if n.startswith("date=")]
    return docs.stored_stations(spark, root, "actual", sorted(days))


# -- acceptance path: J11 + F22 -> J12, F21 -> D2, D3 ---------------------------------------

@fx.per_session()
def _raw_events(spark, sf):
    """J11 over every business date at once + F22 payload (nulls kept); the RAW table
    of the acceptance path, stored once per session."""
    stations, wd = fx.operational_tables(spark, sf)
    j = wd.join(stations, wd.station_id == stations.id, "inner")
    payload = F.to_json(F.struct(stations.wmo_index, stations["name"], stations.country,
                                 F.date_format(wd.observation_date, "yyyy-MM-dd").alias("observation_date"),
                                 wd.quality_flag, wd.min_temp, wd.avg_temp, wd.max_temp, wd.precipitation),
                        {"ignoreNullFields": "false"})
    return fx.store(spark, j.select(wd.id.cast("string").alias("event_id"), stations.wmo_index.alias("station_id"),
                                    payload.alias("payload_json"), wd.ingested_at), "raw_daily_events")


_ACC_SQL = oracle_with("wx").rstrip() + """,
    wd AS (
        SELECT w.seq AS id, e.user_id AS station_id, w.day AS observation_date, e.event_type AS quality_flag,
               w.temp_min AS min_temp, w.temperature AS avg_temp, w.temp_max AS max_temp,
               w.precipitation_mm AS precipitation, w.ingested_at
        FROM wx w JOIN events e ON e.event_id = w.seq WHERE w.dataset_type = 'actual'),
    ods_all AS (
        SELECT CAST(wd.station_id AS VARCHAR) AS station_id, wd.observation_date, wd.avg_temp AS temperature,
               wd.min_temp AS temp_min, wd.max_temp AS temp_max, wd.precipitation AS precipitation_mm,
               wd.observation_date AS business_date, wd.id, wd.ingested_at
        FROM wd JOIN customer c ON c.c_custkey = wd.station_id)
"""


_PAYLOAD_SCHEMA = ("wmo_index string, name string, country string, observation_date date, quality_flag string, "
                   "min_temp double, avg_temp double, max_temp double, precipitation double")


def _ods_from_raw(raw, extra=()):
    """typed columns out of the JSON payload — parsed once per row with an
    explicit schema (not one ``get_json_object`` parse per field)."""
    p = raw.select(*extra, "station_id", "event_id", "ingested_at",
                   F.from_json("payload_json", _PAYLOAD_SCHEMA).alias("p"))
    return p.select(*extra, "station_id", F.col("p.observation_date").alias("observation_date"),
                    F.col("p.avg_temp").alias("temperature"), F.col("p.min_temp").alias("temp_min"),
                    F.col("p.max_temp").alias("temp_max"), F.col("p.precipitation").alias("precipitation_mm"),
                    F.col("p.observation_date").alias("business_date"), F.col("event_id").cast("long").alias("id"),
                    "ingested_at")


@register("json_extract", _ACC_SQL + """
    SELECT station_id, observation_date, temperature, temp_min, temp_max, precipitation_mm, business_date,
           CAST(9 AS INTEGER) AS n_keys FROM ods_all""")
def q_json_extract(spark, sf):
    raw = _raw_events(spark, sf).withColumn("n_keys", F.size(F.json_object_keys("payload_json")))
    return _ods_from_raw(raw, extra=["n_keys"]).drop("id", "ingested_at")


@register("insert_if_absent", _ACC_SQL + """
    SELECT CAST(wd.id AS VARCHAR) AS event_id, CAST(wd.station_id AS VARCHAR) AS station_id
    FROM wd JOIN customer c ON c.c_custkey = wd.station_id
    WHERE wd.ingested_at >= TIMESTAMP '2024-01-20'""")
def q_insert_if_absent(spark, sf):
    raw = _raw_events(spark, sf)
    existing = raw.filter(F.col("ingested_at") < F.lit(fx.FIRST_LOAD_END).cast("timestamp_ntz"))
    return cur.insert_if_absent(existing, raw, ["event_id"]).select("event_id", "station_id")


def _ods_load(spark, sf, first: bool):
    ods = _ods_from_raw(_raw_events(spark, sf))
    ods = ods.filter(F.col("ingested_at") < F.lit(fx.FIRST_LOAD_END).cast("timestamp_ntz")) if first else \
        ods.filter(F.col("ingested_at") >= F.lit(fx.SECOND_LOAD_START).cast("timestamp_ntz"))
    # One statement may not update a key twice: the newest row of the load per key.
    return cur.current(ods, ["station_id", "observation_date"], "ingested_at", "id") \
        .select("station_id", "observation_date", "temperature", "temp_min", "temp_max", "precipitation_mm",
                "business_date")


_ODS_LOADS_SQL = _ACC_SQL.rstrip() + """,
    o1 AS (SELECT * EXCLUDE (rn, id, ingested_at) FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id, observation_date ORDER BY ingested_at DESC, id DESC) rn
        FROM ods_all WHERE ingested_at < TIMESTAMP '2024-01-20') WHERE rn = 1),
    o2 AS (SELECT * EXCLUDE (rn, id, ingested_at) FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id, observation_date ORDER BY ingested_at DESC, id DESC) rn
        FROM ods_all WHERE ingested_at >= TIMESTAMP '2024-01-15') WHERE rn = 1)
"""


@register("upsert", _ODS_LOADS_SQL + """
    SELECT * FROM o2
    UNION ALL
    SELECT a.* FROM o1 a ANTI JOIN o2 b ON a.station_id = b.station_id AND a.observation_date = b.observation_date""")
def q_upsert(spark, sf):
    return cur.upsert(_ods_load(spark, sf, True), _ods_load(spark, sf, False), ["station_id", "observation_date"])


@register("replace_day", _ODS_LOADS_SQL + """
    SELECT station_id, observation_date AS day, temperature, temp_min, temp_max, precipitation_mm FROM o2
    UNION ALL
    SELECT station_id, observation_date AS day, temperature, temp_min, temp_max, precipitation_mm
    FROM o1 WHERE observation_date NOT IN (SELECT observation_date FROM o2)""")
def q_replace_day(spark, sf):
    def dm(o):
        return o.select("station_id", F.col("observation_date").alias("day"), "temperature", "temp_min", "temp_max",
                        "precipitation_mm")
    return cur.replace_partitions(dm(_ods_load(spark, sf, True)), dm(_ods_load(spark, sf, False)), "day")


_DAYS_SQL = _ODS_LOADS_SQL + """
    SELECT CAST(station_id AS VARCHAR) AS wmo_index, observation_date AS day, temperature, temp_min, temp_max, precipitation_mm FROM o2
    UNION ALL
    SELECT CAST(station_id AS VARCHAR), observation_date, temperature, temp_min, temp_max, precipitation_mm
    FROM o1 WHERE observation_date NOT IN (SELECT observation_date FROM o2)"""


@register("replace_days_on_disk", _DAYS_SQL)
def q_replace_days_on_disk(spark, sf):
    """D3 on a stored table, in a folder whose name has a blank: the second load's days replace the first one's."""
    from skyledger.sources import tables as tb

    def dm(o):
        return o.select(F.col("station_id").cast("string").alias("wmo_index"), F.col("observation_date").alias("day"),
                        "temperature", "temp_min", "temp_max", "precipitation_mm")
    path = scratch_dir(spark, "daily weather")
    tb.append_layer(dm(_ods_load(spark, sf, True)), path)
    tb.replace_days(spark, dm(_ods_load(spark, sf, False)), path)
    return spark.read.parquet(path).drop("month")


@register("compact_on_disk", oracle_with("cur") + """
    SELECT wmo_index, day, temperature, precipitation_mm, trace_id, seq, ingested_at FROM cur WHERE dataset_type = 'actual'""")
def q_compact_on_disk(spark, sf):
    """D1 on a stored table: all versions of two appended halves, then the touched months hold the newest ones alone."""
    from skyledger.sources import tables as tb
    rows = dt.dm_side(spark, sf, "actual").select("wmo_index", "day", "temperature", "precipitation_mm", "trace_id", "seq", "ingested_at")
    path = scratch_dir(spark, "all versions")
    for half in (0, 1):
        tb.append_layer(rows.filter(F.floor(F.col("seq") / 2) % 2 == half), path)
    tb.compact_current(spark, path, ["wmo_index", "day"], "ingested_at", "seq")
    return spark.read.parquet(path).drop("month")


@register("pipeline_state", """
    WITH u AS (SELECT 'clerk ' || (o_custkey % 7) AS pipeline_name, CAST(o_custkey AS VARCHAR) AS key, CAST(o_orderkey AS VARCHAR) AS value,
                      o_orderdate AS updated_at, o_orderkey % 3 AS load, o_orderkey FROM orders)
    SELECT pipeline_name, key, arg_max(value, (load, updated_at, value)) AS value, arg_max(updated_at, (load, updated_at, value)) AS updated_at
    FROM (SELECT * FROM u WHERE NOT (load = 2 AND pipeline_name IN ('clerk 3', 'clerk 5'))) GROUP BY 1, 2""")
def q_pipeline_state(spark, sf):
    """Three rounds of updates by pipeline and key; the last one names some pipelines only."""
    from skyledger.sources import tables as tb
    o = dt.table(spark, sf, "orders")
    updates = o.select(F.format_string("clerk %d", o.o_custkey % 7).alias("pipeline_name"), o.o_custkey.cast("string").alias("key"),
                       o.o_orderkey.cast("string").alias("value"), o.o_orderdate.alias("updated_at"), (o.o_orderkey % 3).alias("load"))
    path = scratch_dir(spark, "state")
    for load in (0, 1, 2):
        fresh = updates.filter(F.col("load") == load).filter((F.lit(load) < 2) | ~F.col("pipeline_name").isin("clerk 3", "clerk 5"))
        tb.upsert_state(spark, path, fresh)
    return spark.read.schema(tb.STATE_SCHEMA).parquet(path).select("pipeline_name", "key", "value", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


# -- dimension: S5-shaped station table, A8, A9, W4, O5, O6, J5, J7, J13, F32 ----------------

_DIM_SQL = oracle_with("station")


@register("dim_stations", _DIM_SQL + """
    SELECT s.*, coalesce(s.name || ' (' || s.wmo_index || ')', s.wmo_index) AS label,
           coalesce(r.r_name, s.region_id) AS region_name
    FROM station s LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = s.region_id""")
def q_dim_stations(spark, sf):
    station = dim.station_label(fx.station(spark, sf))
    return dim.with_region_names(station, dt.region_names(spark, sf))


@register("region_station_counts", _DIM_SQL + """
    SELECT region_id, CAST(count(*) AS BIGINT) AS n_stations, CAST(count(DISTINCT wmo_index) AS BIGINT) AS n_distinct_stations
    FROM station WHERE region_id IS NOT NULL GROUP BY region_id""")
def q_region_station_counts(spark, sf):
    return dim.stations_by_region(fx.station(spark, sf))


@register("dimension_stats", _DIM_SQL + """
    SELECT CAST(count(*) FILTER (WHERE region_id IS NOT NULL) + count(*) FILTER (WHERE lat IS NOT NULL AND lng IS NOT NULL)
                AS BIGINT) AS stations_loaded,
           CAST(count(*) FILTER (WHERE name IS NOT NULL) AS BIGINT) AS stations_with_name,
           CAST(0 AS BIGINT) AS skipped_no_id
    FROM station""")
def q_dimension_stats(spark, sf):
    return dim.dimension_stats(fx.station(spark, sf))


@register("last_non_blank", """
    WITH a AS (
        SELECT o_custkey, o_orderkey,
               nullif(trim(CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderpriority END), '') AS priority,
               nullif(trim(CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderstatus END), '') AS status
        FROM orders)
    SELECT o_custkey, arg_max(priority, o_orderkey) FILTER (WHERE priority IS NOT NULL) AS priority,
           arg_max(status, o_orderkey) FILTER (WHERE status IS NOT NULL) AS status
    FROM a GROUP BY o_custkey""")
def q_last_non_blank(spark, sf):
    o = dt.table(spark, sf, "orders")
    log = o.select("o_custkey", "o_orderkey",
                   F.when(o.o_orderstatus == "P", F.lit(" ")).otherwise(o.o_orderpriority).alias("priority"),
                   F.when(o.o_orderpriority == "5-LOW", F.lit("")).otherwise(o.o_orderstatus).alias("status"))
    return dim.last_non_blank(log, "o_custkey", ["priority", "status"], "o_orderkey")


def _search_sql(q: str, limit: int) -> str:
    return _DIM_SQL + f"""
    SELECT wmo_index, name FROM station
    WHERE name IS NOT NULL AND (contains(lower(name), '{q}') OR starts_with(wmo_index, '{q}'))
    ORDER BY CAST(wmo_index AS BIGINT), wmo_index LIMIT {limit}"""


def _search(spark, sf, q, limit):
    station = fx.station(spark, sf).withColumn("name_line", F.col("wmo_index").cast("long"))   # file order
    return dim.search_stations(station, q, limit)


@register("station_search", _search_sql("customer#00000001", 20))
def q_station_search(spark, sf):
    return _search(spark, sf, "  Customer#00000001 ", 20)


@register("station_search_id", _search_sql("12", 50))
def q_station_search_id(spark, sf):
    return _search(spark, sf, "12", 500)   # limit clamps to 50


@register("region_search", _DIM_SQL + """
    SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS name, CAST(count(s.wmo_index) AS BIGINT) AS n_stations
    FROM region LEFT JOIN station s ON s.region_id = CAST(r_regionkey AS VARCHAR)
    WHERE contains(lower(r_name), 'ame')
    GROUP BY 1, 2""")
def q_region_search(spark, sf):
    """O6 over the region dictionary, each match with its number of stations."""
    found = dim.search_regions(dt.region_names(spark, sf), " AME ")
    counts = dim.stations_by_region(fx.station(spark, sf)).select(F.col("region_id").alias("id"), "n_stations")
    return found.join(counts, "id", "left").select("id", "name",
                                                   F.coalesce("n_stations", F.lit(0)).cast("long").alias("n_stations"))


@register("station_coordinates_strict", _DIM_SQL + """
    SELECT DISTINCT CAST(e.user_id AS VARCHAR) AS wmo_index FROM events e
    WHERE CAST(e.user_id AS VARCHAR) NOT IN (SELECT wmo_index FROM station WHERE lat IS NOT NULL AND lng IS NOT NULL)""")
def q_station_coordinates_strict(spark, sf):
    ids = dt.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("wmo_index"))
    return dim.unresolvable_stations(ids, fx.station(spark, sf))


@register("names_for", _DIM_SQL + """
    SELECT s.wmo_index, s.name FROM station s
    WHERE s.name IS NOT NULL AND s.wmo_index IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'O')""")
def q_names_for(spark, sf):
    o = dt.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O")
    return dim.names_for(o.select(F.col("o_custkey").cast("string").alias("wmo_index")), fx.station(spark, sf))


# -- request state: A11, J10, T4 batch, P18 ------------------------------------------------------

_REQ_SQL = "WITH " + fx.ORACLE_LINEITEM_REQUESTS.strip() + "\n"


@register("request_status", _REQ_SQL + "SELECT * FROM status")
def q_request_status(spark, sf):
    waiters, outcomes = fx.lineitem_requests(spark, sf)
    return rq.request_status_rollup(waiters, outcomes)


@register("request_timeouts", _REQ_SQL + """
    SELECT request_id, n_traces, n_pending, updated_at,
           CASE WHEN status = 'pending' AND epoch((SELECT max(created_at) FROM outcomes)) - epoch(updated_at) > 600
                THEN 'failed' ELSE status END AS status,
           CASE WHEN status = 'pending' AND epoch((SELECT max(created_at) FROM outcomes)) - epoch(updated_at) > 600
                THEN 'timed out waiting for upstream data' ELSE error_message END AS error_message
    FROM status""")
def q_request_timeouts(spark, sf):
    waiters, outcomes = fx.lineitem_requests(spark, sf)
    now = outcomes.agg(F.max("created_at")).scalar()
    return rq.request_timeouts(rq.request_status_rollup(waiters, outcomes), now)


@register("waiter_fanout", _REQ_SQL + """
    SELECT o.trace_id, o.event_type, w.request_id FROM outcomes o JOIN waiters w ON w.trace_id = o.trace_id""")
def q_waiter_fanout(spark, sf):
    waiters, outcomes = fx.lineitem_requests(spark, sf)
    return rq.resolve_waiters(outcomes.select("trace_id", "event_type"), waiters) \
        .select("trace_id", "event_type", "request_id")


@register("request_lookup", _REQ_SQL + """
    SELECT CAST(o.o_orderkey AS VARCHAR) AS request_id, s.n_traces, s.n_pending, s.error_message, s.updated_at,
           s.status, CASE WHEN s.status IS NULL THEN 'NOT_FOUND' END AS error_code
    FROM orders o LEFT JOIN status s ON s.request_id = CAST(o.o_orderkey AS VARCHAR)""")
def q_request_lookup(spark, sf):
    waiters, outcomes = fx.lineitem_requests(spark, sf)
    asked = dt.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("request_id"))
    return rq.request_lookup(rq.request_status_rollup(waiters, outcomes), asked)


# -- P10-P13, Q3, T13 over events derived from orders -------------------------------------------

_OE_SQL = "WITH " + fx.ORACLE_ORDER_EVENTS.strip() + "\n"


@register("need_info_routed", _OE_SQL + """
    SELECT dataset_type, event_id, trace_id, date_from, date_to FROM oe
    WHERE dataset_type IS NOT NULL AND trim(event_id) <> '' AND n_ids > 0
      AND CAST(date_from AS DATE) <= CAST(date_to AS DATE)""")
def q_need_info_routed(spark, sf):
    ev = fx.order_events(spark, sf)
    routed = [rq.valid_need_info(rq.route_need_info(ev, d)) for d in ("actual", "forecast")]
    return routed[0].unionByName(routed[1]).select("dataset_type", "event_id", "trace_id", "date_from", "date_to")


@register("manifest_split", _OE_SQL + """
    SELECT trace_id, 'valid' AS route,
           CASE WHEN topic = 'weather.forecast.raw.created' THEN 'forecast' ELSE 'actual' END AS dataset_type,
           NULL AS stage, NULL AS source_name, NULL AS reason, NULL AS details
    FROM oe WHERE bucket IS NOT NULL AND n_ids > 0
    UNION ALL
    SELECT trace_id, 'failed', NULL, 'dm_trigger', 'dm_trigger', 'dm_trigger_invalid_event',
           'missing trace_id/bucket/object_keys/date_from/date_to in ' || topic || ' event'
    FROM oe WHERE NOT (bucket IS NOT NULL AND n_ids > 0)""")
def q_manifest_split(spark, sf):
    ev = fx.order_events(spark, sf).withColumnRenamed("wmo_indexes", "object_keys")
    valid, failures = rq.split_manifests(ev)
    v = valid.select("trace_id", F.lit("valid").alias("route"), rq.topic_to_dataset(F.col("topic")).alias("dataset_type"),
                     *[F.lit(None).cast("string").alias(c) for c in ("stage", "source_name", "reason", "details")])
    f = failures.select("trace_id", F.lit("failed").alias("route"), F.lit(None).cast("string").alias("dataset_type"),
                        "stage", "source_name", "reason", "details")
    return v.unionByName(f)


@register("manifest_errors", _OE_SQL + """
    SELECT trace_id, array_to_string(list_filter([
        CASE WHEN topic <> 'weather.actual.raw.created'
             THEN 'event_type: expected weather.actual.raw.created, got ' || topic END,
        CASE WHEN source_name <> 'actual_fetcher'
             THEN 'source_name: expected actual_fetcher, got ' || source_name END,
        CASE WHEN bucket IS NULL OR bucket <> 'weather-raw'
             THEN 'bucket: expected weather-raw, got ' || coalesce(bucket, 'null') END], lambda x: x IS NOT NULL), '; ') AS errors
    FROM oe""")
def q_manifest_errors(spark, sf):
    ev = fx.order_events(spark, sf).withColumnRenamed("topic", "event_type")
    out = qc.manifest_errors(ev, F.lit("weather.actual.raw.created"), F.lit("actual_fetcher"), F.lit("weather-raw"))
    return out.select("trace_id", F.array_join("errors", "; ").alias("errors"))


@register("build_manifest", _OE_SQL.rstrip() + ",\n" + oracle_with("wx")[len("WITH "):].rstrip() + """
    , ok AS (SELECT *, CASE WHEN dataset_type = 'forecast' THEN 'forecast' ELSE 'actual' END AS ds
             FROM oe WHERE n_ids > 0 AND CAST(date_from AS DATE) <= CAST(date_to AS DATE)),
    pairs AS (SELECT event_id, trace_id, ds, date_from, date_to, first_id AS id FROM ok
              UNION ALL SELECT event_id, trace_id, ds, date_from, date_to, CAST(CAST(first_id AS BIGINT) + 1 AS VARCHAR) FROM ok),
    written AS (
        SELECT DISTINCT ok.event_id, ok.trace_id, ok.ds, w.day
        FROM pairs ok JOIN wx w ON w.wmo_index = ok.id AND w.dataset_type = ok.ds
         AND w.day BETWEEN CAST(ok.date_from AS DATE) AND CAST(ok.date_to AS DATE))
    SELECT ok.trace_id,
           CASE WHEN count(w.day) > 0 THEN 'manifest' ELSE 'failed' END AS route,
           CAST(count(w.day) AS BIGINT) AS n_keys,
           string_agg(w.ds || '/date=' || strftime(w.day, '%Y-%m-%d') || '.json', ',' ORDER BY w.day) AS object_keys
    FROM ok LEFT JOIN written w ON w.event_id = ok.event_id AND w.trace_id = ok.trace_id
    GROUP BY ok.trace_id""")
def q_build_manifest(spark, sf):
    """Documents 'written' for a need-info event = the days of its range on which
    one of its stations has data of its dataset (adapter rows); one manifest per event, or a
    failure. Each event asks for its customer's station and the next one."""
    ev = fx.order_events(spark, sf).filter((F.size("wmo_indexes") > 0)
                                           & (F.to_date("date_from") <= F.to_date("date_to")))
    ev = ev.withColumn("dataset_type", F.coalesce("dataset_type", F.lit("actual"))) \
        .withColumn("wmo_indexes", F.flatten(F.transform("wmo_indexes", lambda x: F.array(x, (x.cast("long") + 1).cast("string"))))) \
        .withColumn("event_id", F.concat_ws("|", "event_id", "trace_id"))
    rows = fx.weather_rows(spark, sf).select("dataset_type", "wmo_index", "day")
    written = rq.written_days(ev, rows)
    manifests, failures = rq.build_manifests(ev, written)
    m = manifests.select("trace_id", F.lit("manifest").alias("route"), F.size("object_keys").cast("long").alias("n_keys"),
                         F.array_join("object_keys", ",").alias("object_keys"))
    f = failures.select("trace_id", F.lit("failed").alias("route"), F.lit(0).cast("long").alias("n_keys"),
                        F.lit(None).cast("string").alias("object_keys"))
    return m.unionByName(f)


# -- need-info -> locations -> responses -> documents -> manifests -----------------------------------

_CHAIN_SQL = """
    WITH lines AS (
        SELECT l_orderkey AS k, l_suppkey AS s, CAST(l_shipdate AS DATE) AS d,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, CAST(l_shipdate AS DATE), l_quantity, l_tax) AS n
        FROM lineitem),
    ev AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate AS DATE) + 60 AS t FROM orders WHERE o_orderkey IN (SELECT k FROM lines)),
    rows AS (
        SELECT ev.k, l.s, l.d + CAST(g AS INTEGER) AS day FROM ev JOIN lines l ON l.k = ev.k JOIN supplier ON s_suppkey = l.s AND s_acctbal >= 0, range(2) x(g)
        WHERE ev.k % 11 <> 3 AND l.d + CAST(g AS INTEGER) BETWEEN ev.f AND ev.t),
    days AS (SELECT DISTINCT k, day FROM rows)
"""


def _fetch_chain(spark, sf):
    """An order asks for its lines' suppliers (those with a balance below 0 have no coordinates) over 60 days; the provider answers
    each line with its ship date and the day after. Every eleventh response is cut short."""
    from skyledger.plans.fetch_chain import fetch_chain
    o, li = dt.table(spark, sf, "orders"), dt.table(spark, sf, "lineitem")
    sup = dt.table(spark, sf, "supplier")
    station = sup.select(F.col("s_suppkey").cast("string").alias("wmo_index"), F.col("s_name").alias("name"),
                         F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey").cast("double")).alias("lat"), F.lit(1.0).alias("lng"))
    ship = F.col("l_shipdate").cast("date")
    one = li.join(sup.select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_acctbal") >= 0).alias("known")), "l_suppkey", "left").select(
        "l_orderkey", F.struct("l_linenumber", "l_suppkey", ship.alias("d"), "l_quantity", "l_tax", "known").alias("x"))
    of_order = one.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    ev = o.join(of_order, o.o_orderkey == F.col("l_orderkey")).select(
        o.o_orderkey.cast("string").alias("event_id"), F.format_string("tr-%d", o.o_orderkey).alias("trace_id"), F.lit("actual").alias("dataset_type"),
        o.o_orderdate.cast("date").cast("string").alias("date_from"), F.date_add(o.o_orderdate.cast("date"), 60).cast("string").alias("date_to"),
        F.transform("xs", lambda x: x["l_suppkey"].cast("string")).alias("wmo_indexes"), "xs", o.o_orderkey.alias("k"))
    answer = F.to_json(F.transform(F.filter("xs", lambda x: x["known"]), lambda x: F.struct(F.struct(
        F.array(x["d"], F.date_add(x["d"], 1)).alias("time"), F.array(x["l_quantity"], x["l_quantity"] + 1).alias("temperature_2m_mean"),
        F.array(x["l_tax"]).alias("temperature_2m_min")).alias("daily"))))
    events = fx.store(spark, ev.withColumn("value", answer), "need-info")
    text = F.when(F.col("k") % 11 == 3, F.expr("concat(left(value, length(value) - 1), ' oops')")).otherwise(F.col("value"))
    root = scratch_dir(spark, "fetched objects")
    return root, fetch_chain(spark, events.drop("xs", "value", "k"), station, events.select("event_id", text.alias("value")), root, "actual")


@register("fetch_chain", _CHAIN_SQL + """
    SELECT 'tr-' || ev.k AS trace_id, CASE WHEN ev.k % 11 = 3 OR count(day) = 0 THEN 'failed' ELSE 'manifest' END AS route,
           CASE WHEN ev.k % 11 = 3 THEN 'malformed' WHEN count(day) = 0 THEN 'nothing_written' END AS reason, CAST(count(day) AS BIGINT) AS n_keys,
           'actual/date=' || CAST(min(day) AS VARCHAR) || '.json' AS first_key, 'actual/date=' || CAST(max(day) AS VARCHAR) || '.json' AS last_key
    FROM ev LEFT JOIN days ON days.k = ev.k GROUP BY ev.k""")
def q_fetch_chain(spark, sf):
    _root, (manifests, failures, _mismatches) = _fetch_chain(spark, sf)
    none = lambda c: F.lit(None).cast("string").alias(c)
    m = manifests.select("trace_id", F.lit("manifest").alias("route"), none("reason"), F.size("object_keys").cast("long").alias("n_keys"),
                         F.col("object_keys")[0].alias("first_key"), F.element_at("object_keys", -1).alias("last_key"))
    return m.unionByName(failures.select("trace_id", F.lit("failed").alias("route"), "reason", F.lit(0).cast("long").alias("n_keys"), none("first_key"), none("last_key")))


@register("fetched_documents", _CHAIN_SQL + "SELECT DISTINCT day AS date, CAST(s AS VARCHAR) AS wmo_index, s_name AS name, '' AS country FROM rows JOIN supplier ON s_suppkey = s")
def q_fetched_documents(spark, sf):
    """What the chain left in the documents: each station once a day."""
    root, _ = _fetch_chain(spark, sf)
    days = sorted(n[5:15] for n in child_names(spark, f"{root}/actual") if n.startswith("date="))
    return docs.stored_stations(spark, root, "actual", days).select("date", "wmo_index", "name", "country")


# -- Q1, Q2, Q4 ------------------------------------------------------------------------------

@register("unexpected_stations", oracle_with("cur", "station") + """
    SELECT DISTINCT day, wmo_index FROM cur WHERE dataset_type = 'actual'
      AND wmo_index NOT IN (SELECT wmo_index FROM station WHERE region_id IN ('1', '3'))""")
def q_unexpected_stations(spark, sf):
    requested = fx.station(spark, sf).filter(F.col("region_id").isin("1", "3"))
    return qc.unexpected_stations(fx.current_side(spark, sf, "actual"), requested)


@register("landing_counts", oracle_with("cur") + """
    SELECT dataset_type, CAST(count(DISTINCT day) AS BIGINT) AS n_keys, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(DISTINCT wmo_index) AS BIGINT) AS n_stations,
           CAST(count(DISTINCT day) * count(DISTINCT wmo_index) AS BIGINT) AS expected_rows,
           count(*) = count(DISTINCT day) * count(DISTINCT wmo_index) AS rows_ok
    FROM cur GROUP BY dataset_type""")
def q_landing_counts(spark, sf):
    both = fx.current_side(spark, sf, "actual").withColumn("dataset_type", F.lit("actual")).unionByName(
        fx.current_side(spark, sf, "forecast").withColumn("dataset_type", F.lit("forecast")))
    return qc.landing_counts(both, ["dataset_type"])


@register("key_violations", oracle_with("wx") + """
    SELECT dataset_type, wmo_index, day, CAST(count(*) AS BIGINT) AS n_rows FROM wx
    GROUP BY dataset_type, wmo_index, day HAVING count(*) > 1""")
def q_key_violations(spark, sf):
    return qc.duplicate_keys(fx.weather_rows(spark, sf), ["dataset_type", "wmo_index", "day"])


@register("required_nulls", oracle_with("wx") + """
    SELECT dataset_type, """ + ", ".join(
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}_nulls"
    for c in ["wmo_index", "day", "temperature", "precipitation_mm", "trace_id", "ingested_at"]) +
          " FROM wx GROUP BY dataset_type")
def q_required_nulls(spark, sf):
    return qc.required_nulls(fx.weather_rows(spark, sf),
                             ["wmo_index", "day", "temperature", "precipitation_mm", "trace_id", "ingested_at"],
                             by=["dataset_type"])


# -- J8: positional pairing of requested locations with provider responses --------------------

@register("zip_locations", """
    WITH coords AS (
        SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_shipdate, l_quantity)
                    - 1 AS INTEGER) AS pos,
               CAST(l_suppkey AS VARCHAR) AS wmo_index
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    resp AS (
        SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey,
                    l_shipdate, l_quantity) - 1 AS INTEGER) AS pos
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R')
    SELECT c.o_orderkey, c.pos, c.wmo_index FROM coords c JOIN resp r ON r.o_orderkey = c.o_orderkey AND r.pos = c.pos""")
def q_zip_locations(spark, sf):
    """A request per order asks for the suppliers of its lines (in line order); the
    provider answered one response per line that was not returned, in order; the
    pairs are cut to the shorter side."""
    from pyspark.sql import Window
    # Merged, not broadcast: the lines go by order anyway, and a table of all orders' keys in every task would grow with the input.
    li = dt.table(spark, sf, "lineitem").join(dt.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")).hint("merge"),
                                               "l_orderkey")
    # Line order within an order (a handful of lines; ties broken on the line's content).
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_quantity")
    coords = li.select(F.col("l_orderkey").alias("o_orderkey"), (F.row_number().over(w) - 1).cast("int").alias("pos"),
                       F.col("l_suppkey").cast("string").alias("wmo_index"))
    resp = li.filter(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").alias("o_orderkey"), (F.row_number().over(w) - 1).cast("int").alias("pos"))
    pairs, _report = docs.zip_locations(coords, resp, by=["o_orderkey"])
    return pairs.select("o_orderkey", "pos", "wmo_index")


# -- S5/F31/W4/A8 from a real CSV --------------------------------------------------------------

@register("dimension_csv", """
    WITH lines AS (
        SELECT o_orderkey AS n, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS id,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'St. "' || o_orderpriority || '", ' || o_orderkey END AS name,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 9 AS VARCHAR) END AS region,
               CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_custkey / 8.0 WHEN 2 THEN 1000.5 ELSE NULL END AS lat,
               CASE WHEN o_orderkey % 4 IN (1, 2) THEN -(o_orderkey % 1000) / 4.0 END AS lng
        FROM orders)
    SELECT id AS wmo_index, arg_max(name, n) FILTER (WHERE name IS NOT NULL) AS name, arg_max(region, n) FILTER (WHERE region IS NOT NULL) AS region_id,
           CAST(arg_max(lat, n) FILTER (WHERE lat IS NOT NULL AND lng IS NOT NULL) AS DOUBLE) AS lat,
           CAST(arg_max(lng, n) FILTER (WHERE lat IS NOT NULL AND lng IS NOT NULL) AS DOUBLE) AS lng,
           CAST(count(*) FILTER (WHERE region IS NOT NULL) AS BIGINT) AS n_member_lines,
           (SELECT CAST(count(*) AS BIGINT) FROM lines WHERE id IS NULL) AS skipped
    FROM lines WHERE id IS NOT NULL GROUP BY id""")
def q_dimension_csv(spark, sf):
    """CSV files of stations, one after another by name, with an order's line each, with quotes, commas and line ends in names, blank
    ids, names and regions, numbers that are none; the last non-blank value of each station in file order wins."""
    from skyledger.sources import dimension_csv as dcsv
    o, path = dt.table(spark, sf, "orders"), scratch_dir(spark, "stations csv")
    k = o.o_orderkey
    lines = o.select(
        F.when(k % 13 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), o.o_custkey.cast("string"))).alias("WMO_index"),
        F.when(k % 5 == 0, F.lit(" ")).otherwise(F.concat(F.lit('St. "'), "o_orderpriority", F.lit('", '), k.cast("string"))).alias("Station"),
        F.when(k % 7 == 0, F.lit("")).otherwise((o.o_custkey % 9).cast("string")).alias("Region"),
        F.expr("CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN CAST(o_custkey / 8 AS STRING) WHEN 2 THEN '1_000.5' ELSE '1.0d' END").alias("Latitude"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 'north' ELSE CAST(-(o_orderkey % 1000) / 4 AS STRING) END").alias("Longitude"), k.alias("k"))
    lines.repartitionByRange("k").sortWithinPartitions("k").drop("k").write.option("header", "true").option("escape", '"').csv(path)
    station, members, skipped = dcsv.scan_station_dimension(spark, path)
    lines_of = members.groupBy("wmo_index").agg(F.count(F.lit(1)).alias("n_member_lines"))
    return station.join(lines_of, "wmo_index", "left").select(
        "wmo_index", "name", "region_id", "lat", "lng", F.coalesce("n_member_lines", F.lit(0)).cast("long").alias("n_member_lines"),
        skipped.agg(F.count(F.lit(1))).scalar().alias("skipped"))


# -- W5: the mart holds every recomputation, reads take the newest ----------------------------------

@register("mart_newest_version", oracle_with("err") + """
    SELECT wmo_index, day, temperature_error + CASE WHEN dayofmonth(day) % 2 = 0 THEN 2 ELSE 1 END AS temperature_error,
           make_timestamp(2026, 7, CASE WHEN dayofmonth(day) % 2 = 0 THEN 3 ELSE 2 END, 0, 0, 0) AS ingested_at
    FROM err""")
def q_mart_newest_version(spark, sf):
    """Three recomputations appended to the mart, the last one of even days only; each key reads its newest row."""
    from skyledger.plans import write_path as wp
    from skyledger.schemas import ERROR, ERROR_TABLE
    from skyledger.sources import tables as tb
    root = scratch_dir(spark, "versions")
    errors = fx.mart_rows(spark, sf)
    for run in (0, 1, 2):
        rows = errors.filter(F.dayofmonth("day") % 2 == 0) if run == 2 else errors
        rows = rows.withColumn("temperature_error", F.col("temperature_error") + run).withColumn("ingested_at", F.lit(f"2026-07-0{run + 1}").cast("timestamp"))
        tb.append_layer(rows.select(*[f.name for f in ERROR.fields]), wp.table_path(root, ERROR_TABLE))
    return wp.read_current_errors(spark, root).select("wmo_index", "day", "temperature_error", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


# -- F4/F5, F15/F26/F27, F20 over columns of the driver tables ---------------------------------------

@register("instant_texts", """
    SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%fZ') AS exact, date_trunc('second', CAST(ts AS TIMESTAMP)) AS read_back FROM events""")
def q_instant_texts(spark, sf):
    """F5 and back by F4 (cut to seconds)."""
    from skyledger.functions import timefmt as tf
    exact = tf.iso_instant_text(F.col("ts").cast("timestamp"))
    return dt.table(spark, sf, "events").select("event_id", exact.alias("exact"), iso_instant_to_ts(exact).cast("timestamp_ntz").alias("read_back"))


@register("id_lists", """
    WITH l AS (SELECT l_orderkey AS order_key, l_suppkey AS s, l_linenumber AS n, l_partkey AS p FROM lineitem),
    lists AS (SELECT order_key, list(CAST(s AS VARCHAR) ORDER BY s) AS ids FROM l GROUP BY 1)
    SELECT order_key, array_to_string(ids, ',') AS ids, array_to_string(list_filter(ids, lambda x: x <> ids[1]), ',') AS others,
           len(list_filter(ids, lambda x: x <> ids[1])) = 0 AS done, CASE WHEN order_key % 2 = 0 THEN '' ELSE ids[1] END AS first_id
    FROM lists""")
def q_id_lists(spark, sf):
    """a comma-separated text with blanks and empty places is split to ids; F26: the resolved id leaves the list; F15."""
    from skyledger.functions import text as tx
    lists = dt.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.transform(F.sort_array(F.collect_list("l_suppkey")), lambda x: x.cast("string")).alias("l"))
    split = lists.withColumn("ids", tx.comma_split(F.concat(F.lit(" , "), F.array_join("l", " ,, "), F.lit(" "))))
    rest = tx.remove_from(F.col("ids"), F.col("ids")[0])
    return split.select("order_key", F.array_join("ids", ",").alias("ids"), F.array_join(rest, ",").alias("others"), tx.is_empty(rest).alias("done"),
                        tx.empty_if_null(F.when(F.col("order_key") % 2 == 1, F.col("ids")[0])).alias("first_id"))


@register("errors_shown", oracle_with("err") + "SELECT wmo_index, day, round(temperature_error, 2) AS temperature_error, round(precipitation_mm_error, 2) AS precipitation_mm_error FROM err")
def q_errors_shown(spark, sf):
    """errors as the dashboard shows them."""
    from skyledger.functions.scores import shown
    return fx.mart_rows(spark, sf).select("wmo_index", "day", *[shown(F.col(c)).alias(c) for c in ("temperature_error", "precipitation_mm_error")])


# -- J5 lenient: coordinates for the asked ids, unknown -> null ----------------------------------

@register("station_coordinates", _DIM_SQL + """
    SELECT a.wmo_index, s.lat, s.lng
    FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS wmo_index FROM events) a
    LEFT JOIN station s ON s.wmo_index = a.wmo_index""")
def q_station_coordinates(spark, sf):
    ids = dt.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("wmo_index")).distinct()
    return dim.station_coordinates(ids, fx.station(spark, sf))


# -- J11 for one business date (the first observed day) -----------------------------------------

@register("operational_raw_day", _ACC_SQL + """
    SELECT 'operational' AS source_name, wd.observation_date AS business_date,
           CAST(c.c_custkey AS VARCHAR) AS wmo_index, c.c_name AS station_name, n.n_name AS country,
           wd.observation_date, wd.min_temp, wd.avg_temp, wd.max_temp, wd.precipitation, wd.quality_flag
    FROM wd JOIN customer c ON c.c_custkey = wd.station_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    WHERE wd.observation_date = (SELECT min(day) FROM wx)""")
def q_operational_raw_day(spark, sf):
    stations, wd = fx.operational_tables(spark, sf)
    first_day = fx.weather_rows(spark, sf).agg(F.min("day").cast("string")).scalar()
    return ly.operational_to_raw(wd, stations, first_day)


# -- T6: requests -> (trace_id, request_id) waiter rows ------------------------------------------

@register("waiter_rows", """
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS request_id,
           CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trace_id
    FROM lineitem""")
def q_waiter_rows(spark, sf):
    """Pending requests carry their trace list (bounded per request by its ranges x 2);
    the fan-out rows are what outcome events are joined with."""
    from skyledger.streaming.request_state import waiter_rows
    waiters, _ = fx.lineitem_requests(spark, sf)
    requests = waiters.groupBy("request_id").agg(F.collect_list("trace_id").alias("pending_trace_ids"))
    return waiter_rows(requests)


# -- T12 batch form: first-hit-anchored windows per user over events ------------------------------

_RATE_LIMIT, _RATE_WINDOW = 60, 60          # the general contract: 60 hits per 60 s


@register("rate_windows", f"""
    WITH RECURSIVE
    h AS (SELECT CAST(user_id AS VARCHAR) AS identity, epoch_us(CAST(ts AS TIMESTAMP)) AS t FROM events),
    r AS (SELECT identity, t, row_number() OVER (PARTITION BY identity ORDER BY t) AS rn,
                 count(*) OVER (PARTITION BY identity) AS n FROM h),
    nx AS (SELECT a.identity, a.rn, min(b.rn) AS nrn
           FROM r a LEFT JOIN r b ON b.identity = a.identity AND b.t >= a.t + {_RATE_WINDOW * 1_000_000}
           GROUP BY a.identity, a.rn),
    starts(identity, rn) AS (
        SELECT identity, rn FROM r WHERE rn = 1
        UNION ALL
        SELECT s.identity, nx.nrn FROM starts s JOIN nx ON nx.identity = s.identity AND nx.rn = s.rn
        WHERE nx.nrn IS NOT NULL),
    w AS (SELECT s.identity, s.rn, r.t, coalesce(nx.nrn, r.n + 1) - s.rn AS n_hits
          FROM starts s JOIN r ON r.identity = s.identity AND r.rn = s.rn
          JOIN nx ON nx.identity = s.identity AND nx.rn = s.rn)
    SELECT w.identity, make_timestamp(w.t) AS window_start, CAST(w.n_hits AS BIGINT) AS n_hits,
           w.n_hits > {_RATE_LIMIT} AS breached, make_timestamp(b.t) AS first_breach_at
    FROM w LEFT JOIN r b ON w.n_hits > {_RATE_LIMIT} AND b.identity = w.identity AND b.rn = w.rn + {_RATE_LIMIT}""")
def q_rate_windows(spark, sf):
    from skyledger.operators.anchored_windows import anchored_windows
    hits = dt.table(spark, sf, "events").select(F.col("user_id").alias("identity"), "ts")
    out = anchored_windows(hits, _RATE_WINDOW, _RATE_LIMIT)
    return out.select("identity", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_hits",
                      "breached", F.col("first_breach_at").cast("timestamp_ntz").alias("first_breach_at"))


@register("pending_requests", _REQ_SQL + "SELECT * FROM status WHERE status = 'pending'")
def q_pending_requests(spark, sf):
    """Every request still waiting on at least one trace."""
    waiters, outcomes = fx.lineitem_requests(spark, sf)
    return rq.pending_requests(rq.request_status_rollup(waiters, outcomes))
