"""Registered queries: each key maps to a Spark plan over the driver tables and,
where SQL can express it, the equivalent DuckDB SQL over the same parquet views.

Every query reads whole tables (or data Spark derives from them); request
parameters that are part of a feature (a region list, a metric name, a page
size) are fixed below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import coverage as cov
from skyledger.operators import metrics as mx
from skyledger.plans import fixtures as fx
from skyledger.schemas import ERROR_FIELDS, METRICS, ROW_COLUMNS
from skyledger.sources import driver_tables as dt
from skyledger.sources.driver_tables import oracle_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# -- SQL fragments -----------------------------------------------------------

def _sql_metric_aggs() -> str:
    parts = ["CAST(count(*) AS BIGINT) AS rows_count"]
    for m in METRICS:
        parts.append(f"round(avg({m}_abs_error), 6) AS {m}_mae")
        parts.append(f"round(avg({m}_error), 6) AS {m}_bias")
    return ", ".join(parts)


SQL_CONTRACT_COLS = ", ".join(
    "strftime(day, '%Y-%m-%d') AS day" if c == "day" else
    "strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at" if c == "ingested_at" else c
    for c in ROW_COLUMNS)

# Feature parameters of the fixed requests.
REGION_REQUEST = ["1", "3", "7"]          # "7" is not a known region
TOP_LIMIT = 100
EMPTY_RANGE = ("2030-01-01", "2030-01-31")


# -- W1 / J1 / P4 -----------------------------------------------------------------

@register("current_actual", oracle_with("cur") + "SELECT * EXCLUDE (dataset_type) FROM cur WHERE dataset_type = 'actual'")
def q_current_actual(spark, sf):
    return fx.current_side(spark, sf, "actual")


@register("current_forecast", oracle_with("cur") + "SELECT * EXCLUDE (dataset_type) FROM cur WHERE dataset_type = 'forecast'")
def q_current_forecast(spark, sf):
    return fx.current_side(spark, sf, "forecast")


@register("forecast_error", oracle_with("err") + "SELECT * FROM err")
def q_forecast_error(spark, sf):
    return fx.mart(spark, sf)             # the full build: W1 for both sides + J1 + P4


# -- A1 / A2 -------------------------------------------------------------------

@register("model_metrics", oracle_with("err") + f"SELECT {_sql_metric_aggs()} FROM err")
def q_model_metrics(spark, sf):
    return mx.model_metrics(fx.mart_rows(spark, sf))


@register("model_metrics_empty", oracle_with("err") + f"SELECT {_sql_metric_aggs()} FROM err "
          f"WHERE day BETWEEN DATE '{EMPTY_RANGE[0]}' AND DATE '{EMPTY_RANGE[1]}'")
def q_model_metrics_empty(spark, sf):
    return mx.model_metrics(fx.mart_table(spark, sf), *EMPTY_RANGE)


PARTIAL_RANGE = ("2024-01-05", "2024-01-20")


@register("model_metrics_range", oracle_with("err") + f"SELECT {_sql_metric_aggs()} FROM err "
          f"WHERE day BETWEEN DATE '{PARTIAL_RANGE[0]}' AND DATE '{PARTIAL_RANGE[1]}'")
def q_model_metrics_range(spark, sf):
    return mx.model_metrics(fx.mart_table(spark, sf), *PARTIAL_RANGE)


@register("model_metrics_daily", oracle_with("err") + f"SELECT day, {_sql_metric_aggs()} FROM err GROUP BY day ORDER BY day")
def q_model_metrics_daily(spark, sf):
    return mx.model_metrics_daily(fx.mart_rows(spark, sf))


# -- O2 top errors per metric ---------------------------------------------------

def _top_query(metric):
    def q(spark, sf):
        return mx.to_contract_rows(mx.top_errors(fx.mart_rows(spark, sf), metric, limit=TOP_LIMIT))
    q.__name__ = f"q_top_errors_{metric}"
    return q


for _m in ERROR_FIELDS:
    register(f"top_errors_{_m}", oracle_with("err") +
             f"SELECT {SQL_CONTRACT_COLS} FROM err WHERE {_m} IS NOT NULL "
             f"ORDER BY {_m} DESC, wmo_index, day LIMIT {TOP_LIMIT}")(_top_query(_m))


# -- O1 / P5-P7 / J3 / J4 / J14 ----------------------------------------------------

def _urgent_order_stations(spark, sf):
    """Station ids requested by urgent orders (a request log derived from ``orders``)."""
    orders = dt.table(spark, sf, "orders")
    return orders.filter(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_custkey").cast("string").alias("wmo_index"))


@register("station_rows", oracle_with("err") +
          f"SELECT {SQL_CONTRACT_COLS} FROM err WHERE wmo_index IN "
          "(SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT') "
          "ORDER BY day, wmo_index")
def q_station_rows(spark, sf):
    return mx.to_contract_rows(mx.rows_by_stations(fx.mart_rows(spark, sf), _urgent_order_stations(spark, sf)))


@register("rows_with_names", oracle_with("err", "station") +
          f"SELECT {SQL_CONTRACT_COLS.replace('wmo_index', 'e.wmo_index')}, s.station_name FROM err e "
          "LEFT JOIN (SELECT wmo_index, max(name) AS station_name FROM station WHERE name IS NOT NULL GROUP BY 1) s "
          "ON s.wmo_index = e.wmo_index")
def q_rows_with_names(spark, sf):
    rows = mx.project_error_rows(fx.mart_rows(spark, sf))
    return mx.to_contract_rows(mx.attach_station_names(rows, fx.station(spark, sf)))


_REGION_VALUES = ", ".join(f"('{r}')" for r in REGION_REQUEST)


def _region_request(spark):
    """The requested region ids as a relation (one SQL call, no driver-side rows)."""
    return spark.sql(f"SELECT region_id FROM VALUES {_REGION_VALUES} AS t(region_id)")


@register("region_rows", oracle_with("err", "station") +
          f"SELECT {SQL_CONTRACT_COLS.replace('wmo_index', 'e.wmo_index')}, s.name AS station_name FROM err e "
          "JOIN (SELECT DISTINCT wmo_index FROM station "
          f"      WHERE region_id IN (SELECT * FROM (VALUES {_REGION_VALUES}) v(r))) k ON k.wmo_index = e.wmo_index "
          "LEFT JOIN station s ON s.wmo_index = e.wmo_index")
def q_region_rows(spark, sf):
    from skyledger.operators.dimension import stations_for_regions
    station = fx.station(spark, sf)
    ids, _unknown = stations_for_regions(station, _region_request(spark))
    rows = mx.select_rows(fx.mart_rows(spark, sf), stations=ids)
    return mx.to_contract_rows(mx.attach_station_names(rows, station).orderBy("day", "wmo_index"))


@register("unknown_regions",
          f"SELECT r AS region_id FROM (VALUES {_REGION_VALUES}) v(r) "
          "WHERE r NOT IN (SELECT CAST(n_regionkey AS VARCHAR) FROM customer JOIN nation ON c_nationkey = n_nationkey)")
def q_unknown_regions(spark, sf):
    from skyledger.operators.dimension import stations_for_regions
    _ids, unknown = stations_for_regions(fx.station(spark, sf), _region_request(spark))
    return unknown


# -- A3 / J9 / W2 / U5 ----------------------------------------------------------------

_COV = oracle_with("err", "station") .rstrip() + ",\n" + fx.ORACLE_REQUESTS.strip() + "\n"


@register("covered_days", _COV + "SELECT request_id, day FROM covered")
def q_covered_days(spark, sf):
    rs, rr = fx.coverage_requests(spark, sf)
    return cov.covered_days(fx.mart_table(spark, sf), rs, rr)


@register("missing_days", _COV + "SELECT request_id, day FROM missing")
def q_missing_days(spark, sf):
    rs, rr = fx.coverage_requests(spark, sf)
    return cov.missing_days(fx.mart_table(spark, sf), rs, rr)


@register("missing_ranges", _COV + "SELECT request_id, range_start, range_end FROM ranges")
def q_missing_ranges(spark, sf):
    rs, rr = fx.coverage_requests(spark, sf)
    return cov.missing_ranges(fx.mart_table(spark, sf), rs, rr)


@register("need_info_requests", _COV +
          "SELECT r.request_id, d.dataset_type, r.range_start AS date_from, r.range_end AS date_to, "
          "sha256(r.request_id || '|' || d.dataset_type || '|' || CAST(r.range_start AS VARCHAR) || '|' "
          "       || CAST(r.range_end AS VARCHAR)) AS trace_id, n.n_stations "
          "FROM ranges r JOIN (VALUES ('actual'), ('forecast')) d(dataset_type) ON TRUE "
          "LEFT JOIN need n ON n.request_id = r.request_id")
def q_need_info_requests(spark, sf):
    rs, rr = fx.coverage_requests(spark, sf)
    return cov.need_info_requests(cov.missing_ranges(fx.mart_table(spark, sf), rs, rr), rs)


# -- the read path: rows when covered, else what is missing ------------------------------

_READ = oracle_with("err").rstrip() + """
    , rr AS (SELECT 'rd-' || wmo_index AS request_id, wmo_index, min(day) AS date_from,
                    min(day) + CAST(CAST(wmo_index AS BIGINT) % 4 * 2 AS INTEGER) + CASE WHEN CAST(wmo_index AS BIGINT) % 10 = 9 THEN 400 ELSE 0 END AS date_to
             FROM err GROUP BY wmo_index),
    ok AS (SELECT * FROM rr WHERE date_to - date_from + 1 <= 365),
    cal AS (SELECT request_id, wmo_index, CAST(d AS DATE) AS day
            FROM ok, generate_series(CAST(date_from AS TIMESTAMP), CAST(date_to AS TIMESTAMP), INTERVAL 1 DAY) t(d)),
    missing AS (SELECT request_id, day FROM cal WHERE (wmo_index, day) NOT IN (SELECT (wmo_index, day) FROM err)),
    ranges AS (
        SELECT request_id, min(day) AS range_start, max(day) AS range_end
        FROM (SELECT request_id, day, day - CAST(row_number() OVER (PARTITION BY request_id ORDER BY day) AS INTEGER) AS g FROM missing)
        GROUP BY request_id, g)
"""


def _read_requests(spark, sf):
    """One request per station, from its first day on: one, three, five or seven days, some over a year."""
    id_ = F.col("wmo_index").cast("bigint")
    per = fx.mart_rows(spark, sf).groupBy("wmo_index").agg(F.min("day").alias("date_from"))
    days = (id_ % 4 * 2 + F.when(id_ % 10 == 9, 400).otherwise(0)).cast("int")
    ranges = per.select(F.concat(F.lit("rd-"), "wmo_index").alias("request_id"), "wmo_index", "date_from", F.date_add("date_from", days).alias("date_to"))
    return cov.read_path(fx.mart_table(spark, sf), ranges.select("request_id", "wmo_index"), ranges.select("request_id", "date_from", "date_to"))


@register("read_path_rows", _READ + f"""
    SELECT ok.request_id, {SQL_CONTRACT_COLS.replace('wmo_index', 'e.wmo_index')} FROM ok JOIN err e ON e.wmo_index = ok.wmo_index AND e.day BETWEEN ok.date_from AND ok.date_to
    WHERE ok.request_id NOT IN (SELECT request_id FROM missing)""")
def q_read_path_rows(spark, sf):
    rows, _, _ = _read_requests(spark, sf)
    ids = rows.select("request_id", *ROW_COLUMNS)
    return mx.to_contract_rows(ids)


@register("read_path_need_info", _READ + """
    SELECT r.request_id, d.dataset_type, r.range_start AS date_from, r.range_end AS date_to,
           sha256(r.request_id || '|' || d.dataset_type || '|' || CAST(r.range_start AS VARCHAR) || '|'
                  || CAST(r.range_end AS VARCHAR)) AS trace_id, CAST(1 AS BIGINT) AS n_stations
    FROM ranges r JOIN (VALUES ('actual'), ('forecast')) d(dataset_type) ON TRUE""")
def q_read_path_need_info(spark, sf):
    return _read_requests(spark, sf)[1]


@register("read_path_refused", _READ + """
    SELECT request_id, CAST(date_to - date_from + 1 AS INTEGER) AS span_days, 'RANGE_TOO_LARGE' AS error_code
    FROM rr WHERE date_to - date_from + 1 > 365""")
def q_read_path_refused(spark, sf):
    return _read_requests(spark, sf)[2]


# -- A4 / A5 / W3 / F18 / F19 / O4 / P17 -------------------------------------------------

@register("daily_mean_error", oracle_with("err") +
          "SELECT day, " + ", ".join(f"round(avg({f}), 6) AS {f}" for f in ERROR_FIELDS) + " FROM err GROUP BY day")
def q_daily_mean_error(spark, sf):
    return mx.daily_mean_error(fx.mart_rows(spark, sf))


@register("column_max_abs", oracle_with("err") + "SELECT " + ", ".join(
    f"greatest(1e-9, max(abs(coalesce({f}, 0.0)))) AS {f}_max_abs" for f in ERROR_FIELDS) + " FROM err")
def q_column_max_abs(spark, sf):
    return mx.column_max_abs(fx.mart_rows(spark, sf))


@register("severity", oracle_with("err") +
          ", mx AS (SELECT " + ", ".join(f"greatest(1e-9, max(abs(coalesce({f}, 0.0)))) AS {f}_m" for f in ERROR_FIELDS)
          + " FROM err) SELECT e.*, " + ", ".join(
              f"round(CASE WHEN e.{f} IS NULL OR mx.{f}_m = 0 THEN 0.0 ELSE least(abs(e.{f}) / mx.{f}_m, 1.0) END, 9)"
              f" AS {f}_severity" for f in ERROR_FIELDS) + " FROM err e, mx")
def q_severity(spark, sf):
    return mx.severity(fx.mart_rows(spark, sf))


def _kpi_sql():
    from skyledger.functions.scores import KPI_BANDS
    parts = []
    for name, (good, warning, maximum) in KPI_BANDS.items():
        parts.append(
            f"SELECT '{name}' AS kpi, {name} AS value, "
            f"CASE WHEN {name} IS NULL THEN NULL WHEN abs({name}) <= {good} THEN 'good' "
            f"WHEN abs({name}) <= {warning} THEN 'warning' ELSE 'poor' END AS band, "
            f"round(CASE WHEN {name} IS NULL THEN 0.0 ELSE least(abs({name}), {maximum}) / {maximum} END, 9)"
            f" AS needle FROM m")
    return oracle_with("err") + f", m AS (SELECT {_sql_metric_aggs()} FROM err) " + " UNION ALL ".join(parts)


@register("kpi_bands", _kpi_sql())
def q_kpi_bands(spark, sf):
    return mx.kpi_bands(mx.model_metrics(fx.mart_rows(spark, sf)))


def _bias_sql():
    from skyledger.functions.scores import BIAS_DOMAIN as d
    parts = []
    for m in METRICS:
        c = f"{m}_bias"
        parts.append(
            f"SELECT '{c}' AS kpi, {c} AS value, "
            f"round(CASE WHEN {c} IS NULL THEN 0.0 ELSE greatest(-{d}, least({d}, {c})) / {d} * 50.0 END, 9)"
            f" AS position_pct, "
            f"round(CASE WHEN {c} IS NULL THEN 0.0 ELSE least(abs({c}) / {d}, 1.0) END, 9) AS intensity FROM m")
    return oracle_with("err") + f", m AS (SELECT {_sql_metric_aggs()} FROM err) " + " UNION ALL ".join(parts)


@register("bias_scale", _bias_sql())
def q_bias_scale(spark, sf):
    return mx.bias_scale(mx.model_metrics(fx.mart_rows(spark, sf)))


@register("sorted_nulls_last_asc", oracle_with("err") +
          f"SELECT {SQL_CONTRACT_COLS} FROM err ORDER BY temperature_error ASC NULLS LAST, wmo_index, day")
def q_sorted_asc(spark, sf):
    rows = mx.project_error_rows(fx.mart_rows(spark, sf))
    return mx.to_contract_rows(mx.sort_rows(rows, "temperature_error", descending=False, tie=["wmo_index", "day"]))


@register("sorted_nulls_last_desc", oracle_with("err") +
          f"SELECT {SQL_CONTRACT_COLS} FROM err ORDER BY precipitation_mm_error DESC NULLS LAST, wmo_index, day")
def q_sorted_desc(spark, sf):
    rows = mx.project_error_rows(fx.mart_rows(spark, sf))
    return mx.to_contract_rows(mx.sort_rows(rows, "precipitation_mm_error", descending=True, tie=["wmo_index", "day"]))


_TREND_FIELDS = [f"{m}_{k}" for m in METRICS for k in ("mae", "bias")]


@register("trend_series", oracle_with("err") + f", d AS (SELECT day, {_sql_metric_aggs()} FROM err GROUP BY day) "
          "SELECT day, series, value FROM (UNPIVOT d ON " + ", ".join(_TREND_FIELDS) +
          " INTO NAME series VALUE value) WHERE value IS NOT NULL")
def q_trend_series(spark, sf):
    daily = mx.model_metrics_daily(fx.mart_rows(spark, sf))
    return mx.to_series(daily, _TREND_FIELDS)


# -- P14 / P16 / F23 over a request log derived from orders ---------------------------------

def _request_log(spark, sf):
    """One request per order: ``from`` = order date, ``to`` = from + (custkey mod 400) - 100
    days, written with slashes for low-priority orders (a malformed date), and
    ``custkey mod 3`` stations."""
    o = dt.table(spark, sf, "orders")
    d_from = o.o_orderdate.cast("date")
    d_to = F.date_add(d_from, (o.o_custkey % 400 - 100).cast("int"))
    to_text = F.when(o.o_orderpriority == "5-LOW", F.date_format(d_to, "yyyy/MM/dd")) \
        .otherwise(F.date_format(d_to, "yyyy-MM-dd"))
    return o.select(o.o_orderkey.alias("request_id"), F.date_format(d_from, "yyyy-MM-dd").alias("date_from"),
                    to_text.alias("date_to"), (o.o_custkey % 3).cast("int").alias("n_stations"))


_REQUEST_LOG_SQL = """
    reqlog AS (
        SELECT o_orderkey AS request_id, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date_from,
               CASE WHEN o_orderpriority = '5-LOW'
                    THEN strftime(CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 - 100 AS INTEGER), '%Y/%m/%d')
                    ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 - 100 AS INTEGER), '%Y-%m-%d') END
                   AS date_to,
               CAST(o_custkey % 3 AS INTEGER) AS n_stations
        FROM orders),
    parsed AS (
        SELECT *, CASE WHEN regexp_full_match(date_from, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                       THEN CAST(try_strptime(date_from, '%Y-%m-%d') AS DATE) END AS df,
                  CASE WHEN regexp_full_match(date_to, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                       THEN CAST(try_strptime(date_to, '%Y-%m-%d') AS DATE) END AS dt
        FROM reqlog)
"""


@register("request_checks", "WITH " + _REQUEST_LOG_SQL.strip() + """
    SELECT request_id, date_from, date_to, n_stations,
           CASE WHEN df IS NOT NULL AND dt IS NOT NULL THEN CAST(dt - df + 1 AS INTEGER) END AS span_days,
           CASE WHEN n_stations <= 0 THEN 'EMPTY_SELECTION'
                WHEN df IS NULL OR dt IS NULL THEN 'INVALID_DATE'
                WHEN df > dt THEN 'RANGE_INVERTED'
                WHEN dt - df + 1 > 180 THEN 'RANGE_TOO_LARGE' END AS error_code,
           CASE WHEN n_stations <= 0 THEN 'selection must not be empty'
                WHEN df IS NULL OR dt IS NULL THEN '''from''/''to'' must be dates in YYYY-MM-DD format'
                WHEN df > dt THEN '''from'' must not be after ''to'''
                WHEN dt - df + 1 > 180 THEN 'requested range spans ' || CAST(dt - df + 1 AS VARCHAR)
                                            || ' days, max is 180' END AS error_message
    FROM parsed""")
def q_request_checks(spark, sf):
    return cov.check_requests(_request_log(spark, sf), cov.MAX_OUTER_DAYS)


@register("clamped_ranges", """
    WITH r AS (
        SELECT o_orderkey AS request_id,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 324 MONTH AS DATE) AS date_from,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 324 MONTH AS DATE) + CAST(o_custkey % 400 AS INTEGER) AS date_to,
               CASE WHEN o_orderstatus = 'F' THEN 'to' ELSE 'from' END AS edited
        FROM orders),
    c AS (
        SELECT *,
               least(greatest(date_from, DATE '2022-01-01'), DATE '2026-06-30') AS nf,
               least(greatest(date_to, DATE '2022-01-01'), DATE '2026-06-30') AS nt
        FROM r)
    SELECT request_id, date_from, date_to, edited,
           CASE WHEN edited = 'from' THEN nf
                ELSE CASE WHEN date_from < least(greatest(nt - 179, DATE '2022-01-01'), DATE '2026-06-30')
                          THEN least(greatest(nt - 179, DATE '2022-01-01'), DATE '2026-06-30') ELSE date_from END
           END AS clamped_from,
           CASE WHEN edited = 'from' THEN
                CASE WHEN nf > date_to THEN nf
                     WHEN date_to > least(greatest(nf + 179, DATE '2022-01-01'), DATE '2026-06-30')
                     THEN least(greatest(nf + 179, DATE '2022-01-01'), DATE '2026-06-30') ELSE date_to END
                ELSE nt END AS clamped_to
    FROM c""")
def q_clamped_ranges(spark, sf):
    o = dt.table(spark, sf, "orders")
    d_from = F.add_months(o.o_orderdate.cast("date"), 324)
    req = o.select(o.o_orderkey.alias("request_id"), d_from.alias("date_from"),
                   F.date_add(d_from, (o.o_custkey % 400).cast("int")).alias("date_to"),
                   F.when(o.o_orderstatus == "F", "to").otherwise("from").alias("edited"))
    return cov.clamp_requests(req)


@register("request_fingerprint", """
    SELECT o_orderkey AS request_id,
           '/dashboard/stations/forecast-errors:' || sha256(
               '{"from": "' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '", "stations": ["'
               || CAST(o_custkey AS VARCHAR) || '"], "to": "'
               || strftime(CAST(o_orderdate AS DATE) + 29, '%Y-%m-%d') || '"}') AS cache_key
    FROM orders""")
def q_request_fingerprint(spark, sf):
    o = dt.table(spark, sf, "orders")
    d_from = o.o_orderdate.cast("date")
    key = cov.request_fingerprint(F.lit("/dashboard/stations/forecast-errors"),
                                  F.date_format(d_from, "yyyy-MM-dd"),
                                  F.date_format(F.date_add(d_from, 29), "yyyy-MM-dd"),
                                  F.array(o.o_custkey.cast("string")))
    return o.select(o.o_orderkey.alias("request_id"), key.alias("cache_key"))
