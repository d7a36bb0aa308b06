"""Coverage and backfill planning over a *table of requests*.

A request is ``request_id`` + a station set (``request_stations``: one row per
``(request_id, wmo_index)``) + an inclusive day range (``request_ranges``:
``request_id, date_from, date_to`` as DATE). Many requests are answered by one
plan: the mart, pruned to the days of all requests together, becomes one row per
station and month with a bit for each day, which are joined with the requested
stations and ANDed per ``(request, month)``. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import monthbits as mb
from skyledger.functions.text import json_string
from skyledger.schemas import DATASETS

# Fixed values of the request contract.
MAX_OUTER_DAYS = 180
MAX_INNER_DAYS = 365
REQUEST_MIN_DATE = "2022-01-01"
REQUEST_MAX_DATE = "2026-06-30"
ISO_DATE_RX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def day_list_sql(date_from: str, date_to: str) -> str:
    """F1 as SQL text: inclusive list of days; empty (not an error) when ``from > to`` or either is null."""
    return (f"CASE WHEN {date_from} <= {date_to} THEN sequence({date_from}, {date_to}, INTERVAL 1 DAY) "
            f"ELSE CAST(array() AS array<date>) END")


def day_list(date_from: Column, date_to: Column) -> Column:
    """inclusive list of days; empty (not an error) when ``from > to`` or either is null."""
    return F.when(date_from <= date_to, F.sequence(date_from, date_to, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))


def span_days(date_from: Column, date_to: Column) -> Column:
    """inclusive span in days."""
    return F.datediff(date_to, date_from) + F.lit(1)


def strict_iso_date(s: Column) -> Column:
    """``yyyy-MM-dd`` only; anything else (or an impossible date) -> null."""
    return F.when(s.rlike(ISO_DATE_RX), F.try_to_date(s, "yyyy-MM-dd"))


def calendar(spark, date_from: str, date_to: str) -> DataFrame:
    """One row per day of the inclusive range; empty when ``from > to``."""
    return spark.range(1).select(
        F.explode(day_list(F.to_date(F.lit(date_from)), F.to_date(F.lit(date_to)))).alias("day"))


def request_calendar(request_ranges: DataFrame) -> DataFrame:
    """U6 per request: ``(request_id, day)``."""
    return request_ranges.selectExpr("request_id", f"explode({day_list_sql('date_from', 'date_to')}) AS day")


def _asked_rows(error: DataFrame, request_ranges: DataFrame) -> DataFrame:
    """The mart's rows of the days of all requests together: months (when it has them) and row groups are pruned."""
    bounds = request_ranges.agg(F.struct(F.min("date_from").alias("f"), F.max("date_to").alias("t"))).scalar()
    rows = error.filter((F.col("day") >= bounds["f"]) & (F.col("day") <= bounds["t"]))
    if "month" in error.columns:
        rows = rows.filter((F.col("month") >= F.date_format(bounds["f"], "yyyyMM")) & (F.col("month") <= F.date_format(bounds["t"], "yyyyMM"))).drop("month")
    return rows


def _asked_stations(request_stations: DataFrame, request_ranges: DataFrame) -> DataFrame:
    return request_stations.select("request_id", "wmo_index").distinct() \
        .join(request_ranges.select("request_id", "date_from", "date_to"), "request_id")


def requested_rows(error: DataFrame, request_stations: DataFrame, request_ranges: DataFrame) -> DataFrame:
    """The mart's rows of each request: one per (request, station, day) that is there.

    The join is on the station, and a row is kept for the requests whose range holds its day. Cells that the
    mart lacks are never generated."""
    asked = _asked_stations(request_stations, request_ranges)
    return _asked_rows(error, request_ranges).join(asked, "wmo_index").filter("day BETWEEN date_from AND date_to").drop("date_from", "date_to")


def covered_months(error: DataFrame, request_stations: DataFrame, request_ranges: DataFrame) -> DataFrame:
    """``request_id, month_start, bits``: the days on which **every** requested station has a mart row, as bits.

    Stations become one row a month before they meet the requests; a request's stations are then ANDed, and a
    month counts only if all of them have a row of it."""
    columns = [c for c in ("wmo_index", "day", "month") if c in error.columns]
    present = _asked_rows(error.select(*columns), request_ranges).groupBy("wmo_index", F.expr(f"{mb.month_of('day')} AS month_start")) \
        .agg(F.expr(f"bit_or({mb.bit_of('day')}) AS bits"))
    need = request_stations.groupBy("request_id").agg(F.countDistinct("wmo_index").alias("n_stations"))
    met = present.join(_asked_stations(request_stations, request_ranges), "wmo_index") \
        .filter("month_start <= date_to AND last_day(month_start) >= date_from AND date_from <= date_to")
    both = met.groupBy("request_id", "month_start").agg(F.expr(f"bit_and(bits & {mb.range_bits('month_start', 'date_from', 'date_to')}) AS bits"), F.expr("count(1) AS n_there"))
    return both.join(need, "request_id").filter("n_there = n_stations AND bits <> 0").select("request_id", "month_start", "bits")


def covered_days(error: DataFrame, request_stations: DataFrame, request_ranges: DataFrame) -> DataFrame:
    """A3: ``(request_id, day)`` where **every** requested station has a mart row.

    Exact: station sets are de-duplicated, and versions of a day set the same bit."""
    return covered_months(error, request_stations, request_ranges).selectExpr("request_id", f"explode({mb.days_of('month_start', 'bits')}) AS day")


def missing_months(error: DataFrame, request_stations: DataFrame, request_ranges: DataFrame) -> DataFrame:
    """``request_id, month_start, bits`` of the days of a request's range that are not covered."""
    months = request_ranges.selectExpr("request_id", "date_from", "date_to", f"explode({mb.months_between('date_from', 'date_to')}) AS month_start")
    asked = months.selectExpr("request_id", "month_start", f"{mb.range_bits('month_start', 'date_from', 'date_to')} AS asked")
    covered = covered_months(error, request_stations, request_ranges)
    return asked.join(covered, ["request_id", "month_start"], "left") \
        .selectExpr("request_id", "month_start", "asked & ~coalesce(bits, 0L) AS bits").filter("bits <> 0")


def missing_days(error: DataFrame, request_stations: DataFrame, request_ranges: DataFrame) -> DataFrame:
    """Calendar minus covered days, per request."""
    return missing_months(error, request_stations, request_ranges).selectExpr("request_id", f"explode({mb.days_of('month_start', 'bits')}) AS day")


def contiguous_ranges(days: DataFrame, by: list[str] | tuple[str, ...] = ("request_id",),
                      day_col: str = "day") -> DataFrame:
    """Gaps-and-islands; a new range starts when the gap exceeds one day.

    ``day - row_number()`` is constant inside an island. The window is per
    request, whose day count is bounded by the request-range cap."""
    by = list(by)
    distinct_days = days.select(*by, day_col).distinct()
    grp = (f"date_sub({day_col}, CAST(row_number() OVER (PARTITION BY {', '.join(by)} ORDER BY {day_col}) AS INT))"
           " AS _grp")
    return distinct_days.selectExpr(*by, day_col, grp).groupBy(*by, "_grp") \
        .agg(F.expr(f"min({day_col}) AS range_start"), F.expr(f"max({day_col}) AS range_end")).drop("_grp")


def missing_ranges(error: DataFrame, request_stations: DataFrame, request_ranges: DataFrame) -> DataFrame:
    return contiguous_ranges(missing_days(error, request_stations, request_ranges))


def need_info_requests(ranges: DataFrame, request_stations: DataFrame | None = None) -> DataFrame:
    """Every missing range is requested for both datasets, for all stations of the request.

    ``trace_id`` is derived from the content (request, dataset, range), so a
    replayed plan asks for the same trace instead of a new one."""
    datasets = ", ".join(f"'{d}'" for d in DATASETS)
    out = ranges.selectExpr("request_id", f"explode(array({datasets})) AS dataset_type",
                            "range_start AS date_from", "range_end AS date_to")
    out = out.selectExpr("*", "sha2(concat_ws('|', request_id, dataset_type, CAST(date_from AS STRING), "
                              "CAST(date_to AS STRING)), 256) AS trace_id")
    if request_stations is not None:
        counts = request_stations.select("request_id", "wmo_index").distinct() \
            .groupBy("request_id").agg(F.expr("count(1) AS n_stations"))
        out = out.join(counts, "request_id", "left")
    return out


def read_path(error: DataFrame, request_stations: DataFrame, request_ranges: DataFrame,
              max_days: int = MAX_INNER_DAYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ready or pending: ``(rows, need_info, refused)`` for a table of requests.

    A request whose days are all covered gets its rows; any other gets the need-info events of
    its missing ranges (and waits on their traces) and no rows. Ranges of more than
    ``max_days`` days are refused before the mart is looked at."""
    too_long = span_days(F.col("date_from"), F.col("date_to")) > max_days
    refused = request_ranges.filter(too_long).select(
        "request_id", span_days(F.col("date_from"), F.col("date_to")).alias("span_days"), F.lit("RANGE_TOO_LARGE").alias("error_code"))
    ranges = request_ranges.filter(~F.coalesce(too_long, F.lit(False)))
    gaps = missing_ranges(error, request_stations, ranges)
    ready = ranges.join(gaps.select("request_id").distinct(), "request_id", "left_anti")
    return requested_rows(error, request_stations, ready), need_info_requests(gaps, request_stations), refused


def check_requests(requests: DataFrame, max_days: int = MAX_OUTER_DAYS,
                   from_col: str = "date_from", to_col: str = "date_to",
                   n_col: str | None = "n_stations") -> DataFrame:
    """Request validation as columns ``error_code`` / ``error_message`` (null when valid)."""
    d_from, d_to = strict_iso_date(F.col(from_col)), strict_iso_date(F.col(to_col))
    span = span_days(d_from, d_to)
    code = F.when(d_from.isNull() | d_to.isNull(), F.lit("INVALID_DATE")) \
        .when(d_from > d_to, F.lit("RANGE_INVERTED")) \
        .when(span > max_days, F.lit("RANGE_TOO_LARGE"))
    message = F.when(d_from.isNull() | d_to.isNull(), F.lit("'from'/'to' must be dates in YYYY-MM-DD format")) \
        .when(d_from > d_to, F.lit("'from' must not be after 'to'")) \
        .when(span > max_days, F.format_string("requested range spans %d days, max is %d", span, F.lit(max_days)))
    if n_col is not None:
        empty = F.coalesce(F.col(n_col), F.lit(0)) <= 0
        code = F.when(empty, F.lit("EMPTY_SELECTION")).otherwise(code)
        message = F.when(empty, F.lit("selection must not be empty")).otherwise(message)
    return requests.withColumn("span_days", F.when(d_from.isNotNull() & d_to.isNotNull(), span)) \
        .withColumn("error_code", code).withColumn("error_message", message)


def _clamp(c: Column, lo: Column, hi: Column) -> Column:
    return F.when(c < lo, lo).when(c > hi, hi).otherwise(c)


def clamp_requests(requests: DataFrame, lo: str = REQUEST_MIN_DATE, hi: str = REQUEST_MAX_DATE,
                   max_days: int = MAX_OUTER_DAYS, edited_col: str = "edited") -> DataFrame:
    """Picker clamping. Editing ``from`` pulls ``to`` back within ``max_days``;
    editing ``to`` pushes ``from`` forward. Dates are DATE columns."""
    lo_c, hi_c = F.to_date(F.lit(lo)), F.to_date(F.lit(hi))
    f, t = F.col("date_from"), F.col("date_to")
    nf = _clamp(f, lo_c, hi_c)
    capped_to = _clamp(F.date_add(nf, max_days - 1), lo_c, hi_c)
    to_after_from_edit = F.when(nf > t, nf).when(t > capped_to, capped_to).otherwise(t)
    nt = _clamp(t, lo_c, hi_c)
    capped_from = _clamp(F.date_sub(nt, max_days - 1), lo_c, hi_c)
    from_after_to_edit = F.when(f < capped_from, capped_from).otherwise(f)
    is_from = F.col(edited_col) == F.lit("from")
    return requests.withColumn("clamped_from", F.when(is_from, nf).otherwise(from_after_to_edit)) \
        .withColumn("clamped_to", F.when(is_from, to_after_from_edit).otherwise(nt))


def request_fingerprint(path: Column, date_from: Column, date_to: Column, ids: Column,
                        ids_key: str = "stations") -> Column:
    """``<path>:<sha256 of the canonical body>``.

    The canonical body is the sorted-key JSON text with ``", "``/``": "``
    separators and ASCII escapes: the byte form of Python's ``json.dumps(sort_keys=True)``."""
    items = {"from": json_string(date_from),
             ids_key: F.concat(F.lit("["), F.array_join(F.transform(ids, json_string), ", "), F.lit("]")),
             "to": json_string(date_to)}
    parts = []
    for i, key in enumerate(sorted(items)):
        parts += [F.lit(("" if i == 0 else ", ") + f'"{key}": '), items[key]]
    body = F.concat(F.lit("{"), *parts, F.lit("}"))
    return F.concat(path, F.lit(":"), F.sha2(body, 256))
