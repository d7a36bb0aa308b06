"""Read path over the current error mart: rows, top-k, model metrics, chart maths.

All operators take the (current) error mart as a DataFrame and return lazy
plans; ``between_days`` filters reach the parquet scan, and when the mart is
stored partitioned by ``month`` the month predicate prunes partitions too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import scores
from skyledger.schemas import ERROR_FIELDS, METRICS, ROW_COLUMNS


def check_metric(name: str) -> Column:
    """Only the 8 error columns may reach a query (identifier allowlist)."""
    if name not in ERROR_FIELDS:
        raise ValueError(f"unknown metric: {name}")
    return F.col(name)


def between_days(df: DataFrame, date_from: str | None, date_to: str | None, day_col: str = "day") -> DataFrame:
    """Inclusive on both ends; ``from > to`` yields no rows.

    Adds the ``month`` predicate as well when the frame carries the month
    partition column, so a partitioned table is pruned, not just filtered."""
    cond = F.lit(True)
    if date_from is not None:
        cond = cond & (F.col(day_col) >= F.to_date(F.lit(date_from)))
    if date_to is not None:
        cond = cond & (F.col(day_col) <= F.to_date(F.lit(date_to)))
    if "month" in df.columns:
        if date_from is not None:
            cond = cond & (F.col("month") >= F.lit(date_from[:7].replace("-", "")))
        if date_to is not None:
            cond = cond & (F.col("month") <= F.lit(date_to[:7].replace("-", "")))
    return df.filter(cond)


def stations_in(df: DataFrame, stations: DataFrame | Sequence[str], col: str = "wmo_index") -> DataFrame:
    """IN-list for a literal list, a left-semi join for a DataFrame of ids."""
    if isinstance(stations, DataFrame):
        return df.join(stations.select(F.col(stations.columns[0]).alias(col)), col, "left_semi")
    return df.filter(F.col(col).isin(list(stations)))


def project_error_rows(df: DataFrame) -> DataFrame:
    """P5: the 11 public columns."""
    return df.select(*ROW_COLUMNS)


def select_rows(error: DataFrame, *, stations=None, date_from=None, date_to=None) -> DataFrame:
    """P6 + P7 + P5."""
    rows = between_days(error, date_from, date_to)
    if stations is not None:
        rows = stations_in(rows, stations)
    return project_error_rows(rows)


def rows_by_stations(error: DataFrame, stations, date_from=None, date_to=None) -> DataFrame:
    """O1: rows for the stations, ordered by ``day, wmo_index``."""
    return select_rows(error, stations=stations, date_from=date_from, date_to=date_to).orderBy("day", "wmo_index")


def attach_station_names(rows: DataFrame, station: DataFrame) -> DataFrame:
    """Left lookup of ``station_name``; missing -> null. Row count is kept.

    The dimension is reduced to one name per id before the join so the lookup
    can never multiply rows; Catalyst/AQE broadcast it when its size allows."""
    names = station.select("wmo_index", F.col("name").alias("station_name")) \
        .filter(F.col("station_name").isNotNull()) \
        .groupBy("wmo_index").agg(F.max("station_name").alias("station_name"))
    return rows.join(names, "wmo_index", "left")


def top_errors(error: DataFrame, metric: str, date_from=None, date_to=None, limit: int = 100) -> DataFrame:
    """O2 + P8: largest first, nulls removed; ties broken by ``wmo_index, day``."""
    m = check_metric(metric)
    rows = between_days(error, date_from, date_to).filter(m.isNotNull())
    return project_error_rows(rows).orderBy(m.desc(), F.col("wmo_index"), F.col("day")).limit(int(limit))


def _metric_aggs(digits: int | None) -> list[Column]:
    """``rows_count`` + MAE/bias per metric, as SQL expressions (one driver call each)."""
    def r(e: str) -> str:
        return f"round({e}, {digits})" if digits is not None else e
    aggs = [F.expr("CAST(count(1) AS BIGINT) AS rows_count")]
    for m in METRICS:
        aggs.append(F.expr(f"{r(f'avg({m}_abs_error)')} AS {m}_mae"))
        aggs.append(F.expr(f"{r(f'avg({m}_error)')} AS {m}_bias"))
    return aggs


def model_metrics(error: DataFrame, date_from=None, date_to=None, digits: int | None = 6) -> DataFrame:
    """A1: one row — ``rows_count`` and MAE/bias per metric. Empty input: 0 and nulls."""
    return between_days(error, date_from, date_to).agg(*_metric_aggs(digits))


def model_metrics_daily(error: DataFrame, date_from=None, date_to=None, digits: int | None = 6) -> DataFrame:
    """A2: A1 per day, ordered by day; absent days stay absent."""
    return between_days(error, date_from, date_to).groupBy("day").agg(*_metric_aggs(digits)).orderBy("day")


def daily_mean_error(rows: DataFrame, fields: Sequence[str] = ERROR_FIELDS, digits: int | None = 6) -> DataFrame:
    """A4: per-day average over stations of each field, ignoring nulls (null if none)."""
    def r(c):
        return F.round(c, digits) if digits is not None else c
    return rows.groupBy("day").agg(*[r(F.avg(f)).alias(f) for f in fields])


def column_max_abs(rows: DataFrame, fields: Sequence[str] = ERROR_FIELDS) -> DataFrame:
    """A5: largest magnitude per field (null counts as 0), floored at 1e-9."""
    return rows.selectExpr(*[f"greatest(1e-9, max(abs(coalesce({f}, 0.0)))) AS {f}_max_abs" for f in fields])


def severity(rows: DataFrame, fields: Sequence[str] = ERROR_FIELDS, digits: int | None = 9) -> DataFrame:
    """``min(|x| / max_abs, 1)`` per field; 0 when null.

    The column maxima are one global partial/final aggregate evaluated once as
    a scalar subquery returning a struct, bound to one column and read field by
    field — no join and no window over the whole table."""
    maxima = column_max_abs(rows, fields).selectExpr("struct(*) AS m").scalar()
    bound = rows.withColumn("_m", maxima)
    def r(e: str) -> str:
        return f"round({e}, {digits})" if digits is not None else e
    sev = [f"{r(f'CASE WHEN {f} IS NULL OR _m.{f}_max_abs = 0 THEN 0.0 ELSE least(abs({f}) / _m.{f}_max_abs, 1.0) END')}"
           f" AS {f}_severity" for f in fields]
    return bound.selectExpr(*rows.columns, *sev)


def kpi_bands(metrics_row: DataFrame) -> DataFrame:
    """F18 over the A1 result: band and needle per MAE metric (long form)."""
    parts = []
    for name, (good, warning, maximum) in scores.KPI_BANDS.items():
        v = F.col(name)
        parts.append(F.struct(F.lit(name).alias("kpi"), v.alias("value"),
                              scores.kpi_band(v, good, warning).alias("band"),
                              F.round(scores.needle_position(v, maximum), 9).alias("needle")))
    return metrics_row.select(F.explode(F.array(*parts)).alias("k")).select("k.*")


def bias_scale(metrics_row: DataFrame, domain: float = scores.BIAS_DOMAIN) -> DataFrame:
    """F19 over the A1 result: position and intensity per bias metric (long form)."""
    parts = []
    for m in METRICS:
        v = F.col(f"{m}_bias")
        parts.append(F.struct(F.lit(f"{m}_bias").alias("kpi"), v.alias("value"),
                              F.round(scores.bias_position(v, domain), 9).alias("position_pct"),
                              F.round(scores.bias_intensity(v, domain), 9).alias("intensity")))
    return metrics_row.select(F.explode(F.array(*parts)).alias("k")).select("k.*")


def sort_rows(df: DataFrame, column: str, descending: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """Nulls last in both directions (Spark's plain ``asc`` puts nulls first).

    A global sort: range-partitioned by sampling, so it scales without a single task."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), *tie)


def to_series(rows: DataFrame, fields: Sequence[str], id_cols: Sequence[str] = ("day",)) -> DataFrame:
    """Wide -> long ``(series, value)`` per field; null points dropped."""
    long = rows.unpivot(list(id_cols), list(fields), "series", "value")
    return long.filter(F.col("value").isNotNull())


def to_contract_rows(df: DataFrame) -> DataFrame:
    """Fixed column list, dates and timestamps as ISO strings."""
    out = []
    for field in df.schema.fields:                   # one schema fetch
        typ, c = field.dataType.typeName(), field.name
        if typ == "date":
            out.append(f"date_format({c}, 'yyyy-MM-dd') AS {c}")
        elif typ.startswith("timestamp"):
            out.append(f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS {c}")
        else:
            out.append(c)
    return df.selectExpr(*out)
