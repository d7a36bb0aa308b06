"""Canonical schemas, the dataset registry and the metric lists."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's contract (names of metrics,
# error columns, datasets and tables).
METRICS = ["temperature", "temp_min", "temp_max", "precipitation_mm"]
ERROR_FIELDS = [f"{m}_{kind}" for m in METRICS for kind in ("error", "abs_error")]
DATASETS = ("actual", "forecast")
DATASET_TABLES = {
    "actual": {"prefix": "actual", "raw": "raw_weather_events",
               "ods": "ods_daily_weather", "dm": "dm_fct_daily_weather"},
    "forecast": {"prefix": "forecast", "raw": "raw_forecast_events",
                 "ods": "ods_daily_forecast", "dm": "dm_fct_daily_forecast"},
}
ERROR_TABLE = "dm_fct_forecast_error"
# The 11 public columns of an error row, in contract order.
ROW_COLUMNS = ["wmo_index", "day", *ERROR_FIELDS, "ingested_at"]

S, D, DT, TS, L, I = (T.StringType(), T.DoubleType(), T.DateType(),
                      T.TimestampType(), T.LongType(), T.IntegerType())


def _struct(*fields):
    return T.StructType([T.StructField(name, typ, True) for name, typ in fields])


MEASUREMENT = _struct(("wmo_index", S), ("name", S), ("country", S), ("min_temp", D),
                      ("avg_temp", D), ("max_temp", D), ("precipitation", D))
RAW_DOC = _struct(("date", DT), ("stations", T.ArrayType(MEASUREMENT)))
RAW = _struct(("source_name", S), ("observation_date", DT), ("wmo_index", S), ("station_name", S),
              ("country", S), ("min_temp", D), ("avg_temp", D), ("max_temp", D), ("precipitation", D),
              ("raw_bucket", S), ("raw_object_key", S), ("event_id", S), ("trace_id", S),
              ("event_created_at", TS), ("ingested_at", TS))
ODS = _struct(("wmo_index", S), ("station_name", S), ("country", S), ("observation_date", DT),
              ("temperature", D), ("temp_min", D), ("temp_max", D), ("precipitation_mm", D),
              ("trace_id", S), ("ingested_at", TS))
DM = _struct(("wmo_index", S), ("day", DT), ("temperature", D), ("temp_min", D), ("temp_max", D),
             ("precipitation_mm", D), ("trace_id", S), ("ingested_at", TS))
ERROR = _struct(("wmo_index", S), ("day", DT), *[(f, D) for f in ERROR_FIELDS],
                ("actual_trace_id", S), ("forecast_trace_id", S), ("ingested_at", TS))
STATION = _struct(("wmo_index", S), ("name", S), ("region_id", S), ("lat", D), ("lng", D))

# Provider payload: one object per location, parallel arrays per day.
DAILY_ARRAYS = ["temperature_2m_mean", "temperature_2m_min", "temperature_2m_max", "precipitation_sum"]
PAYLOAD = _struct(("latitude", D), ("longitude", D), ("elevation", D), ("timezone", S),
                  ("utc_offset_seconds", I),
                  ("daily", _struct(("time", T.ArrayType(DT)),
                                    *[(a, T.ArrayType(D)) for a in DAILY_ARRAYS])))

# Event envelopes (values of the topics).
ENVELOPE = [("event_id", S), ("trace_id", S), ("event_type", S), ("schema_version", I), ("created_at", S)]
NEED_INFO_EVENT = _struct(*ENVELOPE, ("dataset_type", S), ("requested_by", S), ("date_from", S),
                          ("date_to", S), ("wmo_indexes", T.ArrayType(S)), ("reason", S))
RAW_CREATED_EVENT = _struct(*ENVELOPE, ("source_name", S), ("bucket", S), ("object_keys", T.ArrayType(S)),
                            ("date_from", S), ("date_to", S))
DM_READY_EVENT = _struct(*ENVELOPE, ("dataset_type", S), ("date_from", S), ("date_to", S),
                         ("record_count", L))
FAILED_EVENT = _struct(*ENVELOPE, ("stage", S), ("source_name", S), ("reason", S), ("details", S))
# Union of all envelopes: one parse schema for a mixed outcome stream.
ANY_EVENT = _struct(*ENVELOPE, ("dataset_type", S), ("date_from", S), ("date_to", S), ("record_count", L),
                    ("stage", S), ("source_name", S), ("reason", S), ("details", S))
