"""Station dimension from the ``WMO_index,Station,Region,Latitude,Longitude`` CSV.

All fields are read as text (no inference), trimmed; rows without an id are
counted as skipped; for each station the last non-blank name / region /
coordinate pair in file order wins (W4), while the region membership list
keeps every row (a station listed under two regions belongs to both).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("WMO_index", "Station", "Region", "Latitude", "Longitude")])
# Fixed value: the float syntax of the dimension loader (Python's ``float``): digits with
# single underscores between them, optional fraction and exponent, or nan/inf/infinity.
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER_RX = (rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
             r"|(?i:nan|inf|infinity))$")


def _blank_to_null(c: str) -> F.Column:
    """trim; blank -> null."""
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def _safe_double(c: F.Column) -> F.Column:
    """float parse with the loader's syntax; failure -> null. The regex keeps
    Spark-only forms (``1.0d``) out and lets ``1_000.5`` and ``nan`` in."""
    return F.when(c.rlike(NUMBER_RX), F.regexp_replace(c, "_", "").try_cast("double"))


def read_station_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV rows in file order with an explicit ``line_no`` (file name, then offset). A quoted
    field may span lines and hold doubled quotes."""
    raw = spark.read.schema(CSV_SCHEMA).option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    raw = raw.select("*", F.col("_metadata.file_name").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"))
    # Line order = (file, split offset, position inside the split): exact file
    # order without numbering all rows in a single task.
    line_no = F.struct(F.col("_file"), F.col("_block"), F.monotonically_increasing_id().alias("pos"))
    return raw.withColumn("line_no", line_no).select(
        _blank_to_null("WMO_index").alias("wmo_index"), _blank_to_null("Station").alias("name"),
        _blank_to_null("Region").alias("region_id"), _blank_to_null("Latitude").alias("lat_text"),
        _blank_to_null("Longitude").alias("lng_text"), "line_no")


def station_members(rows: DataFrame) -> DataFrame:
    """A8 input: ``region_id, wmo_index, line_no`` for every row with both."""
    return rows.filter(F.col("wmo_index").isNotNull() & F.col("region_id").isNotNull()) \
        .select("region_id", "wmo_index", "line_no")


def station_dimension(rows: DataFrame) -> DataFrame:
    """``station`` schema + ``line_no`` (first appearance, for dimension order)."""
    valid = rows.filter(F.col("wmo_index").isNotNull())
    lat, lng = _safe_double(F.col("lat_text")), _safe_double(F.col("lng_text"))
    coords_ok = F.col("lat_text").isNotNull() & F.col("lng_text").isNotNull() & lat.isNotNull() & lng.isNotNull()
    coord = F.when(coords_ok, F.struct(lat.alias("lat"), lng.alias("lng")))
    last_line = F.col("line_no")
    agg = valid.groupBy("wmo_index").agg(
        F.max_by(F.col("name"), F.when(F.col("name").isNotNull(), last_line)).alias("name"),
        F.max_by(F.col("region_id"), F.when(F.col("region_id").isNotNull(), last_line)).alias("region_id"),
        F.max_by(coord, F.when(coord.isNotNull(), last_line)).alias("_c"),
        F.min("line_no").alias("line_no"),
        # Search order: where the station first got a name (the name map's insertion order).
        F.min(F.when(F.col("name").isNotNull(), F.col("line_no"))).alias("name_line"))
    return agg.select("wmo_index", "name", "region_id", F.col("_c.lat").alias("lat"), F.col("_c.lng").alias("lng"),
                      "line_no", "name_line")


def skipped_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("wmo_index").isNull())


def scan_station_dimension(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(station, members, skipped)``."""
    rows = read_station_rows(spark, path)
    return station_dimension(rows), station_members(rows), skipped_rows(rows)
