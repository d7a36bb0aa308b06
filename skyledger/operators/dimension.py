"""Station / region dimension operators.

The dimension can be as large as the station catalogue, so nothing here
assumes it fits in one task: lookups are joins (Catalyst/AQE broadcast them
only when the measured size allows), per-station attributes are reduced with
partial aggregates, and searches are filters plus an ordered limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEARCH_LIMIT_MIN, SEARCH_LIMIT_MAX, SEARCH_LIMIT_DEFAULT = 1, 50, 20


def stations_for_regions(members: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested regions -> distinct station ids, plus the unknown regions.

    ``members`` has ``region_id, wmo_index`` (a station may be listed under
    several regions); ``regions`` has ``region_id``."""
    known = members.select("region_id", "wmo_index").filter(F.col("region_id").isNotNull())
    wanted = regions.select("region_id").distinct()
    ids = known.join(wanted, "region_id", "left_semi").select("wmo_index").distinct()
    unknown = wanted.join(known.select("region_id"), "region_id", "left_anti")
    return ids, unknown


def station_coordinates(ids: DataFrame, station: DataFrame) -> DataFrame:
    """J5 (lenient): every asked id with its coordinates; unknown -> null."""
    return ids.select("wmo_index").join(station.select("wmo_index", "lat", "lng"), "wmo_index", "left")


def unresolvable_stations(ids: DataFrame, station: DataFrame) -> DataFrame:
    """J5 (strict) + P15: asked ids without both coordinates; the strict path fails when non-empty."""
    resolvable = station.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select("wmo_index")
    return ids.select("wmo_index").distinct().join(resolvable, "wmo_index", "left_anti")


def names_for(ids: DataFrame, station: DataFrame) -> DataFrame:
    """``wmo_index -> name`` for the ids that have a name; others are omitted."""
    named = station.select("wmo_index", "name").filter(F.col("name").isNotNull())
    return ids.select("wmo_index").distinct().join(named, "wmo_index", "inner")


def with_region_names(df: DataFrame, regions: DataFrame, id_col: str = "region_id") -> DataFrame:
    """Region id -> name, falling back to the id when the name is unknown."""
    names = regions.select(F.col("id").alias(id_col), F.col("name").alias("region_name"))
    return df.join(names, id_col, "left").withColumn("region_name", F.coalesce("region_name", F.col(id_col)))


def stations_by_region(members: DataFrame) -> DataFrame:
    """Region -> number of listed stations (repeats kept) and distinct stations.

    The region's id list itself is the long ``members`` form (``region_id,
    wmo_index``), so a catalogue-sized region is never gathered into one array."""
    return members.filter(F.col("region_id").isNotNull()).groupBy("region_id").agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.count_distinct("wmo_index").alias("n_distinct_stations"))


def dimension_stats(station: DataFrame, skipped_rows: DataFrame | None = None) -> DataFrame:
    """``stations_loaded`` = #with region + #with coordinates (a station with
    both counts twice), ``stations_with_name``, and rows skipped for a blank id."""
    stats = station.agg(
        (F.count_if(F.col("region_id").isNotNull())
         + F.count_if(F.col("lat").isNotNull() & F.col("lng").isNotNull())).cast("long").alias("stations_loaded"),
        F.count_if(F.col("name").isNotNull()).cast("long").alias("stations_with_name"))
    if skipped_rows is None:
        return stats.withColumn("skipped_no_id", F.lit(0).cast("long"))
    skipped = skipped_rows.agg(F.count(F.lit(1)).cast("long").alias("skipped_no_id")).scalar()
    return stats.withColumn("skipped_no_id", skipped)


def last_non_blank(df: DataFrame, key: str | Sequence[str], attrs: Sequence[str], order: str) -> DataFrame:
    """Per key, the last non-blank value of each attribute in ``order``.

    ``max_by`` with a filter is a partial aggregate, so a key holding a large
    share of the rows is reduced map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = []
    for a in attrs:
        v = F.nullif(F.trim(F.col(a)), F.lit(""))
        aggs.append(F.max_by(v, F.when(v.isNotNull(), F.col(order))).alias(a))
    return df.groupBy(*keys).agg(*aggs)


def clamp_limit(limit: int) -> int:
    return max(SEARCH_LIMIT_MIN, min(int(limit), SEARCH_LIMIT_MAX))


def search_stations(station: DataFrame, q: str, limit: int = SEARCH_LIMIT_DEFAULT,
                    order: str = "name_line") -> DataFrame:
    """Trimmed, lower-cased query; name contains it or id starts with it;
    only named stations; dimension order; limit clamped to 1..50; blank -> nothing."""
    query = (q or "").strip().lower()
    if not query:
        return station.select("wmo_index", "name").limit(0)
    hit = F.lower(F.col("name")).contains(F.lit(query)) | F.col("wmo_index").startswith(F.lit(query))
    return station.filter(F.col("name").isNotNull() & hit).orderBy(order, "wmo_index") \
        .limit(clamp_limit(limit)).select("wmo_index", "name")


def search_regions(regions: DataFrame, q: str) -> DataFrame:
    """Trimmed, case-insensitive contains on the region name; a blank query matches nothing."""
    query = (q or "").strip().lower()
    if not query:
        return regions.limit(0)
    return regions.filter(F.lower(F.col("name")).contains(F.lit(query)))


def station_label(station: DataFrame) -> DataFrame:
    """F32: ``name (id)``, or the id alone when there is no name."""
    return station.withColumn(
        "label", F.coalesce(F.concat(F.col("name"), F.lit(" ("), F.col("wmo_index"), F.lit(")")), F.col("wmo_index")))
