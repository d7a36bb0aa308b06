"""The fetch chain as one plan: need-info events -> locations -> provider responses -> documents -> manifests.

The provider is asked for an event's resolvable stations in order and answers by position, so responses are paired with
locations by place. An unreadable response fails its event and writes nothing of it; the other events' days
are merged into the stored documents once, and each event gets the manifest of the days that it wrote, or a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.text import empty_if_null
from skyledger.operators import requests as rq
from skyledger.session import staged
from skyledger.sources import documents as docs

FETCH_STAGE, FETCH_SOURCE = "fetch", "fetcher"


def locations(events: DataFrame, station: DataFrame) -> DataFrame:
    """``event_id, pos, wmo_index, name, lat, lng``: an event's stations that have coordinates, in its order."""
    asked = events.select("event_id", F.posexplode("wmo_indexes").alias("place", "wmo_index"))
    known = station.filter("lat IS NOT NULL AND lng IS NOT NULL").select("wmo_index", "name", "lat", "lng")
    in_event = Window.partitionBy("event_id").orderBy("place")          # the list of one event
    return asked.join(known, "wmo_index").withColumn("pos", F.row_number().over(in_event) - 1).drop("place")


def fetch_chain(spark: SparkSession, need_info: DataFrame, station: DataFrame, responses: DataFrame, root: str,
                dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(manifests, failures, mismatches)`` of all need-info events of a dataset.

    ``responses``: ``event_id, value`` (the provider's text). ``mismatches``: events whose response has another
    number of elements than locations were asked for; pairs are cut to the shorter side (J8)."""
    events = rq.valid_need_info(rq.route_need_info(need_info, dataset))
    coords = locations(events, station)
    payloads, rejected = docs.split_payload_text(responses.select("event_id", "value"))
    unread = staged(rejected.join(events.select("event_id"), "event_id", "left_semi").groupBy("event_id").agg(F.min("reason").alias("reason")), "unread")
    answered = events.join(unread.select("event_id"), "event_id", "left_anti")
    pairs, report = docs.zip_locations(coords.join(answered.select("event_id"), "event_id", "left_semi"), payloads, by=["event_id"])
    days = docs.payload_rows(pairs, keep=["event_id", "wmo_index", "name"])
    ranges = answered.select("event_id", F.col("date_from").try_cast("date").alias("f"), F.col("date_to").try_cast("date").alias("t"))
    rows = staged(days.join(ranges, "event_id").filter("date BETWEEN f AND t").select(
        "event_id", "date", "wmo_index", empty_if_null(F.col("name")).alias("name"), F.lit("").alias("country"),
        F.col("temperature_2m_min").alias("min_temp"), F.col("temperature_2m_mean").alias("avg_temp"),
        F.col("temperature_2m_max").alias("max_temp"), F.col("precipitation_sum").alias("precipitation")), "fetched")
    docs.merge_into_documents(spark, rows.drop("event_id"), root, dataset)
    manifests, empty = rq.build_manifests(answered, rq.days_by_event(rows.select("event_id", F.col("date").alias("day"))))
    broken = events.join(unread, "event_id").select("trace_id", *rq.failure_envelope(
        F.lit(FETCH_STAGE), F.lit(FETCH_SOURCE), F.col("reason"), F.format_string("unreadable response for event %s", F.col("event_id"))))
    return manifests, empty.unionByName(broken), report.filter("mismatch")
