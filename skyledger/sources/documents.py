"""Daily documents and provider payloads.

Two on-disk layouts of the daily documents are read:

* ``document``  — one JSON object ``{date, stations:[...]}`` per file at
  ``<root>/<prefix>/date=<day>.json`` (the producers' format). The range's
  files are read in **one** multi-file scan with an explicit schema.
* ``partitioned`` — what :func:`write_daily_documents` writes: JSON lines of
  measurements under ``<root>/<prefix>/date=<day>/``. Reading it prunes
  partitions by the day range and never gathers a day into one row.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.schemas import DAILY_ARRAYS, DATASET_TABLES, MEASUREMENT, PAYLOAD, RAW_DOC
from skyledger.session import scratch_dir
from skyledger.sources.paths import child_names, make_folder, remove_tree, replace_object


class MissingDays(FileNotFoundError):
    """Days of a requested range without documents."""


class BadDates(ValueError):
    """A range whose ends are no dates."""


SOURCE_KEY_RX = r"([^/]+/date=[0-9]{4}-[0-9]{2}-[0-9]{2}(?:\.json)?)(?:/[^/]*)?$"


def day_strings(date_from: str, date_to: str) -> list[str]:
    """F1 on the driver: the (request-capped) list of days, inclusive."""
    try:
        start, end = date.fromisoformat(date_from), date.fromisoformat(date_to)
    except ValueError as exc:
        raise BadDates(f"not a range of dates: {date_from} to {date_to}") from exc
    return [(start + timedelta(days=i)).isoformat() for i in range((end - start).days + 1)]


def object_keys(dataset: str, date_from: str, date_to: str) -> list[str]:
    """``<prefix>/date=<day>.json`` for every day, inclusive."""
    prefix = DATASET_TABLES[dataset]["prefix"]
    return [f"{prefix}/date={d}.json" for d in day_strings(date_from, date_to)]


def with_source_key(df: DataFrame) -> DataFrame:
    """S3: the source object of each row, cut to ``<prefix>/date=<day>[.json]``."""
    return df.withColumn("raw_object_key", F.regexp_extract(F.col("_metadata.file_path"), SOURCE_KEY_RX, 1))


def scan_daily_documents(spark: SparkSession, root: str, dataset: str, date_from: str, date_to: str,
                         layout: str = "document") -> DataFrame:
    """S1 (+S2, S3, U1): ``date, stations, raw_object_key`` for every day of the range.

    A missing day fails the scan in both layouts, and a document that is not JSON of the
    schema (cut short, a value of another type) fails the run: no day is skipped silently."""
    root = root.rstrip("/")
    if layout == "document":
        paths = [f"{root}/{k}" for k in object_keys(dataset, date_from, date_to)]
        docs = spark.read.schema(RAW_DOC).option("multiLine", "true").option("mode", "FAILFAST").json(paths)
        return with_source_key(docs).select("date", "stations", "raw_object_key")
    prefix = DATASET_TABLES[dataset]["prefix"]
    there = set(child_names(spark, f"{root}/{prefix}"))
    missing = [d for d in day_strings(date_from, date_to) if f"date={d}" not in there]
    if missing:
        raise MissingDays(f"[PATH_NOT_FOUND] no documents of {dataset} for {len(missing)} days, first {missing[0]}")
    lines = spark.read.schema(T.StructType(MEASUREMENT.fields + [T.StructField("date", T.DateType())])) \
        .option("basePath", f"{root}/{prefix}").option("mode", "FAILFAST").json(f"{root}/{prefix}")
    lines = lines.filter(F.col("date").between(F.to_date(F.lit(date_from)), F.to_date(F.lit(date_to))))
    lines = with_source_key(lines)
    return lines.select("date", F.struct(*[f.name for f in MEASUREMENT.fields]).alias("station"), "raw_object_key")


def explode_stations(docs: DataFrame) -> DataFrame:
    """One row per station (``observation_date, station, raw_object_key``).

    Documents whose list is empty or null yield no row. Input already in
    long form (the partitioned layout) passes through."""
    if "station" in docs.columns:
        return docs.select(F.col("date").alias("observation_date"), "station", "raw_object_key")
    return docs.select(F.col("date").alias("observation_date"), F.explode("stations").alias("station"),
                       "raw_object_key")


def write_daily_documents(measurements: DataFrame, root: str, dataset: str, mode: str = "overwrite") -> None:
    """One folder per day under ``<root>/<prefix>/``; each line a measurement.

    Rows are range-partitioned on ``(date, wmo_index)`` before ``partitionBy``:
    each task writes a contiguous station range of one or a few days, and a
    day holding a third of all rows is split over many tasks and files. No day
    is ever gathered into a single row or task."""
    prefix = DATASET_TABLES[dataset]["prefix"]
    cols = [f.name for f in MEASUREMENT.fields]
    out = measurements.select(F.col("date").cast("date").alias("date"), *cols)
    out.repartitionByRange("date", "wmo_index").sortWithinPartitions("date", "wmo_index") \
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date").json(f"{root.rstrip('/')}/{prefix}")


def measurements_by_date(measurements: DataFrame) -> DataFrame:
    """``date, stations`` with each day's list sorted by id, as one row per day.

    The list is a day in one row: a form to look at or send, not one to write from;
    :func:`write_documents` writes the same documents without it."""
    cols = [f.name for f in MEASUREMENT.fields]
    return measurements.groupBy("date").agg(
        F.sort_array(F.collect_list(F.struct(*cols))).alias("stations")).orderBy("date")


def write_documents(spark: SparkSession, measurements: DataFrame, root: str, dataset: str, order: list[str] | None = None) -> None:
    """The producers' objects, one ``{date, stations: [...]}`` per ``<prefix>/date=<day>.json``.

    A day's stations go through one task in order (by id, or ``order``, extra columns of ``measurements``), a line each; the
    first line opens the object and the last one closes it, so no row and no buffer holds a day. All objects are
    written in full before the first one is put in place of an older one, each at once: a reader never sees half
    an object, and a run that breaks off is repeated. Days without measurements are left as they are."""
    prefix, cols = DATASET_TABLES[dataset]["prefix"], [f.name for f in MEASUREMENT.fields]
    order = list(order or ["wmo_index"])
    keys = [F.col(c).asc_nulls_last() for c in order] + [F.col(c) for c in cols if c not in order]
    in_day = Window.partitionBy("date").orderBy(*keys)
    day = F.col("date").cast("date").cast("string")
    station = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    lines = measurements.filter("date IS NOT NULL").select(
        day.alias("date"), station.alias("station"), (F.row_number().over(in_day) == 1).alias("opens"),
        F.lead(F.lit(False), 1, True).over(in_day).alias("closes"))
    value = F.concat(F.when(F.col("opens"), F.concat(F.lit('{"date":"'), "date", F.lit('","stations":[\n'))).otherwise(F.lit("")), "station",
                     F.when(F.col("closes"), F.lit("]}")).otherwise(F.lit(",")))
    copy = scratch_dir(spark, "documents")
    lines.select("date", value.alias("value")).write.partitionBy("date").text(copy)
    make_folder(spark, f"{root.rstrip('/')}/{prefix}")
    for folder in child_names(spark, copy):
        if folder.startswith("date="):
            for name in child_names(spark, f"{copy}/{folder}"):          # one file: a day is one task's
                replace_object(spark, f"{copy}/{folder}/{name}", f"{root.rstrip('/')}/{prefix}/{folder}.json")
    remove_tree(spark, copy)


def stored_stations(spark: SparkSession, root: str, dataset: str, days: list[str]) -> DataFrame:
    """``date, pos, <measurement>`` of the stored documents of some days, by place in their document.

    A day without a document has no rows; nor has one whose document can't be read as JSON of the schema: it counts
    as absent and is written anew."""
    there = set(child_names(spark, f"{root.rstrip('/')}/{DATASET_TABLES[dataset]['prefix']}"))
    paths = [f"{root.rstrip('/')}/{k}" for d in days for k in object_keys(dataset, d, d) if k.rsplit("/", 1)[1] in there]
    with_corrupt = T.StructType([*RAW_DOC.fields, T.StructField("_corrupt", T.StringType())])
    docs = spark.read.schema(with_corrupt).option("multiLine", "true").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_corrupt").json(paths) if paths else spark.createDataFrame([], with_corrupt)
    key_day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), r"date=([0-9-]{10})", 1)) if paths else F.col("date")
    rows = docs.withColumn("_day", key_day).filter("_corrupt IS NULL").select(F.col("_day").alias("date"), F.posexplode("stations").alias("pos", "s"))
    return rows.select("date", "pos", *[F.col(f"s.{f.name}").alias(f.name) for f in MEASUREMENT.fields])


def merge_into_documents(spark: SparkSession, fresh: DataFrame, root: str, dataset: str) -> list[str]:
    """U4 on stored documents: a fresh record replaces the whole old one of its station, at its place in the day's list; other
    stations stay; new ones follow by id. Only the days of ``fresh`` are read and written; returns the keys written.

    ``fresh`` holds a request's days (its range is capped). Of several fresh records of a station and day, the one with
    the greatest values is taken."""
    cols = [f.name for f in MEASUREMENT.fields]
    days = sorted(r.date for r in fresh.select(F.col("date").cast("date").cast("string").alias("date")).filter("date IS NOT NULL").distinct().collect())
    new = fresh.select(F.col("date").cast("date").alias("date"), *cols).withColumn("fresh", F.lit(1)).withColumn("pos", F.lit(None).cast("int"))
    old = stored_stations(spark, root, dataset, days).withColumn("fresh", F.lit(0))
    merged = old.unionByName(new).groupBy("date", "wmo_index").agg(
        F.min("pos").alias("pos"), F.max(F.struct("fresh", *[c for c in cols if c != "wmo_index"])).alias("m"))
    write_documents(spark, merged.select("date", "pos", "wmo_index", *[F.col(f"m.{c}").alias(c) for c in cols if c != "wmo_index"]),
                    root, dataset, order=["pos", "wmo_index"])
    return [f"{DATASET_TABLES[dataset]['prefix']}/date={d}.json" for d in days]


def scan_provider_payload(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Each file is one payload object or an array of them -> ``(source, pos, payload)`` and what can't be read so.

    Files are read whole (one provider response each)."""
    text = spark.read.option("wholetext", "true").text(path).select(
        F.col("_metadata.file_path").alias("source"), "value")
    return split_payload_text(text)


def split_payload_text(text: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(payloads, rejected)`` of response texts. A response is one object or an array; each element keeps its place.

    ``rejected`` has every response that is no JSON (``malformed``), or neither object nor array (``not_a_payload``), and every
    element that is no object or whose fields have other types (``wrong_type``), with its text. An empty array has no rows."""
    keep = [c for c in text.columns if c != value_col]
    once = lambda c: F.explode(F.array(c))  # noqa: E731 - a value out of an array of one is computed once, whatever is asked of it
    read = text.select(*keep, F.col(value_col).alias("_value"), once(F.try_parse_json(F.col(value_col))).alias("_v"))
    opens = F.substring(F.expr("ltrim(' \t\r\n', _value)"), 1, 1)          # of valid JSON
    read = read.withColumn("_shape", F.when(F.col("_v").isNull(), "malformed").when(opens == "{", "OBJECT").when(opens == "[", "ARRAY").otherwise("not_a_payload"))
    elements = F.when(F.col("_shape") == "ARRAY", F.try_variant_get("_v", "$", "array<variant>")).when(F.col("_shape") == "OBJECT", F.array("_v"))
    whole = read.select(*keep, "_value", "_shape", F.posexplode_outer(elements).alias("pos", "_e")).filter("pos IS NOT NULL OR _shape <> 'ARRAY'")
    with_corrupt = T.StructType([*PAYLOAD.fields, T.StructField("_corrupt", T.StringType())])
    parsed = whole.select(*keep, "_value", "_shape", "pos", once(F.to_json("_e")).alias("_text")).withColumn(
        "_p", once(F.from_json("_text", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})))
    ok = F.coalesce(F.col("_text").startswith("{") & F.col("_p").isNotNull() & F.col("_p._corrupt").isNull(), F.lit(False))
    good = parsed.filter(ok).select(*keep, "pos", F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in PAYLOAD.fields]).alias("payload"))
    rejected = parsed.filter(~ok).select(
        *keep, "pos", F.when(F.col("pos").isNull(), F.col("_shape")).otherwise(F.lit("wrong_type")).alias("reason"),
        F.when(F.col("pos").isNull(), F.col("_value")).otherwise(F.col("_text")).alias("raw_value"))
    return good, rejected


def payload_rows(payloads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """parallel arrays -> one row per day of ``daily.time``.

    ``posexplode(time)`` drives the rows and every value array is read with
    ``get`` (null when shorter than ``time``), so the output never extends
    past ``time`` the way ``arrays_zip`` would. Null ``daily`` -> no rows."""
    keep = keep if keep is not None else [c for c in payloads.columns if c != "payload"]
    exploded = payloads.select(*keep, "payload", F.posexplode("payload.daily.time").alias("i", "date"))
    return exploded.select(*keep, "date", *[F.get(F.col(f"payload.daily.{a}"), F.col("i")).alias(a)
                                            for a in DAILY_ARRAYS])


def zip_locations(coords: DataFrame, responses: DataFrame, by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Pair requested locations with responses by position, cut to the shorter side.

    ``coords``: ``[*by], pos, wmo_index, ...``; ``responses``: ``[*by], pos, payload``.
    Returns the pairs and a per-group size report (``mismatch`` when sizes differ)."""
    by = list(by or [])
    pairs = coords.join(responses, [*by, "pos"], "inner")
    c = coords.groupBy(*by).agg(F.count(F.lit(1)).alias("n_locations")) if by else \
        coords.agg(F.count(F.lit(1)).alias("n_locations"))
    r = responses.groupBy(*by).agg(F.count(F.lit(1)).alias("n_responses")) if by else \
        responses.agg(F.count(F.lit(1)).alias("n_responses"))
    report = c.join(r, by, "full_outer") if by else \
        c.select("n_locations", r.select("n_responses").scalar().alias("n_responses"))
    report = report.withColumn("mismatch", F.coalesce("n_locations", F.lit(0)) != F.coalesce("n_responses", F.lit(0)))
    return pairs, report


def merge_measurements(existing: DataFrame, fresh: DataFrame, keys=("date", "wmo_index")) -> DataFrame:
    """U4: keyed union where a fresh record replaces the whole old one (nulls
    included) and all other records are kept — source rank as the version."""
    from skyledger.operators.current import current
    both = existing.withColumn("_rank", F.lit(0)).unionByName(fresh.withColumn("_rank", F.lit(1)))
    return current(both, list(keys), "_rank").drop("_rank")
