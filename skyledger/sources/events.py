"""Event topics as DataFrames.

The source format is a parameter: ``kafka`` on a cluster (``value`` bytes),
or a file format (``text``/``json``) for tests and replays. Values are parsed
with an explicit schema; unparsable payloads are routed to a quarantine
output instead of failing the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_events(spark: SparkSession, fmt: str, path_or_topics: str, *, streaming: bool = True,
                **options) -> DataFrame:
    """Raw event values as a ``value STRING, topic STRING`` frame (streaming by default)."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        df = reader.format("kafka").option("subscribe", path_or_topics).options(**options).load()
        return df.select(F.col("value").cast("string").alias("value"), "topic")
    if fmt == "text":
        df = reader.format("text").options(**options).load(path_or_topics)
        topic = F.regexp_extract(F.col("_metadata.file_path"), r"topic=([^/]+)/", 1)
        return df.select("value", topic.alias("topic"))
    raise ValueError(f"unsupported event source format: {fmt}")


def parse_events(raw: DataFrame, schema: T.StructType, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(parsed, quarantine)``; a value that is not a JSON object of the schema goes to
    quarantine with its text, it does not stop the stream. JSON without ids is parsed: what it
    lacks is for the reader of the events to judge."""
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    # out of an array of one: a filter on it isn't pushed below, where the value would be parsed once more
    parsed = raw.withColumn("_e", F.explode(F.array(F.from_json(F.col(value_col), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))))
    ok = F.coalesce(F.trim(value_col).startswith("{") & F.col("_e").isNotNull() & F.col("_e._corrupt").isNull(), F.lit(False))
    keep = [c for c in raw.columns if c != value_col]
    good = parsed.filter(ok).select(*keep, *[F.col(f"_e.{f.name}").alias(f.name) for f in schema.fields])
    bad = parsed.filter(~ok).select(*keep, F.col(value_col).alias("raw_value"))
    return good, bad


def to_event_values(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """Each row -> one UTF-8 JSON value (nulls kept as ``null``)."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.select(F.to_json(F.struct(*df.columns), opts).alias("value"))


def write_events(df: DataFrame, fmt: str, target: str, *, streaming: bool = False, checkpoint: str | None = None,
                 **options):
    """Write event values to a topic (``kafka``) or to JSON-lines files."""
    values = to_event_values(df)
    if fmt == "kafka":
        if streaming:
            return values.writeStream.format("kafka").option("topic", target) \
                .option("checkpointLocation", checkpoint).options(**options).start()
        values.write.format("kafka").option("topic", target).options(**options).save()
        return None
    if streaming:
        return values.writeStream.format("text").option("path", target) \
            .option("checkpointLocation", checkpoint).options(**options).start()
    values.write.mode("append").text(target)
    return None
