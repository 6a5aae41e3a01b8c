"""Flow records, messages and host documents derived from the given tables.

``events`` becomes the traffic of a small network: twelve sources, the addresses of one
/24 as destinations. ``lineitem`` becomes volume: a source per supplier, a destination per
part. Every row of the table is one flow record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtide.operators.features import features_by_source
from flowtide.operators.flows import project_flows, valid_flows
from flowtide.operators.features import flat_window, with_window
from flowtide.session import configure
from flowtide.sources.hosts import host_table
from flowtide.schemas import HOSTS

EVENT_FIELDS = (
    "concat('10.0.0.', CAST(user_id % 12 + 1 AS STRING)) AS srcaddr_s",
    "CAST(32768 + event_id % 1000 AS BIGINT) AS srcport",
    "concat('10.0.1.', CAST(event_id % 251 AS STRING)) AS dstaddr_s",
    "CAST(get_json_object(props, '$.k') AS BIGINT) AS dstport",
    "CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 17 ELSE 6 END AS BIGINT) AS proto",
    "CAST(event_id % 32 AS BIGINT) AS tcp_flags",
    "CAST(round(value * 100) AS BIGINT) AS dOctets",
    "CAST(1 + event_id % 3 AS BIGINT) AS count",
    "unix_millis(CAST(ts AS TIMESTAMP)) AS first",
    "unix_millis(CAST(ts AS TIMESTAMP)) + event_id % 5000 AS last",
    "unix_millis(CAST(ts AS TIMESTAMP)) AS timestamp",
)

EVENT_KEYS = tuple(field.rpartition(" ")[2] for field in EVENT_FIELDS)

# The four shapes of a message, chosen by the destination port.
CUT_PORT = 13
NO_COUNT_PORT = 14
NO_SOURCE_PORT = 15


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records, one per event."""
    return table(spark, folder, "events").selectExpr(*EVENT_FIELDS)


def as_messages(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as JSON text; some are cut short, lack their count or name no source. ``keep`` stays beside the text."""
    port = F.col("dstport")
    spoilt = raw.withColumns({
        "count": F.when(port != NO_COUNT_PORT, F.col("count")),
        "srcaddr_s": F.when(port != NO_SOURCE_PORT, F.col("srcaddr_s")),
    })
    text = F.to_json(F.struct(*[F.col(c) for c in raw.columns if c not in keep]))
    return spoilt.select(
        F.when(port == CUT_PORT, F.substr(text, F.lit(1), F.length(text) - 10))
        .otherwise(text).alias("value"), *keep)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(raw_events(spark, folder))


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages as a stream."""
    schema = table(spark, folder, "events").schema
    events = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(folder))
    return as_messages(events.selectExpr(*EVENT_FIELDS))


# Days that arrive together; every so many events one comes a part later, or is dated far ahead.
PART_DAYS, LATE_EVERY, AHEAD_EVERY, AHEAD_DAYS = 8, 50, 501, 400


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """The messages with the ``part`` they arrive in and their ``arrivalTime``, the end of the part's days."""
    events = table(spark, folder, "events")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    part = F.floor(day / PART_DAYS).cast("int") + F.when(F.col("event_id") % LATE_EVERY == 0, 1).otherwise(0)
    ahead = F.when(F.col("event_id") % AHEAD_EVERY == 7, F.lit(AHEAD_DAYS * 86_400_000)).otherwise(0).cast("long")
    raw = events.withColumns({"part": part, "ahead": ahead}).selectExpr(*EVENT_FIELDS, "part", "ahead")
    raw = raw.withColumn("timestamp", F.col("timestamp") + F.col("ahead")).drop("ahead")
    raw = raw.withColumn("arrivalTime", F.timestamp_seconds(
        F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp")) + (F.col("part") + 1) * (PART_DAYS * 86_400)))
    return as_messages(raw, ("part", "arrivalTime"))


def event_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Valid flows of the event view, with their event time."""
    return valid_flows(project_flows(raw_events(spark, folder), "timestamp"))


def event_features(spark: SparkSession, folder: str, duration: str = "1 day") -> DataFrame:
    """Features per window and source of the event view."""
    flows = with_window(event_flows(spark, folder), duration)
    return plain_window(flat_window(features_by_source(flows, ("window", "srcAddr"))))


def plain_window(features: DataFrame) -> DataFrame:
    return features.withColumn("win", F.col("win").cast("timestamp_ntz"))


def volume_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flows of the lineitem view, with the month as ``win``."""
    return table(spark, folder, "lineitem").select(
        F.date_trunc("MONTH", "l_shipdate").cast("timestamp_ntz").alias("win"),
        F.col("l_suppkey").cast("string").alias("srcAddr"),
        F.col("l_partkey").cast("string").alias("dstAddr"),
        (F.col("l_linenumber") * 100 + F.col("l_quantity").cast("int")).cast("bigint")
        .alias("dstPort"),
        F.round("l_extendedprice").cast("bigint").alias("numBytes"),
        F.lit(1).cast("bigint").alias("numFlows"),
    )


def host_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One host document per supplier as text; every other source address has a host."""
    return table(spark, folder, "supplier").select(F.to_json(F.struct(
        F.array(F.struct(
            F.array(F.concat(F.lit("10.0.0."), (F.col("s_suppkey") * 2 + 1).cast("string")))
            .alias("ipAddresses"),
            F.array(F.struct(F.format_string("of:%016x", F.col("s_nationkey").cast("bigint"))
                             .alias("elementId"))).alias("locations"),
        )).alias("hosts"))).alias("value"))


def hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Host table of those documents."""
    documents = host_documents(spark, folder)
    return host_table(documents.select(F.from_json("value", HOSTS).alias("d")).select("d.hosts"))
