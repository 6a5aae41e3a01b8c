"""Flow records: JSON files, text lines and Kafka messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowtide.schemas import RAW_FLOW, READ_KEYS

# Fixed value: the topic flow exporters publish to.
TOPIC = "NETFLOW"


def read_flow_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines flow files; blank lines are skipped, unreadable ones become all-null rows."""
    return spark.read.schema(RAW_FLOW).json(path)


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               files_per_batch: int | None = None, arrival: bool = False) -> DataFrame:
    """Non-blank text lines as a ``value`` column, like the value of a message.

    ``arrival`` adds the file's time as ``arrivalTime``.
    """
    if stream:
        reader = spark.readStream
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = spark.read
    lines = reader.text(path)
    if arrival:
        lines = lines.select("value", F.col("_metadata.file_modification_time").alias("arrivalTime"))
    return lines.filter(F.trim("value") != "")


def read_kafka(spark: SparkSession, servers: str, topic: str = TOPIC, stream: bool = True,
               starting: str | None = None, **options: str) -> DataFrame:
    """Messages of a Kafka topic as a string ``value`` column and their ``arrivalTime``, the time the
    broker put on them; keys are ignored.

    Every partition of the topic becomes a task, so reading scales with the topic. Each
    query keeps its own offsets in its checkpoint: two jobs never split one topic.
    Needs the Kafka connector on the class path.
    """
    reader = spark.readStream if stream else spark.read
    reader = (reader.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting or ("latest" if stream else "earliest")))
    return reader.options(**options).load().select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrivalTime"))


def decode(messages: DataFrame, keys: Sequence[str] = READ_KEYS,
           keep: Sequence[str] = ("value",)) -> DataFrame:
    """Parse the ``value`` of each message into record fields, by default those read later.

    A field that is absent or of the wrong type is null, an unreadable message is null in
    every field; nothing fails the batch. Unpacking the record as a one-element array parses
    each message once: conditions on its fields are then checked after parsing, where on a
    plain struct every one of them would parse the message again.
    """
    wanted = T.StructType([RAW_FLOW[key] for key in keys])
    return messages.select(*keep, F.inline(F.array(F.from_json("value", wanted))))
