"""Event-time windows of a message stream in which no valid flow is lost: late flows are kept beside the windows.

One query, one pass over each batch. A batch is decoded once and every record goes one of three ways: *timely* into
the open windows, *late* into the late table if its window was closed by an earlier batch, or *rejected* with its
reason. The watermark is carried from batch to batch as a mark of one row, together with the counts of what was read,
timely, late and rejected, which are observed while the batch is written.

Open windows are kept as the distinct (window, source, destination) pairs that :func:`features_by_source` counts: the
pairs left open by the batch before and those of this one are added up, windows behind the new watermark are counted
and written, the rest stays open. That table's size is the size of the windows not yet closed.

All that a batch writes follows from the batch and from what the batch before has left, and lies in folders named by
the batch number. A batch repeated after a failure replaces what it has written; only what lies two batches back is
removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from flowtide.operators.features import WINDOWED, add_pairs, count_pairs, destination_pairs, flat_window
from flowtide.operators.flows import AHEAD, ARRIVAL_TIME, EVENT_TIME, project_flows, with_reason
from flowtide.schemas import FLOW_COLUMNS
from flowtide.sinks.folders import Folders
from flowtide.sources.flows import decode
from flowtide.streaming.run import BatchWork, triggered

KINDS = ("timely", "late", "rejected")
# Totals since the start; `newest` is the newest valid event time in microseconds.
MARK = "batch long, newest long, read long, timely long, late long, rejected long"


def read_mark(spark: SparkSession, path: str, before: int | None = None) -> Row | None:
    """Watermark and counts after the last batch, or after the last one ``before`` a batch."""
    numbers = [int(p.split("/")[1].partition("=")[2]) for p in Folders(spark, path).matching("marks/batch=*/_SUCCESS")]
    numbers = [n for n in numbers if before is None or n < before]
    return spark.read.schema(MARK).parquet(f"{path}/marks/batch={max(numbers)}").first() if numbers else None


def route(messages: DataFrame, closed: Column | None, duration: str, event_time: str, ahead: str) -> DataFrame:
    """Flow columns and ``window`` with their ``kind``; rejected records also have ``value`` and ``reason``.

    Windows that end at ``closed`` or before it are closed.
    """
    keys = list(dict.fromkeys((*FLOW_COLUMNS.values(), event_time)))
    keep = ("value", *([ARRIVAL_TIME] if ARRIVAL_TIME in messages.columns else []))
    flows = with_reason(project_flows(decode(messages, keys, keep), event_time, keep), ahead)
    rejected = F.col("reason").isNotNull()
    late = F.lit(False) if closed is None else F.coalesce(F.col("window.end") <= closed, F.lit(False))
    # A record without event time has no window, yet must stay.
    window = F.window(F.coalesce(F.col(EVENT_TIME), F.timestamp_micros(F.lit(0))), duration)
    return flows.withColumn("window", window).withColumns({
        "kind": F.when(rejected, "rejected").when(late, "late").otherwise("timely"),
        "value": F.when(rejected, F.col("value"))}).drop(ARRIVAL_TIME)


def keep_every_flow(messages: DataFrame, path: str, checkpoint: str, duration: str = "60 seconds",
                    delay: str = "2 minutes", event_time: str = "timestamp", ahead: str = AHEAD,
                    every: str | None = "60 seconds", work: Sequence[BatchWork] = ()) -> StreamingQuery:
    """Windowed features of a message stream below ``path``, with late flows and rejected messages beside them.

    Each ``work`` gets the features of the windows that a batch has closed, and its number.
    Read the results with :func:`read_windows`, :func:`read_open`, :func:`read_aside` and :func:`read_mark`.
    """
    def behind(newest: int | None) -> Column | None:
        return None if newest is None else F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {delay}")

    def on_batch(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before = read_mark(spark, path, batch)
        seen = Observation()
        routed = route(rows, behind(before and before["newest"]), duration, event_time, ahead).observe(
            seen, F.count(F.lit(1)).alias("read"), *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS],
            F.max(F.when(F.col("kind") != "rejected", F.unix_micros(EVENT_TIME))).alias("newest"))
        _replace(routed, f"{path}/routed/batch={batch}", "kind")
        counts = seen.get
        newest = max((t for t in (before and before["newest"], counts["newest"]) if t is not None), default=None)

        timely = _part(spark, f"{path}/routed/batch={batch}", routed.schema, "kind", "timely")
        pairs = destination_pairs(timely, WINDOWED)
        if before:
            pairs = pairs.unionByName(_open_pairs(spark, path, before["batch"], pairs.schema))
        pairs, upto = add_pairs(pairs, WINDOWED), behind(newest)
        closed = F.lit(False) if upto is None else F.col("window.end") <= upto
        _replace(pairs.withColumn("state", F.when(closed, "closed").otherwise("open")), f"{path}/pairs/batch={batch}", "state")
        done = _part(spark, f"{path}/pairs/batch={batch}", pairs.schema, "state", "closed")
        flat_window(count_pairs(done, WINDOWED)).write.mode("overwrite").parquet(f"{path}/windows/batch={batch}")
        for step in work:
            step(spark.read.schema(flat_window(count_pairs(done, WINDOWED)).schema).parquet(f"{path}/windows/batch={batch}"), batch)

        total = lambda c: counts[c] + (before[c] if before else 0)
        mark = [(batch, newest, *[total(c) for c in ("read", *KINDS)])]
        spark.createDataFrame(mark, MARK).coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={batch}")
        folders = Folders(spark, path)
        folders.remove(f"routed/batch={batch}/kind=timely")
        for old in folders.matching("pairs/batch=*") + folders.matching("marks/batch=*"):
            if before and int(old.rpartition("=")[2]) < before["batch"]:
                folders.remove(old)

    writer = messages.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def _replace(rows: DataFrame, path: str, by: str) -> None:
    rows.write.mode("overwrite").partitionBy(by).parquet(path)


def _part(spark: SparkSession, path: str, schema: T.StructType, by: str, value: str) -> DataFrame:
    """One part of a written table; no rows if it has no such part."""
    rest = T.StructType([f for f in schema if f.name != by])
    whole = spark.read.schema(T.StructType([*rest, T.StructField(by, T.StringType())])).parquet(path)
    return whole.filter(F.col(by) == value).drop(by)


def _open_pairs(spark: SparkSession, path: str, batch: int, schema: T.StructType) -> DataFrame:
    return _part(spark, f"{path}/pairs/batch={batch}", schema, "state", "open")


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Features of all closed windows, with the ``batch`` that closed them."""
    return spark.read.parquet(f"{path}/windows")


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Features, so far, of the windows that are still open after the last batch."""
    batch = read_mark(spark, path)["batch"]
    table = spark.read.parquet(f"{path}/pairs/batch={batch}")
    return flat_window(count_pairs(table.filter(F.col("state") == "open").drop("state"), WINDOWED))


def read_aside(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The ``late`` flows or the ``rejected`` messages, with the ``batch`` they came in."""
    table = spark.read.option("basePath", f"{path}/routed").parquet(f"{path}/routed").filter(F.col("kind") == kind)
    if kind == "rejected":
        return table.select("value", "reason", "batch")
    return flat_window(table.select("window", *FLOW_COLUMNS, EVENT_TIME, "batch"))
