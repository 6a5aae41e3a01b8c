"""Running streams: triggers, per-batch work and sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from flowtide.operators.features import SOURCE, features_by_source
from flowtide.operators.rules import hold_off
from flowtide.operators.score import score
from flowtide.operators.versions import load_versions, score_in_force, within
from flowtide.schemas import MODEL_FEATURES
from flowtide.sinks.folders import Folders
from flowtide.sinks.tables import append_features, append_rules

BatchWork = Callable[[DataFrame, int], None]


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Every so often, or without ``every`` all that is there now, then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def each_arrival(flows: DataFrame, work: Sequence[BatchWork], checkpoint: str,
                 every: str | None = "60 seconds",
                 keys: Sequence[str] = SOURCE) -> StreamingQuery:
    """Features by arrival: what came in since the last trigger is one batch per source.

    No state is kept and nothing counts as late. Each ``work`` gets the features of a batch
    and its number; a batch may be repeated after a failure under the same number.
    """
    def on_batch(batch: DataFrame, number: int) -> None:
        features = features_by_source(batch, keys).persist()
        try:
            for step in work:
                step(features, number)
        finally:
            features.unpersist()

    writer = flows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def store_features(path: str, writer: str) -> BatchWork:
    """Work for :func:`each_arrival`: append each batch to the feature store.

    ``writer`` is made once for a checkpoint and kept with it (see :mod:`flowtide.sinks.tables`).
    """
    return lambda features, number: append_features(features, number, path, writer)


def store_rules(path: str, judge: Callable[[DataFrame], DataFrame], writer: str, hold: str | None = None) -> BatchWork:
    """Work for :func:`each_arrival` or :func:`keep_every_flow`: write the rules ``judge`` draws from each batch.

    ``judge`` is one of the blocking plans with its model or limits and hosts filled in. It
    is called for every batch, so tables it reads anew take effect without a restart. With ``hold``, for features with
    a window, a source gets a rule only that long after its last one. What was written before is read from the
    writer's earlier batches, so neither a restart nor a repeated batch changes the outcome.
    """
    def work(features: DataFrame, number: int) -> None:
        rules = judge(features)
        if hold:
            spark = features.sparkSession
            batches = [(int(p.rpartition("=")[2]), p) for p in Folders(spark, path).matching(f"writer={writer}/batch=*")]
            before = [f"{path}/{p}" for n, p in batches if n < number]
            rules = hold_off(rules, spark.read.schema(rules.schema).parquet(*before) if before else rules.limit(0), hold)
        append_rules(rules, number, path, writer)

    return work


def score_stream(features: DataFrame, model: DataFrame | list[Row],
                 columns: Sequence[str] = MODEL_FEATURES, scale: bool = True,
                 center: bool = True) -> DataFrame:
    """Score windowed features with a model that stays fixed while the stream runs."""
    return score(features, model, columns, scale, center)


def score_windows(versions: str, path: str, columns: Sequence[str] = MODEL_FEATURES, scale: bool = True,
                  center: bool = True, at: str = "win") -> BatchWork:
    """Work for :func:`keep_every_flow`: score closed windows, each by the version of the model in force when it began.

    Versions are read anew for every batch, only those that its windows need, so a model saved while the stream runs
    takes effect without a restart. A batch writes to a folder of its own, which a repeated batch replaces.
    """
    def work(windows: DataFrame, number: int) -> None:
        time = F.unix_micros(at)
        span = windows.agg(F.min(time).alias("first"), F.max(time).alias("last")).first()
        models = within(load_versions(windows.sparkSession, versions), span["first"], span["last"])
        scored = score_in_force(windows, models, at, columns, scale, center)
        scored.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return work


def write_table(stream: DataFrame, path: str, checkpoint: str, every: str | None = None,
                state_partitions: int | None = None) -> StreamingQuery:
    """Append closed rows to a Parquet table, each exactly once.

    ``state_partitions`` sets over how many partitions the state is spread; by default as
    many as the session's shuffles have. The first start of a checkpoint fixes the number.
    """
    writer = (stream.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    conf = stream.sparkSession.conf
    usual = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions or usual))
    try:
        return triggered(writer, every).start()  # takes its own copy of the settings
    finally:
        conf.set("spark.sql.shuffle.partitions", usual)


def print_batches(stream: DataFrame, checkpoint: str, rows: int = 10,
                  every: str | None = "1 second", mode: str = "append") -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = (stream.writeStream.outputMode(mode).format("console")
              .option("numRows", rows).option("truncate", False)
              .option("checkpointLocation", checkpoint))
    return triggered(writer, every).start()


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows a stream has left out as late, as far as its recent progress tells.

    Counted after flows of one window, source and destination were combined in a task.
    """
    return sum(int(state.numRowsDroppedByWatermark)
               for step in query.recentProgress for state in step.stateOperators)


def run_available(query: StreamingQuery, timeout: float | None = None) -> None:
    """Block until the query stops; a query still running after ``timeout`` seconds is stopped."""
    finished = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if finished is False:
        query.stop()
