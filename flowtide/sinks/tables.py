"""Writers for feature rows and rules. Each is safe to repeat for the same writer and batch.

The feature store lies in ``day=/writer=/part=`` folders. A part is the batch number, or ``merged-`` and a
number after a compaction; the batch stays a column of the rows. Which parts a merged one replaces is listed in a small
file of the day and writer (:mod:`flowtide.sinks.parts`). ``writer`` names one ingest
job for as long as its checkpoint lives: batch numbers start at 0 with every checkpoint, so a new
checkpoint needs a new writer, or it would replace the old job's batches. Rules lie in
``writer=/batch=`` folders.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowtide.schemas import MODEL_FEATURES, STORE
from flowtide.sinks.folders import Folders
from flowtide.sinks.parts import Parts

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _checked(writer: str) -> str:
    if not _NAME.fullmatch(writer):
        raise ValueError("a writer is a name of letters, digits, '_', '.' and '-'")
    return writer


def append_features(features: DataFrame, batch: int, path: str, writer: str,
                    day: Column | None = None) -> None:
    """Append one batch of a writer to the store, without the source address.

    Writing a batch again replaces exactly its rows, on every day it has touched; other writers and
    batches stay, also those with the same number. ``day`` defaults to the day of the window start,
    else to the day of writing. Rows are rebalanced by day: few files per day, and a large day still
    has many writers.
    """
    spark, writer = features.sparkSession, _checked(writer)
    if day is None:
        day = F.to_date("win") if "win" in features.columns else F.current_date()
    rows = features.select(
        F.col("sumOfFlows").cast("bigint").alias("sumOfFlows"),
        F.col("sumOfBytes").cast("bigint").alias("sumOfBytes"),
        F.col("uniqDstIPs").cast("int").alias("uniqDstIPs"),
        F.col("uniqDstPorts").cast("int").alias("uniqDstPorts"),
        F.lit(batch).cast("bigint").alias("batch"),
        day.alias("day"), F.lit(writer).alias("writer"), F.lit(str(batch)).alias("part"))
    folders = Folders(spark, path)
    before = folders.matching(f"day=*/writer={writer}/part={batch}")
    (rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "writer", "part").parquet(path))
    if before:  # a batch written earlier on days it no longer touches
        now = {f"day={'__HIVE_DEFAULT_PARTITION__' if r['day'] is None else r['day']}/writer={writer}/part={batch}"
               for r in rows.select("day").distinct().collect()}  # one row per day of a batch
        for leaf in before:
            if leaf not in now:
                folders.remove(leaf)


def compact_day(spark: SparkSession, path: str, day: str, keep: int = 1) -> None:
    """Merge the small parts of one day, writer by writer, except each writer's last ``keep`` batches.

    Those may still be written again by a restarted stream. The merged part is written beside the others, where readers
    pass it over; one small file that appears at once makes it live in place of the parts it holds. Those are removed by
    the next compaction, so readers that have begun can finish. After an interruption at any point, calling again
    finishes the work.
    """
    folders = Folders(spark, path)
    data = type(STORE)([f for f in STORE if f.name not in ("day", "writer", "part")])
    for own in folders.matching(f"day={day}/writer=*"):
        parts = Parts(folders, own)
        for stale in parts.replaced:
            folders.remove(f"{own}/part={stale}")
        numbers = sorted(int(p) for p in parts.live if p.isdigit())
        held = [*map(str, numbers[:-keep or None]), *[p for p in parts.live if not p.isdigit()]]
        if not any(p.isdigit() for p in held):
            continue
        name = parts.next_merged()
        (spark.read.schema(data).parquet(*[f"{folders.base}/{own}/part={p}" for p in held]).hint("rebalance")
         .write.mode("overwrite").parquet(f"{folders.base}/{own}/part={name}"))
        parts.commit(name, held)


def append_rules(rules: DataFrame, batch: int, path: str, writer: str) -> None:
    """Write the rules of one batch of a writer; repeating the batch replaces its rules."""
    rules.write.mode("overwrite").parquet(f"{path}/writer={_checked(writer)}/batch={batch}")


def export_csv(features: DataFrame, path: str) -> None:
    """Headerless CSV of bytes, destination addresses and destination ports."""
    features.select(*MODEL_FEATURES).write.option("header", False).csv(path)
