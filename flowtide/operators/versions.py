"""Scoring by the model in force: a detector is replaced while it runs, each row is scored by the model of its time.

Versions lie in ``since=`` folders, one model table each; ``since`` is the time from which it holds, in microseconds.
A version holds until the next one begins. Saving a version again replaces it. A version should be saved before
its time comes: rows already scored are not scored again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowtide.operators.score import _decide
from flowtide.schemas import MODEL, MODEL_FEATURES
from flowtide.sinks.folders import Folders

VERSIONS = T.StructType([*MODEL, T.StructField("since", T.LongType())])


def save_version(model: DataFrame, path: str, since: str) -> None:
    """Write a model that holds from ``since``, a timestamp in the session's time zone."""
    spark = model.sparkSession
    micros = spark.range(1).select(F.unix_micros(F.lit(since).cast("timestamp"))).first()[0]
    model.coalesce(1).write.mode("overwrite").parquet(f"{path}/since={micros}")


def load_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions saved so far; no rows before the first."""
    if not Folders(spark, path).matching("since=*/_SUCCESS"):
        return spark.createDataFrame([], VERSIONS)
    return spark.read.schema(VERSIONS).parquet(path)


def within(versions: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """The versions in force at any time from ``first`` to ``last``, in microseconds."""
    if first is None or last is None:
        return versions.limit(0)
    start = versions.filter(F.col("since") <= first).agg(F.max("since")).first()[0]
    return versions.filter((F.col("since") <= last) & (F.col("since") >= (first if start is None else start)))


def score_in_force(live: DataFrame, versions: DataFrame, at: str, columns: Sequence[str] = MODEL_FEATURES,
                   scale: bool = True, center: bool = True) -> DataFrame:
    """What :func:`flowtide.operators.score.score` gives, by the version in force at the time in column ``at``.

    Adds ``since``, the begin of that version, and the decision. A row without a time, or from before the first version,
    has no distance and is not anomalous. The beginnings of the versions reach the driver, one number each; models are
    joined by the beginning, so each row meets one version.
    """
    begins = sorted(r["since"] for r in versions.select("since").distinct().collect())
    own = F.unix_micros(F.col(at).cast("timestamp"))
    past = F.filter(F.array(*map(F.lit, begins)).cast("array<bigint>"), lambda t: t <= F.col("_at"))
    models = versions.groupBy("since").agg(
        F.collect_list(F.struct("center", F.col("cluster"), "threshold")).alias("_centers"),
        F.min_by("mean", "cluster").alias("_mean"), F.min_by("stddev", "cluster").alias("_stddev"))
    joined = (live.withColumn("_at", own).withColumn("since", F.array_max(past)).drop("_at")
              .join(models, "since", "left"))

    def point(i: int, c: str) -> Column:
        if not scale:
            return F.col(c).cast("double")
        mean = F.coalesce(F.col("_mean")[i], F.lit(0.0)) if center else F.lit(0.0)
        return (F.col(c) - mean) / F.coalesce(F.nullif(F.col("_stddev")[i], F.lit(0.0)), F.lit(1.0))

    names = [f"_p{i}" for i in range(len(columns))]
    scaled = joined.withColumns({n: point(i, c) for i, (n, c) in enumerate(zip(names, columns))})
    axis = lambda i: F.transform("_centers", lambda m: m["center"][i])  # noqa: E731  a second parameter would be the index
    highest = [F.array_max(axis(i)) for i in range(len(columns))]
    scaled = scaled.withColumn("_below", reduce(and_, [F.col(n) < h for n, h in zip(names, highest)]))

    def away(m: Column) -> Column:
        squares = [(F.col(n) - m["center"][i]) * (F.col(n) - m["center"][i]) for i, n in enumerate(names)]
        return F.struct(F.when(F.col("_below"), F.lit(0.0)).otherwise(F.sqrt(reduce(add, squares))).alias("distance"),
                        m["cluster"].alias("cluster"), m["threshold"].alias("threshold"))

    decided = _decide(scaled, F.array_min(F.transform("_centers", away)))
    added = ("since", "distance", "cluster", "threshold", "anomaly")
    return decided.select(*[F.col(f"`{c}`") for c in live.columns if c not in added], F.timestamp_micros("since").alias("since"),
                          *added[1:])
