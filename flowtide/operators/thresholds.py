"""Thresholds learnt from normal traffic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from flowtide.functions.stats import presented, sigma_steps
from flowtide.schemas import FEATURES, MODEL_FEATURES


def sigma_thresholds(features: DataFrame, columns: Sequence[str] = FEATURES,
                     start: int = 2) -> DataFrame:
    """Per feature the smallest mean + n * deviation that covers the training maximum.

    One row per feature: mean, stddev, max, n and upper, over the values present.
    """
    row = presented(features, columns).agg(*[
        F.struct(F.avg(c).alias("mean"),
                 F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias("stddev"),
                 F.max(c).cast("double").alias("max")).alias(c)
        for c in columns
    ])
    entries = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`.mean").alias("mean"),
                 F.col(f"`{c}`.stddev").alias("stddev"), F.col(f"`{c}`.max").alias("max"))
        for c in columns
    ])).alias("row")).select("row.*")
    return (entries
            .withColumn("n", sigma_steps(F.col("max"), F.col("mean"), F.col("stddev"), start))
            .withColumn("upper", F.col("mean") + F.col("n") * F.col("stddev")))


def moments_of(columns: Sequence[str]) -> list[Column]:
    """Aggregates ``mean`` and ``stddev``, arrays over the columns. One row has deviation 0."""
    return [
        F.array(*[F.avg(c) for c in columns]).alias("mean"),
        F.array(*[F.coalesce(F.stddev_samp(c), F.lit(0.0)) for c in columns]).alias("stddev"),
    ]


def cluster_stats(assigned: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows per cluster, with max, mean and deviation of each column as arrays."""
    return presented(assigned, columns).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.max(c).cast("double") for c in columns]).alias("feature_max"),
        *moments_of(columns))


def overall_stats(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> Column:
    """Mean and deviation of each column over all rows, as one struct of arrays."""
    return presented(df, columns).agg(F.struct(*moments_of(columns)).alias("stats")).scalar()


def _length(parts: Sequence[Column]) -> Column:
    return F.sqrt(reduce(add, [p * p for p in parts]))


def cluster_thresholds(assigned: DataFrame, columns: Sequence[str] = MODEL_FEATURES,
                       n_sigma: float = 2) -> DataFrame:
    """Distance threshold per cluster.

    Each feature allows the cluster's maximum plus ``n_sigma`` deviations of all rows; the
    threshold is the length of that vector.
    """
    upper = [F.col("feature_max")[i] + F.lit(float(n_sigma)) * F.col("overall.stddev")[i]
             for i in range(len(columns))]
    return (cluster_stats(assigned, columns)
            .withColumn("overall", overall_stats(assigned, columns))
            .select("cluster", "rows", "feature_max", F.array(*upper).alias("upper"),
                    _length(upper).alias("threshold")))


def cluster_thresholds_by_spread(assigned: DataFrame, columns: Sequence[str] = MODEL_FEATURES,
                                 start: int = 2) -> DataFrame:
    """Earlier form: the sigma threshold within each cluster, rounded up to whole numbers."""
    steps = [sigma_steps(F.col("feature_max")[i], F.col("mean")[i], F.col("stddev")[i], start)
             for i in range(len(columns))]
    upper = [F.ceil(F.col("mean")[i] + n * F.col("stddev")[i]).cast("double")
             for i, n in enumerate(steps)]
    return cluster_stats(assigned, columns).select(
        "cluster", "rows", "feature_max", "mean", "stddev",
        F.array(*upper).alias("upper"), _length(upper).alias("threshold"))
