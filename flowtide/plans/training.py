"""From the feature store to a detector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from flowtide.operators.cluster import centers_of, fit_kmeans
from flowtide.functions.stats import presented
from flowtide.operators.prep import as_double, assemble, scaled_by
from flowtide.operators.thresholds import (
    cluster_thresholds, cluster_thresholds_by_spread, moments_of,
)
from flowtide.schemas import MODEL, MODEL_FEATURES


def fit_detector(features: DataFrame, columns: Sequence[str] = MODEL_FEATURES, k: int = 3,
                 seed: int = 1, scale: bool = True, n_sigma: float = 2,
                 by_spread: bool = False) -> DataFrame:
    """Scale, cluster and derive thresholds; returns the model table, one row per cluster.

    Everything that grows with the data stays in Spark: only the k centres and the k + 1
    rows of statistics reach the driver. ``by_spread`` gives the earlier model, whose
    thresholds and scaling use the spread within each cluster.
    """
    columns = list(columns)
    raw = presented(as_double(features.select(*columns), columns), columns).dropna()
    # One pass for the moments, one that fills the cache; all else reads the cache.
    overall = raw.agg(*moments_of(columns)).first().asDict()
    prepared = scaled_by(raw, columns, overall["stddev"]) if scale else raw
    vectors = assemble(prepared, columns).persist()
    try:
        model = fit_kmeans(vectors, k, seed)
        assigned = model.transform(vectors)
        if by_spread:
            stats = cluster_thresholds_by_spread(assigned, columns)
        else:
            stats = cluster_thresholds(assigned, columns, n_sigma)
        learnt = {r["cluster"]: r.asDict() for r in stats.collect()}
    finally:
        vectors.unpersist()

    rows = []
    for cluster, center in enumerate(centers_of(model)):
        found = learnt.get(cluster, {})
        moments = found if by_spread else overall
        rows.append((cluster, center, found.get("feature_max"), moments.get("mean"),
                     moments.get("stddev"), found.get("threshold")))
    return features.sparkSession.createDataFrame(rows, MODEL)


def save_model(model: DataFrame, path: str) -> None:
    model.coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL).parquet(path)
