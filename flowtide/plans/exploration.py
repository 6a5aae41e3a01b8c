"""Offline look at feature rows: profile, clean, scale, choose k, cluster, label."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from flowtide.operators import profile
from flowtide.operators.cluster import assign, centers_of, cluster_sizes, elbow, fit_kmeans
from flowtide.operators.prep import assemble, standardize
from flowtide.schemas import MODEL_FEATURES
from flowtide.session import materialize

# Destination-port counts known to come from port scans.
OUTLIERS = (6091, 711, 284)


def explore(features: DataFrame, columns: Sequence[str] = MODEL_FEATURES,
            outlier_column: str = "uniqDstPorts", outliers: Sequence[float] = OUTLIERS,
            ks: Iterable[int] = range(1, 10), k: int = 3, seed: int = 0) -> dict[str, DataFrame]:
    """The tables of an exploration session, by name."""
    columns = list(columns)
    features = features if hasattr(features, "written_to") else materialize(features, "explored")
    cleaned = profile.exclude_values(features.select(*columns), outlier_column, outliers)
    scaled = standardize(cleaned, columns, sigma="population")
    centers = centers_of(fit_kmeans(assemble(scaled, columns), k, seed))
    labelled = assign(scaled, columns, centers)
    return {
        "shape": profile.shape(features),
        "describe": profile.describe(features, columns),
        "value_counts": profile.value_counts(features, outlier_column),
        "histogram": profile.histogram(cleaned, outlier_column),
        "quality": profile.quality_report(cleaned, columns),
        "elbow": elbow(scaled, columns, ks, fraction=None, seed=seed),
        "labelled": labelled,
        "sizes": cluster_sizes(labelled),
    }
