"""Scoring of live feature rows. Works on tables and streams alike."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, functions as F

from flowtide.functions.distance import nearest, one_sided, one_sided_by_sign
from flowtide.functions.stats import present
from flowtide.schemas import MODEL_FEATURES


def model_rows(model: DataFrame) -> list[Row]:
    """The k rows of a model table, by cluster."""
    return sorted(model.collect(), key=lambda r: r["cluster"])


def _number(values: Sequence[float | None] | None, i: int) -> float:
    return float(values[i] or 0.0) if values else 0.0


def _scaled(column: Column, moments: Row, i: int, center: bool) -> Column:
    """Feature ``i`` in units of its deviation; a deviation of zero or none counts as 1."""
    mean = _number(moments["mean"], i) if center else 0.0
    return (column - F.lit(mean)) / F.lit(_number(moments["stddev"], i) or 1.0)


def _decide(live: DataFrame, best: Column) -> DataFrame:
    """Add distance, cluster, threshold and the decision. Strictly beyond is anomalous; a
    cluster without a threshold never is, nor a row without a distance (a feature missing)."""
    distance = F.nanvl(F.col("_best.distance"), F.lit(None).cast("double"))
    over = distance > F.col("_best.threshold")
    return (live.withColumn("_best", best)
            .withColumns({
                "distance": distance,
                "cluster": F.when(distance.isNotNull(), F.col("_best.cluster")),
                "threshold": F.when(distance.isNotNull(), F.col("_best.threshold")),
                "anomaly": F.coalesce(over, F.lit(False)),
            }).drop("_best"))


def score(live: DataFrame, model: DataFrame | list[Row],
          columns: Sequence[str] = MODEL_FEATURES, scale: bool = True,
          center: bool = True) -> DataFrame:
    """Nearest centre by one-sided distance, and whether it is beyond the threshold.

    Live rows are scaled with the mean and deviation of the raw training rows. Centres were
    learnt without subtracting the mean; ``center=False`` treats live rows the same way,
    the default subtracts it.
    """
    rows = model_rows(model) if isinstance(model, DataFrame) else model
    centers = [r["center"] for r in rows]
    first = rows[0]
    point = [
        _scaled(F.col(c), first, i, center) if scale
        else F.col(c).cast("double")
        for i, c in enumerate(columns)
    ]
    names = [f"_p{i}" for i in range(len(columns))]
    scaled = live.withColumns(dict(zip(names, point)))
    axes = [F.col(n) for n in names]
    best = nearest([one_sided(axes, c, centers) for c in centers],
                   [r["cluster"] for r in rows], [r["threshold"] for r in rows])
    return _decide(scaled, best).drop(*names)


def score_by_sign(live: DataFrame, model: DataFrame | list[Row],
                  columns: Sequence[str] = MODEL_FEATURES, scale: bool = True) -> DataFrame:
    """Earlier form: the sign-matched distance, with each centre scaling by its own cluster."""
    rows = model_rows(model) if isinstance(model, DataFrame) else model
    centers = [r["center"] for r in rows]
    distances = []
    for r in rows:
        point = [
            _scaled(F.col(c), r, i, True) if scale
            else F.col(c).cast("double")
            for i, c in enumerate(columns)
        ]
        distances.append(one_sided_by_sign(point, r["center"], centers))
    return _decide(live, nearest(distances, [r["cluster"] for r in rows],
                                 [r["threshold"] for r in rows]))


def upper_limits(thresholds: DataFrame) -> dict[str, float | None]:
    """Feature -> upper limit, from the few rows of a sigma threshold table.

    A feature without training values has no limit (None) and flags nothing.
    """
    return {r["feature"]: r["upper"] for r in thresholds.collect()}


def _beyond(live: DataFrame, limits: dict[str, float | None], column: str) -> Column:
    limit = limits.get(column)
    if limit is None:
        return F.lit(False)
    return present(live, column) > F.lit(float(limit))


def exceedances(live: DataFrame, limits: dict[str, float | None],
                columns: Sequence[str] = MODEL_FEATURES,
                keys: Sequence[str] = ("srcAddr",)) -> DataFrame:
    """Rows beyond a limit in at least one feature; features within their limit are null."""
    beyond = [F.when(_beyond(live, limits, c), F.col(c)).alias(c) for c in columns]
    return live.select(*keys, *beyond).filter(
        reduce(or_, [F.col(c).isNotNull() for c in columns]))


def exceedances_by_join(live: DataFrame, limits: dict[str, float | None],
                        columns: Sequence[str] = MODEL_FEATURES,
                        keys: Sequence[str] = ("srcAddr",)) -> DataFrame:
    """The same rows as a full outer join of one filtered table per feature."""
    tables = [live.filter(_beyond(live, limits, c)).select(*keys, c) for c in columns]
    return reduce(lambda left, right: left.join(right, list(keys), "full_outer"), tables)

