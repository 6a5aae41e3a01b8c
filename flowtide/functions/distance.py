"""Distances from a point to cluster centres.

A point is a list of columns, a centre a list of numbers. Centres come from a model of k
rows, so the expressions are written out in full and stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, functions as F


def squared_distance(point: Sequence[Column], center: Sequence[float]) -> Column:
    return reduce(add, [(p - F.lit(float(c))) * (p - F.lit(float(c)))
                        for p, c in zip(point, center, strict=True)])


def euclidean(point: Sequence[Column], center: Sequence[float]) -> Column:
    return F.sqrt(squared_distance(point, center))


def _below_some_center(point: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    highest = [max(axis) for axis in zip(*centers)]
    return reduce(and_, [p < F.lit(float(h)) for p, h in zip(point, highest, strict=True)])


def _inside_by_sign(point: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    axes = list(zip(*centers))
    return reduce(and_, [
        ((p > 0) & (p < F.lit(float(max(axis))))) | ((p < 0) & (p > F.lit(float(min(axis)))))
        for p, axis in zip(point, axes, strict=True)
    ])


def one_sided(point: Sequence[Column], center: Sequence[float],
              centers: Sequence[Sequence[float]]) -> Column:
    """Distance that only counts excess.

    Zero where every coordinate lies below that coordinate of some centre, else Euclidean.
    """
    return (F.when(_below_some_center(point, centers), F.lit(0.0))
            .otherwise(euclidean(point, center)))


def one_sided_by_sign(point: Sequence[Column], center: Sequence[float],
                      centers: Sequence[Sequence[float]]) -> Column:
    """Earlier form for centred data.

    Zero where every coordinate has the sign of some centre's coordinate and lies between
    it and zero, else Euclidean. A coordinate of exactly zero is never inside.
    """
    return (F.when(_inside_by_sign(point, centers), F.lit(0.0))
            .otherwise(euclidean(point, center)))


def nearest(distances: Sequence[Column], clusters: Sequence[int],
            thresholds: Sequence[float | None]) -> Column:
    """Struct (distance, cluster, threshold) of the closest centre; ties go to the lowest cluster."""
    return F.array_min(F.array(*[
        F.struct(d.alias("distance"), F.lit(int(c)).alias("cluster"),
                 F.lit(t).cast("double").alias("threshold"))
        for d, c, t in zip(distances, clusters, thresholds, strict=True)
    ]))
