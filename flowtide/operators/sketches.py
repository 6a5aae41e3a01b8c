"""Distinct counts over any range of windows, from sketches that can be merged.

The exact features of an hour cannot be had from those of its minutes, as a destination may occur in many of them.
Here each (window, source) keeps two HyperLogLog sketches beside its sums; rows of any windows are merged without reading
flows again. Estimates of merged sketches are off by about 1.04 / sqrt(2 ** precision) of the count; the exact
features stay the default.

Sketches are built and merged within each task before the shuffle, so a source with a third of all flows sends one row
per task. Missing destinations are not counted; a group without any counts zero. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flowtide.operators.features import WINDOWED

PRECISION = 12  # a full sketch has 4 KB, one of a few destinations some bytes
SUMS = ("sumOfFlows", "sumOfBytes", "numRecords")
SKETCHES = {"uniqDstIPs": "dstAddr", "uniqDstPorts": "dstPort"}


def error(sigmas: float = 3, precision: int = PRECISION) -> float:
    """By which share of the exact count an estimate may be off, at that many standard errors."""
    return sigmas * 1.04 / 2 ** (precision / 2)


def sketched_features(flows: DataFrame, keys: Sequence[str] = WINDOWED, precision: int = PRECISION) -> DataFrame:
    """Sums and sketches per key, of a table or of a stream with a watermark."""
    return flows.groupBy(*keys).agg(
        F.sum("numFlows").alias("sumOfFlows"), F.sum("numBytes").alias("sumOfBytes"), F.count(F.lit(1)).alias("numRecords"),
        *[F.hll_sketch_agg(c, F.lit(precision)).alias(name) for name, c in SKETCHES.items()])


def merged_features(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of :func:`sketched_features` or of this function, merged by other keys."""
    return sketches.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.hll_union_agg(c).alias(c) for c in SKETCHES])


def estimated(sketches: DataFrame) -> DataFrame:
    """The sketches replaced by the numbers of distinct destinations they estimate."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in SKETCHES})
