"""Per-source traffic features of a batch or a window.

The one definition in :func:`features_by_source` serves tables and streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from flowtide.operators.flows import EVENT_TIME
from flowtide.schemas import FEATURES, MODEL_FEATURES

SOURCE = ("srcAddr",)
WINDOWED = ("window", "srcAddr")


def with_window(flows: DataFrame, duration: str, event_time: str = EVENT_TIME) -> DataFrame:
    """Add the tumbling ``window`` each flow belongs to."""
    return flows.withColumn("window", F.window(event_time, duration))


def flat_window(features: DataFrame) -> DataFrame:
    """Replace ``window`` by its start, ``win``."""
    rest = [c for c in features.columns if c != "window"]
    return features.select(F.col("window.start").alias("win"), *rest)


def features_by_source(flows: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """Flows, bytes, distinct destination addresses and ports, and records per key.

    Grouping sets reduce each flow to its (key, address) and (key, port) pairs, combined
    before the shuffle and spread over it by the destination, so a source holding a large
    part of the traffic is counted by many tasks. Only pair counts reach the second
    grouping. The sums ride along with the address pairs. Exact, and without a set of
    destinations held in any one row, hence also usable as streaming state.
    """
    return count_pairs(destination_pairs(flows, keys), keys)


def destination_pairs(flows: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """The distinct (key, address) and (key, port) pairs with their flows, bytes and records."""
    keys = list(keys)
    return flows.groupingSets(
        [[*keys, "dstAddr"], [*keys, "dstPort"]], *keys, "dstAddr", "dstPort",
    ).agg(
        F.sum("numFlows").alias("flows"),
        F.sum("numBytes").alias("bytes"),
        F.count(F.lit(1)).alias("records"),
        F.grouping("dstAddr").alias("by_port"),
    )


def add_pairs(pairs: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """Pairs of several tables of :func:`destination_pairs` as one."""
    return pairs.groupBy(*keys, "dstAddr", "dstPort", "by_port").agg(
        *[F.sum(c).alias(c) for c in ("flows", "bytes", "records")])


def count_pairs(pairs: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """The features of :func:`features_by_source` from its pairs."""
    by_address = F.col("by_port") == 0
    return pairs.groupBy(*keys).agg(
        F.sum(F.when(by_address, F.col("flows"))).alias("sumOfFlows"),
        F.sum(F.when(by_address, F.col("bytes"))).alias("sumOfBytes"),
        F.count_if(by_address).alias("uniqDstIPs"),
        F.count_if(~by_address).alias("uniqDstPorts"),
        F.sum(F.when(by_address, F.col("records"))).alias("numRecords"),
    )


def pair_counts(flows: DataFrame, peer: str, keys: Sequence[str] = SOURCE) -> DataFrame:
    """How many flow records each (key, peer) pair has."""
    return flows.groupBy(*keys, peer).agg(F.count(F.lit(1)).alias("records"))


def single_feature(flows: DataFrame, feature: str, keys: Sequence[str] = SOURCE) -> DataFrame:
    """One feature on its own, as (key..., feature)."""
    keys = list(keys)
    if feature == "sumOfFlows":
        return flows.groupBy(*keys).agg(F.sum("numFlows").alias(feature))
    if feature == "sumOfBytes":
        return flows.groupBy(*keys).agg(F.sum("numBytes").alias(feature))
    peer = {"uniqDstIPs": "dstAddr", "uniqDstPorts": "dstPort"}[feature]
    return (pair_counts(flows, peer, keys).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias(feature)))


def features_by_join(flows: DataFrame, keys: Sequence[str] = SOURCE,
                     features: Sequence[str] = FEATURES, how: str = "inner") -> DataFrame:
    """The same features as a chain of joins of single-feature tables.

    Every table is already partitioned by the keys when it is joined, so the joins add no
    shuffle, but the flows are read once per feature; :func:`features_by_source` needs one
    pass. ``how`` is ``inner``, or ``full_outer`` with :data:`MODEL_FEATURES` for scoring.
    """
    tables = [single_feature(flows, f, keys) for f in features]
    return reduce(lambda left, right: left.join(right, list(keys), how), tables)


def model_features_by_join(flows: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """Scoring features by full outer joins."""
    return features_by_join(flows, keys, MODEL_FEATURES, "full_outer")


def flow_rates(flows: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """Average bytes per flow, total and average communication time (ms) per key."""
    total_flows = F.nullif(F.sum("numFlows"), F.lit(0))
    time = F.sum(F.col("timestampEnd") - F.col("timestampStart"))
    return flows.groupBy(*keys).agg(
        (F.sum("numBytes") / total_flows).alias("bytesPerFlow"),
        time.alias("commTime"),
        (time / total_flows).alias("avgCommTime"),
    )
