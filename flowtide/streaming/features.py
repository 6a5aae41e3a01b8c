"""Event-time features of a message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowtide.operators.features import (
    WINDOWED, count_pairs, destination_pairs, features_by_source, flat_window, with_window,
)
from flowtide.operators.flows import (
    AHEAD, ARRIVAL_TIME, EVENT_TIME, counted_flows, project_flows, rejected_flows, valid_flows,
)
from flowtide.operators.sketches import PRECISION, sketched_features
from flowtide.schemas import FEATURES, FLOW_COLUMNS
from flowtide.sources.flows import decode


def _decoded(messages: DataFrame, event_time: str, keep: tuple[str, ...] = ()) -> DataFrame:
    keys = list(dict.fromkeys((*FLOW_COLUMNS.values(), event_time)))
    keep = (*keep, *([ARRIVAL_TIME] if ARRIVAL_TIME in messages.columns else []))
    return project_flows(decode(messages, keys, keep), event_time, keep)


def valid_stream(messages: DataFrame, event_time: str = "timestamp", ahead: str = AHEAD,
                 counts: str | None = None) -> DataFrame:
    """Messages with a ``value`` column -> valid flows with their event time.

    With an ``arrivalTime`` column, records dated more than ``ahead`` after their arrival are rejected. ``counts`` names
    the metrics of :func:`counted_flows`, which :class:`FlowCounts` adds up.
    """
    decoded = _decoded(messages, event_time)
    flows = counted_flows(decoded, counts, ahead) if counts else valid_flows(decoded, ahead)
    return flows.drop(ARRIVAL_TIME)


def rejected_stream(messages: DataFrame, event_time: str = "timestamp", ahead: str = AHEAD) -> DataFrame:
    """The messages left out of :func:`valid_stream`, with the reason."""
    return rejected_flows(_decoded(messages, event_time, ("value",)), ahead).select("value", "reason")


def windowed_features(flows: DataFrame, duration: str = "60 seconds",
                      delay: str = "2 minutes") -> DataFrame:
    """Features per window and source, one row each, once the window is closed.

    Flows later than ``delay`` behind the newest event are dropped (:func:`keep_every_flow` keeps them). State holds one row per
    distinct (source, destination) of the open windows, spread over all partitions, and is
    removed with the window.
    """
    timely = with_window(flows.withWatermark(EVENT_TIME, delay), duration)
    return flat_window(features_by_source(timely, WINDOWED))


def windowed_sketches(flows: DataFrame, duration: str = "60 seconds", delay: str = "2 minutes",
                      precision: int = PRECISION) -> DataFrame:
    """Sums and mergeable sketches per window and source, once the window is closed.

    State holds one row per (window, source), whatever the number of destinations.
    """
    timely = with_window(flows.withWatermark(EVENT_TIME, delay), duration)
    return flat_window(sketched_features(timely, WINDOWED, precision))


def joined_features(flows: DataFrame, duration: str = "60 seconds", delay: str = "2 minutes") -> DataFrame:
    """The features of :func:`windowed_features` as a full outer join of two aggregated streams.

    One side sums flows, bytes and records, the other counts distinct destinations; both close their windows by the same
    watermark. The join keeps a window's row of one side until the other side's has come, and drops its state with
    the window. For sides that come from different streams; from one stream, :func:`windowed_features` reads it once.
    """
    timely = with_window(flows.withWatermark(EVENT_TIME, delay), duration)
    sums = timely.groupBy(*WINDOWED).agg(
        F.sum("numFlows").alias("sumOfFlows"), F.sum("numBytes").alias("sumOfBytes"), F.count(F.lit(1)).alias("numRecords"))
    peers = count_pairs(destination_pairs(timely, WINDOWED), WINDOWED).select(*WINDOWED, "uniqDstIPs", "uniqDstPorts")
    return join_windows(sums, peers).select("win", "srcAddr", *FEATURES, "numRecords")


def join_windows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two windowed streams on window and source; a side without a row is null."""
    return flat_window(left.join(right, list(WINDOWED), "full_outer"))
