"""Raw records -> the ten flow columns, valid flows and rejects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, functions as F

from flowtide.functions.flow import l4_port
from flowtide.schemas import FLOW_COLUMNS

EVENT_TIME = "eventTime"
# When a message came in, by the clock of the receiving side.
ARRIVAL_TIME = "arrivalTime"
AHEAD = "10 minutes"


def project_flows(raw: DataFrame, event_time: str | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Select and rename the ten flow columns.

    ``event_time`` names an epoch-millisecond field that is added as timestamp ``eventTime``.
    ``keep`` passes further columns through, such as the message a record came from.
    """
    columns = [F.col(key).alias(name) for name, key in FLOW_COLUMNS.items()]
    if event_time:
        columns.append(F.timestamp_millis(event_time).alias(EVENT_TIME))
    return raw.select(*columns, *keep)


def _required(flows: DataFrame) -> list[str]:
    return [*FLOW_COLUMNS, *([EVENT_TIME] if EVENT_TIME in flows.columns else [])]


def _ahead(flows: DataFrame, ahead: str) -> Column:
    """Whether a flow claims a time later than its arrival allows."""
    if EVENT_TIME not in flows.columns or ARRIVAL_TIME not in flows.columns:
        return F.lit(False)
    return F.coalesce(F.col(EVENT_TIME) > F.col(ARRIVAL_TIME) + F.expr(f"INTERVAL {ahead}"), F.lit(False))


def valid_flows(flows: DataFrame, ahead: str = AHEAD) -> DataFrame:
    """Flows with every required column present.

    Where the arrival time is known, flows dated more than ``ahead`` after it are left out: one
    such record would move the watermark of a stream past all traffic still to come.
    """
    return flows.filter(reduce(and_, [F.col(c).isNotNull() for c in _required(flows)]) & ~_ahead(flows, ahead))


def rejected_flows(flows: DataFrame, ahead: str = AHEAD) -> DataFrame:
    """The complement of :func:`valid_flows`, with the reason.

    ``unreadable`` if nothing could be read, else ``missing`` and the column names, or
    ``ahead of arrival``.
    """
    absent = [F.col(c).isNull() for c in _required(flows)]
    return with_reason(flows.filter(reduce(or_, absent) | _ahead(flows, ahead)), ahead)


def with_reason(flows: DataFrame, ahead: str = AHEAD) -> DataFrame:
    """Every flow with the reason to reject it, null for a valid one."""
    required = _required(flows)
    absent = [F.col(c).isNull() for c in required]
    names = F.concat_ws(",", *[F.when(a, F.lit(c)) for c, a in zip(required, absent)])
    return flows.withColumn(
        "reason",
        F.when(reduce(and_, absent), F.lit("unreadable"))
        .when(reduce(or_, absent), F.concat(F.lit("missing "), names))
        .when(_ahead(flows, ahead), F.lit("ahead of arrival")))


def counted_flows(flows: DataFrame, name: str | Observation = "flows", ahead: str = AHEAD) -> DataFrame:
    """:func:`valid_flows`, with counts of what was read, passed on and rejected observed on the way.

    A batch job gets them from an ``Observation`` after its action, a stream by name in its progress events. They take
    no pass of their own, and read = valid + unreadable + missing + ahead.
    """
    absent = [F.col(c).isNull() for c in _required(flows)]
    none, some, early = reduce(and_, absent), reduce(or_, absent), _ahead(flows, ahead)
    return valid_flows(flows.observe(
        name, F.count(F.lit(1)).alias("read"), F.count_if(~some & ~early).alias("valid"),
        F.count_if(none).alias("unreadable"), F.count_if(some & ~none).alias("missing"),
        F.count_if(~some & early).alias("ahead")), ahead)


def with_l4_ports(flows: DataFrame) -> DataFrame:
    """Ports only where the protocol has them: anything but TCP and UDP gets port 0."""
    return flows.withColumns({c: l4_port(F.col("protocol"), F.col(c))
                              for c in ("srcPort", "dstPort")})
