"""From live feature rows to drop rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row

from flowtide.operators.rules import drop_rules
from flowtide.operators.score import exceedances, score
from flowtide.schemas import MODEL_FEATURES


def block_anomalies(live: DataFrame, model: DataFrame | list[Row], hosts: DataFrame,
                    keys: Sequence[str] = (), columns: Sequence[str] = MODEL_FEATURES,
                    scale: bool = True, center: bool = True) -> DataFrame:
    """Rules for the rows beyond their cluster's threshold, one per (keys, source)."""
    scored = score(live, model, columns, scale, center)
    return drop_rules(scored.filter("anomaly"), hosts, tuple(keys))


def block_exceedances(live: DataFrame, limits: dict[str, float], hosts: DataFrame,
                      keys: Sequence[str] = (),
                      columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rules for the rows beyond a sigma threshold, one per (keys, source)."""
    flagged = exceedances(live, limits, columns, (*keys, "srcAddr"))
    return drop_rules(flagged, hosts, tuple(keys))
