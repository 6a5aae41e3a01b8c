"""Column expressions on flows and rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# IP protocol numbers that carry ports.
TCP = 6
UDP = 17

# Fixed value: application a rule is filed under.
RULE_APP = "org.onosproject.fwd"


def l4_port(protocol: Column, port: Column) -> Column:
    """The port where the protocol has ports, else 0."""
    return F.when(protocol.isin(TCP, UDP), port).otherwise(F.lit(0).cast("bigint"))


def block_network(ip: Column) -> Column:
    """The single-address network of ``ip``."""
    return F.concat(ip, F.lit("/32"))


def rule_path(device: Column, app: str = RULE_APP) -> Column:
    """Where the rules of a device are posted; null without a device."""
    return F.concat(F.lit("/flows/"), device, F.lit(f"?appId={app}"))
