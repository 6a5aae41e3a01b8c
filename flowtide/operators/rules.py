"""Flagged sources -> device lookup -> drop rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowtide.functions.flow import RULE_APP, block_network, rule_path

# Fixed values of a drop rule.
PRIORITY = 40000
TIMEOUT = 0
IS_PERMANENT = "true"
ETH_TYPE = "0x0800"


def host_lookup(flagged: DataFrame, hosts: DataFrame, ip: str = "srcAddr") -> DataFrame:
    """Add the ``device`` of each flagged source and whether it is ``mapped``.

    Hosts hold one row per address. Spark sends that table to every task while it is below
    the broadcast limit of the session and otherwise shuffles both sides.
    """
    return (flagged.join(hosts.withColumnRenamed("ip", ip), ip, "left")
            .withColumn("status", F.when(F.col("device").isNull(), F.lit("unmapped"))
                        .otherwise(F.lit("mapped"))))


def rule_body(device: Column, ip: Column) -> Column:
    """The rule document as JSON text. An empty treatment means the traffic is dropped."""
    criteria = F.array(
        F.struct(F.lit("ETH_TYPE").alias("type"), F.lit(ETH_TYPE).alias("ethType"),
                 F.lit(None).cast("string").alias("ip")),
        F.struct(F.lit("IPV4_SRC").alias("type"), F.lit(None).cast("string").alias("ethType"),
                 block_network(ip).alias("ip")),
    )
    return F.to_json(F.struct(
        F.lit(PRIORITY).alias("priority"),
        F.lit(TIMEOUT).alias("timeout"),
        F.lit(IS_PERMANENT).alias("isPermanent"),
        device.alias("deviceId"),
        F.create_map().cast("map<string,string>").alias("treatment"),
        F.struct(criteria.alias("criteria")).alias("selector"),
    ))


def not_written(rules: DataFrame, written: DataFrame) -> DataFrame:
    """The rules whose path is not among those written before; unmapped rows have none and stay.

    Written rules grow with time, so Spark sends the smaller side along or shuffles both.
    """
    return rules.join(written.select("path").filter("path is not null").distinct(), "path", "left_anti").select(*rules.columns)


def hold_off(rules: DataFrame, earlier: DataFrame, hold: str, at: str = "win", ip: str = "srcAddr") -> DataFrame:
    """Of each source's rules, in order of time, those at least ``hold`` after the last one kept.

    ``earlier`` holds the rules kept before. A source's times in one batch are folded in order, starting from its last
    earlier rule; only earlier rules that can still hold something off are read.
    """
    gap = F.expr(f"INTERVAL {hold}")
    oldest = rules.agg(F.min(at).alias("oldest")).scalar()
    last = earlier.filter(F.col(at) > oldest - gap).groupBy(ip).agg(F.max(at).alias("_last"))
    times = rules.groupBy(ip).agg(F.array_sort(F.collect_set(at)).alias("_times")).join(last, ip, "left")
    kind = rules.schema[at].dataType.simpleString()
    start = F.struct(F.col("_last").alias("last"), F.array().cast(f"array<{kind}>").alias("kept"))
    free = lambda state, t: state["last"].isNull() | (t >= state["last"] + gap)
    kept = F.aggregate("_times", start, lambda state, t: F.when(
        free(state, t), F.struct(t.alias("last"), F.array_append(state["kept"], t).alias("kept"))).otherwise(state),
        lambda state: state["kept"])
    return rules.join(times.select(ip, F.explode(kept).alias(at)), [ip, at], "left_semi").select(*rules.columns)


def drop_rules(flagged: DataFrame, hosts: DataFrame, keys: tuple[str, ...] = (),
               ip: str = "srcAddr", app: str = RULE_APP) -> DataFrame:
    """One rule per flagged row: keys, source, device, status, path and body.

    A source without a device keeps its row, marked ``unmapped``, without path and body.
    """
    mapped = F.col("device").isNotNull()
    return host_lookup(flagged.select(*keys, ip), hosts, ip).select(
        *keys, ip, "device", "status",
        rule_path(F.col("device"), app).alias("path"),
        F.when(mapped, rule_body(F.col("device"), F.col(ip))).alias("body"))
