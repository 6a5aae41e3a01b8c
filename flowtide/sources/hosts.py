"""Host inventory: which device an address is attached to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtide.schemas import HOSTS


def read_hosts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Host documents from JSON files.

    One document per file by default; with ``multi_line=False`` one per line, which lets
    Spark split large files.
    """
    return host_table(spark.read.schema(HOSTS).option("multiLine", multi_line).json(path))


def host_table(documents: DataFrame) -> DataFrame:
    """One row (ip, device) per address from ``hosts`` documents.

    Takes the first address and the first location of each host. An address listed more
    than once keeps its last entry in the document.
    """
    hosts = documents.select(F.posexplode("hosts").alias("position", "host")).select(
        "position",
        F.get(F.col("host.ipAddresses"), F.lit(0)).alias("ip"),
        F.get(F.col("host.locations"), F.lit(0))["elementId"].alias("device"),
    )
    return (hosts.filter(F.col("ip").isNotNull())
            .groupBy("ip")
            .agg(F.max_by("device", F.struct("position", "device")).alias("device")))
