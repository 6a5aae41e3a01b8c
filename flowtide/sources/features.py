"""Feature rows: the Parquet store, its rules and headerless CSV."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtide.schemas import FEATURE_CSV, STORE
from flowtide.sinks.folders import Folders
from flowtide.sinks.parts import live_folders
from flowtide.sources.flows import read_lines


def _iso(day: str) -> str:
    return date.fromisoformat(day[:10]).isoformat()


def read_store(spark: SparkSession, path: str, since: str | None = None,
               until: str | None = None) -> DataFrame:
    """The feature store, optionally limited to days in ``[since, until)``.

    The store's day folders are listed once by name; only those in the range are handed to the
    reader, so the parts of other days are never listed. Without a range, rows without a day are included.
    Of days that were compacted only the live parts are read, so that no row is missing or doubled at any time.
    """
    folders = Folders(spark, path)
    days = folders.matching("day=*")
    if since or until:
        low, high = _iso(since) if since else "", _iso(until) if until else "~"
        named = {d: d.partition("=")[2] for d in days if "__HIVE" not in d}
        days = [d for d, name in named.items() if low <= name < high]
    live = [part for day in days for part in live_folders(folders, day)]
    if not live:
        return spark.createDataFrame([], STORE)
    return (spark.read.schema(STORE).option("basePath", path)
            .parquet(*[f"{path.rstrip('/')}/{part}" for part in live]))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """All rules written so far, with their ``writer`` and ``batch``."""
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/writer=*")


def read_feature_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV with bytes, destination addresses and destination ports."""
    return spark.read.schema(FEATURE_CSV).option("header", False).csv(path)


def checked_feature_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The lines of :func:`read_feature_csv` that hold three numbers, and the others as (line, reason).

    Nothing is cut off or made null: a line with a fourth field, a missing or empty field or a text in place of a number
    is rejected as it stands, with the number of its fields, ``empty field`` or ``not a number``. Blank lines are neither.
    """
    names = FEATURE_CSV.fieldNames()
    schema = f"{', '.join(f'{n} double' for n in names)}, _unread string"
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread"}
    lines = read_lines(spark, path).select(F.col("value").alias("line"), F.from_csv("value", schema, how).alias("row"))
    fields = F.split("line", ",", -1)
    reason = (F.when(F.size(fields) != len(names), F.concat(F.size(fields).cast("string"), F.lit(" fields")))
              .when(F.exists(fields, lambda f: F.trim(f) == ""), F.lit("empty field"))
              .when(F.col("row._unread").isNotNull(), F.lit("not a number")))
    judged = lines.withColumn("reason", reason)
    return (judged.filter(F.col("reason").isNull()).select(*[F.col(f"row.{n}").alias(n) for n in names]),
            judged.filter(F.col("reason").isNotNull()).select("line", "reason"))
