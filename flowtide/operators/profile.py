"""Statistics of feature tables. Each reads its input once or a fixed number of times."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowtide.functions.stats import missing, present, presented
from flowtide.operators.quantiles import quantile_values
from flowtide.session import materialize


def _rows(one_row: DataFrame, columns: Sequence[str], names: Sequence[str],
          label: str = "feature") -> DataFrame:
    """Turn a one-row table of structs, one per column, into one row per column."""
    entry = F.explode(F.array(*[
        F.struct(F.lit(c).alias(label), *[F.col(f"`{c}`.{n}").alias(n) for n in names])
        for c in columns
    ]))
    return one_row.select(entry.alias("row")).select("row.*")


STATS = ("count", "mean", "min", "max", "variance", "stddev")


def _stats(column: str) -> list[Column]:
    return [F.count(column).alias("count"), F.avg(column).alias("mean"),
            F.min(column).alias("min"), F.max(column).alias("max"),
            F.var_samp(column).alias("variance"), F.stddev_samp(column).alias("stddev")]


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, min, max, sample variance and deviation of the values present, one row
    per column."""
    row = df.select(*[present(df, c).alias(c) for c in columns]).agg(*[
        F.struct(*_stats(c)).alias(c) for c in columns])
    return _rows(row, columns, STATS)


def _written(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles in a written table, for input that is read more than once."""
    named = df.select(*[present(df, c).alias(c) for c in columns])
    return named if hasattr(df, "written_to") else materialize(named, "columns")


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles, (feature, n, values), by radix selection (:mod:`flowtide.operators.quantiles`).

    A computed input is written once. Columns without values have no row.
    """
    named = _written(df, columns)
    counts = named.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    found = quantile_values(named, counts, [float(p) for p in probabilities])
    return df.sparkSession.createDataFrame(
        [(c, counts[c], found[c]) for c in found], "feature string, n long, values array<double>")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, min, quartiles and max, one row per column, from a few scans of a written table."""
    named = _written(df, columns)
    stats = named.agg(*[F.struct(*_stats(c)).alias(c) for c in columns]).first()
    quartiles = quantile_values(named, {c: stats[c]["count"] for c in columns}, (0.25, 0.5, 0.75))
    rows = [(c, stats[c]["count"], stats[c]["mean"], stats[c]["stddev"], stats[c]["min"],
             *quartiles.get(c, (None, None, None)), stats[c]["max"]) for c in columns]
    return df.sparkSession.createDataFrame(
        rows, "feature string, count long, mean double, stddev double, min double, q25 double, q50 double, q75 double, max double")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Distinct values by frequency, most frequent first; ``top`` keeps the first N.

    Nulls and NaN are no values.
    """
    counts = (df.filter(~missing(df, column)).groupBy(F.col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), "value"))
    return counts.limit(top) if top is not None else counts


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from min to max, the last one closed; empty bins are listed with 0."""
    value = present(df, column)
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))
                  .alias("ends")).scalar()
    # A constant column gets bins half a unit to either side.
    flat = F.col("ends.low") == F.col("ends.high")
    low = F.col("ends.low") - F.when(flat, 0.5).otherwise(0.0)
    high = F.col("ends.high") + F.when(flat, 0.5).otherwise(0.0)
    width = (high - low) / bins

    filled = (
        df.filter(value.isNotNull())
        .select(value.alias("value"), ends.alias("ends"))
        .select(F.least(F.floor((F.col("value") - low) / width), F.lit(bins - 1))
                .cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    )
    axis = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
            .withColumn("ends", ends)
            .select("bin", (low + F.col("bin") * width).alias("low"),
                    (low + (F.col("bin") + 1) * width).alias("high")))
    return (axis.join(filled, "bin", "left")
            .select("bin", "low", "high", F.coalesce("rows", F.lit(0).cast("bigint")).alias("count")))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass, over the rows that hold both."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = presented(df, columns).agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    both_ways = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    both_ways += [(b, a, i) for a, b, i in both_ways if a != b]
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                 F.col(f"{i}").alias("correlation"))
        for a, b, i in both_ways
    ])).alias("row")).select("row.*")


def _zero(df: DataFrame, column: str) -> Column:
    numeric = isinstance(df.schema[column].dataType, T.NumericType)
    return F.col(column) == 0 if numeric else F.lit(False)


def quality_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, missing (null or NaN) rows and zero rows, one row per column. Text is never zero."""
    row = df.agg(*[
        F.struct(F.count(F.lit(1)).alias("rows"),
                 F.count_if(missing(df, c)).alias("null_rows"),
                 F.count_if(_zero(df, c)).alias("zero_rows")).alias(c)
        for c in columns
    ])
    return _rows(row, columns, ("rows", "null_rows", "zero_rows"))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is null or NaN."""
    return df.filter(missing(df, column))


def zero_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is 0."""
    return df.filter(_zero(df, column))


def exclude_values(df: DataFrame, column: str, values: Sequence[float]) -> DataFrame:
    """Drop rows holding one of ``values``; rows without a value stay."""
    kept = reduce(lambda rest, v: rest & (F.col(column) != v), values, F.lit(True))
    return df.filter(F.coalesce(kept, F.lit(True)))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
