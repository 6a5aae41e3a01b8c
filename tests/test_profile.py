from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowtide.operators import profile, quantiles
from flowtide.session import discard, job_tables, materialize


def one_column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("values", [
    [5.0], [1, 2], [7] * 500, [0] * 900 + list(range(100)), list(range(1000)),
    [2.0 ** i for i in range(60)], [-3, -2.5, None, 4, 1e12, 1e12, None],
])
def test_quantiles_match_numpy(spark, values):
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    row = profile.quantiles(one_column(spark, values), ["x"], probabilities).first()
    present = [v for v in values if v is not None]
    assert row["n"] == len(present)
    assert row["values"] == pytest.approx(np.quantile(present, probabilities).tolist())


def test_quantiles_of_random_columns(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"a": rng.lognormal(3, 2, 3000), "b": rng.integers(0, 4, 3000).astype(float)})
    rows = {r["feature"]: r["values"] for r in profile.quantiles(
        spark.createDataFrame(data), ["a", "b"], (0.25, 0.5, 0.75)).collect()}
    for c in data:
        assert rows[c] == pytest.approx(data[c].quantile([0.25, 0.5, 0.75]).tolist())


def test_describe_matches_pandas(spark):
    data = pd.DataFrame({"a": [1.0, 2.0, 2.0, 10.0], "b": [0.0, 0.0, 0.0, 1.0]})
    got = {r["feature"]: tuple(r)[1:] for r in profile.describe(
        spark.createDataFrame(data), ["a", "b"]).collect()}
    for c in data:
        assert got[c] == pytest.approx(tuple(data[c].describe()))


def test_column_stats(spark):
    row = profile.column_stats(one_column(spark, [1, 2, 3, 6]), ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (4, 3.0, 1.0, 6.0)
    assert row["variance"] == pytest.approx(14 / 3) and row["stddev"] == pytest.approx((14 / 3) ** 0.5)


def test_value_counts_order_and_top(spark):
    counts = profile.value_counts(one_column(spark, [3, 1, 1, 2, 3, None]), "x")
    assert [tuple(r) for r in counts.collect()] == [(1.0, 2), (3.0, 2), (2.0, 1)]
    assert profile.value_counts(one_column(spark, [3, 1, 1]), "x", top=1).collect()[0]["value"] == 1.0


@pytest.mark.parametrize("values", [[0, 1, 2, 9.5, 10, 10], [4, 4, 4], [-1, 3], list(range(101))])
def test_histogram_matches_numpy(spark, values):
    rows = profile.histogram(one_column(spark, [*values, None]), "x").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["low"] for r in rows] == pytest.approx(edges[:-1].tolist())
    assert rows[-1]["high"] == pytest.approx(edges[-1])


def test_correlation(spark):
    data = pd.DataFrame({"a": [1.0, 2, 3, 4], "b": [2.0, 4, 6, 9], "c": [5.0, 1, 4, 0]})
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in profile.correlation_matrix(
        spark.createDataFrame(data), list(data)).collect()}
    expected = data.corr()
    assert len(got) == 9
    for (a, b), value in got.items():
        assert value == pytest.approx(expected.loc[a, b])


def test_quality_and_filters(spark):
    df = one_column(spark, [0, 0, 1, None, float("nan"), 5])
    assert tuple(profile.quality_report(df, ["x"]).first()) == ("x", 6, 2, 2)
    assert profile.null_rows(df, "x").count() == 2
    assert profile.zero_rows(df, "x").count() == 2
    assert profile.exclude_values(df, "x", (0, 5)).count() == 3
    assert tuple(profile.shape(df).first()) == (6, 1)


def test_null_rows_of_integers(spark):
    df = spark.createDataFrame([(1,), (None,)], "x bigint")
    assert profile.null_rows(df, "x").count() == 1
    assert profile.exclude_values(df, "x", (1,)).first()["x"] is None


def test_quantiles_never_sort_a_column_in_one_task(spark):
    df = spark.range(5000).select((F.col("id") * 1.0).alias("x"))
    plan = profile.quantiles(df, ["x"], (0.5,))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_missing_values_and_infinities(spark):
    df = one_column(spark, [1, 2, 4, None, float("nan")])
    assert profile.describe(df, ["x"]).first()[1:] == pytest.approx(
        tuple(pd.Series([1.0, 2, 4]).describe()))
    assert sum(r["count"] for r in profile.histogram(df, "x").collect()) == 3
    wild = one_column(spark, [float("-inf"), 1, 2, 3, float("inf")])
    assert profile.quantiles(wild, ["x"], (0.25, 0.5, 0.75)).first()["values"] == [1.0, 2.0, 3.0]
    empty = profile.describe(one_column(spark, [None, float("nan")]), ["x"]).first()
    assert empty["count"] == 0 and empty["q50"] is None


def test_text_and_nan_are_handled(spark):
    rows = spark.createDataFrame([("a", 1.0, 2), (None, float("nan"), 0), ("", None, None)], "t string, x double, n int")
    report = {r["feature"]: (r["rows"], r["null_rows"], r["zero_rows"]) for r in profile.quality_report(rows, ("t", "x", "n")).collect()}
    assert report == {"t": (3, 1, 0), "x": (3, 2, 0), "n": (3, 1, 1)}
    assert profile.null_rows(rows, "t").count() == 1 and profile.zero_rows(rows, "t").count() == 0
    assert [tuple(r) for r in profile.value_counts(rows, "x").collect()] == [(1.0, 1)]


def test_describe_reads_a_written_table_a_few_times(spark, monkeypatch):
    """Statistics, then one pass per 12 bits of code that are still in doubt; nothing sorts values."""
    passes, counts = [], quantiles.prefix_counts

    def counted(*args):
        passes.append(counts(*args))
        return passes[-1]

    monkeypatch.setattr(quantiles, "prefix_counts", counted)
    with job_tables(spark):
        table = materialize(spark.range(1000).selectExpr("cast(id as double) as x", "cast(id % 7 as double) as y"), "t")
        row = {r["feature"]: r for r in profile.describe(table, ["x", "y"]).collect()}
        plans = [p._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0] for p in passes]
    assert row["x"]["q50"] == 499.5 and row["y"]["max"] == 6
    assert 1 <= len(plans) <= 6
    for plan in plans:
        assert "Sort" not in plan and "SinglePartition" not in plan and plan.count("FileScan") == 1


WILD = [0.0, -0.0, 1.0, -1.0, 2.0, 3.0, 1.5, 4.9e-324, -4.9e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1e-310, 1.7976931348623157e308,
        -1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1 / 3, 1e16, 2.0 ** 53, 2.0 ** 53 - 1, 7.0, 8.0, 7.999999999999999]


def test_codes_are_the_bits_of_doubles(spark):
    rng = np.random.default_rng(11)
    values = [*WILD, *[float(np.nextafter(2.0 ** e, d)) for e in range(-1074, 1024, 3) for d in (0, np.inf)],
              *[2.0 ** e for e in range(-1074, 1024)], *rng.normal(size=2000), *(10.0 ** rng.uniform(-320, 308, 2000))]
    rows = quantiles.with_codes(one_column(spark, values), ["x"]).withColumnRenamed("x_code", "code").collect()
    for r in rows:
        bits = int(np.float64(abs(r["x"])).view(np.int64))
        assert r["code"] == (-bits if r["x"] < 0 else bits), r


def test_quantiles_of_wild_columns(spark):
    rng = np.random.default_rng(12)
    values = [v for v in WILD if np.isfinite(v)] + (rng.normal(size=500) * 1e-3).tolist() + [5.5] * 300
    probabilities = (0.0, 0.01, 0.3, 0.5, 0.77, 1.0)
    found = profile.quantiles(one_column(spark, values), ["x"], probabilities).first()["values"]
    assert found == pytest.approx(np.quantile(values, probabilities).tolist(), rel=1e-12, abs=0)


def test_job_tables_leave_nothing(spark):
    with job_tables(spark) as folder:
        table = materialize(spark.range(5), "t")
        assert table.count() == 5 and table.written_to.startswith(folder) and Path(table.written_to).exists()
    assert not Path(folder).exists()
    alone = materialize(spark.range(5), "t")
    discard(alone)
    assert not Path(alone.written_to).exists()
