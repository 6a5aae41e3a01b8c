from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import StandardScaler, UnivariateFeatureSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowtide.functions import vector_columns
from flowtide.operators import prep

COLUMNS = ["a", "b", "flat"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    return pd.DataFrame({"a": rng.normal(50, 9, 200), "b": rng.exponential(1e6, 200), "flat": 4.0})


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data)


def collected(df):
    return df.toPandas()[COLUMNS].sort_values(COLUMNS).to_numpy()


@pytest.mark.parametrize("center", [True, False])
def test_standardize_matches_ml_scaler(frame, center):
    ours = prep.standardize(frame, COLUMNS, center=center)
    vectors = prep.assemble(frame, COLUMNS)
    theirs = StandardScaler(inputCol="features", outputCol="s", withMean=center).fit(vectors)
    theirs = theirs.transform(vectors).select(*vector_columns("s", COLUMNS))
    assert collected(ours) == pytest.approx(collected(theirs))


def test_population_scaling_has_unit_population_variance(frame):
    scaled = prep.standardize(frame, COLUMNS, sigma="population")
    row = scaled.agg(F.avg("a"), F.var_pop("a"), F.var_pop("flat"), F.max("flat")).first()
    assert tuple(row) == pytest.approx((0.0, 1.0, 0.0, 0.0), abs=1e-9)


def test_sample_and_population_forms_differ_by_the_known_factor(frame):
    sample = prep.standardize(frame, COLUMNS).agg(F.var_pop("a")).first()[0]
    assert sample == pytest.approx(199 / 200)


def test_standardize_single_row_and_nulls(spark):
    one = spark.createDataFrame([(3.0,)], "a double")
    assert prep.standardize(one, ["a"]).first()[0] == 0.0
    assert prep.standardize(one, ["a"], center=False).first()[0] == 0.0
    some = spark.createDataFrame([(3.0,), (None,), (5.0,)], "a double")
    assert prep.standardize(some, ["a"], center=False).filter("a is null").count() == 1


def test_interactions(spark):
    df = spark.createDataFrame([(1, 2.0, 0.0, 3.0), (2, 5.0, 0.0, 7.0)],
                               "id bigint, x double, zero double, y double")
    plain = prep.interactions(df)
    assert plain.columns == ["id", "x", "zero", "y", "id_x", "id_zero", "id_y", "x_zero", "x_y", "zero_y"]
    kept = prep.add_interactions(df)
    assert kept.columns == ["id", "x", "y", "x_y"]
    assert [r["x_y"] for r in kept.orderBy("id").collect()] == [6.0, 35.0]


def test_columns_with_nulls_are_not_zero_columns(spark):
    df = spark.createDataFrame([(0.0, None), (0.0, 0.0)], "a double, b double")
    assert prep.drop_zero_columns(df).columns == ["b"]


def test_anova_matches_the_closed_form_and_selector(spark):
    rng = np.random.default_rng(8)
    label = rng.integers(0, 3, 300)
    data = pd.DataFrame({
        "label": label.astype(float), "strong": label * 5 + rng.normal(0, 1, 300) + 1e6,
        "weak": label * 0.4 + rng.normal(0, 1, 300), "none": rng.normal(0, 1, 300)})
    df, columns = spark.createDataFrame(data), ["none", "weak", "strong"]
    scores = {r["feature"]: r["f_value"] for r in prep.anova_f(df, columns, "label").collect()}
    for c in columns:
        groups = [g[c].to_numpy() for _, g in data.groupby("label")]
        between = sum(len(g) * (g.mean() - data[c].mean()) ** 2 for g in groups) / 2
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 297
        assert scores[c] == pytest.approx(between / within, rel=1e-6)
    selector = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="o")
    selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(2)
    chosen = selector.fit(prep.assemble(df, columns)).selectedFeatures
    assert prep.select_k_best(df, columns, "label", 2) == [columns[i] for i in sorted(chosen)]


def test_sample_and_split(spark):
    df = prep.add_row_id(spark.range(20000).select((F.col("id") * 2).alias("v")))
    assert df.columns == ["id", "v"] and df.select("id").distinct().count() == 20000
    assert 1700 < prep.bernoulli_sample(df).count() < 2300
    train, test = prep.train_test_split(df)
    assert 15500 < train.count() < 16500
    assert train.count() + test.count() == 20000 and train.join(test, "id").count() == 0


def test_vector_roundtrip(frame):
    vectors = prep.assemble(frame, COLUMNS)
    back = vectors.select(*vector_columns("features", COLUMNS))
    assert collected(back) == pytest.approx(collected(frame))
    assert vectors.select(vector_to_array("features")).first()[0][2] == 4.0


def test_as_double_keeps_large_integers(spark):
    df = spark.createDataFrame([(2 ** 40 + 1,)], "v bigint")
    assert prep.as_double(df, ["v"]).first()[0] == 2.0 ** 40 + 1


def test_anova_extremes(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (0, 1.0, 2.0), (1, 5.0, 2.0), (1, 5.0, 2.0)],
                               "label int, split double, flat double")
    scores = {r["feature"]: r["f_value"] for r in prep.anova_f(df, ["split", "flat"], "label").collect()}
    assert scores == {"split": float("inf"), "flat": None}
    assert prep.select_k_best(df, ["flat", "split"], "label", 1) == ["split"]


def test_text_columns_are_left_alone(spark):
    df = spark.createDataFrame([("a", 2.0, 3.0), ("b", 0.0, 1.0)], "srcAddr string, x double, y double")
    assert prep.add_interactions(df).columns == ["srcAddr", "x", "y", "x_y"]
