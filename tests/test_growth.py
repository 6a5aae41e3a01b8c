"""What the findings of round 3 asked for: work that is done once, in bounded memory, with the same results."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import queries, views
from flowtide.operators import cluster, lloyd

COLUMNS = ("x", "y")


def plain_lloyd(points, times, centers, limit):
    centers = np.array(centers, float)
    for n in range(1, limit + 1):
        nearest = ((points[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        after = centers.copy()
        for k in range(len(centers)):
            own = nearest == k
            if own.any():
                after[k] = np.average(points[own], axis=0, weights=times[own])
        moved, centers = ((after - centers) ** 2).sum(axis=1).max(), after
        if moved <= lloyd.TOLERANCE ** 2:
            break
    return centers, n


@pytest.fixture(scope="module")
def points(spark):
    random = np.random.default_rng(3)
    rows = np.round(np.concatenate([random.normal(m, 1.0, (150, 2)) for m in (0, 4, 9)]), 4)
    return spark.createDataFrame([tuple(map(float, r)) for r in np.concatenate([rows, rows[:40]])], "x double, y double")


def test_one_pass_serves_all_models(spark, points):
    vectors = cluster.weighted_vectors(points, COLUMNS).cache()
    rows = np.array([tuple(r) for r in vectors.select(*COLUMNS, cluster.WEIGHT).collect()], float)
    drawn = lloyd.random_starts(vectors, COLUMNS, 12, 1)
    assert drawn == lloyd.random_starts(vectors.repartition(5), COLUMNS, 12, 1) and len(set(map(tuple, drawn))) == 12
    blocks = lloyd.packed(vectors.repartition(3), COLUMNS, cluster.WEIGHT).cache()
    found = lloyd.lloyd(blocks, {k: drawn[:k] for k in (2, 3, 12)}, (1, 3, 200))
    measured = lloyd.measures(blocks, {k: f[200] for k, f in found.items()})
    for k in (2, 3, 12):
        for limit in (1, 3, 200):
            expected, _ = plain_lloyd(rows[:, :2], rows[:, 2], drawn[:k], limit)
            assert np.allclose(found[k][limit], expected)
        square = ((rows[:, None, :2] - np.array(found[k][200])) ** 2).sum(axis=2).min(axis=1)
        assert measured[k][0] == pytest.approx((square * rows[:, 2]).sum())
        assert measured[k][1] == pytest.approx(np.average(np.sqrt(square), weights=rows[:, 2]))


def test_grid_costs_are_those_of_all_rows(points, monkeypatch):
    monkeypatch.setattr(cluster, "fit_kmeans", None)  # no fit, hence no job, of a single model
    grid = {(r["max_iter"], r["k"]): r for r in cluster.iteration_grid(points, COLUMNS, (1, 2, 5, 900), (1, 50)).collect()}
    assert set(grid) == {(n, k) for n in (1, 50) for k in (1, 2, 5, 900)}
    assert grid[50, 900]["wssse"] == pytest.approx(0, abs=1e-9)  # fewer vectors than centres
    assert grid[50, 1]["wssse"] >= grid[1, 2]["wssse"] >= grid[50, 2]["wssse"] >= grid[50, 5]["wssse"]


def test_vectors_without_a_value_are_an_error(spark):
    gap = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "x double, y double")
    with pytest.raises(Exception, match="needs a value"):
        lloyd.packed(gap, COLUMNS).count()
    found = cluster.costs_by_row(gap, COLUMNS, {1: [[2.0, 1.0]]}).first()  # left out, as sums leave them out
    assert (found["wssse"], found["distortion"]) == (4.0, 2.0)


def events(spark, folder) -> str:
    rows = spark.range(400).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 4000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 30).alias("user_id"), F.lit("click").alias("event_type"), (F.col("id") / 7).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"))
    rows.write.parquet(f"{folder}/events.parquet")
    lines = spark.range(300).select(
        (F.col("id") % 3 + 1).alias("l_suppkey"), F.col("id").alias("l_partkey"), (F.col("id") % 7).alias("l_linenumber"),
        F.col("id").cast("double").alias("l_quantity"), (F.col("id") * 1.5).alias("l_extendedprice"),
        F.lit("2024-01-05").cast("timestamp").alias("l_shipdate"))
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["standardize_gaps", "standardize_sample", "standardize_pop", "scale_only"])
def test_scaled_features_are_worked_out_once(spark, tmp_path, name):
    frame = queries.REGISTRY[name](spark, events(spark, tmp_path))
    assert frame.count() > 0
    assert not any("lineitem.parquet" in f or "events.parquet" in f for f in frame.inputFiles())


def test_messages_are_written_once(spark, tmp_path, monkeypatch):
    folder, written = events(spark, tmp_path), []
    monkeypatch.setattr(queries, "materialize", lambda df, purpose: written.append(purpose) or df)
    result = queries.days_in_parts(spark, folder)
    assert not written
    assert queries.read_mark(spark, result)["read"] == views.messages(spark, folder).count() == 400


def test_counts_of_terms_are_pooled_in_bounded_memory():
    from flowtide.llm.divergence import term_counts

    def batches(docs=40, words=20_000):
        for d in range(docs):
            text = " ".join("".join(chr(97 + int(c)) for c in f"{d * words + i:08d}") for i in range(words))
            yield pa.RecordBatch.from_pydict({"lang": ["en"], "source": ["a"], "text": [text]})

    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in term_counts(batches()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 800_000
    assert peak < 80 << 20  # 112 MB when 1.5 million counts were held
