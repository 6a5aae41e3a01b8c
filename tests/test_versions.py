"""Models in force one after the other, and sketches merged over ranges of windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from flowtide.operators import sketches, versions
from flowtide.operators.score import score
from flowtide.schemas import MODEL, MODEL_FEATURES

LIVE = "id int, win timestamp, sumOfBytes double, uniqDstIPs double, uniqDstPorts double, threshold string"


def model(spark, seed, k=3):
    rng = random.Random(seed)
    moments = [[rng.uniform(1, 5) for _ in range(3)], [rng.choice([0.0, 2.0, None]) for _ in range(3)]]
    return spark.createDataFrame([(i, [rng.uniform(-1, 3) for _ in range(3)], None, *moments, rng.choice([None, rng.uniform(0, 2)]))
                                  for i in range(k)], MODEL)


@pytest.fixture
def live(spark):
    rng = random.Random(5)
    rows = [(i, f"2024-01-{rng.randrange(1, 29):02d} 00:00:00", *[rng.choice([None, float("nan"), *[rng.uniform(-5, 9)] * 9])
                                                                  for _ in range(3)], "own") for i in range(300)]
    rows += [(900, None, 1.0, 1.0, 1.0, "own"), (901, "2024-01-10 00:00:00", 1.0, 1.0, 1.0, "own")]
    return spark.createDataFrame([(a, b, *c) for a, b, *c in rows], LIVE.replace("win timestamp", "win string")).withColumn(
        "win", F.col("win").cast("timestamp"))


SINCE = ["2024-01-05 00:00:00", "2024-01-10 00:00:00", "2024-01-20 00:00:00"]


@pytest.mark.parametrize("how", [{}, {"scale": False}, {"center": False}])
def test_each_row_is_scored_by_its_own_model(spark, live, tmp_path, how):
    path = str(tmp_path / "models")
    assert versions.load_versions(spark, path).count() == 0
    models = [model(spark, n) for n in range(3)]
    for since, m in zip(SINCE[::-1], models[::-1]):
        versions.save_version(m, path, since)
    versions.save_version(models[1], path, SINCE[1])  # again
    found = versions.score_in_force(live, versions.load_versions(spark, path), "win", **how)
    assert found.columns == [c for c in live.columns if c != "threshold"] + ["since", "distance", "cluster", "threshold", "anomaly"]
    told = {r["id"]: r for r in found.collect()}
    assert len(told) == live.count() == found.count()
    seen = 0
    for begin, end, m in zip(SINCE, [*SINCE[1:], "2999-01-01"], models):
        for r in score(live.drop("threshold").filter((F.col("win") >= begin) & (F.col("win") < end)), m, **how).collect():
            own = told[r["id"]]
            assert (own["cluster"], own["threshold"], own["anomaly"]) == (r["cluster"], r["threshold"], r["anomaly"])
            assert own["distance"] == pytest.approx(r["distance"]) and str(own["since"]) == begin
            seen += 1
    rest = [r for r in told.values() if r["since"] is None]
    assert len(rest) + seen == len(told) and any(r["id"] == 900 for r in rest)
    assert all(r["distance"] is None and r["anomaly"] is False for r in rest)
    assert sum(r["anomaly"] for r in told.values()) > 10


def test_no_version_and_no_rows(spark, live, tmp_path):
    none = versions.load_versions(spark, str(tmp_path / "none"))
    assert versions.score_in_force(live, none, "win").filter("anomaly or distance is not null").count() == 0
    versions.save_version(model(spark, 1), str(tmp_path / "one"), SINCE[0])
    assert versions.score_in_force(live.limit(0), versions.load_versions(spark, str(tmp_path / "one")), "win").count() == 0


def test_only_versions_in_force_are_taken(spark, tmp_path):
    path = str(tmp_path / "models")
    for n, since in enumerate(SINCE):
        versions.save_version(model(spark, n), path, since)
    kept = versions.load_versions(spark, path)
    times = sorted(r["since"] for r in kept.select("since").distinct().collect())
    taken = lambda a, b: sorted(r[0] for r in versions.within(kept, a, b).select("since").distinct().collect())
    assert taken(times[0] + 1, times[1]) == times[:2] and taken(times[1], times[1]) == [times[1]]
    assert taken(times[0] - 5, times[0] - 1) == [] and taken(0, times[2]) == times and taken(None, None) == []
    assert taken(times[2] + 9, times[2] + 99) == [times[2]]


def test_merged_sketches_are_near_the_exact_counts(spark):
    rng = random.Random(3)
    rows = [(w, s, f"d{rng.randrange(n)}" if rng.random() > 0.01 else None, rng.randrange(n), 10, 1)
            for s, n in (("a", 3), ("b", 400), ("c", 20_000)) for w in range(20) for _ in range(1500 if s == "c" else 60)]
    flows = spark.createDataFrame(rows, "minute int, srcAddr string, dstAddr string, dstPort long, numBytes long, numFlows long")
    minutes = sketches.sketched_features(flows, ("minute", "srcAddr"))
    hours = sketches.merged_features(minutes.withColumn("hour", F.expr("minute div 5")), ("hour", "srcAddr"))
    assert minutes.count() == 60 and hours.count() == 12
    exact = {r[0]: r for r in flows.groupBy("srcAddr").agg(
        F.countDistinct("dstAddr"), F.countDistinct("dstPort"), F.sum("numBytes"), F.count("*")).collect()}
    for parts in (minutes, hours):  # merged in one step or in two
        for r in sketches.estimated(sketches.merged_features(parts, ("srcAddr",))).collect():
            _, addresses, ports, volume, records = exact[r["srcAddr"]]
            assert (r["sumOfBytes"], r["numRecords"], r["sumOfFlows"]) == (volume, records, records)
            assert abs(r["uniqDstIPs"] - addresses) <= sketches.error() * addresses
            assert abs(r["uniqDstPorts"] - ports) <= sketches.error() * ports
            if ports < 100:
                assert (r["uniqDstIPs"], r["uniqDstPorts"]) == (addresses, ports)
    blank = sketches.estimated(sketches.sketched_features(flows.withColumn("dstAddr", F.lit(None).cast("string")), ("srcAddr",)))
    assert {r["uniqDstIPs"] for r in blank.collect()} == {0}
    assert sketches.sketched_features(flows.limit(0), ("srcAddr",)).count() == 0
