from __future__ import annotations

import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtide.functions import euclidean, one_sided, one_sided_by_sign, sigma_steps, zero_guard
from flowtide.operators import cluster, rules, score, thresholds
from flowtide.operators.prep import assemble
from flowtide.plans import (
    block_anomalies, block_exceedances, explore, fit_detector, load_model, save_model,
)
from flowtide.schemas import FEATURES, MODEL, MODEL_FEATURES
from flowtide.sources import host_table, read_hosts
from flowtide.schemas import HOSTS

XYZ = ["x", "y", "z"]
CENTERS = [[1.0, 1.0, 1.0], [2.0, 2.0, 2.0], [3.0, 1.0, 4.0]]
LIMITS = [1.0, 1.5, 1.5]


def points(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "x double, y double, z double")


def model_rows(limits=LIMITS, mean=None, stddev=None, centers=CENTERS):
    return [{"cluster": i, "center": c, "feature_max": None, "mean": mean, "stddev": stddev,
             "threshold": t} for i, (c, t) in enumerate(zip(centers, limits))]


# --- thresholds ------------------------------------------------------------------------


@pytest.mark.parametrize("mean, sigma, largest, n", [
    (10.0, 5.0, 20.0, 2), (10.0, 5.0, 20.1, 3), (10.0, 5.0, 27.0, 4), (10.0, 0.0, 10.0, 2),
    (10.0, None, 10.0, 2),
])
def test_sigma_steps(spark, mean, sigma, largest, n):
    value = F.lit(sigma).cast("double")
    assert spark.range(1).select(sigma_steps(F.lit(largest), F.lit(mean), value)).first()[0] == n


def test_sigma_steps_is_the_smallest_covering_n(spark):
    rng = np.random.default_rng(1)
    cases = [tuple(map(float, c)) for c in zip(rng.normal(0, 50, 300), rng.exponential(5, 300) + .01,
                                               rng.normal(40, 80, 300))]
    df = spark.createDataFrame(cases, "m double, s double, top double")
    for r in df.select("*", sigma_steps(F.col("top"), F.col("m"), F.col("s")).alias("n")).collect():
        assert r["top"] <= r["m"] + r["n"] * r["s"] + 1e-9
        assert r["n"] == 2 or r["top"] > r["m"] + (r["n"] - 1) * r["s"] - 1e-9


def test_zero_guard(spark):
    df = spark.createDataFrame([(0.0,), (None,), (2.5,)], "s double")
    assert [r[0] for r in df.select(zero_guard(F.col("s"))).collect()] == [1.0, 1.0, 2.5]


def test_sigma_thresholds_and_detector(spark):
    store = spark.createDataFrame([(i, 10 * i, i % 3, 5) for i in range(1, 21)],
                                  "sumOfFlows bigint, sumOfBytes bigint, uniqDstIPs int, uniqDstPorts int")
    limits = score.upper_limits(thresholds.sigma_thresholds(store))
    data = [i * 10 for i in range(1, 21)]
    mean, sigma = np.mean(data), np.std(data, ddof=1)
    assert limits["sumOfBytes"] == pytest.approx(mean + 2 * sigma)
    assert limits["uniqDstPorts"] == 5.0
    live = spark.createDataFrame([
        ("quiet", 10, 1, 5), ("ports", 10, 1, 6), ("both", 10000, 90, 5), ("edge", 10, 1, 5)],
        "srcAddr string, sumOfBytes bigint, uniqDstIPs bigint, uniqDstPorts bigint")
    found = {tuple(r) for r in score.exceedances(live, limits).collect()}
    assert found == {("ports", None, None, 6), ("both", 10000, 90, None)}
    joined = score.exceedances_by_join(live, limits)
    assert {tuple(r) for r in joined.collect()} == found
    assert set(limits) == set(FEATURES)


def test_cluster_thresholds(spark):
    rows = [(0, 1.0, 2.0, 3.0), (0, 3.0, 2.0, 5.0), (1, 10.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "cluster int, x double, y double, z double")
    got = {r["cluster"]: r for r in thresholds.cluster_thresholds(df, XYZ).collect()}
    sigma = [np.std([r[i] for r in rows], ddof=1) for i in (1, 2, 3)]
    for c, tops in ((0, (3, 2, 5)), (1, (10, 0, 1))):
        upper = [t + 2 * s for t, s in zip(tops, sigma)]
        assert got[c]["upper"] == pytest.approx(upper)
        assert got[c]["threshold"] == pytest.approx(math.sqrt(sum(u * u for u in upper)))
    stats = {r["cluster"]: r for r in thresholds.cluster_stats(df, XYZ).collect()}
    assert stats[1]["stddev"] == [0.0, 0.0, 0.0] and stats[1]["rows"] == 1
    old = {r["cluster"]: r for r in thresholds.cluster_thresholds_by_spread(df, XYZ).collect()}
    assert old[1]["upper"] == [10.0, 0.0, 1.0]
    assert old[0]["upper"] == [math.ceil(2 + 2 * 2 ** .5), 2.0, math.ceil(4 + 2 * 2 ** .5)]


# --- distances and decisions -----------------------------------------------------------


def test_worked_example(spark):
    df = points(spark, [(2.9, 1.9, 3.9), (3, 1, 1), (3, 1, 4), (-9, -9, -9)])
    got = score.score(df, model_rows(), XYZ, scale=False).collect()
    assert [(r["cluster"], round(r["distance"], 7), r["anomaly"]) for r in got] == [
        (0, 0.0, False), (1, 1.7320508, True), (2, 0.0, False), (0, 0.0, False)]


def excess(p, c, centers):
    """The rule in words: no excess if some centre is higher, in every coordinate."""
    calm = all(any(o[d] > p[d] for o in centers) for d in range(len(p)))
    return 0.0 if calm else math.dist(p, c)


def excess_by_sign(p, c, centers):
    calm = all(any(0 < p[d] < o[d] or o[d] < p[d] < 0 for o in centers) for d in range(len(p)))
    return 0.0 if calm else math.dist(p, c)


@pytest.mark.parametrize("ours, theirs", [(one_sided, excess), (one_sided_by_sign, excess_by_sign)])
def test_distances_match_the_rule(spark, ours, theirs):
    centers = [[1.0, -2.0, 0.5], [-1.5, 2.0, 3.0], [0.0, -0.5, -4.0]]
    grid = list(itertools.product([-5.0, -1.0, -0.25, 0.0, 0.25, 1.0, 1.5], repeat=3))
    axes = [F.col(c) for c in XYZ]
    got = points(spark, grid).select(*XYZ, *[ours(axes, c, centers) for c in centers]).collect()
    for r in got:
        assert tuple(r[3:]) == pytest.approx([theirs(tuple(r[:3]), c, centers) for c in centers])


def test_ties_nulls_and_equality(spark):
    df = points(spark, [(5, 0, 0)]).union(spark.range(1).selectExpr("null", "1D", "1D"))
    twins = [[0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    got = score.score(df, model_rows([5.0, 1.0], centers=twins), XYZ, scale=False).collect()
    assert (got[0]["cluster"], got[0]["distance"], got[0]["anomaly"]) == (0, 5.0, False)
    assert got[1]["distance"] is None and got[1]["anomaly"] is False
    without = score.score(df, model_rows([None, 1.0], centers=twins), XYZ, scale=False).first()
    assert without["anomaly"] is False and without["threshold"] is None


def test_live_scaling(spark):
    df = points(spark, [(30, 8, 5)])
    model = model_rows(mean=[10.0, 2.0, 5.0], stddev=[4.0, 0.0, None])
    for center, p in ((True, (5.0, 6.0, 0.0)), (False, (7.5, 8.0, 5.0))):
        got = score.score(df, model, XYZ, center=center).first()
        assert got["distance"] == pytest.approx(min(excess(p, c, CENTERS) for c in CENTERS))


def test_scaling_by_cluster(spark):
    df = points(spark, [(30, 8, 5), (1.5, 1.5, 1.5)])
    model = model_rows()
    for i, row in enumerate(model):
        row.update(mean=[float(i)] * 3, stddev=[1.0 + i] * 3)
    for r in score.score_by_sign(df, model, XYZ).collect():
        d = [excess_by_sign([(v - i) / (1 + i) for v in r[:3]], c, CENTERS) for i, c in enumerate(CENTERS)]
        assert (r["cluster"], r["distance"]) == (d.index(min(d)), pytest.approx(min(d)))


def test_assignment(spark):
    got = cluster.assign(points(spark, [(0, 0, 0), (3, 1, 3.9), (1.5, 1.5, 1.5)]), XYZ, CENTERS).collect()
    assert [r["cluster"] for r in got] == [0, 2, 0]
    assert cluster.rows_of_cluster(cluster.assign(points(spark, [(0, 0, 0)]), XYZ, CENTERS), 0).count() == 1


def test_scoring_is_native_and_joins_nothing(spark):
    plan = score.score(points(spark, [(1, 2, 3)]), model_rows(), XYZ, scale=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Python" not in text


# --- models ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def store(spark):
    rng = np.random.default_rng(4)
    rows = []
    for level, size in ((1, 120), (6, 80), (20, 40)):
        for _ in range(size):
            rows.append((f"10.0.0.{len(rows) % 12}", int(rng.normal(level * 1e4, 900)),
                         int(rng.normal(level * 5, 1)), int(rng.normal(level * 9, 2))))
    return spark.createDataFrame(
        rows, "srcAddr string, sumOfBytes bigint, uniqDstIPs bigint, uniqDstPorts bigint").cache()


def test_fit_detector(spark, store, tmp_path):
    model = fit_detector(store)
    assert model.schema == MODEL and model.count() == 3
    rows = score.model_rows(model)
    data = store.toPandas()[list(MODEL_FEATURES)].to_numpy(dtype=float)
    sigma = data.std(axis=0, ddof=1)
    scaled = data / sigma
    centers = np.array([r["center"] for r in rows])
    near = np.linalg.norm(scaled[:, None] - centers, axis=2).argmin(axis=1)
    for i, r in enumerate(rows):
        mine = scaled[near == i]
        assert r["center"] == pytest.approx(mine.mean(axis=0).tolist(), rel=1e-6)
        assert r["feature_max"] == pytest.approx(mine.max(axis=0).tolist())
        assert r["threshold"] == pytest.approx(np.linalg.norm(mine.max(axis=0) + 2 * scaled.std(axis=0, ddof=1)))
        assert r["mean"] == pytest.approx(data.mean(axis=0).tolist())
        assert r["stddev"] == pytest.approx(sigma.tolist())
    save_model(model, str(tmp_path / "model"))
    assert score.model_rows(load_model(spark, str(tmp_path / "model"))) == rows
    live = store.limit(1).select(F.lit("scan").alias("srcAddr"), F.lit(10 ** 7).alias("sumOfBytes"),
                                 F.lit(250).alias("uniqDstIPs"), F.lit(60000).alias("uniqDstPorts"))
    assert score.score(live, model).first()["anomaly"] is True
    assert score.score(store, model).filter("anomaly").count() == 0


def test_fit_detector_variants(store):
    raw = score.model_rows(fit_detector(store, scale=False))
    assert max(r["center"][0] for r in raw) > 1e5
    old = score.model_rows(fit_detector(store, by_spread=True))
    assert len({tuple(r["mean"]) for r in old}) == 3
    assert all(u == int(u) for r in old for u in [round(r["threshold"] ** 2, 6)])


def test_more_clusters_than_points(spark):
    few = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (9, 9, 9)],
                                "sumOfBytes bigint, uniqDstIPs bigint, uniqDstPorts bigint")
    model = fit_detector(few, k=5)
    assert 1 <= model.count() <= 5
    assert score.score(few, model).count() == 3


def test_single_training_row(spark):
    one = spark.createDataFrame([(5, 5, 5)], "sumOfBytes bigint, uniqDstIPs bigint, uniqDstPorts bigint")
    row = score.model_rows(fit_detector(one, k=2))[0]
    assert row["stddev"] == [0.0, 0.0, 0.0] and row["threshold"] == 0.0


def test_silhouette_and_elbow(spark, store):
    columns = list(MODEL_FEATURES)
    vectors = assemble(store, columns)
    value = cluster.silhouette(cluster.fit_kmeans(vectors).transform(vectors))
    assert 0.5 < value <= 1.0
    curve = {r["k"]: r for r in cluster.elbow(store, columns, range(1, 5), None).collect()}
    data = store.toPandas()[columns].to_numpy(dtype=float)
    spread = data - data.mean(axis=0)
    assert curve[1]["wssse"] == pytest.approx((spread ** 2).sum())
    assert curve[1]["distortion"] == pytest.approx(np.linalg.norm(spread, axis=1).mean())
    assert all(curve[k]["wssse"] <= curve[1]["wssse"] for k in curve)
    sampled = cluster.elbow(store, columns, (2, 3), 0.5)
    assert [r["k"] for r in sampled.orderBy("k").collect()] == [2, 3]
    grid = cluster.iteration_grid(store, columns, (1, 2), (300, 400)).collect()
    assert {(r["max_iter"], r["k"]) for r in grid} == {(300, 1), (300, 2), (400, 1), (400, 2)}


def test_costs_of_a_model_and_of_its_centers_agree(store):
    columns = list(MODEL_FEATURES)
    model = cluster.fit_kmeans(assemble(store, columns), 4)
    by_model, by_centers = cluster.costs(
        store, columns, {"model": model, "centers": cluster.centers_of(model)}).collect()
    assert by_model["wssse"] == pytest.approx(by_centers["wssse"])
    assert by_model["wssse"] == pytest.approx(model.summary.trainingCost)
    assert by_model["distortion"] == pytest.approx(by_centers["distortion"])


def test_predictions_join_back_to_their_rows(store):
    columns = list(MODEL_FEATURES)
    keyed = store.withColumn("id", F.monotonically_increasing_id()).cache()
    kept = cluster.fit_kmeans(assemble(keyed, columns)).transform(assemble(keyed, columns))
    joined = kept.select("id", "cluster").join(keyed, "id").select("id", "cluster", *columns)
    assert joined.exceptAll(kept.select("id", "cluster", *columns)).count() == 0


def test_explore(store):
    tables = explore(store, ks=range(1, 4))
    assert tuple(tables["shape"].first()) == (240, 4)
    assert tables["describe"].count() == 3 and tables["elbow"].count() == 3
    assert tables["labelled"].count() == sum(r["rows"] for r in tables["sizes"].collect())
    assert tables["histogram"].count() == 10 and tables["quality"].count() == 3


# --- rules -----------------------------------------------------------------------------


def inventory(*pairs):
    return {"hosts": [{"ipAddresses": [ip], "locations": [{"elementId": d}] if d else []} for ip, d in pairs]}


@pytest.fixture(scope="module")
def hosts(spark):
    text = json.dumps(inventory(("10.0.0.1", "of:01"), ("10.0.0.2", "of:02"), ("10.0.0.1", "of:03"),
                                ("10.0.0.9", None)))
    return host_table(spark.createDataFrame([(text,)], "v string").select(
        F.from_json("v", HOSTS).alias("d")).select("d.hosts"))


def test_host_table(hosts):
    assert {tuple(r) for r in hosts.collect()} == {
        ("10.0.0.1", "of:03"), ("10.0.0.2", "of:02"), ("10.0.0.9", None)}


def test_read_hosts(spark, tmp_path):
    document = inventory(("10.0.0.1", "of:0000000000000001"), ("10.0.0.2", "of:02")) | {"extra": 1}
    (tmp_path / "hosts.json").write_text(json.dumps(document, indent=2))
    assert read_hosts(spark, str(tmp_path)).count() == 2


def test_drop_rules(spark, hosts):
    flagged = spark.createDataFrame([("10.0.0.2", 1), ("10.0.0.7", 2), ("10.0.0.9", 3)], "srcAddr string, win int")
    got = {r["srcAddr"]: r for r in rules.drop_rules(flagged, hosts, ("win",)).collect()}
    assert [got[ip]["status"] for ip in sorted(got)] == ["mapped", "unmapped", "unmapped"]
    assert got["10.0.0.7"]["body"] is None and got["10.0.0.7"]["path"] is None
    rule = got["10.0.0.2"]
    assert rule["path"] == "/flows/of:02?appId=org.onosproject.fwd"
    assert json.loads(rule["body"]) == {
        "priority": 40000, "timeout": 0, "isPermanent": "true", "deviceId": "of:02", "treatment": {},
        "selector": {"criteria": [{"type": "ETH_TYPE", "ethType": "0x0800"},
                                  {"type": "IPV4_SRC", "ip": "10.0.0.2/32"}]}}


def test_rules_from_both_detectors(spark, hosts, store):
    live = spark.createDataFrame([("10.0.0.2", 10 ** 7, 900, 60000), ("10.0.0.1", 9000, 5, 9)],
                                 "srcAddr string, sumOfBytes bigint, uniqDstIPs bigint, uniqDstPorts bigint")
    blocked = block_anomalies(live, fit_detector(store), hosts).collect()
    assert [r["srcAddr"] for r in blocked] == ["10.0.0.2"]
    limits = score.upper_limits(thresholds.sigma_thresholds(store, MODEL_FEATURES))
    assert [r["srcAddr"] for r in block_exceedances(live, limits, hosts).collect()] == ["10.0.0.2"]


def test_euclidean(spark):
    df = points(spark, [(3, 4, 0)])
    assert df.select(euclidean([F.col(c) for c in XYZ], [0.0, 0.0, 0.0])).first()[0] == 5.0


def test_nothing_learnt_flags_nothing(spark):
    columns = "srcAddr string, sumOfBytes double, uniqDstIPs double, uniqDstPorts double"
    live = spark.createDataFrame([("a", 1e9, 1.0, 2.0), ("b", float("nan"), None, 1.0)], columns)
    empty = score.upper_limits(thresholds.sigma_thresholds(live.limit(0), MODEL_FEATURES))
    assert set(empty.values()) == {None}
    assert score.exceedances(live, empty).count() == score.exceedances_by_join(live, empty).count() == 0
    limits = score.upper_limits(thresholds.sigma_thresholds(live, MODEL_FEATURES))
    assert limits["sumOfBytes"] == 1e9 and limits["uniqDstIPs"] == 1.0
    assert score.exceedances(live.filter("srcAddr = 'b'"), {**limits, "sumOfBytes": 5.0}).count() == 0


def test_rows_without_a_distance_are_not_scored(spark):
    model = [{"cluster": 0, "center": [0.0] * 3, "mean": [0.0] * 3, "stddev": [1.0] * 3, "threshold": 1.0}]
    live = spark.createDataFrame([("nan", float("nan"), 5.0, 5.0), ("null", None, 5.0, 5.0), ("far", 5.0, 5.0, 5.0)],
                                 "srcAddr string, sumOfBytes double, uniqDstIPs double, uniqDstPorts double")
    found = {r["srcAddr"]: (r["anomaly"], r["distance"] is None) for r in score.score(live, model).collect()}
    assert found == {"nan": (False, True), "null": (False, True), "far": (True, False)}


def test_rules_are_held_off(spark):
    from flowtide.operators.rules import hold_off

    day = lambda n: f"2024-01-{n:02d}"
    make = lambda rows: spark.createDataFrame(rows, "srcAddr string, d string, path string").withColumn(
        "win", F.to_timestamp("d")).drop("d")
    rules = make([("a", day(n), "p") for n in (1, 2, 3, 4, 8, 9, 12)] + [("b", day(2), "q"), ("b", day(2), "q"), ("c", day(3), None)])
    none = rules.limit(0)
    found = lambda kept: sorted((r["srcAddr"], r["win"].day) for r in kept.collect())
    assert found(hold_off(rules, none, "3 days")) == [("a", 1), ("a", 4), ("a", 8), ("a", 12), ("b", 2), ("b", 2), ("c", 3)]
    earlier = make([("a", "2023-12-30", "p"), ("b", "2023-12-31", "q"), ("c", "2023-01-01", None)])
    assert found(hold_off(rules, earlier, "3 days")) == [("a", 2), ("a", 8), ("a", 12), ("c", 3)]
    assert hold_off(none, earlier, "3 days").count() == 0
