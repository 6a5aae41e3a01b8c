from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from flowtide.functions import day_of, stamp
from flowtide.operators.features import (
    features_by_join, features_by_source, flat_window, flow_rates, model_features_by_join,
    pair_counts, with_window,
)
from flowtide.operators.flows import project_flows, rejected_flows, valid_flows, with_l4_ports
from flowtide.schemas import FEATURES, FLOW_COLUMNS, RAW_FLOW
from flowtide.sources import decode, read_flow_json, read_lines
from tests.records import MINUTES, WHOLE, as_dicts, as_lines, without

COLUMNS = (*FEATURES, "numRecords")


def value_frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


@pytest.fixture(scope="module")
def capture(spark):
    return valid_flows(project_flows(decode(value_frame(spark, as_lines())), "timestamp")).cache()


def test_schema_has_forty_fields():
    kinds = [f.dataType.simpleString() for f in RAW_FLOW]
    assert (len(kinds), kinds.count("bigint"), kinds.count("string")) == (40, 33, 7)


def test_json_file_with_blank_lines(spark, tmp_path):
    lines = as_lines()
    (tmp_path / "capture.json").write_text("\n".join(lines[:5] + [""] + lines[5:] + ["", ""]))
    raw = read_flow_json(spark, str(tmp_path))
    assert raw.count() == 18 and len(raw.columns) == 40
    assert read_lines(spark, str(tmp_path)).count() == 18


def test_decode_all_keys(spark):
    full = decode(value_frame(spark, as_lines()), keys=RAW_FLOW.names, keep=())
    assert full.columns == RAW_FLOW.names
    assert full.filter(F.col("dOctets") > 2 ** 17).count() == 2


def test_projection_renames_ten_columns(capture):
    row = capture.select(*FLOW_COLUMNS).first()
    assert list(row.asDict()) == list(FLOW_COLUMNS)
    assert tuple(row) == ("10.0.0.2", 37390, "10.0.0.1", 8000, 17, 6, 1523417407025,
                          1523417407025, 198, 1)


def test_rejects_and_valid_are_complementary(spark):
    good = as_dicts()[0]
    lines = [
        json.dumps(good),
        json.dumps(without(good, "count")),
        json.dumps(good | {"srcaddr_s": None}),
        json.dumps(good | {"dOctets": "many"}),
        json.dumps(without(good, "count", "proto")),
        json.dumps(good)[:-9],
        "not json",
        "[1, 2]",
        "   ",
        None,
        json.dumps(without(good, "timestamp")),
    ]
    flows = project_flows(decode(value_frame(spark, lines)), "timestamp", keep=("value",))
    reasons = {r["value"]: r["reason"] for r in rejected_flows(flows).collect()}
    assert valid_flows(flows).count() == 1 and len(reasons) == 10
    assert [reasons[line] for line in lines[1:]] == [
        "missing numFlows", "missing srcAddr", "missing numBytes", "missing protocol,numFlows",
        "unreadable", "unreadable", "unreadable", "unreadable", "unreadable", "missing eventTime",
    ]


def test_values_beyond_32_bits_survive(spark):
    big = as_dicts()[0] | {"srcaddr": 4294967295, "dOctets": 2 ** 53 + 1}
    row = decode(value_frame(spark, [json.dumps(big)]), ("srcaddr", "dOctets"), keep=()).first()
    assert tuple(row) == (4294967295, 2 ** 53 + 1)


def test_each_message_is_parsed_once(spark):
    flows = valid_flows(project_flows(decode(value_frame(spark, as_lines())), "timestamp"))
    plan = flows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_l4_ports(capture):
    plain = {tuple(r) for r in capture.filter("protocol = 1").select("srcPort", "dstPort").collect()}
    zeroed = with_l4_ports(capture)
    assert (0, 2048) in plain
    assert {tuple(r) for r in zeroed.filter("protocol = 1").select("srcPort", "dstPort").collect()} == {(0, 0)}
    assert zeroed.filter("protocol = 6").exceptAll(capture.filter("protocol = 6")).count() == 0


def test_whole_batch(capture):
    assert {tuple(r) for r in features_by_source(capture).select("srcAddr", *COLUMNS).collect()} == WHOLE


def test_minutes(capture):
    rows = flat_window(features_by_source(with_window(capture, "60 seconds"), ("window", "srcAddr")))
    got = rows.select(F.date_format("win", "HH:mm"), "srcAddr", *COLUMNS).collect()
    assert {tuple(r) for r in got} == MINUTES


def test_join_forms_agree(capture):
    expected = features_by_source(capture)
    inner = features_by_join(capture)
    assert expected.select(*inner.columns).exceptAll(inner).count() == 0
    outer = model_features_by_join(capture)
    assert expected.select(*outer.columns).exceptAll(outer).count() == 0
    assert inner.count() == outer.count() == 2


def test_one_source_holding_most_rows(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50))
        .alias("srcAddr"),
        (F.col("id") % 4001).cast("string").alias("dstAddr"), (F.col("id") % 911).alias("dstPort"),
        F.col("id").alias("numBytes"), F.lit(1).cast("bigint").alias("numFlows"))
    expected = rows.groupBy("srcAddr").agg(
        F.sum("numFlows").alias("sumOfFlows"), F.sum("numBytes").alias("sumOfBytes"),
        F.countDistinct("dstAddr").alias("uniqDstIPs"), F.countDistinct("dstPort").alias("uniqDstPorts"),
        F.count("*").alias("numRecords"))
    got = features_by_source(rows)
    assert expected.exceptAll(got).count() == got.exceptAll(expected).count() == 0


def test_pairs_and_rates(capture):
    pairs = {tuple(r) for r in pair_counts(capture, "dstPort").collect()}
    assert ("10.0.0.2", 2048, 5) in pairs
    rates = {r["srcAddr"]: r for r in flow_rates(capture).collect()}
    assert rates["10.0.0.1"]["bytesPerFlow"] == pytest.approx(369956 / 15)
    time = sum(d["last"] - d["first"] for d in as_dicts() if d["srcaddr_s"] == "10.0.0.1")
    assert rates["10.0.0.1"]["commTime"] == time
    assert rates["10.0.0.1"]["avgCommTime"] == pytest.approx(time / 15)


def test_rates_without_flows_are_null(capture):
    none = capture.withColumn("numFlows", F.lit(0).cast("bigint"))
    assert {r["bytesPerFlow"] for r in flow_rates(none).collect()} == {None}


def test_empty_input(capture):
    assert features_by_source(capture.limit(0)).count() == 0


def test_date_texts(spark):
    row = spark.range(1).select(
        day_of(F.lit("2018-04-11")).cast("string").alias("day"),
        stamp(F.timestamp_millis(F.lit(1523417467487))).alias("at"), stamp().alias("now")).first()
    assert (row["day"], row["at"]) == ("2018-04-11", "2018-04-11 03:31:07")
    assert len(row["now"]) == 19
