from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from flowtide.operators.features import features_by_source, flat_window, with_window
from flowtide.plans import block_anomalies, load_model, save_model
from flowtide.operators import score
from flowtide.schemas import FEATURES, MODEL
from flowtide.sinks import Folders, append_features, append_rules, compact_day, export_csv
from flowtide.sinks.parts import live_folders
from flowtide.sources import checked_feature_csv, read_feature_csv, read_kafka, read_lines, read_rules, read_store
from flowtide.streaming import (
    FlowCounts, dropped_as_late, each_arrival, keep_every_flow, print_batches, read_aside, read_mark, read_open, read_windows,
    rejected_stream, run_available, score_stream, store_features, store_rules, valid_stream, windowed_features, write_table,
)
from tests.records import WHOLE, as_dicts, as_lines

KEYS = ["win", "srcAddr", *FEATURES, "numRecords"]


def drop_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    return path


def shifted(seconds, **changes):
    """The first record, exported so many seconds later."""
    record = as_dicts()[0]
    return json.dumps(record | {"timestamp": record["timestamp"] + seconds * 1000} | changes)


@pytest.fixture
def inbox(tmp_path):
    """Three files in order of arrival; the second holds junk, the last closes all windows."""
    lines = as_lines()
    folder = tmp_path / "inbox"
    drop_file(folder, "1.txt", lines[:6])
    time.sleep(0.02)
    drop_file(folder, "2.txt", [*lines[6:], "", "junk", lines[3][:-4]])
    time.sleep(0.02)
    drop_file(folder, "3.txt", [shifted(7200)])
    return folder


def batch_windows(spark, folder):
    flows = with_window(valid_stream(read_lines(spark, str(folder))), "60 seconds")
    return flat_window(features_by_source(flows, ("window", "srcAddr"))).select(*KEYS)


def test_stream_equals_batch_on_closed_windows(spark, inbox, tmp_path):
    messages = read_lines(spark, str(inbox), stream=True, files_per_batch=1)
    table = windowed_features(valid_stream(messages))
    query = write_table(table, str(tmp_path / "out"), str(tmp_path / "cp"))
    run_available(query)
    got = spark.read.parquet(str(tmp_path / "out")).select(*KEYS)
    expected = batch_windows(spark, inbox).filter("win < timestamp'2018-04-11 05:00:00'")
    assert got.count() == 10
    assert expected.exceptAll(got).count() == got.exceptAll(expected).count() == 0


def test_restart_continues_and_late_rows_are_dropped(spark, inbox, tmp_path):
    def run():
        messages = read_lines(spark, str(inbox), stream=True, files_per_batch=1)
        run_available(write_table(windowed_features(valid_stream(messages)),
                                  str(tmp_path / "out"), str(tmp_path / "cp")))
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert run() == 10
    assert run() == 10
    drop_file(inbox, "4.txt", [shifted(10), shifted(7300), shifted(14400)])
    assert run() == 12  # the windows of 7200 and 7300; the one of 10 was closed long ago


def test_a_date_far_ahead_does_not_close_windows(spark, inbox, tmp_path):
    far = shifted(0, timestamp=int(time.time() * 1000) + 86_400_000)
    inbox.joinpath("1.txt").write_text(far + "\n" + inbox.joinpath("1.txt").read_text())
    time.sleep(0.02)
    for name in ("2.txt", "3.txt"):
        inbox.joinpath(name).write_text(inbox.joinpath(name).read_text())
        time.sleep(0.02)
    messages = read_lines(spark, str(inbox), stream=True, files_per_batch=1, arrival=True)
    run_available(write_table(windowed_features(valid_stream(messages)), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    rejects = rejected_stream(read_lines(spark, str(inbox), arrival=True))
    assert (far, "ahead of arrival") in {(r["value"], r["reason"]) for r in rejects.collect()}


def test_late_rows_are_counted(spark, inbox, tmp_path):
    drop_file(inbox, "4.txt", [shifted(14400)])
    time.sleep(0.02)
    drop_file(inbox, "5.txt", [shifted(10), shifted(20)])
    time.sleep(0.02)
    drop_file(inbox, "6.txt", [shifted(10), shifted(21600)])
    query = write_table(windowed_features(valid_stream(read_lines(spark, str(inbox), stream=True, files_per_batch=1))),
                        str(tmp_path / "out"), str(tmp_path / "cp"))
    run_available(query)
    assert dropped_as_late(query) > 0


def test_rejects_of_a_stream(spark, inbox, tmp_path):
    rejects = rejected_stream(read_lines(spark, str(inbox), stream=True), event_time="first")
    run_available(write_table(rejects, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r["value"], r["reason"]) for r in got} == {
        ("junk", "unreadable"), (as_lines()[3][:-4], "unreadable")}


def test_stream_scoring(spark, inbox, tmp_path):
    model = spark.createDataFrame(
        [(0, [0.0, 0.0, 0.0], None, [0.0, 0.0, 0.0], [1.0, 1.0, 1.0], 100000.0)], MODEL)
    scored = score_stream(
        windowed_features(valid_stream(read_lines(spark, str(inbox), stream=True))), model)
    run_available(write_table(scored, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = {(r["srcAddr"], r["sumOfBytes"]): r["anomaly"]
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 10
    assert {key for key, flagged in got.items() if flagged} == {
        ("10.0.0.1", 155424), ("10.0.0.2", 161168), ("10.0.0.1", 210400), ("10.0.0.2", 204656)}


def test_arrival_batches_store_and_block(spark, tmp_path):
    folder = tmp_path / "inbox"
    drop_file(folder, "1.txt", as_lines())
    hosts = spark.createDataFrame([("10.0.0.1", "of:01")], "ip string, device string")
    model = spark.createDataFrame(
        [(0, [0.0, 0.0, 0.0], None, [0.0, 0.0, 0.0], [1.0, 1.0, 1.0], 368000.0)], MODEL)
    save_model(model, str(tmp_path / "model"))
    paths = {n: str(tmp_path / n) for n in ("store", "rules", "cp")}

    def run():
        flows = valid_stream(read_lines(spark, str(folder), stream=True, files_per_batch=1))
        run_available(each_arrival(flows, [
            store_features(paths["store"], "w1"),
            store_rules(paths["rules"], lambda features: block_anomalies(
                features, load_model(spark, str(tmp_path / "model")), hosts), "w1"),
        ], paths["cp"], every=None))

    run()
    stored = read_store(spark, paths["store"]).select("batch", *FEATURES)
    assert {tuple(r) for r in stored.collect()} == {(0, *row[1:5]) for row in WHOLE}
    written = spark.read.parquet(paths["rules"]).collect()
    assert [(r["batch"], r["srcAddr"], r["status"]) for r in written] == [(0, "10.0.0.1", "mapped")]
    drop_file(folder, "2.txt", as_lines())
    run()
    assert read_store(spark, paths["store"]).count() == 4
    # No memory of earlier batches: the same source is blocked again.
    assert spark.read.parquet(paths["rules"]).count() == 2


def test_store_append_is_repeatable(spark, tmp_path):
    rows = batch_like(spark)
    path = str(tmp_path / "store")
    for batch in (0, 1, 1, 0):
        append_features(rows, batch, path, "w1")
    store = read_store(spark, path)
    assert store.count() == 6 and {r[0] for r in store.select("batch").distinct().collect()} == {0, 1}
    assert store.dtypes[:4] == [("sumOfFlows", "bigint"), ("sumOfBytes", "bigint"),
                                ("uniqDstIPs", "int"), ("uniqDstPorts", "int")]
    one_day = read_store(spark, path, since="2018-04-11", until="2018-04-12")
    assert one_day.count() == 4
    assert all("day=2018-04-11" in f for f in one_day.inputFiles())
    assert read_store(spark, path, since="2020-01-01").count() == 0


def test_a_lost_checkpoint_loses_no_rows(spark, tmp_path):
    folder = tmp_path / "inbox"
    store = str(tmp_path / "store")

    def run(name):
        flows = valid_stream(read_lines(spark, str(folder), stream=True))
        run_available(each_arrival(flows, [store_features(store, name)], str(tmp_path / name), every=None))

    drop_file(folder, "1.txt", as_lines())
    run("w1")
    run("w2")  # a new checkpoint counts its batches from 0 again
    found = read_store(spark, store).groupBy("writer", "batch").count().collect()
    assert {tuple(r) for r in found} == {("w1", 0, 2), ("w2", 0, 2)}


def test_a_replay_replaces_the_days_it_touched(spark, tmp_path):
    path, rows = str(tmp_path / "store"), batch_like(spark)
    append_features(rows, 0, path, "w1")
    append_features(rows, 0, path, "w2")
    append_features(rows.filter("srcAddr = 'a' and t < '2018-04-12'"), 0, path, "w1")
    found = {(r["writer"], str(r["day"])) for r in read_store(spark, path).collect()}
    assert found == {("w1", "2018-04-11"), ("w2", "2018-04-11"), ("w2", "2018-04-12")}
    append_features(rows.limit(0), 0, path, "w2")
    assert read_store(spark, path).count() == 1
    with pytest.raises(ValueError):
        append_features(rows, 0, path, "a/b")


def test_compaction_keeps_rows_and_can_be_interrupted(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "store"), batch_like(spark)
    for batch in range(5):
        append_features(rows, batch, path, "w1")
    append_features(rows, 0, path, "w2")
    key = lambda: sorted(map(str, read_store(spark, path).drop("part").collect()))
    before = key()
    compact_day(spark, path, "2018-04-11")
    assert key() == before
    assert live_folders(Folders(spark, path), "day=2018-04-11") == [
        f"day=2018-04-11/writer={w}" for w in ("w1/part=4", "w1/part=merged-1", "w2/part=0")]
    append_features(rows, 4, path, "w1")  # the last batch may still come again
    assert key() == before
    append_features(rows, 5, path, "w1")
    before = key()
    remove = Folders.remove

    def stop(self, name):
        raise OSError("interrupted")

    monkeypatch.setattr(Folders, "remove", stop)
    with pytest.raises(OSError):
        compact_day(spark, path, "2018-04-11")
    assert key() == before
    monkeypatch.setattr(Folders, "remove", remove)
    compact_day(spark, path, "2018-04-11")
    assert key() == before
    compact_day(spark, path, "2018-04-11")
    assert key() == before
    assert Folders(spark, path).matching("day=2018-04-11/writer=w1/part=*") == [
        f"day=2018-04-11/writer=w1/part={p}" for p in ("5", "merged-2")]


def test_a_reader_sees_every_row_between_any_two_steps(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "store"), batch_like(spark)
    for batch in range(3):
        append_features(rows, batch, path, "w1")
    key = lambda: sorted(map(str, read_store(spark, path).drop("part").collect()))
    before, seen = key(), []

    def watched(name):
        original = getattr(Folders, name)

        def step(self, *args):
            seen.append((name, key() == before))
            result = original(self, *args)
            seen.append((name, key() == before))
            return result

        monkeypatch.setattr(Folders, name, step)

    for name in ("remove", "rename", "write_line_file"):
        watched(name)
    for keep in (1, 0, 0):
        begun = read_store(spark, path).drop("part")
        compact_day(spark, path, "2018-04-11", keep)
        assert sorted(map(str, begun.collect())) == before  # a reader that began before the compaction
    assert {name for name, _ in seen} == {"remove", "rename", "write_line_file"} and all(same for _, same in seen)


def batch_like(spark):
    return spark.createDataFrame([
        ("2018-04-11 03:31:00", "a", 1, 10, 2, 3), ("2018-04-11 23:59:00", "b", 4, 50, 6, 7),
        ("2018-04-12 00:00:00", "a", 8, 90, 1, 1)],
        "t string, srcAddr string, sumOfFlows bigint, sumOfBytes bigint, uniqDstIPs bigint, "
        "uniqDstPorts bigint").withColumn("win", F.to_timestamp("t"))


def test_rules_are_repeatable(spark, tmp_path):
    rules = spark.createDataFrame([("10.0.0.1", "of:1")], "srcAddr string, device string")
    for _ in range(2):
        append_rules(rules, 5, str(tmp_path / "rules"), "w1")
    append_rules(rules, 5, str(tmp_path / "rules"), "w2")
    assert read_rules(spark, str(tmp_path / "rules")).count() == 2


def test_csv_has_three_bare_columns(spark, tmp_path):
    export_csv(batch_like(spark), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert sorted(text.split()) == ["10,2,3", "50,6,7", "90,1,1"]
    back = read_feature_csv(spark, str(tmp_path / "csv"))
    assert back.dtypes == [("sumOfBytes", "double"), ("uniqDstIPs", "double"), ("uniqDstPorts", "double")]
    assert back.count() == 3


def test_malformed_lines_are_set_aside_whole(spark, tmp_path):
    lines = ["1,2,3", "", "abc,2,3", "1,2", "1,2,3,4", "1,,3", " 4.5,1e3,-2", "1,2,x y", ",,", "\"7\",8,9"]
    drop_file(tmp_path / "csv", "a.csv", lines)
    good, rejected = checked_feature_csv(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, good.collect())) == [(1.0, 2.0, 3.0), (4.5, 1000.0, -2.0), (7.0, 8.0, 9.0)]
    assert dict(map(tuple, rejected.collect())) == {
        "abc,2,3": "not a number", "1,2": "2 fields", "1,2,3,4": "4 fields", "1,,3": "empty field", "1,2,x y": "not a number",
        ",,": "empty field"}


def test_console_print(spark, inbox, tmp_path):
    """The JVM prints past the capture of tests; the query's progress tells what it has read."""
    query = print_batches(read_lines(spark, str(inbox), stream=True), str(tmp_path / "cp"), rows=12, every=None)
    run_available(query)
    lines = sum(len([x for x in p.read_text().split("\n") if x.strip()]) for p in inbox.iterdir())
    read = [step.numInputRows for step in query.recentProgress]
    assert sum(read) >= lines and query.recentProgress[0].sink.description.lower().find("console") >= 0


def test_running_query_is_stopped_after_timeout(spark, inbox, tmp_path):
    query = print_batches(read_lines(spark, str(inbox), stream=True), str(tmp_path / "cp"))
    run_available(query, timeout=2)
    assert not query.isActive


def test_empty_arrival_batch(spark, tmp_path):
    append_features(batch_like(spark).limit(0), 0, str(tmp_path / "store"), "w1")
    assert read_store(spark, str(tmp_path / "store")).count() == 0


def test_state_is_spread_and_columnar_plan_has_no_python(spark, inbox):
    table = windowed_features(valid_stream(read_lines(spark, str(inbox), stream=True)))
    plan = table._jdf.queryExecution().analyzed().toString()
    assert "collect_set" not in plan and "PythonUDF" not in plan


def test_kafka_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, "localhost:9092")


def test_model_rows_are_ordered(spark):
    df = spark.createDataFrame([(2,), (0,), (1,)], "cluster int")
    assert [r["cluster"] for r in score.model_rows(df)] == [0, 1, 2]


def every_flow(spark, folder, tmp_path, name="kept", **how):
    messages = read_lines(spark, str(folder), stream=True, **how)
    run_available(keep_every_flow(messages, str(tmp_path / name), str(tmp_path / f"{name}-cp"), every=None))
    return str(tmp_path / name)


def test_late_flows_are_kept_and_everything_is_accounted_for(spark, inbox, tmp_path):
    drop_file(inbox, "4.txt", [shifted(14400)])
    time.sleep(0.02)
    drop_file(inbox, "5.txt", [shifted(10), shifted(20), shifted(14410)])
    time.sleep(0.02)
    drop_file(inbox, "6.txt", [shifted(10), shifted(21600), '{"srcaddr_s": "10.0.0.1"}'])
    path = every_flow(spark, inbox, tmp_path, files_per_batch=1)
    late = read_aside(spark, path, "late").collect()
    assert [r["batch"] for r in sorted(late, key=lambda r: r["batch"])] == [4, 4, 5]
    windows = read_windows(spark, path).agg(F.sum("numRecords")).first()[0]
    still_open = read_open(spark, path).agg(F.sum("numRecords")).first()[0]
    rejected = {r["reason"] for r in read_aside(spark, path, "rejected").collect()}
    mark = read_mark(spark, path)
    assert "unreadable" in rejected and any(r.startswith("missing") for r in rejected)
    assert mark["timely"] == windows + still_open and mark["late"] == 3
    assert mark["read"] == mark["timely"] + mark["late"] + mark["rejected"] == read_lines(spark, str(inbox)).count()
    # Timely windows hold what the batch features hold, less the late flows.
    assert read_windows(spark, path).join(read_open(spark, path), ["win", "srcAddr"]).count() == 0


def test_a_repeated_batch_replaces_what_it_wrote(spark, inbox, tmp_path, monkeypatch):
    """The second batch fails after it has written its windows, before its mark; the restart repeats it."""
    plain = every_flow(spark, inbox, tmp_path, "plain", files_per_batch=1)
    from flowtide.streaming import late as module

    count, calls = module.flat_window, []

    def failing(rows):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        return count(rows)

    monkeypatch.setattr(module, "flat_window", failing)
    with pytest.raises(Exception):
        query = keep_every_flow(read_lines(spark, str(inbox), stream=True, files_per_batch=1), str(tmp_path / "kept"),
                                str(tmp_path / "kept-cp"), every=None)
        query.awaitTermination()
    monkeypatch.setattr(module, "flat_window", count)
    kept = every_flow(spark, inbox, tmp_path, files_per_batch=1)
    rows = lambda path: sorted(map(tuple, read_windows(spark, path).select(*KEYS).collect()))
    assert rows(kept) == rows(plain) and len(rows(kept)) == 10
    assert read_mark(spark, kept)[1:] == read_mark(spark, plain)[1:]


def test_counts_of_a_stream_are_complete(spark, inbox, tmp_path):
    listener = FlowCounts("arrivals")
    spark.streams.addListener(listener)
    try:
        flows = valid_stream(read_lines(spark, str(inbox), stream=True, files_per_batch=1), counts="arrivals")
        query = write_table(flows, str(tmp_path / "out"), str(tmp_path / "cp"))
        run_available(query)
        assert listener.wait(query.id)
    finally:
        spark.streams.removeListener(listener)
    written = spark.read.parquet(str(tmp_path / "out")).count()
    counts = listener.totals
    assert counts["valid"] == written and counts["read"] == read_lines(spark, str(inbox)).count()
    assert counts["read"] == sum(counts[c] for c in ("valid", "unreadable", "missing", "ahead"))
