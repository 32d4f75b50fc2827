"""Streams give what the batch gives on the same rows, also when a batch is run again."""

import pytest
from pyspark.sql import functions as F

from tallyvein.operators.sampling import fixed_sample, trending_tags
from tallyvein.operators.sketches import SketchStore, estimated, pane_sketches, windows_of_panes
from tallyvein.session import Scratch
from tallyvein.sources.readers import tagged_messages
from tallyvein.streaming.reservoir import merge_batch, report_lines, reports, start_trending, write_report
from tallyvein.streaming.sources import json_stream, parse_json, table_stream
from tallyvein.streaming.stateful import start_stateful_trending
from tallyvein.streaming.windows import start_window_estimates, start_window_sketches

NOW = {"availableNow": True}


def messages(spark, start, stop):
    text = F.concat(F.lit("#t"), (F.col("id") % 7).cast("string"), F.lit(" no tag"))
    return spark.range(start, stop).select("id", F.when(F.col("id") % 5 == 0, "nothing").otherwise(text).alias("text"))


def test_sample_of_batches_is_the_sample_of_all(spark):
    folder = Scratch(spark, "test-reservoir").base
    parts = [(0, 300), (300, 310), (310, 900)]
    for i, (a, b) in enumerate(parts):
        merge_batch(messages(spark, a, b), folder, i, n=50)
    sample = spark.read.parquet(f"{folder}/state/batch=2/sample")
    whole = fixed_sample(messages(spark, 0, 900).where("text != 'nothing'"), "id", 50)
    assert sorted(sample.collect()) == sorted(whole.collect())
    last = reports(spark, folder).where("batch_id = 2")
    assert sorted((r["tag"], r["cnt"]) for r in last.collect()) == sorted(tuple(r) for r in trending_tags(whole).collect())
    assert {r["n_seen"] for r in last.collect()} == {720}


def test_a_batch_can_be_run_again(spark):
    folder = Scratch(spark, "test-replay").base
    merge_batch(messages(spark, 0, 200), folder, 0, n=20)
    for _ in range(2):
        merge_batch(messages(spark, 200, 400), folder, 1, n=20)
    assert {(r["batch_id"], r["n_seen"]) for r in reports(spark, folder).collect()} == {(0, 160), (1, 320)}


def test_batch_without_tags(spark):
    folder = Scratch(spark, "test-untagged").base
    merge_batch(spark.createDataFrame([(1, "none here")], "id bigint, text string"), folder, 0)
    assert [r["line"].endswith(": 0") for r in report_lines(spark, folder, 0).collect()] == [True]


def test_stream_goes_on_after_a_stop(spark):
    scratch = Scratch(spark, "test-restart")
    schema = messages(spark, 0, 1).schema
    for i, (a, b) in enumerate([(0, 100), (100, 250)]):
        messages(spark, a, b).coalesce(1).write.parquet(scratch.path(f"in/part={i}"))
        stream = table_stream(spark, scratch.path("in"), schema)
        start_trending(stream, scratch.path("out"), scratch.path("checkpoint"), trigger=NOW).awaitTermination()
    assert {(r["batch_id"], r["n_seen"]) for r in reports(spark, scratch.path("out")).collect()} == {(0, 80), (1, 200)}


@pytest.mark.parametrize("keep_all", [True, False])
def test_windows_over_json_lines(spark, keep_all):
    scratch = Scratch(spark, "test-windows")
    rows = [("2020-01-01 00:00:05", "QC"), ("2020-01-01 00:00:06", "QC"), ("2020-01-01 00:00:25", "AZ"), ("2020-01-01 01:00:00", "NV")]
    lines = spark.createDataFrame(rows, "ts string, state string")
    lines.coalesce(1).write.json(scratch.path("in"))
    stream = json_stream(spark, scratch.path("in"), "ts timestamp, state string")
    start_window_estimates(
        stream, "ts", "state", scratch.path("out"), scratch.path("checkpoint"), keep_all=keep_all, trigger=NOW
    ).awaitTermination()
    written = spark.read.schema("`Time` bigint, `Ground Truth` bigint, `Estimation` bigint").csv(scratch.path("out"), header=True)
    found = {r["Time"] - 1577836800: r["Ground Truth"] for r in written.collect()}
    if keep_all:
        assert found == {10: 1, 20: 1, 30: 2, 40: 1, 50: 1}
    else:
        assert all(abs(r["Ground Truth"] - r["Estimation"]) <= 0.25 * r["Estimation"] for r in written.collect())


def test_json_column_and_message_filter(spark):
    raw = spark.createDataFrame([(bytearray(b'{"text": "a #b", "lang": "en"}'),), (bytearray(b'{"text": "plain", "lang": "en"}'),)], "value binary")
    parsed = parse_json(raw, "text string, lang string")
    assert [r["text"] for r in tagged_messages(parsed).collect()] == ["a #b"]


def test_stateful_sample_is_the_sample_of_all_and_goes_on_after_a_stop(spark):
    """Three starts of one stream, each with a further folder: reports are those of the batch sample."""
    scratch = Scratch(spark, "test-stateful")
    parts = [(0, 300), (300, 310), (310, 900)]
    schema = messages(spark, 0, 1).schema
    for i, (a, b) in enumerate(parts):
        messages(spark, a, b).repartition(3).write.parquet(scratch.path(f"in/part={i}"))
        stream = table_stream(spark, scratch.path("in"), schema)
        start_stateful_trending(stream, scratch.path("out"), scratch.path("checkpoint"), n=50, shards=5, trigger=NOW).awaitTermination()
    found = reports(spark, scratch.path("out")).collect()
    for i, (_, b) in enumerate(parts):
        whole = fixed_sample(messages(spark, 0, b).where("text != 'nothing'"), "id", 50)
        expected = sorted((b - b // 5 - (b % 5 > 0), *r) for r in trending_tags(whole).collect())
        assert sorted((r.n_seen, r.tag, r.cnt) for r in found if r.batch_id == i) == expected


def test_stateful_report_can_be_written_again(spark):
    folder = Scratch(spark, "test-report-again").base
    rows = spark.createDataFrame([(0, 7, 1, "#a #b"), (0, 7, 2, "#a")], "update_no long, n_seen long, id long, text string")
    for _ in range(2):
        write_report(rows, folder, 0)
    assert sorted(tuple(r) for r in reports(spark, folder).collect()) == [(0, 7, "a", 2), (0, 7, "b", 1)]
    write_report(rows.select("update_no", "n_seen", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text")), folder, 1)
    assert [tuple(r) for r in reports(spark, folder).where("batch_id = 1").collect()] == [(1, 7, None, None)]


def test_sketches_of_a_stream_are_those_of_the_batch(spark):
    scratch = Scratch(spark, "test-sketch-stream")
    rows = spark.range(0, 3000).select(
        F.timestamp_seconds(F.lit(1_577_836_800) + F.col("id") % 120).alias("ts"), (F.col("id") % 700).cast("string").alias("who")
    )
    late = spark.createDataFrame([("2020-01-02 00:00:00", "late")], "ts string, who string").select(F.col("ts").cast("timestamp"), "who")
    rows.unionByName(late).repartition(4).write.parquet(scratch.path("in/part=0"))
    store = SketchStore(spark, scratch.path("out"), "window_start bigint")
    stream = table_stream(spark, scratch.path("in"), rows.schema)
    start_window_sketches(stream, "ts", "who", store, scratch.path("checkpoint"), trigger=NOW).awaitTermination()
    panes = pane_sketches(rows, "ts", "who", 10)
    # The window of the last, late row stays open.
    expected = windows_of_panes(panes, 30, 10).where("window_start < 1577836800 + 120").select("window_start", estimated("sketch"))
    found = store.read().select("window_start", estimated("sketch"))
    one, other = (dict(map(tuple, df.collect())) for df in (found, expected))
    assert one.keys() == other.keys() and len(one) == 14
    assert all(abs(one[w] - other[w]) <= 1 + 0.02 * other[w] for w in one)
