"""Readers, sinks and the scratch folder."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyvein import session
from tallyvein.session import Scratch, scratch_root
from tallyvein.sources import readers, sinks


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_json_records(spark, tmp_path):
    path = write(f"{tmp_path}/a/r.json", '{"name": "Café", "state": "QC", "more": 1}\n{"name": "B"}\n')
    rows = readers.read_json_records(spark, path, "name string, state string").collect()
    assert [tuple(r) for r in rows] == [("Café", "QC"), ("B", None)]
    broken = write(f"{tmp_path}/b/r.json", '{"name": \n')
    with pytest.raises(Exception):
        readers.read_json_records(spark, broken, "name string").collect()


def test_pairs(spark, tmp_path):
    path = write(f"{tmp_path}/p.csv", "user_id,business_id\nu1,b1\nu2,b1\n")
    assert [tuple(r) for r in readers.read_pairs(spark, path).collect()] == [("u1", "b1"), ("u2", "b1")]


def test_points_and_chunks(spark, tmp_path):
    write(f"{tmp_path}/c/x/data0.txt", "0,1.5,2\n1,-3,4e1\n")
    write(f"{tmp_path}/c/y/data1.txt", "2,5,6\n")
    write(f"{tmp_path}/c/y/notes.md", "not,a,point\n")
    rows = readers.read_points(spark, f"{tmp_path}/c/x/data0.txt", scale=2.0).collect()
    assert [(r["point_id"], r["features"]) for r in rows] == [("0", [0.75, 1.0]), ("1", [-1.5, 20.0])]
    chunks = readers.read_point_chunks(spark, f"{tmp_path}/c").collect()
    assert sorted((os.path.basename(r["chunk"]), r["point_id"]) for r in chunks) == [
        ("data0.txt", "0"), ("data0.txt", "1"), ("data1.txt", "2"),
    ]


def test_average_map_is_read_whole(spark, tmp_path):
    averages = {f"id_{i}-x": i / 7 for i in range(500)} | {'quo"te': 1.5}
    path = write(f"{tmp_path}/m/avg.json", json.dumps(averages))
    found = {r["id"]: r["average"] for r in readers.read_average_map(spark, path).collect()}
    assert len(found) == 501 and found["id_70-x"] == 10.0
    pretty = write(f"{tmp_path}/n/avg.json", json.dumps(averages, indent=1))
    assert readers.read_average_map(spark, pretty).count() == 501


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent,ascii_only", [(None, True), (1, False)])
def test_average_map_over_many_splits(spark, tmp_path, small_splits, indent, ascii_only):
    """Ids with commas, escapes, braces, colons and line ends, longer than a split, against the json module."""
    rng = random.Random(5)
    letters = [",", ",", '"', "\\", "{", "}", ":", ": 1", "\n", " ", "é", "\U0001f600", "a", "b7"]
    averages = {"".join(rng.choices(letters, k=rng.randrange(12))) + str(i): rng.choice([i / 7, -i, 1e-9 * i]) for i in range(800)}
    averages |= {"": 0.5, ",": 1, ",,": 2.5, ': 1,b': 3, "a,": 4, 'x,"': 5, "long," * 700: 6, "w" * 9000: 7, ": 1": 8}
    entries = list(averages.items())
    rng.shuffle(entries)
    half = len(entries) // 2
    for name, part in (("x", entries[:half]), ("y", entries[half:])):
        write(f"{tmp_path}/m/{name}.json", json.dumps(dict(part), indent=indent, ensure_ascii=ascii_only))
    found = readers.read_average_map(spark, f"{tmp_path}/m")
    assert spark.read.option("lineSep", ",").text(f"{tmp_path}/m").rdd.getNumPartitions() > 10
    rows = found.collect()
    assert len(rows) == len(averages) and {r["id"]: r["average"] for r in rows} == averages


def test_average_map_without_entries(spark, tmp_path):
    assert readers.read_average_map(spark, write(f"{tmp_path}/avg.json", " { }\n")).count() == 0


@pytest.mark.parametrize("text", ['{"a": 1.0, b": 2.0}', '{"a": "x"}', '{"a,b: 1}', '{"a": 1 2, "c": 2}', '{"a": 1} more', '{"a": 1, 5}'])
def test_average_map_rejects_what_is_no_entry(spark, tmp_path, text):
    with pytest.raises(Exception, match="not an id and a number"):
        readers.read_average_map(spark, write(f"{tmp_path}/avg.json", text)).collect()


def test_users(spark, tmp_path):
    user = {f: 1 for f in readers.USER_FIELDS} | {
        "user_id": "u", "friends": "a, b, c", "yelping_since": "2010-07-05 17:03:04", "extra": "x",
    }
    path = write(f"{tmp_path}/u.json", json.dumps(user) + "\n")
    from tallyvein.operators.ratings import user_features

    row = user_features(readers.read_users(spark, path)).first()
    assert row["friends"] == 3.0 and row["yelping_since"] == 1278349384.0 and row["useful"] == 1.0
    assert row.__fields__ == ["user_id", *readers.USER_FIELDS]


def test_flag_lines(spark):
    flags = spark.createDataFrame([(i, i % 3 == 0) for i in range(10)], "seq bigint, f boolean").repartition(4)
    assert sinks.flag_lines(flags, "seq", "f").collect()[0]["line"] == "T F F T F F T F F T"
    short = sinks.flag_lines(flags, "seq", "f", per_line=4).orderBy("line_no").collect()
    assert [r["line"] for r in short] == ["T F F T", "F F T F", "F T"]


def test_community_lines(spark):
    members = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (3, "c"), (3, "d"), (3, "e")], "label int, id string")
    rows = sinks.community_lines(members, "label", "id").orderBy("size", "first_member", "piece").collect()
    assert [r["line"] for r in rows] == ["'z'", "'a', 'b'", "'c', 'd', 'e'"]
    pieces = sinks.community_lines(members, "label", "id", per_line=2).orderBy("size", "first_member", "piece").collect()
    assert [r["line"] for r in pieces] == ["'z'", "'a', 'b'", "'c', 'd'", "'e'"]


def test_betweenness_lines_and_ordered_text(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b", 1.5), ("c", "d", 9.0), ("a", "c", 9.0)], "src string, dst string, betweenness double")
    lines = sinks.betweenness_lines(edges)
    path = f"{tmp_path}/out"
    sinks.write_ordered_lines(lines, [F.desc("score"), F.asc("src"), F.asc("dst")], path)
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    text = "".join(open(f"{path}/{n}").read() for n in names).splitlines()
    assert text == ["('a', 'c'), 9.0", "('c', 'd'), 9.0", "('a', 'b'), 1.5"]
    assert sinks.betweenness_lines(edges, " , ").where("src = 'c'").first()["line"] == "('c', 'd') , 9.0"


def test_report_block(spark):
    report = spark.createDataFrame([(7, "b", 2), (7, "a", 2), (7, "c", 5)], "n_seen bigint, tag string, cnt bigint")
    lines = [r["line"] for r in sinks.report_block(report).orderBy("seq").collect()]
    assert lines == [sinks.COUNT_LINE + "7", "c:5", "a:2", "b:2"]


def test_label_round_and_prediction_files(spark, tmp_path):
    labels = spark.createDataFrame([(1, 0), (2, 3)], "point_id bigint, cluster_id int")
    sinks.write_labels(labels, f"{tmp_path}/labels")
    assert spark.read.json(f"{tmp_path}/labels").count() == 2
    stats = spark.createDataFrame([(2, 4, 5, 6, 7, 8), (1, 1, 1, 1, 1, 1)], ", ".join(f"{c} bigint" for c in sinks.ROUND_COLUMNS))
    sinks.write_round_stats(stats, f"{tmp_path}/stats")
    (name,) = [n for n in os.listdir(f"{tmp_path}/stats") if n.endswith(".csv")]
    lines = open(f"{tmp_path}/stats/{name}").read().splitlines()
    assert lines == [",".join(sinks.ROUND_COLUMNS), "1,1,1,1,1,1", "2,4,5,6,7,8"]
    predicted = spark.createDataFrame([("u", "b", 3.5)], "user_id string, business_id string, stars double")
    assert sinks.prediction_lines(predicted).first()["line"] == '{"user_id":"u","business_id":"b","stars":3.5}'
    sinks.write_predictions(predicted, f"{tmp_path}/predictions")
    assert spark.read.json(f"{tmp_path}/predictions").count() == 1
    sinks.save_table(predicted, f"{tmp_path}/table")
    assert sinks.load_table(spark, f"{tmp_path}/table").collect() == predicted.collect()


class FakeSession:
    def __init__(self, root, master):
        self.conf = {"spark.checkpoint.dir": root} if root else {}
        self.sparkContext = type("C", (), {"master": master, "applicationId": "app-test"})()


def test_scratch_root_reads_the_setting():
    assert scratch_root(FakeSession("hdfs://shared/folder/", "yarn")) == "hdfs://shared/folder"
    with pytest.raises(RuntimeError):
        scratch_root(FakeSession(None, "yarn"))
    local = scratch_root(FakeSession(None, "local[2]"))
    assert os.path.isdir(local) and scratch_root(FakeSession(None, "local[2]")) == local
    session._local_roots.pop("app-test")


def test_scratch_tables(spark):
    scratch = Scratch(spark, "test")
    table = scratch.write(spark.range(5), "five")
    assert table.count() == 5 and table.columns == ["id"]
    scratch.drop("five")
    assert spark.range(1).count() == 1
    with pytest.raises(Exception):
        spark.read.parquet(scratch.path("five"))
