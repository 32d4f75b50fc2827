"""Membership, distinct counts, samples and positions."""

import statistics

import pytest
from pyspark.sql import functions as F

from tallyvein.functions.grouping import group_values
from tallyvein.functions.hashing import hash_parameters, linear_hash, string_key, trailing_zeros
from tallyvein.functions.ranking import positions, with_top_counts
from tallyvein.functions.text import epoch_seconds, list_length, tags, tokens
from tallyvein.operators import blocked_bloom, distinct, membership, sampling, sketches
from tallyvein.session import Scratch


def names(spark, start, stop):
    return spark.range(start, stop).select(F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"))


def test_no_false_negatives_and_few_false_positives(spark):
    members = names(spark, 0, 2000)
    bloom = membership.bloom_build(members.unionByName(members), "name", 2000)
    probed = membership.bloom_probe(names(spark, 0, 12000), "name", bloom)
    report = membership.bloom_report(probed, members, "name").first()
    assert report["false_negatives"] == 0 and report["members"] == 2000
    assert report["false_positive_rate"] < 0.06


def test_both_probes_agree(spark):
    bloom = membership.bloom_build(names(spark, 0, 100), "name")
    assert bloom.broadcastable
    probes = names(spark, 50, 400).unionByName(spark.createDataFrame([(None,)], "name string"))
    small = {tuple(r) for r in membership.bloom_probe(probes, "name", bloom).collect()}
    assert small == {tuple(r) for r in membership.probe_by_word(probes, "name", bloom).collect()}
    assert (None, False) in small


def test_blocked_filter_near_theory(spark):
    members = names(spark, 0, 4000)
    n_blocks = blocked_bloom.blocks_for(4000)
    bloom = blocked_bloom.blocked_build(members.unionByName(members), "name", n_blocks)
    report = membership.bloom_report(blocked_bloom.blocked_probe(names(spark, 0, 44000), "name", bloom), members, "name").first()
    theory = blocked_bloom.expected_rate(4000, n_blocks)
    assert report["false_negatives"] == 0 and report["members"] == 4000
    # 40,000 probes: four standard deviations, with as much again for the filling of this one filter.
    assert abs(report["false_positive_rate"] - theory) < 8 * (theory / 40000) ** 0.5
    assert theory < 0.02


def test_blocked_filters_merge_and_probe_both_ways(spark):
    n_blocks = 7
    parts = [blocked_bloom.blocked_build(names(spark, a, a + 60), "name", n_blocks) for a in (0, 60)]
    merged = blocked_bloom.blocked_merge(parts)
    whole = blocked_bloom.blocked_build(names(spark, 0, 120), "name", n_blocks)
    assert sorted(merged.blocks.collect()) == sorted(whole.blocks.collect())
    with pytest.raises(ValueError):
        blocked_bloom.blocked_merge([whole, blocked_bloom.blocked_build(names(spark, 0, 9), "name", 3)])
    probes = names(spark, 0, 300).unionByName(spark.createDataFrame([(None,), ("",)], "name string")).withColumn("block", F.lit(1)).withColumn("lane0", F.lit("x"))
    small = blocked_bloom.blocked_probe(probes, "name", merged)
    assert small.columns == ["name", "block", "lane0", "maybe_present"]
    large = blocked_bloom.blocked_probe(probes, "name", blocked_bloom.BlockedFilter(merged.blocks.where("false"), 10**7))
    assert small.count() == large.count() == 302 and small.where("maybe_present").count() >= 120
    assert large.where("maybe_present").count() == 0 and not small.where("name is null and maybe_present").count()
    assert small._jdf.queryExecution().executedPlan().toString().count("Join") == 1


def test_large_filter_is_not_broadcast(spark):
    bloom = membership.bloom_build(names(spark, 0, 10), "name", 10**9)
    assert not bloom.broadcastable
    assert membership.bloom_probe(names(spark, 0, 10), "name", bloom).where("maybe_present").count() == 10


def test_keys_fit_the_linear_hash():
    assert all(0 < a < 2**20 and a % 2 and 0 < b < 2**20 for a, b in hash_parameters(100))
    assert (2**40 - 1) * (2**20 - 1) + 2**20 < 2**63


def test_trailing_zeros(spark):
    df = spark.createDataFrame([(0,), (1,), (8,), (12,), (2**40,)], "x bigint")
    assert [r[0] for r in df.select(trailing_zeros(F.col("x"))).collect()] == [0, 0, 3, 2, 40]


def test_sketch_by_hand(spark):
    values = [f"v{i}" for i in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    k, bits = 10, 10
    rows = df.select(*[string_key("v", i).alias(f"k{i}") for i in range(3)]).collect()
    tops = []
    for i, (a, b) in enumerate(hash_parameters(k)):
        hashes = [(r[i % 3] * a + b) % 2**bits for r in rows]
        tops.append(max([h & -h for h in hashes if h] or [1]))
    means = [statistics.mean(tops[:3]), statistics.mean(tops[3:6]), statistics.mean(tops[6:])]
    assert distinct.fm_distinct(df, "v", k=k, bits=bits, mean_of="powers").first()["estimate"] == int(statistics.median(means))


def test_sketches_ignore_repeats_and_merge(spark):
    left, right = names(spark, 0, 700), names(spark, 500, 1500)
    whole = distinct.fm_sketch(left.unionByName(right).unionByName(left), "name").select("hash_no", "top")
    parts = distinct.fm_merge(distinct.fm_sketch(left, "name").unionByName(distinct.fm_sketch(right, "name")))
    assert sorted(whole.collect()) == sorted(parts.select("hash_no", "top").collect())


def test_stream_and_batch_hashes_agree(spark):
    df = names(spark, 0, 300).withColumn("g", F.length("name"))
    rows = distinct.hash_rows(distinct.with_keys(df, "name"), ["g"], 20, 12, 28)
    built_in = rows.groupBy("g", "hash_no").agg(F.max(F.col("hash").bitwiseAND(-F.col("hash"))).alias("top"))
    arrow = distinct.fm_sketch(df, "name", ["g"], 20, 12).select("g", "hash_no", "top")
    assert sorted(arrow.collect()) == sorted(built_in.select("g", "hash_no", "top").collect())


def test_window_must_be_whole_slides(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    with pytest.raises(ValueError):
        distinct.window_distinct(events, "ts", "user_id", 100, 30)


def test_windows_of_known_stamps(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:05", "a"), ("2020-01-01 00:00:25", "b"), ("2020-01-01 00:00:26", "b")], "s string, v string")
    found = distinct.window_distinct(df.withColumn("ts", F.col("s").cast("timestamp_ntz")), "ts", "v", 30, 10)
    start = 1577836800
    assert {(r[0] - start, r[1]) for r in found.collect()} == {(-20, 1), (-10, 1), (0, 2), (10, 1), (20, 1)}


def test_sample_size_and_partitions(spark):
    rows = names(spark, 0, 5000).withColumn("id", F.monotonically_increasing_id())
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(3000)], "id bigint, text string")
    one = sorted(sampling.fixed_sample(rows.repartition(7), "id").collect())
    assert one == sorted(sampling.fixed_sample(rows.coalesce(1), "id").collect())
    assert len(one) == 100
    assert len(sampling.fixed_sample(rows.limit(30), "id").collect()) == 30
    assert one != sorted(sampling.fixed_sample(rows, "id", seed=29).collect())


def test_sample_is_uniform(spark):
    rows = spark.range(4000)
    taken = [0, 0, 0, 0]
    for seed in range(12):
        for r in sampling.fixed_sample(rows, "id", 200, seed).collect():
            taken[r["id"] // 1000] += 1
    assert all(500 < t < 700 for t in taken)  # 600 expected


def test_sample_limits():
    assert [sampling.sample_size(n) for n in (10, 199, 200, 10**6)] == [2, 39, 40, 40]


def test_tokens_and_tags(spark):
    df = spark.createDataFrame([("Go #Élan! #a_1,#,##x #b#c ok",), ("",)], "t string")
    rows = df.select(tokens(F.col("t")), tags(F.col("t"))).collect()
    assert rows[0][0] == ["Go", "#", "lan", "#a_1", "#", "##x", "#b#c", "ok"]
    assert rows[0][1] == ["a_1", "#x", "b#c"]
    assert rows[1][0] == [] and rows[1][1] == []


def test_top_counts_keep_ties(spark):
    df = spark.createDataFrame([("a", 9), ("b", 9), ("c", 7), ("d", 5), ("e", 5), ("f", 1)], "tag string, cnt bigint")
    assert {r["tag"] for r in with_top_counts(df).collect()} == set("abcde")


def test_epoch_ignores_the_session_zone(spark):
    df = spark.createDataFrame([("2010-07-05 17:03:04",)], "s string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert df.select(epoch_seconds(F.col("s"))).first()[0] == 1278349384
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_list_length(spark):
    df = spark.createDataFrame([("a, b, c",), ("",), (None,), ("a",)], "f string")
    assert [r[0] for r in df.select(list_length(F.col("f"))).collect()] == [3, 0, 0, 1]


def test_positions_over_a_hot_group(spark):
    rows = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(5)] + [("warm", i) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(6)
    placed = positions(df, [F.desc("v")], by=["g"]).collect()
    assert len(placed) == len(rows)
    top = {"hot": 3000, "cold": 5, "warm": 40}
    assert all(r["position"] == top[r["g"]] - r["v"] for r in placed)
    overall = positions(df, [F.col("g"), F.col("v")]).collect()
    assert sorted(r["position"] for r in overall) == list(range(1, len(rows) + 1))


def test_group_pieces_lose_nothing(spark):
    rows = [("hot", i % 900) for i in range(1800)] + [("cold", 1), ("cold", 1)]
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, n bigint")
    lists = group_values(df, "k", "v", per_row=100).collect()
    assert sorted((r["k"], v) for r in lists for v in r["members"]) == sorted(rows)
    assert len([r for r in lists if r["k"] == "hot"]) > 9
    sets = group_values(df, "k", "v", unique=True, per_row=100).collect()
    assert sorted((r["k"], v) for r in sets for v in r["members"]) == sorted(set(rows))
    assert max(len(r["members"]) for r in sets) < 200


def test_one_value_repeated_is_spread(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.lit(7).alias("v"), "id")
    lists = group_values(df, "k", "v", per_row=1000).collect()
    assert sum(len(r["members"]) for r in lists) == 20_000 and max(len(r["members"]) for r in lists) <= 4000 and len(lists) > 9
    empty = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "k string, v int")
    assert {r["k"]: r["members"] for r in group_values(empty, "k", "v").collect()} == {"a": [1], "b": []}


@pytest.mark.parametrize("n", [30, 1500, 40_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_estimates_do_not_saturate(spark, n, seed):
    df = spark.range(n).select(F.concat(F.lit("v"), "id").alias("v"))
    assert abs(distinct.fm_distinct(df, "v", seed=seed).first()["estimate"] - n) / n < 0.4


def test_stored_sketches_merge_to_one_pass(spark):
    """Overlapping parts, a part written twice, a compacted store: the estimate is that of all rows at once."""
    rows = spark.range(0, 60_000).select((F.col("id") % 3).cast("int").alias("g"), (F.col("id") * 7 % 20_011).alias("v"))
    store = sketches.SketchStore(spark, Scratch(spark, "test-store").path("runs"), "g int")
    parts = [rows.where("v < 9000"), rows.where("v BETWEEN 5000 AND 15000"), rows.where("v > 14000")]
    for i, part in enumerate(parts):
        store.write(i, sketches.sketch_values(part, "v", ["g"]))
    store.write(1, sketches.sketch_values(parts[1], "v", ["g"]))
    kept = store.compact(Scratch(spark, "test-store").path("one"))
    whole = sketches.merge_sketches(sketches.sketch_values(rows, "v", ["g"]), ["g"])

    def answers(df):
        return sorted(tuple(r) for r in df.select("g", sketches.estimated("sketch")).collect())

    def same(one, other):
        return [g for g, _ in one] == [g for g, _ in other] and all(abs(a - b) <= 1 + 0.02 * b for (_, a), (_, b) in zip(one, other))

    assert same(answers(store.read()), answers(whole)) and same(answers(kept.read()), answers(whole))
    kept.write("again", sketches.sketch_values(parts[0], "v", ["g"]))
    assert same(answers(kept.read()), answers(whole))
    truth = rows.distinct().groupBy("g").agg(F.count("*").alias("truth"))
    found = sketches.coverage_report(whole.select("g", sketches.estimated("sketch").alias("estimate")), truth, ["g"])
    assert all(r.within_bound and r.relative_error < 0.08 for r in found.collect()) and found.count() == 3


def test_sketch_bound_is_that_of_the_registers(spark):
    """Many groups of one size: the spread of the estimates is the stated deviation."""
    rows = spark.range(0, 400 * 3000).select((F.col("id") % 400).alias("g"), F.col("id").alias("v"))
    for lg_k in (8, 12):
        found = sketches.merge_sketches(sketches.sketch_values(rows, "v", ["g"], lg_k), ["g"])
        off = [(r[0] - 3000) / 3000 for r in found.select(sketches.estimated("sketch")).collect()]
        deviation = (sum(x * x for x in off) / len(off)) ** 0.5
        assert 0.5 < deviation / sketches.relative_deviation(lg_k) < 1.5


def test_windows_from_panes_and_missing_values(spark):
    events = spark.createDataFrame(
        [("2020-01-01 00:00:05", "a"), ("2020-01-01 00:00:15", "b"), ("2020-01-01 00:00:15", None), ("2020-01-01 00:00:25", "a"), (None, "z")],
        "ts string, v string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    panes = sketches.pane_sketches(events, "ts", "v", 10)
    found = sketches.windows_of_panes(panes, 30, 10).select("window_start", "window_end", sketches.estimated("sketch"))
    base = 1577836800
    assert sorted(tuple(r) for r in found.collect()) == [(base + s, base + s + 30, n) for s, n in ((-20, 1), (-10, 2), (0, 2), (10, 2), (20, 1))]
    assert sketches.pane_sketches(events.limit(0), "ts", "v", 10).count() == 0
