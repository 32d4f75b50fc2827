"""Both ways to shared pairs against brute force."""

import random
from itertools import combinations

import pandas as pd
import pyarrow as pa
import pytest

from tallyvein.operators import minhash, overlap
from tallyvein.operators.overlap import Rule, shared_pairs


def brute(memberships, rule):
    sets = {}
    for user, item in memberships:
        sets.setdefault(user, set()).add(item)
    out = set()
    for a, b in combinations(sorted(sets), 2):
        k = len(sets[a] & sets[b])
        fits = k >= rule.overlap if rule.overlap is not None else k and k / len(sets[a] | sets[b]) >= rule.jaccard
        if fits:
            out.add((a, b, k, len(sets[a]), len(sets[b])))
    return out


def random_memberships(seed, text=False):
    rng = random.Random(seed)
    rows = []
    for user in range(40):
        for _ in range(rng.randint(1, 12)):
            rows.append((user, min(rng.randrange(15), rng.randrange(15))))
    # A user with very many items, copies of one set, and an item nearly everyone has.
    rows += [(100, i) for i in range(15)] + [(101, i) for i in range(1, 14)]
    rows += [(u, i) for u in (200, 201, 202, 203) for i in (3, 4, 5)]
    rows += [(u, 99) for u in range(0, 40, 2)]
    if text:
        rows = [(f"u{u:03d}", f"i{i}") for u, i in rows]
    return rows + rows[:20]


RULES = [Rule(overlap=1), Rule(overlap=2), Rule(overlap=4), Rule(jaccard=0.3), Rule(jaccard=0.5), Rule(jaccard=0.8), Rule(jaccard=1.0)]
WAYS = {
    "expand": {"expansion": 1e9},
    "prefix": {"expansion": 0.0},
    "prefix, blocks": {"expansion": 0.0, "popular": 5},
    "prefix, large users": {"expansion": 0.0, "row_items": 6},
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("rule", RULES, ids=str)
def test_matches_brute_force(spark, rule, way):
    rows = random_memberships(RULES.index(rule), text=way == "prefix")
    kind = "string" if way == "prefix" else "bigint"
    df = spark.createDataFrame(rows, f"u {kind}, i {kind}")
    got = shared_pairs(df, "u", "i", rule, **WAYS[way]).collect()
    assert len(got) == len({(r["src"], r["dst"]) for r in got})
    assert {tuple(r) for r in got} == brute(rows, rule)


def test_rule_needs_one_threshold():
    for bad in ({}, {"overlap": 2, "jaccard": 0.5}, {"overlap": 0}, {"jaccard": 0.0}, {"jaccard": 1.5}):
        with pytest.raises(ValueError):
            Rule(**bad)


def test_empty_input(spark):
    df = spark.createDataFrame([], "u bigint, i bigint")
    assert shared_pairs(df, "u", "i", Rule(overlap=1)).count() == 0


@pytest.mark.parametrize("rule", [Rule(overlap=300), Rule(jaccard=0.4), Rule(jaccard=0.95)], ids=str)
def test_large_users_in_groups_and_parts(spark, rule, monkeypatch):
    """A user with 100,000 items, others near it, and small groups and parts, so that every kind of boundary is met."""
    monkeypatch.setattr(overlap, "LARGE_GROUP", 2)
    monkeypatch.setattr(overlap, "OTHER_GROUP", 3)
    monkeypatch.setattr(overlap, "PART_ROWS", 20_000)
    sets = {0: range(100_000), 1: range(40_000, 100_000), 2: range(0, 100_000, 2), 3: range(99_500, 100_300), 4: range(300), 5: range(700)}
    sets |= {6: range(1, 100_000), 7: range(200_000, 200_900), 8: range(5)}
    rows = [(u, i) for u, items in sets.items() for i in items]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["u", "i"]))
    got = {tuple(r) for r in shared_pairs(df, "u", "i", rule, expansion=0.0).collect()}
    assert got == brute(rows, rule) and got


def test_pairs_that_fail_do_not_leave_the_task(spark):
    rows = [(u, f"item {i}") for u in range(12) for i in range(u * 50, u * 50 + 600)]
    df = spark.createDataFrame(rows, "u int, i string")
    rule = Rule(overlap=500)
    left = []
    batches = [pa.RecordBatch.from_pydict({
        "row": pa.array([0] * 1800, pa.int32()), "column": pa.array([0] * 1800, pa.int32()), "part": pa.array([0] * 1800, pa.int32()),
        "first": [True] * 600 + [False] * 1200, "at": pa.array([0] * 600 + [0] * 600 + [1] * 600, pa.int32()),
        "size": pa.array([600] * 1800, pa.int64()), "item": [*range(600), *range(50, 650), *range(400, 1000)],
    })]
    for batch in overlap._count_bits(batches, rule):
        left += batch.to_pylist()
    assert [(r["a"], r["b"], r["overlap"]) for r in left] == [(0, 0, 550)]
    assert {tuple(r) for r in shared_pairs(df, "u", "i", rule, expansion=0.0).collect()} == brute(rows, rule)


def test_items_go_only_where_both_groups_hold_them(spark):
    rows = spark.createDataFrame([(u, i) for u in range(20) for i in range(u * 10, u * 10 + 15)], "user int, item int")
    users = spark.createDataFrame([(u, u, 0, 15) for u in range(20)], "user int, group int, at int, size long")
    met = overlap._meetings(overlap.Scratch(spark, "meetings"), rows, users, users, overlap.F.lit(0)).collect()
    # Each user meets itself by 15 items and each neighbour by 5; every group to every group would be 20 * 20 * 30 rows.
    assert len(met) == 2 * (20 * 15 + 2 * 19 * 5)
    assert all(abs(r["row"] - r["column"]) <= 1 for r in met)


@pytest.mark.parametrize("bound", [1_000, 80], ids=["short", "long users added up first"])
def test_expanded_pairs_set_the_tasks(spark, monkeypatch, bound):
    monkeypatch.setattr(overlap, "TASK_PAIRS", bound)
    rows = [(u, i) for u in range(60) for i in range(u % 7, 90, 7)]
    df = spark.createDataFrame(rows, "u int, i int")
    expanded = sum(n * (n - 1) / 2 for n in pd.Series([i for _, i in rows]).value_counts())
    found = shared_pairs(df, "u", "i", Rule(overlap=3), with_sizes=False)
    if bound > 80:
        assert found.rdd.getNumPartitions() == -(-expanded // bound)
    assert {tuple(r) for r in found.collect()} == {r[:3] for r in brute(rows, Rule(overlap=3))}


def test_bands_reach_the_stated_recall():
    for jaccard in (0.3, 0.5, 0.8, 0.95, 1.0):
        for recall in (0.5, 0.9, 0.99):
            bands, rows = minhash.band_plan(jaccard, recall)
            assert 1 - (1 - jaccard**rows) ** bands >= recall - 1e-12 and bands * rows <= minhash.MOST_HASHES
    with pytest.raises(ValueError, match="recall"):
        minhash.band_plan(0.001, 0.99)


def test_approximate_pairs_are_right_and_nearly_all(spark):
    rng = random.Random(9)
    rows = []
    for group in range(60):
        base = rng.sample(range(2000), 40)
        for copy in range(4):
            rows += [(group * 4 + copy, i) for i in rng.sample(base, 36)]
    rows += [(1000 + k, i) for k in range(5) for i in range(3000, 3010)]
    df = spark.createDataFrame(rows, "u long, i long")
    found = minhash.approximate_pairs(df, "u", "i", 0.7, 0.95)
    report = minhash.recall_report(found, shared_pairs(df, "u", "i", Rule(jaccard=0.7))).first()
    assert report.wrong == 0 and report.pairs > 300 and report.recall >= 0.9
    assert found.count() == report.found
    assert minhash.approximate_pairs(df.limit(0), "u", "i", 0.7).count() == 0


def test_copies_are_one_until_pairs_pass(spark, monkeypatch):
    """Five sets of 30 users each: candidates are pairs of sets; equal signatures of other sets are no copies."""
    rows = [(100 * s + c, i) for s in range(5) for c in range(30) for i in range(s * 3, s * 3 + 12)]
    df = spark.createDataFrame(rows, "u long, i long")
    written, plain = {}, minhash.Scratch.write
    monkeypatch.setattr(minhash.Scratch, "write", lambda self, table, name: written.setdefault(name, plain(self, table, name)))
    rule = Rule(jaccard=0.5)
    found = minhash.approximate_pairs(df, "u", "i", 0.5, 0.99)
    assert {tuple(r) for r in found.collect()} <= brute(rows, rule)
    assert found.where("src div 100 = dst div 100").count() == 5 * 30 * 29 / 2
    assert written["candidates"].count() <= 10
    flat = lambda rows, bands, depth: rows.select("user").distinct().withColumn("keys", minhash.F.array(*[minhash.F.lit(b).cast("long") for b in range(bands)]))
    monkeypatch.setattr(minhash, "signatures", flat)
    written.clear()
    assert {tuple(r) for r in minhash.approximate_pairs(df, "u", "i", 0.5).collect()} == brute(rows, rule)


@pytest.mark.parametrize(("rule", "text"), [(Rule(overlap=4), False), (Rule(jaccard=0.3), True), (Rule(jaccard=0.5), False)], ids=str)
def test_sets_with_few_items_between_them_meet_as_matrices(spark, monkeypatch, rule, text):
    rng = random.Random(11)
    rows = [(u, i) for u in range(300) for i in rng.sample(range(30), rng.randint(1, 14))]
    rows += [(u + 1000, i) for u, i in rows if u < 20]  # equal sets
    rows = [(f"u{u:04d}", f"i{i}") for u, i in rows] if text else rows
    df = spark.createDataFrame(rows, "u string, i string" if text else "u bigint, i bigint")
    monkeypatch.setattr(overlap, "BLOCK_SETS", 40)
    monkeypatch.setattr(overlap, "TILE_SETS", 16)
    monkeypatch.setattr(overlap, "_prefix_pairs", None)  # must not be needed
    got = shared_pairs(df, "u", "i", rule, expansion=0.0).collect()
    assert len(got) == len({(r["src"], r["dst"]) for r in got})
    assert {tuple(r) for r in got} == brute(rows, rule)


@pytest.mark.parametrize(("rule", "text"), [(Rule(overlap=3), False), (Rule(jaccard=0.4), True)], ids=str)
def test_users_of_equal_sets_meet_in_the_tasks_of_the_matrices(spark, monkeypatch, rule, text):
    """Pairs of users leave the tasks: no join or exchange lies behind the products. Sets with more users than a row holds stand in several."""
    rng = random.Random(17)
    sets = [rng.sample(range(20), rng.randint(1, 9)) for _ in range(60)] + [[1], [1, 2, 3]]
    rows = [(100 * s + c, i) for s, items in enumerate(sets) for c in range(1 if s % 3 else 8) for i in items]
    rows = [(f"u{u:05d}", f"i{i}") for u, i in rows] if text else rows
    df = spark.createDataFrame(rows, "u string, i string" if text else "u bigint, i bigint")
    for name, value in (("BLOCK_SETS", 16), ("TILE_SETS", 4), ("ROW_USERS", 3), ("PAIRS_AT_ONCE", 10), ("_prefix_pairs", None)):
        monkeypatch.setattr(overlap, name, value)
    found = shared_pairs(df, "u", "i", rule, expansion=0.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.partition("MapInArrow")[0]
    got = found.collect()
    assert len(got) == len({(r["src"], r["dst"]) for r in got})
    assert {tuple(r) for r in got} == brute(rows, rule)


def test_candidates_that_cannot_pass_are_not_written(spark, monkeypatch):
    """Sets that agree in a band, but in few items."""
    rng = random.Random(19)
    rows = [(u, i) for u in range(250) for i in rng.sample(range(40), 8)]
    df = spark.createDataFrame(rows, "u long, i long")
    written, plain = {}, minhash.Scratch.write
    monkeypatch.setattr(minhash.Scratch, "write", lambda self, table, name: written.setdefault(name, plain(self, table, name)))
    rule = Rule(jaccard=0.5)
    found = {tuple(r) for r in minhash.approximate_pairs(df, "u", "i", 0.5, 0.99).collect()}
    assert found <= brute(rows, rule) and len(found) >= 0.9 * len(brute(rows, rule))
    assert written["candidates"].count() <= 150  # of 31,125 pairs; 5 pass
