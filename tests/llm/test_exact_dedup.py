import hashlib
import random
import string
from collections import defaultdict

from pyspark.sql import functions as F

from tallyvein.llm.exact_dedup import duplicate_groups, lower_az, without_duplicates

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def norm(text):
    return (text or "").translate(LOWER)


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[norm(text)].append(i)
    return sorted((i, max(groups[norm(t)]), len(groups[norm(t)])) for i, t in rows)


def found(df):
    return sorted((r.doc_id, r.keep_id, r.group_size) for r in df.collect())


def test_equals_brute_force(spark):
    rng = random.Random(3)
    heads = ["", "ABC ", "É" * 300, "x" * 400]
    rows = []
    for i in range(600):
        text = rng.choice(heads) + rng.choice(["", "a", "A", "b", "é", "É", "😀", "İ", "K", "ab" * 5000])
        rows.append((i, None if rng.random() < 0.05 else text))
    rows += [(1000 + i, "hot Group") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = duplicate_groups(df, carry={"sha": F.sha2(lower_az(F.col("text")).cast("binary"), 256)})
    assert found(out) == brute(rows)
    got = out.collect()
    assert {r.doc_id: r.sha for r in got} == {i: hashlib.sha256(norm(t).encode()).hexdigest() for i, t in rows}
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_same_length_and_prefix_are_not_enough(spark):
    rows = [(1, "p" * 300 + "a"), (2, "p" * 300 + "b"), (3, "P" * 300 + "A"), (4, "q" * 301)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(duplicate_groups(df)) == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)]


def test_one_of_repeated_rows_stays_and_null_ids_are_smallest(spark):
    rows = [(5, "same"), (5, "SAME"), (None, "same"), (None, None), (None, "")]
    out = duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.keep_id for r in out if r.group_size == 3] == [5, 5, 5]
    assert sum(r.kept for r in out if r.group_size == 3) == 1
    assert sum(r.kept for r in out if r.group_size == 2) == 1


def test_clashing_columns_and_empty_tables(spark):
    names = ["size", "digest", "row", "key", "given", "large", "class.x", "id", "prefix"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(i, "a" if i < 3 else f"t{i}", *names) for i in range(5)]
    df = spark.createDataFrame(rows, schema)
    kept = without_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r[0] for r in kept.collect()) == [2, 3, 4]
    assert all(tuple(r)[2:] == tuple(names) for r in kept.collect())
    assert duplicate_groups(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    plan = duplicate_groups(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
