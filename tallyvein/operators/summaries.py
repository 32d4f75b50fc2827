"""Cluster summaries as a table, and their merging without the driver.

A summary is (cluster_id, n, sum, sumsq): moments that add up. Two summaries may merge if every
dimension of their union deviates by less than the gate g = 3 * sqrt(d).

Candidates come from a grid. With sizes n <= m and r = m / n the union deviates by at least
gap * sqrt(n * m) / (n + m) in a dimension where the centres lie ``gap`` apart, so a passing pair has
gap < g * (sqrt(r) + 1 / sqrt(r)) there. Sizes are put into levels of a factor four; two summaries whose
levels differ by k meet in a grid of cells of width g * (2^(k+1) + 1), where they lie in the same or in
neighbouring cells. The grid takes the two dimensions in which the centres spread most.

Merging is by rounds: every summary names its nearest passing partner (the distance of the centres, then
the lower ids), pairs that name each other merge, the lower id stays. The closest passing pair of all
names itself, so rounds go on until no pair passes, and the result depends on no order of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvein.functions.vectors import add_powers, deviation_of, euclidean, gate, mean_of
from tallyvein.session import Scratch

SUMMARIES = "cluster_id int, n bigint, sum array<double>, sumsq array<double>"
MOVES = "cluster_id int, into int"
#: At most so many summaries are merged in one piece of memory instead of rounds of jobs, by the same rule.
LOCAL = 512


def union_deviation(a: str, b: str) -> Column:
    """Deviation per dimension of the union of two summaries, by the prefixes of their columns."""
    sums, squares = (add_powers(F.col(f"{a}_{c}"), F.col(f"{b}_{c}")) for c in ("sum", "sumsq"))
    return deviation_of(F.col(f"{a}_n") + F.col(f"{b}_n"), sums, squares)


def added(parts: DataFrame) -> DataFrame:
    """Parts of summaries added up per cluster, dimension by dimension."""
    single = parts.select("cluster_id", "n", F.posexplode(F.arrays_zip("sum", "sumsq")).alias("dim", "m"))
    totals = single.groupBy("cluster_id", "dim").agg(F.sum("n").alias("n"), F.sum("m.sum").alias("sum"), F.sum("m.sumsq").alias("sumsq"))
    entries = F.array_sort(F.collect_list(F.struct("dim", "sum", "sumsq")))  # one entry per dimension
    rows = totals.groupBy("cluster_id").agg(F.max("n").alias("n"), entries.alias("m"))
    return rows.select("cluster_id", "n", F.col("m.sum").alias("sum"), F.col("m.sumsq").alias("sumsq"))


def widest(summaries: DataFrame) -> tuple[int, list[int]]:
    """(dimensions, the two in which the centres spread most): one row per dimension comes back."""
    centres = summaries.select(F.posexplode(mean_of(F.col("n"), F.col("sum"))).alias("dim", "x"))
    rows = centres.groupBy("dim").agg((F.max("x") - F.min("x")).alias("spread")).collect()
    order = sorted(rows, key=lambda r: (-r["spread"], r["dim"]))
    return len(rows), [r["dim"] for r in order[:2]] * (2 if len(rows) == 1 else 1)


def neighbours(summaries: DataFrame) -> DataFrame:
    """(one, other): pairs whose centres are near enough to merge in the two dimensions of the grid; one < other."""
    d, dims = widest(summaries)
    if d == 0:
        return summaries.sparkSession.createDataFrame([], "one int, other int")
    g = gate(d)
    centre = mean_of(F.col("n"), F.col("sum"))
    placed = summaries.select(
        "cluster_id", F.col("n").cast("double").alias("n"), F.floor(F.log2("n") / 2).cast("int").alias("level"),
        *[F.element_at(centre, dim + 1).alias(f"x{i}") for i, dim in enumerate(dims)],
    )
    levels = sorted(r["level"] for r in placed.select("level").distinct().collect())  # 32 at most
    steps = sorted({high - low for low in levels for high in levels if high >= low})
    width = F.pow(F.lit(2.0), F.col("step") + 1) * g + g
    every = placed.withColumn("step", F.explode(F.array(*[F.lit(s) for s in steps])))
    cells = every.select("*", *[F.floor(F.col(f"x{i}") / width).alias(f"cell{i}") for i in range(2)])
    around = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    small = cells.where(F.col("level") + F.col("step") <= levels[-1]).withColumn("at", F.explode(around)).select(
        F.col("level").alias("low"), "step", (F.col("cell0") + F.col("at.a")).alias("cell0"), (F.col("cell1") + F.col("at.b")).alias("cell1"),
        *[F.col(c).alias(f"a_{c}") for c in ("cluster_id", "n", "x0", "x1")],
    )
    large = cells.where(F.col("level") - F.col("step") >= levels[0]).select(
        (F.col("level") - F.col("step")).alias("low"), "step", "cell0", "cell1", *[F.col(c).alias(f"b_{c}") for c in ("cluster_id", "n", "x0", "x1")]
    )
    reach = g * (F.col("a_n") + F.col("b_n")) / F.sqrt(F.col("a_n") * F.col("b_n"))
    near = (F.abs(F.col("a_x0") - F.col("b_x0")) < reach) & (F.abs(F.col("a_x1") - F.col("b_x1")) < reach)
    once = (F.col("step") > 0) | (F.col("a_cluster_id") < F.col("b_cluster_id"))
    # The planner does not see how far the sides were exploded: no side is broadcast, a full cell is split by AQE.
    pairs = small.hint("merge").join(large, ["low", "step", "cell0", "cell1"]).where(once & near)
    ids = (F.col("a_cluster_id"), F.col("b_cluster_id"))
    return pairs.select(F.least(*ids).alias("one"), F.greatest(*ids).alias("other"))


def merge_pairs(summaries: DataFrame) -> DataFrame:
    """(one, other, n, distance, deviation): all pairs that pass the gate, the distance of their centres and their union's largest deviation."""
    pairs = neighbours(summaries)
    for end, name in (("one", "a"), ("other", "b")):
        side = summaries.select(F.col("cluster_id").alias(end), *[F.col(c).alias(f"{name}_{c}") for c in ("n", "sum", "sumsq")])
        pairs = pairs.join(side, end)
    deviation = F.array_max(union_deviation("a", "b"))
    distance = euclidean(mean_of(F.col("a_n"), F.col("a_sum")), mean_of(F.col("b_n"), F.col("b_sum")))
    found = pairs.select("one", "other", (F.col("a_n") + F.col("b_n")).alias("n"), distance.alias("distance"), deviation.alias("deviation"), F.size("a_sum").alias("d"))
    return found.where(F.col("deviation") < F.sqrt("d") * 3).drop("d")


def merge_summaries(summaries: DataFrame, local: int = LOCAL) -> tuple[DataFrame, DataFrame]:
    """(summaries, moves): merged until no pair passes, and (cluster_id, into) for each that went, ``into`` being one that stays."""
    spark = summaries.sparkSession
    scratch = Scratch(spark, "merge")
    now, seen = scratch.write_counted(summaries.select("cluster_id", "n", "sum", "sumsq"), "round-0", rows=F.count(F.lit(1)))
    rows, moves, number = seen["rows"], [], 0
    while rows > local:
        number += 1
        best = F.struct("distance", "one", "other")
        named = merge_pairs(now).withColumn("id", F.explode(F.array("one", "other"))).groupBy("id").agg(F.min(best).alias("best"))
        mutual = named.groupBy("best.one", "best.other").agg(F.count("*").alias("ends")).where("ends = 2")
        step, seen = scratch.write_counted(mutual.select(F.col("other").alias("cluster_id"), F.col("one").alias("into")), f"moves-{number}", rows=F.count(F.lit(1)))
        if not seen["rows"]:
            break
        moves.append(step)
        rows -= seen["rows"]
        now = scratch.write(_moved(now, step), f"round-{number}")
    if rows <= local:
        now, last = _merge_local(spark, now)
        moves.append(last)
    total = spark.createDataFrame([], MOVES)
    for step in moves:
        total = total.unionByName(step)
    return now, scratch.write(resolve(scratch, total), "moves")


def _moved(summaries: DataFrame, step: DataFrame) -> DataFrame:
    """Summaries after the moves of a round, of which each stays or takes one other in."""
    left = summaries.join(step, "cluster_id", "left_anti")
    gone = summaries.join(step, "cluster_id").select(F.col("into").alias("cluster_id"), *[F.col(c).alias(f"b_{c}") for c in ("n", "sum", "sumsq")])
    both = left.join(gone, "cluster_id", "left")
    add = {c: F.when(F.col("b_n").isNull(), F.col(c)).otherwise(add_powers(F.col(c), F.col(f"b_{c}"))) for c in ("sum", "sumsq")}
    return both.select("cluster_id", (F.col("n") + F.coalesce("b_n", F.lit(0))).alias("n"), *[add[c].alias(c) for c in add])


def resolve(scratch: Scratch, moves: DataFrame, name: str = "resolve") -> DataFrame:
    """Moves that lead to where a chain of them ends: each round doubles how far a move looks."""
    number = 0
    now = scratch.write(moves, f"{name}-0")
    while True:
        number += 1
        ahead = now.select(F.col("cluster_id").alias("into"), F.col("into").alias("next"))
        jumped = now.join(ahead, "into", "left").select("cluster_id", F.coalesce("next", "into").alias("into"), F.col("next").isNotNull().alias("more"))
        now, seen = scratch.write_counted(jumped, f"{name}-{number}", more=F.count_if("more"))
        now = now.select("cluster_id", "into")
        if not seen["more"]:
            return now


def _merge_local(spark, summaries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same rounds over at most LOCAL summaries as arrays."""
    rows = summaries.toArrow().to_pylist()
    ids, n, sums, squares, gone = merge_arrays(
        [r["cluster_id"] for r in rows], [r["n"] for r in rows], [r["sum"] for r in rows], [r["sumsq"] for r in rows]
    )
    kept = [(int(i), int(k), s.tolist(), q.tolist()) for i, k, s, q in zip(ids, n, sums, squares)]
    return spark.createDataFrame(kept, SUMMARIES), spark.createDataFrame(gone, MOVES)


def merge_arrays(ids, n, sums, squares):
    """(ids, n, sums, squares, moves) after merging until no pair passes; one row of the pair table in memory at a time."""
    if not len(ids):
        return ids, n, sums, squares, []
    order = np.argsort(ids, kind="stable")
    ids, n = np.array(ids, np.int64)[order], np.array(n, np.float64)[order]
    sums, squares = (np.array(x, np.float64).reshape(len(ids), -1)[order] for x in (sums, squares))
    moves: list[tuple[int, int]] = []
    while len(ids) > 1:
        centres, limit = sums / n[:, None], gate(sums.shape[1])
        best = []
        for i in range(len(ids)):
            total = (n + n[i])[:, None]
            deviation = np.sqrt(np.maximum((squares + squares[i]) / total - ((sums + sums[i]) / total) ** 2, 0.0))
            fits = (deviation < limit).all(axis=1)
            fits[i] = False
            distance = np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
            found = np.flatnonzero(fits)
            # Rows are in order of ids, so the lowest pair of ids comes first among equals.
            best.append(int(min(found, key=lambda j: (distance[j], min(i, j), max(i, j)))) if len(found) else -1)
        pairs = [(i, j) for i, j in enumerate(best) if i < j and best[j] == i]
        if not pairs:
            break
        for i, j in pairs:
            n[i] += n[j]
            sums[i] += sums[j]
            squares[i] += squares[j]
            moves.append((int(ids[j]), int(ids[i])))
        keep = np.setdiff1d(np.arange(len(ids)), [j for _, j in pairs])
        ids, n, sums, squares = ids[keep], n[keep], sums[keep], squares[keep]
    return ids, n, sums, squares, moves
