"""k-means and chunk-by-chunk clustering against plain arithmetic and their invariants."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyvein.functions import vectors
from tallyvein.functions.vectors import gate
from tallyvein.operators import chunked, clustering, summaries
from tallyvein.session import Scratch


def points_of(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in f]) for i, f in rows], "point_id bigint, features array<double>")


def blobs(n, seed=3, dims=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[0.0] * dims, [20.0] * dims, [0.0] * (dims - 1) + [40.0]])
    return [(i, centres[i % 3] + rng.normal(0, 1, dims)) for i in range(n)]


def test_farthest_first_by_hand(spark):
    points = points_of(spark, [(0, [0, 0]), (1, [1, 0]), (2, [10, 0]), (3, [10, 1]), (4, [0, 9])])
    assert clustering.farthest_first(points, 3) == [[0.0, 0.0], [10.0, 1.0], [0.0, 9.0]]
    assert clustering.farthest_first(points, 2, start=4) == [[0.0, 9.0], [10.0, 0.0]]


def test_farthest_tie_goes_to_the_smaller_id(spark):
    points = points_of(spark, [(0, [0]), (1, [5]), (2, [-5])])
    assert clustering.farthest_first(points, 2) == [[0.0], [5.0]]


def test_kmeans_matches_numpy(spark):
    rows = blobs(90)
    matrix = np.array([f for _, f in rows])
    centres = np.array(clustering.farthest_first(points_of(spark, rows), 3))
    while True:
        labels = ((matrix[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([matrix[labels == c].mean(axis=0) for c in range(3)])
        if np.allclose(moved, centres, atol=0):
            break
        centres = moved
    found = clustering.kmeans(points_of(spark, rows).repartition(5), 3, tol=1e-12)
    assert np.allclose(found.centres, centres)
    assert {r["point_id"]: r["cluster_id"] for r in found.labels.collect()} == dict(enumerate(labels))


def test_empty_cluster_keeps_its_centre(spark):
    points = points_of(spark, [(0, [0]), (1, [2])])
    assert clustering.kmeans_step(points, [[1.0], [100.0]]) == [[1.0], [100.0]]


def test_more_clusters_than_points(spark):
    found = clustering.kmeans(points_of(spark, [(0, [0, 1]), (1, [2, 3])]), 5)
    assert {r["cluster_id"] for r in found.labels.collect()} == {0, 1}


def test_summary_and_centroids(spark):
    assigned = points_of(spark, [(0, [1, 2]), (1, [3, 4]), (2, [5, 6])]).withColumn("cluster_id", F.when(F.col("point_id") < 2, 0).otherwise(1))
    rows = {r["cluster_id"]: r for r in clustering.cluster_summary(assigned).collect()}
    assert (rows[0]["n"], rows[0]["sum"], rows[0]["sumsq"]) == (2, [4.0, 6.0], [10.0, 20.0])
    means = {(r["cluster_id"], r["dim"]): r["mean"] for r in clustering.centroids(assigned).collect()}
    assert means == {(0, 0): 2.0, (0, 1): 3.0, (1, 0): 5.0, (1, 1): 6.0}


def test_vector_expressions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0], [3.0, 0.0])], "x array<double>, y array<double>, s array<double>")
    row = df.select(
        vectors.euclidean(F.col("x"), F.col("y")).alias("e"),
        vectors.mahalanobis(F.col("y"), F.col("x"), F.col("s")).alias("m"),
        vectors.add_powers(F.col("x"), F.col("y"), 2).alias("a"),
    ).first()
    assert row["e"] == 5.0
    assert row["m"] == pytest.approx(np.sqrt(1 + 16))  # no spread in the second dimension: plain difference
    assert row["a"] == [17.0, 38.0]


def test_kmeans_parallel_labels_all(spark):
    labels = clustering.kmeans_parallel(points_of(spark, blobs(60)), 3).collect()
    assert len(labels) == 60
    assert len({r["cluster_id"] for r in labels if r["point_id"] % 3 == 0}) == 1


def test_placing_prefers_ds_and_the_nearest(spark):
    def summary(i, centre, spread):
        n = 100
        return chunked.Summary(i, n, np.array([centre * n]), np.array([(spread**2 + centre**2) * n]))

    ds, cs = [summary(0, 0.0, 1.0), summary(1, 4.0, 1.0)], [summary(2, 3.0, 5.0)]
    placed = chunked.with_set(points_of(spark, [(0, [1]), (1, [2.9]), (2, [9]), (3, [100])]), ds, cs)
    found = {r["point_id"]: (r["set_kind"], r["cluster_id"]) for r in placed.collect()}
    assert found == {0: ("DS", 0), 1: ("DS", 1), 2: ("CS", 2), 3: ("RS", None)}


def test_merge_gate(spark):
    one = chunked.Summary(0, 10, np.array([0.0]), np.array([0.0]))
    near = chunked.Summary(1, 10, np.array([50.0]), np.array([250.0]))
    far = chunked.Summary(2, 10, np.array([100.0]), np.array([1000.0]))
    # Two points of weight 10 at distance x deviate by x / 2; the gate is 3 in one dimension.
    assert chunked.may_merge(one, near) and not chunked.may_merge(one, far)
    assert gate(4) == 6.0


def run_chunks(spark, rows, k, chunks=4):
    points = points_of(spark, rows).withColumn("chunk", F.col("point_id") % chunks)
    return chunked.cluster_chunks(points, k, Scratch(spark, "test-chunks").base)


def test_chunks_count_every_point_once(spark):
    rows = blobs(240) + [(1000 + i, [500.0 + 200 * i, -300.0 * i, 90.0 * i]) for i in range(20)]
    state = run_chunks(spark, rows, 3)
    stats = chunked.chunk_stats(spark, state).orderBy("round_id").collect()
    per_round = [r["nof_point_discard"] + r["nof_point_compression"] + r["nof_point_retained"] for r in stats]
    assert per_round == [65, 130, 195, 260]
    labels = chunked.chunk_labels(spark, state).collect()
    assert sorted(r["point_id"] for r in labels) == sorted(i for i, _ in rows)
    last = stats[-1]
    kinds = [r["set_kind"] for r in labels]
    assert (kinds.count("DS"), kinds.count("CS"), kinds.count("RS")) == (
        last["nof_point_discard"], last["nof_point_compression"], last["nof_point_retained"],
    )
    numbers = {k: {r["cluster_id"] for r in labels if r["set_kind"] == k} for k in ("DS", "CS", "RS")}
    assert numbers["DS"] <= set(range(3))
    assert len(numbers["RS"]) == kinds.count("RS")
    assert not numbers["DS"] & numbers["CS"] and not numbers["CS"] & numbers["RS"]


def test_points_far_from_everything_are_retained_then_grouped(spark):
    near = blobs(200)
    # Far groups only in later chunks: first single points, then enough of them to be clustered.
    far = [(2001 + 2 * i, [1e4 * (1 + i % 12), 1e4 * (i % 5), float(i)]) for i in range(40)]
    rows = [(2 * i, f) for i, f in near] + far
    state = run_chunks(spark, rows, 3, chunks=2)
    assert state.stats[-1][5] < 40 and state.stats[-1][3] > 0
    assert chunked.chunk_labels(spark, state).count() == len(rows)


def test_state_survives_json_and_a_repeated_round(spark):
    rows = blobs(150)
    points = points_of(spark, rows)
    folder = Scratch(spark, "test-rounds").base
    first = chunked.start_chunks(points.where("point_id < 80"), 3, folder)
    again = chunked.load_state(spark, folder, 1)
    assert again.to_json() == first.to_json()
    second = points.where("point_id >= 80")
    once = chunked.absorb_chunk(second, again)
    twice = chunked.absorb_chunk(second, chunked.load_state(spark, folder, 1))
    assert once.stats == twice.stats
    assert chunked.chunk_labels(spark, twice).count() == 150


@pytest.mark.parametrize("rows", [[[1.0, 2.0], None], [[1.0], [2.0, 3.0]], [[1.0, None]], [[float("nan"), 1.0]]])
def test_incomplete_vectors_are_errors(spark, rows):
    with pytest.raises(ValueError):
        vectors.as_matrix(pa.array(rows, pa.list_(pa.float64())))
    points = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "point_id long, features array<double>").coalesce(1)
    with pytest.raises(Exception, match="vectors must"):
        clustering.with_nearest(points, [[0.0, 0.0]]).collect()


def test_first_chunk_and_sample_size(spark):
    points = spark.range(300).select(F.col("id").alias("point_id"), F.array(F.col("id").cast("double"), F.lit(0.0)).alias("features"))
    folder = Scratch(spark, "sized").base
    state = chunked.start_chunks(points, 60, folder, sample=100, max_iter=3)
    assert len(state.ds) == 60
    with pytest.raises(ValueError, match="first chunk"):
        chunked.start_chunks(points.limit(4), 5, Scratch(spark, "small").base)


def test_finishing_leaves_the_rounds_alone(spark):
    points = spark.range(200).select(F.col("id").alias("point_id"), F.array(F.col("id").cast("double"), (F.col("id") * 3 % 7).cast("double")).alias("features"))
    folder = Scratch(spark, "finish").base
    state = chunked.start_chunks(points, 3, folder)
    chunked.finish_chunks(spark, state)
    assert chunked.load_state(spark, folder, 1).to_json() == state.to_json()


def random_summaries(count, dims, seed, spread=60.0):
    rng = np.random.default_rng(seed)
    n = rng.integers(2, 400, count)
    centres, deviations = rng.uniform(-spread, spread, (count, dims)), rng.uniform(0, 3, (count, dims))
    return [(i, int(k), (c * k).tolist(), ((s**2 + c**2) * k).tolist()) for i, (k, c, s) in enumerate(zip(n, centres, deviations))]


def summary_frame(spark, rows):
    return spark.createDataFrame(rows, summaries.SUMMARIES).repartition(3)


def brute_pairs(rows):
    made = [chunked.Summary(i, n, np.array(s), np.array(q)) for i, n, s, q in rows]
    return {(a.cluster_id, b.cluster_id) for a, b in itertools.combinations(made, 2) if chunked.may_merge(a, b)}


@pytest.mark.parametrize("dims,count", [(1, 60), (2, 80), (5, 60)])
def test_merge_pairs_are_all_that_pass(spark, dims, count):
    rows = random_summaries(count, dims, dims)
    # Sizes far apart: a small cluster may pass with a large one from far away.
    rows += [(1000 + i, 200_000 * (i + 1), [c * 200_000.0 * (i + 1)] * dims, [(c * c + 0.5) * 200_000.0 * (i + 1)] * dims) for i, c in enumerate((0.0, 45.0))]
    found = {(r.one, r.other) for r in summaries.merge_pairs(summary_frame(spark, rows)).collect()}
    assert found == brute_pairs(rows) and found


def test_merging_by_jobs_equals_merging_in_memory(spark):
    rows = random_summaries(120, 2, 7)
    frame = summary_frame(spark, rows)
    answers = []
    for local in (0, 40, 1000):
        merged, moves = summaries.merge_summaries(frame, local)
        answers.append((sorted((r.cluster_id, r.n, [round(v, 6) for v in r["sum"]]) for r in merged.collect()), sorted(map(tuple, moves.collect()))))
    assert answers[0] == answers[1] == answers[2]
    kept, gone = answers[0]
    assert sum(k[1] for k in kept) == sum(r[1] for r in rows) and len(kept) + len(gone) == 120 and gone
    assert {into for _, into in gone} <= {k[0] for k in kept}
    merged, _ = summaries.merge_summaries(frame)
    assert summaries.merge_pairs(merged).isEmpty()


def test_merging_nothing(spark):
    for rows in ([], random_summaries(1, 3, 1)):
        merged, moves = summaries.merge_summaries(spark.createDataFrame(rows, summaries.SUMMARIES), 0)
        assert merged.count() == len(rows) and moves.count() == 0


def test_placing_by_grid_equals_placing_by_broadcast(spark):
    rng = np.random.default_rng(5)
    rows = random_summaries(90, 3, 11)
    rows[4] = (4, 10, [10.0, 0.0, 0.0], [10.0, 0.0, 0.0])  # no spread
    points = points_of(spark, [(i, p.tolist()) for i, p in enumerate(rng.uniform(-70, 70, (400, 3)))])
    ds = [chunked.Summary(500, 100, np.array([100.0, 0.0, 0.0]), np.array([2500.0, 2500.0, 2500.0]))]
    cs = summary_frame(spark, rows)
    some, many = (
        sorted((r.point_id, r.set_kind, r.cluster_id, r.distance and round(r.distance, 9)) for r in chunked.place_points(points, ds, cs, 90, most).collect())
        for most in (90, 10)
    )
    assert some == many and {k for _, k, _, _ in some} == {"DS", "CS", "RS"}


def test_merging_into_ds_takes_the_nearest_that_passes(spark):
    ds = [chunked.Summary(i, 10, np.array([c * 10.0]), np.array([c * c * 10.0])) for i, c in enumerate((0.0, 8.0))]
    rows = [(10, 10, [30.0], [90.0]), (11, 10, [60.0], [360.0]), (12, 10, [1000.0], [100_000.0])]
    assert {r.cluster_id: r.into for r in chunked.merged_into(summary_frame(spark, rows), ds).collect()} == {10: 0, 11: 1, 12: None}


def test_chains_of_moves_lead_to_their_end(spark):
    rows = [(i, i - 1) for i in range(1, 40)] + [(100, 50)]
    found = summaries.resolve(Scratch(spark, "test-chains"), spark.createDataFrame(rows, summaries.MOVES))
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(1, 40)] + [(100, 50)]


@pytest.mark.parametrize("carry", [1, 3, 100])
def test_carried_distances_give_the_same_seeds(spark, carry):
    rng = np.random.default_rng(3)
    rows = rng.integers(-50, 50, (80, 3)).tolist()  # whole numbers: ties of distances are met
    df = points_of(spark, list(enumerate(rows)))
    matrix, seeds = np.array(rows, float), [0]
    while len(seeds) < 12:
        near = np.min([np.linalg.norm(matrix - matrix[s], axis=1) for s in seeds], axis=0)
        seeds.append(int(np.flatnonzero(near >= near.max() - 1e-12)[0]))
    found = clustering.farthest_first(df, 12, carry=carry)
    assert found == [matrix[s].tolist() for s in seeds]
