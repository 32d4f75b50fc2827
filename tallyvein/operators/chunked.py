"""Clustering of data that arrives in chunks, keeping only summaries of what was seen.

Three sets: discard (DS, settled clusters), compression (CS, small groups kept as summaries) and
retained (RS, single points). DS has as many clusters as the caller asked for and is part of the state
record. CS grows with the data: its summaries, the moves of its merges, the retained points and the
labels are tables per round. A state is written under its round number, so a round that is run again
overwrites its own output and nothing else.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvein.functions.ranking import positions
from tallyvein.functions.vectors import as_matrix, deviation_of, gate, mahalanobis, mean_of
from tallyvein.operators.clustering import cluster_summary, kmeans, label_moments
from tallyvein.operators.sampling import fixed_sample, sample_size
from tallyvein.operators.summaries import MOVES, SUMMARIES, widest, added, merge_summaries, resolve
from tallyvein.session import Scratch
from tallyvein.sources.sinks import ROUND_COLUMNS

ASSIGNED = "set_kind string, cluster_id int"
#: At most so many CS summaries are sent to the tasks that place points.
PLACED = 4096


@dataclass
class Summary:
    cluster_id: int
    n: int
    sum: np.ndarray
    sumsq: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        return self.sum / self.n

    @property
    def deviation(self) -> np.ndarray:
        return np.sqrt(np.maximum(self.sumsq / self.n - self.centre**2, 0.0))

    def plus(self, other: "Summary") -> "Summary":
        return Summary(self.cluster_id, self.n + other.n, self.sum + other.sum, self.sumsq + other.sumsq)


def may_merge(a: Summary, b: Summary) -> bool:
    """Every dimension of the merged cluster deviates by less than 3 * sqrt(d)."""
    return bool((a.plus(b).deviation < gate(len(a.sum))).all())


@dataclass
class ChunkState:
    """All that a round needs of the rounds before it."""

    folder: str
    k: int
    round: int = 0
    next_id: int = 0
    ds: list[Summary] = field(default_factory=list)
    cs_clusters: int = 0
    cs_points: int = 0
    retained: int = 0
    stats: list[list[int]] = field(default_factory=list)

    finished: bool = False

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}/{'finished' if self.finished else 'round'}={self.round}"

    def to_json(self) -> str:
        ds = [[s.cluster_id, s.n, s.sum.tolist(), s.sumsq.tolist()] for s in self.ds]
        return json.dumps({**self.__dict__, "ds": ds})

    @classmethod
    def from_json(cls, text: str) -> "ChunkState":
        body = json.loads(text)
        body["ds"] = [Summary(c, n, np.array(s), np.array(q)) for c, n, s, q in body["ds"]]
        return cls(**body)


def save_state(spark: SparkSession, state: ChunkState, name: str = "state") -> None:
    spark.createDataFrame([(state.to_json(),)], "value string").write.mode("overwrite").text(state.table(name))


def load_state(spark: SparkSession, folder: str, round_no: int) -> ChunkState:
    return ChunkState.from_json(spark.read.text(f"{folder}/state/round={round_no}").first()["value"])


def summaries_of(assigned: DataFrame) -> dict[int, Summary]:
    """Summaries per cluster of labelled points, for few clusters: clusters * dimensions rows come back."""
    found: dict[int, Summary] = {}
    rows = label_moments(assigned).collect()
    dims = 1 + max((r["dim"] for r in rows), default=-1)
    for row in rows:
        s = found.setdefault(row["cluster_id"], Summary(row["cluster_id"], row["n"], np.zeros(dims), np.zeros(dims)))
        s.sum[row["dim"]], s.sumsq[row["dim"]] = row["sum"], row["sumsq"]
    return dict(sorted(found.items()))


def merge_candidates(summaries: list[Summary]) -> list[tuple[int, int, int, float, bool]]:
    """(one, other, n, largest deviation, passes) for the union of every two summaries.

    Works on cluster summaries only: their number is set by k, not by the data.
    """
    found = []
    for i, one in enumerate(summaries):
        for other in summaries[i + 1 :]:
            union = one.plus(other)
            found.append((one.cluster_id, other.cluster_id, union.n, float(union.deviation.max()), may_merge(one, other)))
    return found


def with_set(points: DataFrame, ds: list[Summary], cs: list[Summary]) -> DataFrame:
    """Add set_kind, cluster_id and distance: the nearest DS cluster inside the gate, else the nearest
    such CS cluster, else RS. The summaries stay as they are while a chunk is placed, so the result
    does not depend on the order of the points.
    """
    sets = [(kind, s) for kind, group in (("DS", ds), ("CS", cs)) for s in group]
    centres = np.array([s.centre for _, s in sets])
    spreads = np.array([s.deviation for _, s in sets])
    scales = np.where(spreads == 0, 1.0, spreads)
    ids = np.array([s.cluster_id for _, s in sets], dtype=np.int32)
    n_ds = len(ds)

    @F.arrow_udf("struct<set_kind:string,cluster_id:int,distance:double>")
    def place(features: pa.Array) -> pa.Array:
        points_ = as_matrix(features)
        rows = np.arange(len(points_))
        distances = np.empty((len(points_), len(sets)))
        for j in range(len(sets)):
            distances[:, j] = np.sqrt((((points_ - centres[j]) / scales[j]) ** 2).sum(axis=1))
        limit = gate(points_.shape[1])
        kinds = np.full(len(points_), "RS", dtype=object)
        best = np.full(len(points_), -1)
        # CS first, then DS over it: a DS match always wins.
        for kind, start, stop in (("CS", n_ds, len(sets)), ("DS", 0, n_ds)):
            if stop > start:
                near = start + distances[:, start:stop].argmin(axis=1)
                inside = distances[rows, near] < limit
                kinds[inside], best[inside] = kind, near[inside]
        none = best < 0
        cluster = pa.array(ids[best], mask=none) if len(ids) else pa.nulls(len(rows), pa.int32())
        distance = pa.array(distances[rows, best], mask=none) if len(ids) else pa.nulls(len(rows), pa.float64())
        return pa.StructArray.from_arrays([pa.array(kinds, pa.string()), cluster, distance], ["set_kind", "cluster_id", "distance"])

    placed = points.withColumn("_set", place("features"))
    return placed.select(*points.columns, "_set.set_kind", "_set.cluster_id", "_set.distance")


def place_points(points: DataFrame, ds: list[Summary], cs: DataFrame, cs_clusters: int, most: int = PLACED) -> DataFrame:
    """``with_set`` for a table of CS clusters: up to ``most`` of them travel to the points, more are met in a grid."""
    if cs_clusters <= most:
        return with_set(points, ds, [_summary(r) for r in cs.orderBy("cluster_id").collect()])
    return _placed_by_grid(points, ds, cs)


def _summary(row) -> Summary:
    return Summary(row["cluster_id"], row["n"], np.array(row["sum"]), np.array(row["sumsq"]))


def _placed_by_grid(points: DataFrame, ds: list[Summary], cs: DataFrame) -> DataFrame:
    """A point inside a CS cluster's gate lies within gate * deviation of its centre in every dimension: a box.

    In the two dimensions with the most spread, each cluster stands in the cells that its box touches (a
    hundred at most, as a cell is at least an eighth of the widest box) and each point in one cell.
    """
    scratch = Scratch(points.sparkSession, "placing")
    d, dims = widest(cs)
    limit = gate(d)
    spread = deviation_of(F.col("n"), F.col("sum"), F.col("sumsq"))
    boxes = cs.select("cluster_id", mean_of(F.col("n"), F.col("sum")).alias("centre"), spread.alias("deviation"))

    def half(i: int) -> Column:
        s = F.element_at("deviation", dims[i] + 1)
        return F.when(s == 0, F.lit(1.0)).otherwise(s) * limit

    sizes = boxes.agg(*[F.greatest(2 * F.avg(half(i)), F.max(half(i)) / 4).alias(f"w{i}") for i in range(2)]).first()
    widths = [sizes["w0"], sizes["w1"]]

    def cell(x: Column, i: int) -> Column:
        return F.floor(x / F.lit(widths[i]))

    for i in range(2):
        x = F.element_at("centre", dims[i] + 1)
        boxes = boxes.withColumn(f"cell{i}", F.explode(F.sequence(cell(x - half(i), i), cell(x + half(i), i))))
    placed = with_set(points, ds, []).withColumn("_row", F.monotonically_increasing_id())
    placed = scratch.write(placed, "placed")
    asked = placed.where(F.col("set_kind") == "RS").select(
        "_row", "features", *[cell(F.element_at("features", dims[i] + 1), i).alias(f"cell{i}") for i in range(2)]
    )
    distance = mahalanobis(F.col("features"), F.col("centre"), F.col("deviation"))
    met = asked.join(boxes, ["cell0", "cell1"]).select("_row", F.col("cluster_id").alias("cs_id"), distance.alias("cs_distance")).where(F.col("cs_distance") < limit)
    best = scratch.write(met.groupBy("_row").agg(F.min(F.struct("cs_distance", "cs_id")).alias("best")), "best")
    joined = placed.join(best, "_row", "left")
    found = F.col("best").isNotNull()
    return joined.select(
        *points.columns, F.when(found, "CS").otherwise(F.col("set_kind")).alias("set_kind"),
        F.coalesce("best.cs_id", "cluster_id").alias("cluster_id"), F.coalesce("best.cs_distance", "distance").alias("distance"),
    )


def _cluster_into(points: DataFrame, k: int, state: ChunkState, path: str, max_iter: int) -> tuple[DataFrame, dict]:
    """k-means of a table, written with ids not used before; returns the table and its summaries."""
    found = kmeans(points, k, max_iter=max_iter, tol=1e-5)
    offset = state.next_id
    state.next_id += k
    labelled = found.labels.select("point_id", "features", (F.col("cluster_id") + offset).alias("cluster_id"))
    labelled.write.mode("overwrite").parquet(path)
    spark = points.sparkSession
    table = spark.read.schema(labelled.schema).parquet(path)
    return table, summaries_of(table)


def _keep_labels(labelled: DataFrame, state: ChunkState, name: str) -> None:
    labelled.select("point_id", "cluster_id").write.mode("overwrite").parquet(f"{state.folder}/labels/round={state.round}/part={name}")


def _keep_cs(cs: DataFrame, state: ChunkState) -> DataFrame:
    """Write the CS summaries of a round and count them."""
    cs.select("cluster_id", "n", "sum", "sumsq").write.mode("overwrite").parquet(state.table("cs"))
    kept = read_cs(cs.sparkSession, state)
    row = kept.agg(F.count("*").alias("clusters"), F.coalesce(F.sum("n"), F.lit(0)).alias("points")).first()
    state.cs_clusters, state.cs_points = row["clusters"], row["points"]
    return kept


def read_cs(spark: SparkSession, state: ChunkState) -> DataFrame:
    return spark.read.schema(SUMMARIES).parquet(state.table("cs"))


def _as_table(spark: SparkSession, summaries: list[Summary]) -> DataFrame:
    """Summaries of one k-means run: 3k at most."""
    return spark.createDataFrame([(s.cluster_id, s.n, s.sum.tolist(), s.sumsq.tolist()) for s in summaries], SUMMARIES)


def _keep_moves(moves: DataFrame, state: ChunkState, name: str = "moves") -> None:
    moves.select("cluster_id", "into").write.mode("overwrite").parquet(f"{state.folder}/moves/round={state.round}/part={name}")


def _split_singles(table: DataFrame, found: dict[int, Summary]) -> tuple[list[Summary], DataFrame, DataFrame]:
    """Clusters of more than one point, their points, and the points that are alone."""
    alone = [c for c, s in found.items() if s.n == 1]
    groups = [s for s in found.values() if s.n > 1]
    single = F.col("cluster_id").isin(alone) if alone else F.lit(False)
    return groups, table.where(~single), table.where(single)


def _keep_retained(retained: DataFrame, state: ChunkState) -> None:
    path = state.table("retained")
    retained.select("point_id", "features").write.mode("overwrite").parquet(path)
    state.retained = retained.sparkSession.read.parquet(path).count()


def _end_round(spark: SparkSession, state: ChunkState, name: str = "state") -> ChunkState:
    state.stats.append(
        [state.round, len(state.ds), sum(s.n for s in state.ds), state.cs_clusters, state.cs_points, state.retained]
    )
    save_state(spark, state, name)
    return state


def start_chunks(chunk: DataFrame, k: int, folder: str, seed: int = 28, max_iter: int = 50, sample: int = 40) -> ChunkState:
    """Round 1: k clusters of a small sample become DS, 3k clusters of the rest become CS and RS.

    The sample has at most ``sample`` points and a fifth of the chunk, but k at least; a first chunk
    with fewer than k points is an error.
    """
    spark = chunk.sparkSession
    state = ChunkState(folder=folder, k=k, round=1)
    chunk = chunk.select("point_id", "features")
    sample_path, rest_path = state.table("sample"), state.table("rest")
    rows = chunk.count()
    if rows < k:
        raise ValueError(f"the first chunk has {rows} points for {k} clusters")
    fixed_sample(chunk, "point_id", max(k, sample_size(rows, sample)), seed).write.mode("overwrite").parquet(sample_path)
    sample = spark.read.schema(chunk.schema).parquet(sample_path)
    # The sample has at most max(k, sample) rows, so its ids are broadcast.
    rest = chunk.join(F.broadcast(sample.select("point_id")), "point_id", "left_anti")

    labelled, found = _cluster_into(sample, k, state, state.table("sample-labels"), max_iter)
    state.ds = list(found.values())
    _keep_labels(labelled, state, "ds")

    labelled, found = _cluster_into(rest, 3 * k, state, rest_path, max_iter)
    groups, grouped, single = _split_singles(labelled, found)
    _keep_cs(_as_table(spark, groups), state)
    _keep_labels(grouped, state, "cs")
    _keep_retained(single, state)
    return _end_round(spark, state)


def absorb_chunk(chunk: DataFrame, before: ChunkState, max_iter: int = 50) -> ChunkState:
    """One further round: place the points, cluster RS if it grew too large, merge CS clusters."""
    spark = chunk.sparkSession
    state = replace(before, round=before.round + 1, ds=list(before.ds), stats=[list(s) for s in before.stats])
    cs = read_cs(spark, before)
    placed = place_points(chunk.select("point_id", "features"), state.ds, cs, before.cs_clusters)
    path = state.table("placed")
    placed.write.mode("overwrite").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    settled = placed.where(F.col("set_kind") != "RS")
    _keep_labels(settled, state, "placed")
    gained = summaries_of(settled.where(F.col("set_kind") == "DS"))
    state.ds = [s.plus(gained[s.cluster_id]) if s.cluster_id in gained else s for s in state.ds]
    cs = cs.unionByName(cluster_summary(settled.where(F.col("set_kind") == "CS")))

    old = spark.read.schema(chunk.select("point_id", "features").schema).parquet(before.table("retained"))
    _keep_retained(old.unionByName(placed.where(F.col("set_kind") == "RS").select("point_id", "features")), state)
    if state.retained > 3 * len(state.ds):
        retained = spark.read.schema(old.schema).parquet(state.table("retained"))
        labelled, found = _cluster_into(retained, 3 * len(state.ds), state, state.table("regrouped"), max_iter)
        groups, grouped, single = _split_singles(labelled, found)
        cs = cs.unionByName(_as_table(spark, groups))
        _keep_labels(grouped, state, "regrouped")
        # `single` reads the regrouped table, so the retained table may be replaced.
        _keep_retained(single, state)

    merged, moves = merge_summaries(added(cs))
    _keep_cs(merged, state)
    _keep_moves(moves, state)
    return _end_round(spark, state)


def finish_chunks(spark: SparkSession, before: ChunkState) -> ChunkState:
    """After the last chunk: merge CS into DS and count the last round anew.

    The result is written beside the rounds, whose state stays as it was: more chunks can follow.
    """
    state = replace(before, ds=list(before.ds), finished=True, stats=[list(s) for s in before.stats[:-1]])
    placed = merged_into(read_cs(spark, before), state.ds)
    scratch = Scratch(spark, "finish")
    placed = scratch.write(placed, "placed")
    gone = placed.where(F.col("into").isNotNull())
    gained = {r["cluster_id"]: _summary(r) for r in added(gone.withColumn("cluster_id", F.col("into"))).collect()}  # one per DS cluster
    state.ds = [s.plus(gained[s.cluster_id]) if s.cluster_id in gained else s for s in state.ds]
    _keep_cs(placed.where(F.col("into").isNull()), state)
    gone.select("cluster_id", "into").write.mode("overwrite").parquet(state.table("moves"))
    return _end_round(spark, state, "finished")


def merged_into(cs: DataFrame, ds: list[Summary]) -> DataFrame:
    """CS summaries with ``into``: the DS cluster with the nearest centre of those whose union passes the gate, else null.

    The DS clusters are taken as they are before any of these merges, as a chunk's points are placed
    against the summaries before them, so no order of the CS clusters matters.
    """
    sums, squares, n = (np.array([getattr(s, c) for s in ds], dtype=np.float64) for c in ("sum", "sumsq", "n"))
    ids = [s.cluster_id for s in ds]

    @F.arrow_udf("int")
    def into(n_col: pa.Array, sum_col: pa.Array, sumsq_col: pa.Array) -> pa.Array:
        counts, own, own_squares = n_col.to_numpy(), as_matrix(sum_col), as_matrix(sumsq_col)
        out = []
        for k, s, q in zip(counts, own, own_squares):
            total = (n + k)[:, None]
            deviation = np.sqrt(np.maximum((squares + q) / total - ((sums + s) / total) ** 2, 0.0))
            fits = np.flatnonzero((deviation < gate(len(s))).all(axis=1))
            distance = np.sqrt(((sums / n[:, None] - s / k) ** 2).sum(axis=1))
            out.append(ids[min(fits, key=lambda j: (distance[j], j))] if len(fits) else None)
        return pa.array(out, pa.int32())

    return cs.withColumn("into", into("n", "sum", "sumsq"))


def chunk_stats(spark: SparkSession, state: ChunkState) -> DataFrame:
    """One row per round: clusters and points of DS and CS, and points of RS."""
    return spark.createDataFrame(state.stats, ", ".join(f"{c} bigint" for c in ROUND_COLUMNS))


def chunk_labels(spark: SparkSession, state: ChunkState, id_type: str = "bigint") -> DataFrame:
    """(point_id, set_kind, cluster_id): DS clusters from 0, then CS clusters in order of their ids, then one number per RS point."""
    scratch = Scratch(spark, "labels")
    parts = [f"{state.folder}/moves/round={r}" for r in range(2, state.round + 1)]
    moves = spark.createDataFrame([], MOVES)
    if parts:
        moves = spark.read.schema(MOVES).option("recursiveFileLookup", True).parquet(*parts)
    if state.finished:
        moves = moves.unionByName(spark.read.schema(MOVES).parquet(state.table("moves")))
    homes = resolve(scratch, moves)
    settled = spark.createDataFrame([(s.cluster_id, i) for i, s in enumerate(state.ds)], "cluster_id int, label bigint")
    small = positions(read_cs(spark, state).select("cluster_id"), [F.col("cluster_id")], name="label")
    names = scratch.write(
        settled.withColumn("set_kind", F.lit("DS")).unionByName(
            small.select("cluster_id", (F.col("label") - 1 + len(state.ds)).alias("label"), F.lit("CS").alias("set_kind"))
        ),
        "names",
    )
    # Every cluster that was ever made, under the name of the one it ended in.
    ended = homes.join(names.withColumnRenamed("cluster_id", "into"), "into").select("cluster_id", "label", "set_kind").unionByName(names.select("cluster_id", "label", "set_kind"))
    ended = scratch.write(ended, "ended")
    rounds = [f"{state.folder}/labels/round={r}" for r in range(1, state.round + 1)]
    kept = spark.read.schema(f"point_id {id_type}, cluster_id int").option("recursiveFileLookup", True).parquet(*rounds)
    numbered = len(state.ds) + state.cs_clusters
    settled = kept.join(ended, "cluster_id").select("point_id", "set_kind", F.col("label").alias("cluster_id"))
    retained = spark.read.parquet(f"{state.folder}/retained/round={state.round}").select("point_id")
    alone = positions(retained, [F.col("point_id")], name="at").select(
        "point_id", F.lit("RS").alias("set_kind"), (F.col("at") - 1 + numbered).alias("cluster_id")
    )
    return settled.unionByName(alone)


def cluster_chunks(points: DataFrame, k: int, folder: str, seed: int = 28, max_iter: int = 50, sample: int = 40) -> ChunkState:
    """All rounds over (point_id, features, chunk), in chunk order.

    The points are written once, apart by chunk, so that every round reads its own chunk only.
    """
    kinds = points.select("chunk", "point_id", "features").schema
    points.select("chunk", "point_id", "features").write.mode("overwrite").partitionBy("chunk").parquet(f"{folder}/points")
    points = points.sparkSession.read.schema(kinds).parquet(f"{folder}/points")
    chunks = [r["chunk"] for r in points.select("chunk").distinct().orderBy("chunk").collect()]  # one row per file
    state = start_chunks(points.where(F.col("chunk") == F.lit(chunks[0])), k, folder, seed, max_iter, sample)
    for chunk in chunks[1:]:
        state = absorb_chunk(points.where(F.col("chunk") == F.lit(chunk)), state, max_iter)
    return finish_chunks(points.sparkSession, state)
