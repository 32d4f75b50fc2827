"""Distances, seeds, k-means, summaries and chunk-by-chunk clustering over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyvein.functions import vectors
from tallyvein.operators import chunked, clustering, summaries
from tallyvein.plans.inputs import event_points, r6
from tallyvein.plans.registry import query
from tallyvein.session import Scratch
from tallyvein.sources.readers import table
from tallyvein.streaming.rounds import start_cluster_stream
from tallyvein.streaming.sources import table_stream

SEEDS = 5
#: Rounds that the SQL spells out; the points settle before.
ROUNDS = 30
DIMS = 64
#: Files of a slice of the stream.
FILES = 4

_P = "p AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f, label FROM embeddings)"


def _seed_ctes(k: int) -> str:
    ctes = [_P, "c0 AS MATERIALIZED (SELECT f FROM p ORDER BY id LIMIT 1)"]
    for j in range(1, k):
        nearest = "least(" + ", ".join(f"list_distance(f, (SELECT f FROM c{i}))" for i in range(j)) + ")"
        ctes.append(f"c{j} AS MATERIALIZED (SELECT f FROM p ORDER BY {nearest} DESC, id LIMIT 1)")
    ctes.append("k0 AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {j} AS c, f FROM c{j}" for j in range(k)) + ")")
    return ",\n".join(ctes)


def _assigned(centres: str) -> str:
    return f"""SELECT id, any_value(p.f) AS f, CAST(arg_min(c, list_distance(p.f, k.f)) AS INTEGER) AS cluster_id,
        min(list_distance(p.f, k.f)) AS distance FROM p, {centres} AS k GROUP BY id"""


def _round_ctes(rounds: int) -> str:
    ctes = []
    for r in range(1, rounds + 1):
        ctes.append(f"a{r} AS MATERIALIZED ({_assigned(f'k{r - 1}')})")
        ctes.append(f"""k{r} AS MATERIALIZED (SELECT k.c, coalesce(m.f, k.f) AS f FROM k{r - 1} AS k LEFT JOIN
            (SELECT cluster_id, list(x ORDER BY d) AS f FROM (SELECT cluster_id, d, avg(f[d + 1]) AS x FROM a{r}, range(0, {DIMS}) AS t(d)
            GROUP BY ALL) GROUP BY cluster_id) AS m ON m.cluster_id = k.c)""")
    return ",\n".join(ctes)


def _points(spark, folder):
    return clustering.as_points(table(spark, folder, "embeddings"), "vec_id", "embedding")


def _by_label(spark, folder):
    """Points that carry the label of the table as their cluster."""
    rows = table(spark, folder, "embeddings")
    return rows.select(
        F.col("vec_id").alias("point_id"), F.col("embedding").cast("array<double>").alias("features"), F.col("label").alias("cluster_id")
    )


def _centre_rows(spark, centres, name="cluster_id"):
    rows = [(c, d, float(x)) for c, centre in enumerate(centres) for d, x in enumerate(centre)]
    return spark.createDataFrame(rows, f"{name} int, dim int, x double").withColumn("x", r6(F.col("x")))


_MOMENTS = f"""SELECT label AS cluster_id, CAST(d AS INTEGER) AS dim, count(*) AS n, round(sum(f[d + 1]), 6) AS sum,
    round(sum(f[d + 1] * f[d + 1]), 6) AS sumsq FROM p, range(0, {DIMS}) AS t(d) GROUP BY ALL"""


@query("AGG9 CL3", f"WITH {_P} {_MOMENTS}")
def cluster_summary(spark, folder):
    summary = clustering.cluster_summary(_by_label(spark, folder))
    rows = summary.select("cluster_id", "n", F.posexplode(F.arrays_zip("sum", "sumsq")).alias("dim", "m"))
    return rows.select("cluster_id", "dim", "n", r6(F.col("m.sum")).alias("sum"), r6(F.col("m.sumsq")).alias("sumsq"))


@query("AGG8", f"""WITH {_P} SELECT label AS cluster_id, CAST(d AS INTEGER) AS dim, round(avg(f[d + 1]), 6) AS mean
    FROM p, range(0, {DIMS}) AS t(d) GROUP BY ALL""")
def centroids(spark, folder):
    return clustering.centroids(_by_label(spark, folder)).withColumn("mean", r6(F.col("mean")))


@query("M4", f"""WITH {_P} SELECT label AS cluster_id, CAST(d AS INTEGER) AS dim,
    round(greatest(sum(f[d + 1] * f[d + 1]) / count(*) - pow(sum(f[d + 1]) / count(*), 2), 0), 6) AS variance
    FROM p, range(0, {DIMS}) AS t(d) GROUP BY ALL""")
def moment_variance(spark, folder):
    summary = clustering.cluster_summary(_by_label(spark, folder))
    deviation = vectors.deviation_of(F.col("n"), F.col("sum"), F.col("sumsq"))
    rows = summary.select("cluster_id", F.posexplode(deviation).alias("dim", "s"))
    return rows.select("cluster_id", "dim", r6(F.col("s") * F.col("s")).alias("variance"))


def _label_centres(spark, folder):
    found = chunked.summaries_of(_by_label(spark, folder))
    return [s.centre for s in found.values()]


@query("J8 RNK7", f"""WITH {_P}, k AS MATERIALIZED (SELECT label AS c, list(x ORDER BY d) AS f FROM
    (SELECT label, d, avg(f[d + 1]) AS x FROM p, range(0, {DIMS}) AS t(d) GROUP BY ALL) GROUP BY label)
    SELECT id AS point_id, cluster_id, round(distance, 6) AS distance FROM ({_assigned('k')})""")
def nearest_centroid(spark, folder):
    near = clustering.with_nearest(_points(spark, folder), _label_centres(spark, folder))
    return near.select("point_id", "cluster_id", r6(F.col("distance")).alias("distance"))


@query("M2", f"WITH {_P} SELECT id AS point_id, round(list_distance(f, (SELECT f FROM p ORDER BY id LIMIT 1)), 6) AS distance FROM p")
def euclidean_distance(spark, folder):
    points = _points(spark, folder)
    start = clustering.farthest_first(points, 1)[0]
    distance = vectors.euclidean(F.col("features"), vectors.array_of(start))
    return points.select("point_id", r6(distance).alias("distance"))


@query("RNK8", f"""WITH {_P}, c AS (SELECT f FROM p ORDER BY id LIMIT 1), q AS (SELECT f FROM p ORDER BY list_distance(f, (SELECT f FROM c)) DESC, id LIMIT 1)
    SELECT 0 AS cluster_id, CAST(d AS INTEGER) AS dim, round(f[d + 1], 6) AS x FROM q, range(0, {DIMS}) AS t(d)""")
def farthest_point(spark, folder):
    points = _points(spark, folder)
    return _centre_rows(spark, [clustering.farthest_point(points, clustering.farthest_first(points, 1))])


@query("CL1", f"WITH {_seed_ctes(SEEDS)} SELECT c AS seed, CAST(d AS INTEGER) AS dim, round(f[d + 1], 6) AS x FROM k0, range(0, {DIMS}) AS t(d)")
def farthest_first(spark, folder):
    return _centre_rows(spark, clustering.farthest_first(_points(spark, folder), SEEDS), "seed")


@query("CL2 AGG8", f"""WITH {_seed_ctes(SEEDS)}, {_round_ctes(1)}
    SELECT c AS cluster_id, CAST(d AS INTEGER) AS dim, round(f[d + 1], 6) AS x FROM k1, range(0, {DIMS}) AS t(d)""")
def kmeans_step(spark, folder):
    points = _points(spark, folder)
    return _centre_rows(spark, clustering.kmeans_step(points, clustering.farthest_first(points, SEEDS)))


@query("M5", f"""WITH {_seed_ctes(SEEDS)}, {_round_ctes(1)}
    SELECT round(sqrt(sum(pow(list_distance(k0.f, k1.f), 2))), 6) AS shift FROM k0 JOIN k1 USING (c)""")
def centroid_shift(spark, folder):
    points = _points(spark, folder)
    seeds = clustering.farthest_first(points, SEEDS)
    shift = clustering.centre_shift(seeds, clustering.kmeans_step(points, seeds))
    return spark.createDataFrame([(shift,)], "shift double").withColumn("shift", r6(F.col("shift")))


@query("CL2 SNK4", f"""WITH {_seed_ctes(SEEDS)}, {_round_ctes(ROUNDS)}
    SELECT id AS point_id, cluster_id, round(distance, 6) AS distance FROM ({_assigned(f'k{ROUNDS}')})""")
def kmeans(spark, folder):
    found = clustering.kmeans(_points(spark, folder), SEEDS)
    return found.labels.select("point_id", "cluster_id", r6(F.col("distance")).alias("distance"))


@query("CL2")
def kmeans_parallel(spark, folder):
    return clustering.kmeans_parallel(_points(spark, folder), 10)


@query("AGG10 FLT6", f"""WITH {_P}, m AS MATERIALIZED (SELECT label, d, count(*) AS n, sum(f[d + 1]) AS s, sum(f[d + 1] * f[d + 1]) AS q
    FROM p, range(0, {DIMS}) AS t(d) GROUP BY ALL)
    SELECT a.label AS one, b.label AS other, max(a.n + b.n) AS n,
        round(max(sqrt(greatest((a.q + b.q) / (a.n + b.n) - pow((a.s + b.s) / (a.n + b.n), 2), 0))), 6) AS deviation,
        max(sqrt(greatest((a.q + b.q) / (a.n + b.n) - pow((a.s + b.s) / (a.n + b.n), 2), 0))) < 3 * sqrt({DIMS}) AS fits
    FROM m a JOIN m b ON a.d = b.d AND a.label < b.label GROUP BY ALL""")
def merge_gate(spark, folder):
    rows = chunked.merge_candidates(list(chunked.summaries_of(_by_label(spark, folder)).values()))
    out = spark.createDataFrame(rows, "one int, other int, n bigint, deviation double, fits boolean")
    return out.withColumn("deviation", r6(F.col("deviation")))


# Order lines as points of (quantity, discount, tax) in groups by quantity and return flag.
_FLAGS = ("A", "N", "R")
_LINE_MOMENTS = f"""l AS (SELECT CAST(l_quantity AS BIGINT) * 10 + CASE l_returnflag {" ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(_FLAGS))} END AS c,
        CAST(l_quantity AS DOUBLE) AS x0, round(CAST(l_discount AS DOUBLE) * 100) AS x1, round(CAST(l_tax AS DOUBLE) * 100) AS x2 FROM lineitem),
    m AS MATERIALIZED (SELECT c, count(*) AS n, {", ".join(f"sum(x{i}) AS s{i}, sum(x{i} * x{i}) AS q{i}" for i in range(3))} FROM l GROUP BY c)"""
_UNION = [f"sqrt(greatest((a.q{i} + b.q{i}) / (a.n + b.n) - pow((a.s{i} + b.s{i}) / (a.n + b.n), 2), 0))" for i in range(3)]


def _line_summaries(spark, folder):
    lines = table(spark, folder, "lineitem")
    flag = F.array_position(F.array(*[F.lit(c) for c in _FLAGS]), F.col("l_returnflag")) - 1
    features = [F.col("l_quantity").cast("double"), *[F.round(F.col(c).cast("double") * 100) for c in ("l_discount", "l_tax")]]
    points = lines.select((F.col("l_quantity").cast("int") * 10 + flag).cast("int").alias("cluster_id"), F.array(*features).alias("features"))
    return Scratch(spark, "line-summaries").write(clustering.cluster_summary(points), "summaries")


@query("FLT6 AGG10 CL7", f"""WITH {_LINE_MOMENTS}
    SELECT CAST(a.c AS INTEGER) AS one, CAST(b.c AS INTEGER) AS other, a.n + b.n AS n,
        round(sqrt({" + ".join(f"pow(a.s{i} / a.n - b.s{i} / b.n, 2)" for i in range(3))}), 6) AS distance,
        round(greatest({", ".join(_UNION)}), 6) AS deviation
    FROM m a JOIN m b ON a.c < b.c WHERE greatest({", ".join(_UNION)}) < 3 * sqrt(3)""")
def merge_pairs(spark, folder):
    """All groups of order lines that may be one cluster, found through the grid of their centres."""
    found = summaries.merge_pairs(_line_summaries(spark, folder))
    return found.select("one", "other", "n", r6(F.col("distance")).alias("distance"), r6(F.col("deviation")).alias("deviation"))


@query("CL7", f"""WITH {_LINE_MOMENTS} SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS points, true AS adds_up, CAST(0 AS BIGINT) AS pairs_left,
    true AS as_in_memory FROM m""")
def merged_summaries(spark, folder):
    """Groups merged by rounds of jobs: nothing lost, no pair left that passes, and the same clusters as by arrays in memory."""
    start = _line_summaries(spark, folder)
    kept, moves = summaries.merge_summaries(start, local=0)
    other, other_moves = summaries.merge_summaries(start)
    left = summaries.merge_pairs(kept).agg(F.count("*").alias("pairs_left"))
    differ = moves.exceptAll(other_moves).unionByName(other_moves.exceptAll(moves)).agg((F.count("*") == 0).alias("as_in_memory"))
    before = start.agg(F.count("*").alias("groups"), F.sum("n").alias("points"))
    after = kept.agg(F.count("*").alias("kept"), F.sum("n").alias("still"))
    went = moves.agg(F.count("*").alias("went"))
    joined = before.join(F.broadcast(after)).join(F.broadcast(went)).join(F.broadcast(left)).join(F.broadcast(differ))  # one row each
    adds_up = (F.col("points") == F.col("still")) & (F.col("groups") == F.col("kept") + F.col("went"))
    return joined.select("groups", "points", adds_up.alias("adds_up"), "pairs_left", "as_in_memory")


# Clusters of the event points: the types of the events, settled ones first.
_DS, _CS = ("click", "purchase", "view"), ("error", "signup")
_EVENT_POINTS = """e AS MATERIALIZED (SELECT event_id AS id, event_type, value AS x0,
    CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS x1, CAST(hour(ts) AS DOUBLE) AS x2 FROM events)"""
_KIND = f"CASE WHEN event_type IN {_DS} THEN 'DS' ELSE 'CS' END"
_NUMBER = "CASE event_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(_DS + _CS)) + " END"
_SPREAD = ", ".join(f"avg(x{i}) AS c{i}, sqrt(greatest(avg(x{i} * x{i}) - pow(avg(x{i}), 2), 0)) AS s{i}" for i in range(3))
_MAHALANOBIS = "sqrt(" + " + ".join(f"pow((x{i} - c{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END, 2)" for i in range(3)) + ")"


def _event_sets(spark, folder):
    points = event_points(spark, folder)
    number = F.array_position(F.array(*[F.lit(t) for t in _DS + _CS]), F.col("event_type")) - 1
    found = chunked.summaries_of(points.withColumn("cluster_id", number.cast("int")))
    return points, [found[i] for i in range(3)], [found[i] for i in (3, 4)]


@query("CL5 FLT5", f"""WITH {_EVENT_POINTS}, m AS (SELECT {_KIND} AS kind, {_NUMBER} AS c, {_SPREAD} FROM e GROUP BY ALL),
    d AS (SELECT id, kind, c, {_MAHALANOBIS} AS d FROM e, m), g AS (SELECT * FROM d WHERE d < 3 * sqrt(3)),
    b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY kind DESC, d, c) AS r FROM g)
    SELECT e.id AS point_id, coalesce(kind, 'RS') AS set_kind, CAST(c AS INTEGER) AS cluster_id, round(d, 6) AS distance
    FROM e LEFT JOIN b ON b.id = e.id AND r = 1""")
def bfr_assign(spark, folder):
    points, ds, cs = _event_sets(spark, folder)
    placed = chunked.with_set(points.select("point_id", "features"), ds, cs)
    return placed.select("point_id", "set_kind", "cluster_id", r6(F.col("distance")).alias("distance"))


@query("M3 FLT5", f"""WITH {_EVENT_POINTS}, m AS (SELECT event_type, {_SPREAD} FROM e GROUP BY ALL)
    SELECT id AS point_id, round({_MAHALANOBIS}, 6) AS distance, {_MAHALANOBIS} < 3 * sqrt(3) AS inside FROM e JOIN m USING (event_type)""")
def mahalanobis_distance(spark, folder):
    """Every event against the summary of its own type, as expressions."""
    points, ds, cs = _event_sets(spark, folder)
    rows = [(t, s.centre.tolist(), s.deviation.tolist()) for t, s in zip(_DS + _CS, ds + cs)]
    types = spark.createDataFrame(rows, "event_type string, centre array<double>, deviation array<double>")
    # One row per cluster: as many as there are event types.
    near = points.join(F.broadcast(types), "event_type")
    distance = vectors.mahalanobis(F.col("features"), F.col("centre"), F.col("deviation"))
    return near.select("point_id", r6(distance).alias("distance"), (distance < vectors.gate(3)).alias("inside"))


def _chunked_events(spark, folder):
    points = event_points(spark, folder).withColumnRenamed("event_type", "chunk")
    return chunked.cluster_chunks(points, 5, Scratch(spark, "chunks").base)


@query("CL4 CL5 CL6 CL7 AGG16 SNK5")
def bfr_rounds(spark, folder):
    return chunked.chunk_stats(spark, _chunked_events(spark, folder))


@query("CL4 CL5 CL6 CL7 CL8 SNK4")
def bfr_labels(spark, folder):
    return chunked.chunk_labels(spark, _chunked_events(spark, folder))


@query("STR6")
def stream_rounds(spark, folder):
    scratch = Scratch(spark, "cluster-stream")
    points = _points(spark, folder)
    # The points arrive in three slices by a hash of their id, one micro-batch each.
    for i in range(3):
        part = points.where(F.pmod(F.xxhash64("point_id"), F.lit(3)) == i)
        part.repartition(FILES).write.parquet(scratch.path(f"in/part={i}"))
    stream = table_stream(spark, scratch.path("in"), points.schema, FILES)
    query = start_cluster_stream(
        stream, scratch.path("out"), scratch.path("checkpoint"), 4, trigger={"availableNow": True}
    )
    query.awaitTermination()
    state = chunked.finish_chunks(spark, chunked.load_state(spark, scratch.path("out"), 3))
    return chunked.chunk_stats(spark, state)
