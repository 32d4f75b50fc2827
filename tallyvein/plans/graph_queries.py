"""Graphs and communities over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyvein.functions.ranking import at_maximum, positions
from tallyvein.operators import communities, graphs, minhash, overlap
from tallyvein.plans.inputs import customer_months, customer_nations, customer_parts, r6
from tallyvein.plans.registry import CUSTOMER_MONTHS, CUSTOMER_NATIONS, CUSTOMER_PARTS, query
from tallyvein.session import Scratch
from tallyvein.sources import sinks
from tallyvein.sources.readers import table

COMMON = 5  # parts two customers must share
SIMILAR = 0.5
LEVELS = 8  # breadth-first levels spelled out in SQL; the graphs checked with it are less deep
PROPAGATION = 5

_CO = f"""(SELECT a.u AS src, b.u AS dst, count(*) AS cnt FROM {CUSTOMER_PARTS} a JOIN {CUSTOMER_PARTS} b ON a.i = b.i AND a.u < b.u
    GROUP BY ALL HAVING count(*) >= {{common}})"""
CO_SQL = _CO.format(common=COMMON)
_SIM = f"""(WITH d AS {CUSTOMER_MONTHS}, s AS (SELECT u, count(*) AS n FROM d GROUP BY 1),
    p AS (SELECT a.u AS src, b.u AS dst, count(*) AS k FROM d a JOIN d b ON a.i = b.i AND a.u < b.u GROUP BY ALL)
    SELECT src, dst, k / (s.n + t.n - k) AS jaccard FROM p JOIN s ON s.u = src JOIN s t ON t.u = dst WHERE k / (s.n + t.n - k) >= {SIMILAR})"""


def _edges(sql: str) -> str:
    return f"""e AS MATERIALIZED (SELECT src, dst FROM {sql}),
    b AS MATERIALIZED (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e)"""


def cooccurring(spark, folder):
    """The co-occurrence graph, written once for the loops that read it."""
    edges = graphs.cooccurrence_graph(customer_parts(spark, folder), "o_custkey", "l_partkey", COMMON)
    return Scratch(spark, "graph").write(edges.select("src", "dst"), "edges")


def similar(spark, folder):
    edges = graphs.similarity_graph(customer_months(spark, folder), "o_custkey", "order_month", SIMILAR)
    return Scratch(spark, "graph").write(edges.select("src", "dst"), "edges")


_BIPARTITE = f"(SELECT 's:' || i AS src, 'u:' || u AS dst FROM {CUSTOMER_NATIONS})"


@query("J1 PRJ4 AR2", _CO.format(common=2))
def cooccurrence_pairs(spark, folder):
    return graphs.cooccurrence_graph(customer_parts(spark, folder), "o_custkey", "l_partkey", 2)


_SUPPLIER_ORDERS = "(SELECT DISTINCT l_suppkey AS u, l_orderkey AS i FROM lineitem)"
#: Orders two suppliers must share: suppliers have hundreds of orders each, so most are large users.
SHARED_ORDERS = 35


@query("J1 SET1 AR2", f"""WITH d AS MATERIALIZED {_SUPPLIER_ORDERS}, s AS (SELECT u, count(*) AS n FROM d GROUP BY 1),
    p AS (SELECT a.u AS src, b.u AS dst, count(*) AS overlap FROM d a JOIN d b ON a.i = b.i AND a.u < b.u GROUP BY ALL HAVING count(*) >= {SHARED_ORDERS})
    SELECT src, dst, overlap, s.n AS src_size, t.n AS dst_size FROM p JOIN s ON s.u = src JOIN s t ON t.u = dst""")
def supplier_pairs(spark, folder):
    """Pairs of large sets, counted bit by bit in groups; only pairs that pass leave a task."""
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey")
    return overlap.shared_pairs(lines, "l_suppkey", "l_orderkey", overlap.Rule(overlap=SHARED_ORDERS), expansion=0.0)


@query("GR1 J1 FLT2", CO_SQL)
def cooccurrence_graph(spark, folder):
    return graphs.cooccurrence_graph(customer_parts(spark, folder), "o_custkey", "l_partkey", COMMON)


@query("GR1 PRJ5", f"WITH {_edges(CO_SQL)} SELECT src AS id, count(*) AS degree FROM b GROUP BY src")
def vertex_degrees(spark, folder):
    both = graphs.mirror(cooccurring(spark, folder))
    return both.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))


@query("GR4 J2 FLT3 M6", f"SELECT src, dst, round(jaccard, 6) AS jaccard FROM {_SIM}")
def similarity_graph(spark, folder):
    edges = graphs.similarity_graph(customer_months(spark, folder), "o_custkey", "order_month", SIMILAR)
    return edges.withColumn("jaccard", r6(F.col("jaccard")))


@query("J2", f"SELECT count(*) AS pairs, CAST(0 AS BIGINT) AS wrong, true AS recall_reached FROM {_SIM}")
def similarity_recall(spark, folder):
    """Similar customers by MinHash bands, beside the exact pairs: none wrong, and a measured recall of at least 0.9."""
    months = customer_months(spark, folder)
    found = minhash.approximate_pairs(months, "o_custkey", "order_month", SIMILAR, 0.99)
    report = minhash.recall_report(found, overlap.shared_pairs(months, "o_custkey", "order_month", overlap.Rule(jaccard=SIMILAR)))
    return report.select("pairs", "wrong", (F.coalesce("recall", F.lit(1.0)) >= 0.9).alias("recall_reached"))


@query("GR3 J3", f"SELECT 's:' || i AS src, 'u:' || u AS dst FROM {CUSTOMER_NATIONS}")
def bipartite_graph(spark, folder):
    return graphs.bipartite_graph(customer_nations(spark, folder), "o_custkey", "n_name")


@query("SET4", f"WITH d AS {CUSTOMER_NATIONS} SELECT 'u:' || u AS id FROM d UNION SELECT 's:' || i FROM d")
def typed_union(spark, folder):
    return graphs.typed_vertices(customer_nations(spark, folder), "o_custkey", "n_name")


@query("GR6", f"""WITH RECURSIVE {_edges(CO_SQL)}, r(id, c) AS (SELECT DISTINCT src, src FROM b UNION SELECT b.dst, r.c FROM r JOIN b ON b.src = r.id)
    SELECT id, min(c) AS component FROM r GROUP BY id""")
def components(spark, folder):
    edges = cooccurring(spark, folder)
    return communities.connected_components(graphs.endpoints(edges), edges)


@query("GR6", f"""WITH RECURSIVE {_edges(_BIPARTITE)},
    r(id, c) AS (SELECT DISTINCT src, src FROM e UNION SELECT b.dst, r.c FROM r JOIN b ON b.src = r.id)
    SELECT id, min(c) AS component FROM r GROUP BY id""")
def bipartite_components(spark, folder):
    """The name of a component is the smallest id, here always a place, so the SQL starts from places."""
    memberships = customer_nations(spark, folder)
    edges = Scratch(spark, "graph").write(graphs.bipartite_graph(memberships, "o_custkey", "n_name"), "edges")
    return communities.connected_components(graphs.typed_vertices(memberships, "o_custkey", "n_name"), edges)


def _labels(rounds: int) -> str:
    ctes = ["l0 AS MATERIALIZED (SELECT DISTINCT src AS id, src AS label FROM b)"]
    for r in range(1, rounds + 1):
        ctes.append(f"""l{r} AS MATERIALIZED (SELECT id, label FROM (SELECT src AS id, label,
            row_number() OVER (PARTITION BY src ORDER BY count(*) DESC, label) AS place
            FROM b JOIN l{r - 1} ON id = dst GROUP BY src, label) WHERE place = 1)""")
    return ",\n".join(ctes)


_LPA = f"{_edges(CO_SQL)}, {_labels(PROPAGATION)}"


def _propagated(spark, folder):
    edges = cooccurring(spark, folder)
    return edges, communities.label_propagation(graphs.endpoints(edges), edges, PROPAGATION)


@query("GR2", f"WITH {_LPA} SELECT id, label FROM l{PROPAGATION}")
def label_propagation(spark, folder):
    return _propagated(spark, folder)[1]


@query("AGG15 RNK4 RNK5 RNK6 SNK6 ST4", f"""WITH {_LPA} SELECT count(*) AS size, CAST(min(id) AS VARCHAR) AS first_member, CAST(0 AS BIGINT) AS piece,
    string_agg('''' || id || '''', ', ' ORDER BY id) AS line FROM l{PROPAGATION} GROUP BY label""")
def community_lines(spark, folder):
    return sinks.community_lines(_propagated(spark, folder)[1], "label", "id")


@query("RNK4 RNK5", f"""WITH {_LPA}, c AS (SELECT label, count(*) AS size, min(id) AS first_member FROM l{PROPAGATION} GROUP BY label)
    SELECT *, row_number() OVER (ORDER BY size, first_member) AS place FROM c""")
def ranked_communities(spark, folder):
    labels = _propagated(spark, folder)[1]
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"), F.min("id").alias("first_member"))
    return positions(sizes, [F.col("size"), F.col("first_member")], name="place")


@query("GR7 AGG17", f"""WITH {_LPA}, d AS (SELECT label, count(*) AS k FROM b JOIN l{PROPAGATION} ON id = src GROUP BY label),
    i AS (SELECT s.label, count(*) AS n FROM e JOIN l{PROPAGATION} s ON s.id = src JOIN l{PROPAGATION} t ON t.id = dst
        WHERE s.label = t.label GROUP BY ALL), m AS (SELECT count(*) AS m FROM e)
    SELECT round(sum(coalesce(n, 0) / m - pow(k / (2 * m), 2)), 6) AS modularity FROM d LEFT JOIN i USING (label), m""")
def modularity(spark, folder):
    edges, labels = _propagated(spark, folder)
    return communities.modularity(edges, labels).withColumn("modularity", r6(F.col("modularity")))


@query("RNK3", f"SELECT src, dst, cnt, row_number() OVER (ORDER BY cnt DESC, src, dst) AS place FROM {CO_SQL}")
def ranked_edges(spark, folder):
    edges = graphs.cooccurrence_graph(customer_parts(spark, folder), "o_custkey", "l_partkey", COMMON)
    return positions(edges, [F.desc("cnt"), F.asc("src"), F.asc("dst")], name="place")


def _search(levels: int) -> str:
    ctes = ["n0 AS MATERIALIZED (SELECT DISTINCT src AS source, src AS node, CAST(1 AS DOUBLE) AS paths FROM b)"]
    for level in range(1, levels + 1):
        seen = " UNION ALL ".join(f"SELECT source, node FROM n{i}" for i in range(max(0, level - 2), level))
        ctes.append(f"""n{level} AS MATERIALIZED (SELECT source, dst AS node, sum(paths) AS paths FROM n{level - 1} JOIN b ON b.src = node
            WHERE (source, dst) NOT IN ({seen}) GROUP BY ALL)""")
    return ",\n".join(ctes)


def _credits(levels: int) -> str:
    ctes = [f"r{levels} AS MATERIALIZED (SELECT source, node, paths, CAST(1 AS DOUBLE) AS credit FROM n{levels})"]
    for level in range(levels, 0, -1):
        ctes.append(f"""f{level} AS MATERIALIZED (SELECT w.source, v.node AS v, w.node AS w, v.paths / w.paths * credit AS flow
            FROM r{level} w JOIN b ON b.src = w.node JOIN n{level - 1} v ON v.source = w.source AND v.node = b.dst)""")
        ctes.append(f"""r{level - 1} AS MATERIALIZED (SELECT n.source, n.node, n.paths, 1 + coalesce(x.flow, 0) AS credit FROM n{level - 1} n
            LEFT JOIN (SELECT source, v, sum(flow) AS flow FROM f{level} GROUP BY ALL) x ON x.source = n.source AND x.v = n.node)""")
    return ",\n".join(ctes)


def _betweenness(sql: str) -> str:
    flows = " UNION ALL ".join(f"SELECT v, w, flow FROM f{level}" for level in range(1, LEVELS + 1))
    return f"""{_edges(sql)}, {_search(LEVELS)}, {_credits(LEVELS)}, s AS MATERIALIZED (SELECT least(v, w) AS src, greatest(v, w) AS dst,
        sum(flow) / 2 AS betweenness FROM ({flows}) GROUP BY ALL)"""


@query("GR5 AGG18", f"WITH {_betweenness(_SIM)} SELECT src, dst, round(betweenness, 6) AS betweenness FROM s")
def edge_betweenness(spark, folder):
    return communities.edge_betweenness(similar(spark, folder)).withColumn("betweenness", r6(F.col("betweenness")))


@query("GR5 AGG18", f"WITH {_betweenness(CO_SQL)} SELECT src, dst, round(betweenness, 6) AS betweenness FROM s")
def cooccurrence_betweenness(spark, folder):
    return communities.edge_betweenness(cooccurring(spark, folder)).withColumn("betweenness", r6(F.col("betweenness")))


@query("SNK7 RNK3", f"""WITH {_betweenness(_SIM)} SELECT round(betweenness, 6) AS score, src, dst,
    '(''' || src || ''', ''' || dst || '''), ' || round(betweenness, 6) AS line FROM s""")
def betweenness_lines(spark, folder):
    scores = communities.edge_betweenness(similar(spark, folder)).withColumn("betweenness", r6(F.col("betweenness")))
    return sinks.betweenness_lines(scores)


@query("GR5 GR3 AGG18 SNK7", f"""WITH {_betweenness(_BIPARTITE)} SELECT round(betweenness, 6) AS score, src, dst,
    '(''' || src || ''', ''' || dst || ''') , ' || round(betweenness, 6) AS line FROM s""")
def bipartite_betweenness(spark, folder):
    """Shortest ways between customers and nations over each of their edges, in the line form of that graph."""
    edges = graphs.bipartite_graph(customer_nations(spark, folder), "o_custkey", "n_name")
    scores = communities.edge_betweenness(Scratch(spark, "graph").write(edges, "edges"))
    return sinks.betweenness_lines(scores.withColumn("betweenness", r6(F.col("betweenness"))), " , ")


@query("RNK9", f"""WITH {_betweenness(_SIM)} SELECT src, dst, round(betweenness, 6) AS betweenness FROM s
    WHERE betweenness >= (SELECT max(betweenness) FROM s) * (1 - 1e-9)""")
def top_score_edges(spark, folder):
    top = at_maximum(communities.edge_betweenness(similar(spark, folder)), "betweenness")
    return top.withColumn("betweenness", r6(F.col("betweenness")))


@query("J9 SET3", f"""WITH {_edges(CO_SQL)}, {_search(2)} SELECT source, count(*) AS reached, CAST(sum(paths) AS BIGINT) AS paths FROM n2 GROUP BY source""")
def frontier_expansion(spark, folder):
    """Vertices two steps from each vertex, and the shortest ways to them."""
    both = graphs.mirror(cooccurring(spark, folder))
    start = both.select(F.col("src").alias("source"), F.col("src").alias("node")).distinct().withColumn("paths", F.lit(1.0))
    none = start.limit(0)
    first = communities.next_level(start, none, both)
    second = communities.next_level(first, start, both)
    return second.groupBy("source").agg(F.count("*").alias("reached"), F.sum("paths").cast("bigint").alias("paths"))


@query("GR8 GR7")
def girvan_newman(spark, folder):
    edges = similar(spark, folder)
    return communities.girvan_newman(graphs.endpoints(edges), edges)
