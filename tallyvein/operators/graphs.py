"""Graphs from memberships: co-occurrence, similarity and bipartite edges.

Edges are (src, dst) with src < dst, each once; ``mirror`` gives both directions. Vertices are (id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvein.operators.overlap import Rule, jaccard_of, shared_pairs


def swap(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """(first, second) as (second, first)."""
    return pairs.select(second, first)


def mirror(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, made without a second scan."""
    ends = F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    return edges.select(F.explode(ends).alias("e")).select("e.src", "e.dst")


def endpoints(edges: DataFrame) -> DataFrame:
    """The vertices that have an edge."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def cooccurrence_graph(memberships: DataFrame, user: str, item: str, threshold: int) -> DataFrame:
    """(src, dst, cnt): users with at least ``threshold`` different items in common."""
    pairs = shared_pairs(memberships, user, item, Rule(overlap=threshold), with_sizes=False)
    return pairs.select("src", "dst", F.col("overlap").alias("cnt"))


def similarity_graph(memberships: DataFrame, user: str, item: str, threshold: float = 0.5) -> DataFrame:
    """(src, dst, jaccard): users whose sets of items have at least this Jaccard similarity."""
    pairs = shared_pairs(memberships, user, item, Rule(jaccard=threshold))
    similarity = jaccard_of(F.col("overlap"), F.col("src_size"), F.col("dst_size"))
    return pairs.select("src", "dst", similarity.alias("jaccard"))


def bipartite_graph(memberships: DataFrame, user: str, place: str) -> DataFrame:
    """(src, dst): each user joined to each place; a prefix keeps the two kinds of id apart."""
    return memberships.select(
        F.concat(F.lit("s:"), F.col(place).cast("string")).alias("src"),
        F.concat(F.lit("u:"), F.col(user).cast("string")).alias("dst"),
    ).dropna().distinct()


def typed_vertices(memberships: DataFrame, user: str, place: str) -> DataFrame:
    """The vertices of the bipartite graph: all users and all places."""
    users = memberships.select(F.concat(F.lit("u:"), F.col(user).cast("string")).alias("id"))
    places = memberships.select(F.concat(F.lit("s:"), F.col(place).cast("string")).alias("id"))
    return users.unionByName(places).dropna().distinct()
