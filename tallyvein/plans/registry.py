"""The named queries over the given tables, each with the inventory entries it covers and its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyvein.functions.hashing import WORD_HEX_DIGITS, WORDS_PER_KEY


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name."""

    def add(fn):
        QUERIES[fn.__name__] = Query(fn, sql, tuple(covers.split()))
        return fn

    return add


def key_sql(value: str, word: int = 0) -> str:
    start = 1 + WORD_HEX_DIGITS * (word % WORDS_PER_KEY)
    return f"CAST('0x' || substr(md5(CAST({value} AS VARCHAR)), {start}, {WORD_HEX_DIGITS}) AS BIGINT)"


def rank_sql(value: str, seed: int = 28) -> str:
    return f"md5(CAST({value} AS VARCHAR) || '|{seed}')"


# Memberships shared by several queries.
CUSTOMER_PARTS = "(SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"
CUSTOMER_MONTHS = "(SELECT DISTINCT o_custkey AS u, year(o_orderdate) * 100 + month(o_orderdate) AS i FROM orders)"
CUSTOMER_NATIONS = """(SELECT DISTINCT o_custkey AS u, n_name AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
MESSAGES = """(SELECT event_id, ts, '#' || event_type || ' #k' || regexp_extract(props, '"k": *([0-9]+)', 1) AS text FROM events)"""
RATINGS = """(SELECT o_custkey AS user_id, l_partkey AS item_id, avg(ceil(l_quantity / 10)) AS stars
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)"""
HELD = f"{key_sql("user_id || '|' || item_id")} % 10 = 0"
