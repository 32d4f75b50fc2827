"""Positions and top counts without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvein.session import Scratch


def positions(df: DataFrame, order: list[Column], by: list[str] | None = None, name: str = "position") -> DataFrame:
    """1-based position of every row in the given order, within each group of ``by``.

    Rows are range-partitioned by (by, order), so a group of any size spreads over many tasks; each
    task numbers its own rows, and the rows before a task are added from per-task counts. ``order``
    must tell rows of one group apart.
    """
    by = by or []
    scratch = Scratch(df.sparkSession, "positions")
    laid = scratch.write(
        df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_part", F.spark_partition_id()), "laid"
    )
    local = laid.withColumn("_row", F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order)))
    counts = laid.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Only a group that runs over a part boundary has rows before it: at most one per part.
    offsets = (
        counts.withColumn("_before", F.sum("_n").over(before)).where(F.col("_before") > 0).drop("_n")
    )
    joined = local.join(F.broadcast(offsets), [*by, "_part"], "left")
    at = F.col("_row") + F.coalesce(F.col("_before"), F.lit(0))
    return joined.select(*df.columns, at.cast("bigint").alias(name))


def with_top_counts(counts: DataFrame, count: str = "cnt", top: int = 3) -> DataFrame:
    """Rows whose count is among the ``top`` highest distinct counts; ties stay together."""
    best = counts.select(count).distinct().orderBy(F.desc(count)).limit(top)
    return counts.join(F.broadcast(best), count, "left_semi").select(*counts.columns)  # at most `top` rows


def at_maximum(df: DataFrame, score: str, tolerance: float = 1e-9) -> DataFrame:
    """Rows whose score equals the maximum up to a relative tolerance."""
    top = df.agg(F.max(score)).scalar()
    return df.where(F.col(score) >= top * F.lit(1.0 - tolerance))
