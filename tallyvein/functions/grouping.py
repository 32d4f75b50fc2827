"""Lists and sets per key whose rows stay bounded, whatever the size of a key's group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvein.session import Scratch


def group_values(df: DataFrame, key: str, value: str, unique: bool = False, per_row: int = 100_000) -> DataFrame:
    """(key, piece, members): the values of each key, sorted within a row.

    A key with at most ``per_row`` values gets one row with piece 0. The values of a larger key are
    spread over as many rows as needed, so no task ever holds a whole hot group and no value is lost.
    Repeats of a value are counted before anything is shuffled and are cut into runs that go to
    different pieces, so one value repeated very often is spread like many values.
    """
    counted = df.select(key, value).groupBy(key, value).agg((F.lit(1).cast("bigint") if unique else F.count("*")).alias("_times"))
    heavy = counted.groupBy(key).agg(F.sum("_times").alias("_n")).where(F.col("_n") > per_row)
    heavy = heavy.select(key, F.ceil(F.col("_n") / F.lit(per_row)).alias("_pieces"))
    # Written, so that the join with it sees real sizes and splits a hot key.
    heavy = Scratch(df.sparkSession, "heavy").write(heavy, "keys")
    run = max(1, per_row // 8)
    pieces = F.coalesce("_pieces", F.lit(1).cast("bigint"))
    cut = (
        counted.join(heavy, key, "left")
        .withColumn("_width", F.when(pieces > 1, F.lit(run).cast("bigint")).otherwise(F.col("_times")))
        .withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / F.col("_width")))))
        .withColumn("piece", F.pmod(F.xxhash64(key, value) + F.col("_run"), pieces).cast("int"))
        .withColumn("_times", F.least(F.col("_width"), F.col("_times") - F.col("_run") * F.col("_width")).cast("int"))
    )
    repeated = F.flatten(F.collect_list(F.when(F.col(value).isNotNull(), F.array_repeat(F.col(value), F.col("_times")))))
    return cut.groupBy(key, "piece").agg(F.array_sort(repeated).alias("members"))
