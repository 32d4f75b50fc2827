"""Distinct counts per sliding event-time window of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyvein.functions.hashing import lowest_bit
from tallyvein.operators.distinct import HASH_BITS, fm_estimate, hash_rows, with_error_gate, with_keys
from tallyvein.operators.sketches import LG_K, SketchStore
from tallyvein.sources.sinks import write_window_estimates


def window_sketches(
    events: DataFrame, ts: str, col: str, window: str, slide: str, lateness: str, k: int, bits: int, seed: int
) -> DataFrame:
    """(window, hash_no, n_rows, top), written once a window is closed by the watermark.

    A value is kept once per window, in state spread by (window, value), so the rows of a sketch also
    count the distinct values exactly; the sketch itself is k numbers per window.
    """
    stamped = events.select(F.col(ts).cast("timestamp").alias("ts"), F.col(col)).withWatermark("ts", lateness)
    pairs = stamped.select(F.window("ts", window, slide).alias("window"), F.col(col)).dropDuplicates(["window", col])
    rows = hash_rows(with_keys(pairs, col), ["window"], k, bits, seed)
    return rows.groupBy("window", "hash_no").agg(
        F.count("*").alias("n_rows"), F.max(lowest_bit(F.col("hash"))).alias("top")
    )


def start_window_estimates(
    events: DataFrame,
    ts: str,
    col: str,
    out: str,
    checkpoint: str,
    window: str = "30 seconds",
    slide: str = "10 seconds",
    lateness: str = "5 seconds",
    k: int = 100,
    groups: int = 3,
    bits: int = HASH_BITS,
    seed: int = 28,
    limit: float = 0.25,
    keep_all: bool = True,
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Write Time, Ground Truth and Estimation of every closed window, one CSV folder per micro-batch.

    Windows outside the error limit are written too unless ``keep_all`` is off. Time is the end of the
    window as epoch seconds. The number of state partitions is fixed for the life of a checkpoint; it is
    the session's number of shuffle partitions unless given.
    """
    sketches = window_sketches(events, ts, col, window, slide, lateness, k, bits, seed)

    def write(batch: DataFrame, batch_id: int) -> None:
        closed = batch.withColumn("window_end", F.col("window.end").cast("bigint")).drop("window")
        found = fm_estimate(closed, ["window_end"], k, groups).withColumnRenamed("n_rows", "truth")
        checked = with_error_gate(found, limit)
        write_window_estimates(checked if keep_all else checked.where("within_limit"), out, batch_id)

    writer = (
        sketches.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(write)
    )
    return _start(writer, events.sparkSession, state_partitions)


def sketch_panes(events: DataFrame, ts: str, col: str, slide: str, lateness: str, lg_k: int = LG_K) -> DataFrame:
    """(window, sketch) per closed pane of a stream: the state holds one sketch per open pane, whatever the rows."""
    stamped = events.select(F.col(ts).cast("timestamp").alias("ts"), F.col(col).cast("string").alias("value")).withWatermark("ts", lateness)
    return stamped.groupBy(F.window("ts", slide)).agg(F.hll_sketch_agg("value", F.lit(lg_k)).alias("sketch"))


def sketch_windows(events: DataFrame, ts: str, col: str, window: str, slide: str, lateness: str, lg_k: int = LG_K) -> DataFrame:
    """(window, sketch) per closed sliding window, merged in a second aggregate from the closed panes."""
    panes = sketch_panes(events, ts, col, slide, lateness, lg_k)
    return panes.groupBy(F.window("window", window, slide).alias("window")).agg(F.hll_union_agg("sketch").alias("sketch"))


def start_window_sketches(
    events: DataFrame, ts: str, col: str, store: SketchStore, checkpoint: str, window: str = "30 seconds", slide: str = "10 seconds",
    lateness: str = "5 seconds", trigger: dict | None = None, state_partitions: int | None = None,
) -> StreamingQuery:
    """Put the sketch of every closed window into a store keyed by ``window_start``, a part per micro-batch.

    The exact count of a window needs every value in the state; this needs two sketches per window and
    pane. A batch that is run again replaces its own part.
    """
    sketches = sketch_windows(events, ts, col, window, slide, lateness, store.lg_k)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write(batch_id, batch.select(F.col("window.start").cast("bigint").alias("window_start"), "sketch"))

    writer = (
        sketches.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(write)
    )
    return _start(writer, events.sparkSession, state_partitions)


def _start(writer, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start a query; it takes the settings of its session at this moment."""
    if state_partitions is None:
        return writer.start()
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
