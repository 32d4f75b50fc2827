"""Chunk-by-chunk clustering of a stream: every micro-batch is a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyvein.operators.chunked import absorb_chunk, load_state, start_chunks


def cluster_batch(batch: DataFrame, folder: str, batch_id: int, k: int, seed: int = 28, max_iter: int = 50) -> None:
    """Round ``batch_id + 1``. State is read from the round before and written under its own round."""
    points = batch.select("point_id", "features").persist()
    try:
        if batch_id == 0:
            start_chunks(points, k, folder, seed, max_iter)
        else:
            absorb_chunk(points, load_state(batch.sparkSession, folder, batch_id), max_iter)
    finally:
        points.unpersist()


def start_cluster_stream(
    points: DataFrame, folder: str, checkpoint: str, k: int, seed: int = 28, max_iter: int = 50, trigger: dict | None = None
) -> StreamingQuery:
    return (
        points.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(lambda batch, batch_id: cluster_batch(batch, folder, batch_id, k, seed, max_iter))
        .start()
    )
