"""The fixed-size sample of a stream as keyed state instead of tables that each batch rewrites.

Two stateful steps. Shards of the stream, by a hash of the id, keep the rows with their smallest ranks and
pass on only rows that entered a sample; one last key keeps the smallest of those. A row beyond a
shard's n-th rank never leaves its task, so the last key sees few rows however many arrive: after m
messages a shard passes on about n * ln(m / n) of them in all. State is in the state store with the
stream's checkpoint: a batch that is run again, or a stream that is started again, goes on from it.

The sample is that of ``sampling.fixed_sample``: the n smallest ranks, which do not depend on the order
or the cut of the batches.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyvein.operators.sampling import sample_rank, tagged_only
from tallyvein.streaming.reservoir import write_report

#: The state store that keyed processors need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ORDER = ["rank", "id", "text"]


class _Smallest(StatefulProcessor):
    """Keeps the n smallest rows of a key in a list state, and in value states its n-th rank and what it has seen."""

    def __init__(self, n: int, id_type: str):
        self.n, self.id_type = n, id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", f"rank string, id {self.id_type}, text string")
        self.limit = handle.getValueState("limit", "rank string")
        self.seen = handle.getValueState("seen", "n bigint")
        self.updates = handle.getValueState("updates", "n bigint")

    def _count(self, state, more: int) -> int:
        total = (int(state.get()[0]) if state.exists() else 0) + more
        state.update((total,))
        return total

    def _admit(self, frames: Iterator[pd.DataFrame]) -> tuple[list[tuple], list[tuple], int]:
        """(rows that entered, sample after them, messages counted): one frame and n rows in memory at a time."""
        limit = self.limit.get()[0] if self.limit.exists() else None
        fresh: list[tuple] = []
        seen = 0
        for frame in frames:
            seen += int(frame["seen"].sum())
            near = frame["rank"].notna() if limit is None else frame["rank"] <= limit
            some = zip(*(frame.loc[near, c].tolist() for c in _ORDER))
            fresh = heapq.nsmallest(self.n, chain(fresh, ((*row, 1) for row in some)))
        if not fresh:
            return [], [], seen
        kept = heapq.nsmallest(self.n, chain(((*row, 0) for row in self._sample()), fresh))
        entered = [row[:3] for row in kept if row[3]]
        if entered:
            self.rows.put([row[:3] for row in kept])
            if len(kept) == self.n:
                self.limit.update((kept[-1][0],))
        return entered, [row[:3] for row in kept], seen

    def _sample(self) -> list[tuple]:
        return [tuple(row) for row in self.rows.get()]

    def close(self) -> None:
        pass


class _Shard(_Smallest):
    """Passes on the rows that entered its sample and one row with the number of messages."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        entered, _, seen = self._admit(rows)
        yield pd.DataFrame([*((*row, 0) for row in entered), (None, None, None, seen)], columns=[*_ORDER, "seen"]).astype({"id": object})


class _Whole(_Smallest):
    """Reports the whole sample after each batch: (update_no, n_seen, id, text); one row without an id if it is empty."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        _, kept, seen = self._admit(rows)
        total, number = self._count(self.seen, seen), self._count(self.updates, 1) - 1
        kept = kept or self._sample() or [(None, None, None)]
        yield pd.DataFrame([(number, total, i, text) for _, i, text in kept], columns=["update_no", "n_seen", "id", "text"])


def stateful_sample(messages: DataFrame, n: int = 100, seed: int = 28, shards: int = 64) -> DataFrame:
    """(update_no, n_seen, id, text): the sample of all (id, text) messages with tags so far, whole after every batch that has one."""
    kind = messages.schema["id"].dataType.simpleString()
    tagged = tagged_only(messages).where(F.col("id").isNotNull())
    ranked = tagged.select(
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        sample_rank(F.col("id"), seed).alias("rank"), "id", "text", F.lit(1).cast("bigint").alias("seen"),
    )
    entered = ranked.groupBy("shard").transformWithStateInPandas(
        _Shard(n, kind), T.StructType.fromDDL(f"rank string, id {kind}, text string, seen bigint"), "Append", "None"
    )
    return entered.withColumn("whole", F.lit(0)).groupBy("whole").transformWithStateInPandas(
        _Whole(n, kind), T.StructType.fromDDL(f"update_no bigint, n_seen bigint, id {kind}, text string"), "Append", "None"
    )


def start_stateful_trending(
    messages: DataFrame, folder: str, checkpoint: str, n: int = 100, seed: int = 28, top: int = 3, shards: int = 64,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Report the sample's top tags after every batch, as ``reservoir.start_trending`` does; ``reservoir.reports`` reads them."""
    spark = messages.sparkSession
    sample = stateful_sample(messages, n, seed, shards)

    def report(batch: DataFrame, batch_id: int) -> None:
        write_report(batch, folder, batch_id, top)

    writer = (
        sample.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(report)
    )
    return _with_rocksdb(spark, writer.start)


def _with_rocksdb(spark: SparkSession, start):
    """A query keeps the state store that its session names when it starts."""
    usual = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.set(PROVIDER, usual)
