"""A fixed-size sample over all messages of a stream, reported after every micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyvein.operators.sampling import fixed_sample, tagged_only, trending_tags
from tallyvein.sources.sinks import report_block


def merge_batch(batch: DataFrame, folder: str, batch_id: int, n: int = 100, seed: int = 28, top: int = 3) -> None:
    """Merge one batch into the sample and report the sample's top tags.

    State before the batch is read under the number of the batch before it and the new state is
    written under the batch's own number, so a batch that is run again gives the same result.
    """
    spark = batch.sparkSession
    tagged = tagged_only(batch).select("id", "text").persist()
    try:
        seen = tagged.count()
        rows = tagged
        if batch_id > 0:
            before = f"{folder}/state/batch={batch_id - 1}"
            rows = rows.unionByName(spark.read.schema(tagged.schema).parquet(f"{before}/sample"))
            seen += spark.read.schema("n_seen bigint").parquet(f"{before}/seen").first()["n_seen"]
        state = f"{folder}/state/batch={batch_id}"
        # At most n rows and one row: single small files.
        fixed_sample(rows, "id", n, seed).coalesce(1).write.mode("overwrite").parquet(f"{state}/sample")
    finally:
        tagged.unpersist()
    spark.createDataFrame([(seen,)], "n_seen bigint").coalesce(1).write.mode("overwrite").parquet(f"{state}/seen")
    sample = spark.read.schema(tagged.schema).parquet(f"{state}/sample")
    write_report(sample.withColumn("n_seen", F.lit(seen).cast("bigint")), folder, batch_id, top, seen)


def write_report(sample: DataFrame, folder: str, batch_id: int, top: int = 3, seen: int | None = None) -> None:
    """Write the top tags of a sample of (n_seen, text) rows; ``seen`` is given where the sample may have no row."""
    if seen is None:
        seen = sample.agg(F.coalesce(F.max("n_seen"), F.lit(0))).first()[0]
    report = trending_tags(sample.where(F.col("text").isNotNull()), "text", top).select(F.lit(seen).cast("bigint").alias("n_seen"), "tag", "cnt")
    if report.isEmpty():
        report = sample.sparkSession.createDataFrame([(seen, None, None)], "n_seen bigint, tag string, cnt bigint")
    report.coalesce(1).write.mode("overwrite").parquet(f"{folder}/report/batch_id={batch_id}")


def start_trending(
    messages: DataFrame, folder: str, checkpoint: str, n: int = 100, seed: int = 28, top: int = 3, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the sample of a stream of (id, text) messages up to date."""
    return (
        messages.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(lambda batch, batch_id: merge_batch(batch, folder, batch_id, n, seed, top))
        .start()
    )


def reports(spark, folder: str) -> DataFrame:
    """(batch_id, n_seen, tag, cnt) of all batches."""
    schema = "n_seen bigint, tag string, cnt bigint, batch_id int"
    return spark.read.schema(schema).parquet(f"{folder}/report").select("batch_id", "n_seen", "tag", "cnt")


def report_lines(spark, folder: str, batch_id: int) -> DataFrame:
    """The printed form of one report."""
    return report_block(reports(spark, folder).where(F.col("batch_id") == batch_id))
