"""Streams of records. File streams need nothing but Spark; any other source that delivers a text
column of JSON goes through ``parse_json``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_stream(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines that arrive as files in a folder or below it."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def table_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files that arrive in a folder or below it."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def parse_json(raw: DataFrame, schema: T.StructType | str, column: str = "value") -> DataFrame:
    """The fields of a text or binary column of JSON, as message queues deliver it."""
    return raw.select(F.from_json(F.col(column).cast("string"), schema).alias("_r")).select("_r.*")
