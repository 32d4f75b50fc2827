"""Scans of the record shapes the operators work on. Every schema is explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The user fields behind the rating features, in feature order.
USER_FIELDS = [
    "useful", "funny", "cool", "friends",
    "compliment_hot", "compliment_more", "compliment_profile",
    "compliment_cute", "compliment_list", "compliment_note", "yelping_since",
    "compliment_plain", "compliment_cool", "compliment_funny",
]
TEXT_USER_FIELDS = {"friends", "yelping_since"}

USER_SCHEMA = T.StructType(
    [T.StructField("user_id", T.StringType())]
    + [T.StructField(f, T.StringType() if f in TEXT_USER_FIELDS else T.LongType()) for f in USER_FIELDS]
)
RATING_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.DoubleType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; only the fields of the schema are parsed, and a broken line raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_pairs(spark: SparkSession, path: str, columns: tuple[str, str] = ("user_id", "business_id")) -> DataFrame:
    """Two-column CSV with a header line, both columns text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).csv(path)


def _parse_points(lines: DataFrame, scale: float | None) -> DataFrame:
    parts = F.split("value", ",")
    features = F.slice(parts, F.lit(2), F.size(parts) - 1).cast("array<double>")
    if scale is not None:
        features = F.transform(features, lambda x: x / F.lit(float(scale)))
    kept = [c for c in lines.columns if c != "value"]
    return lines.select(F.element_at(parts, 1).alias("point_id"), features.alias("features"), *kept)


def read_points(spark: SparkSession, path: str, scale: float | None = None) -> DataFrame:
    """Headerless lines ``id,f1,...,fn`` as (point_id, features); ``scale`` divides each coordinate."""
    return _parse_points(spark.read.text(path), scale)


def read_point_chunks(spark: SparkSession, folder: str, scale: float | None = None) -> DataFrame:
    """All ``*.txt`` point files below a folder, with the file path as ``chunk`` (its order is the round order)."""
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.txt")
        .text(folder)
        .select("value", F.col("_metadata.file_path").alias("chunk"))
    )
    return _parse_points(lines, scale)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """User records as JSON lines, pruned to the id and the feature fields."""
    return read_json_records(spark, path, USER_SCHEMA)


# One entry of an object of numbers, and what may stand around entries.
_ENTRY = r'(?s)^\s*"(?:[^"\\]++|\\.)*+"\s*:\s*-?[0-9][-+0-9.eE]*\s*$'
_BETWEEN = r"(?s)^[\s{}]*$"


def read_average_map(spark: SparkSession, path: str, key: str = "id", value: str = "average") -> DataFrame:
    """One JSON object ``{"id": number, ...}`` per file, as rows; ids are decoded, whatever they hold.

    The text reader cuts the object at every comma, so many tasks share one long file. A fragment with
    both quotes of its id is an entry and stays where it was read. Only fragments of ids with commas are
    shuffled: quotes are summed over blocks of the file, then inside each block, and the sum before a
    fragment names its entry. Whatever is not an entry raises.
    """
    quotes = F.size(F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')).cast("long") - 1
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    fragments = spark.read.option("lineSep", ",").text(path).select(F.col("value").alias("text"), quotes.alias("quotes"), *place)
    # Ids of rows rise within a task, and one task reads a block.
    pieces = fragments.where("quotes < 2").withColumn("nth", F.monotonically_increasing_id())
    blocks = pieces.groupBy("file", "block").agg(F.sum("quotes").alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("ahead"))
    before = Window.partitionBy("file", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.join(blocks, ["file", "block"]).withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    inside = pieces.where((F.col("ahead") % 2 == 1) | ~F.col("text").rlike(_BETWEEN))
    parts = F.array_sort(F.collect_list(F.struct("block", "nth", "text")))
    joined = inside.groupBy("file", F.floor(F.col("ahead") / 2).alias("entry")).agg(F.array_join(F.transform(parts, lambda x: x["text"]), ",").alias("text"))
    entries = fragments.where("quotes >= 2").select("text").unionByName(joined.select("text"))
    bare = F.regexp_replace(F.regexp_replace("text", r"^\s*\{", ""), r"\}\s*$", "")
    bad = F.raise_error(F.concat(F.lit("not an id and a number: "), F.col("text"))).cast("string")
    checked = entries.withColumn("text", bare).select(F.when(F.col("text").rlike(_ENTRY), F.col("text")).otherwise(bad).alias("text"))
    parsed = F.from_json(F.concat(F.lit("{"), F.col("text"), F.lit("}")), "map<string,double>", {"mode": "FAILFAST"})
    return checked.select(F.explode(parsed).alias(key, value))


def json_field(lines: DataFrame, field: str, name: str, column: str = "value", kind: str = "string") -> DataFrame:
    """One field of JSON text lines; works the same on a stream."""
    parsed = F.from_json(column, f"`{field}` {kind}", {"mode": "FAILFAST"})
    return lines.select(parsed.getField(field).alias(name))


def tagged_messages(messages: DataFrame, language: str = "en", mark: str = "#") -> DataFrame:
    """Messages in one language whose text holds the tag mark; batch or stream."""
    return messages.where((F.col("lang") == language) & (F.instr("text", mark) > 0))
