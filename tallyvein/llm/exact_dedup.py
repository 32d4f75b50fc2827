"""Exact duplicates by progressive refinement: lengths, then hashes of prefixes, then hashes of whole texts.

DataFrame functions only. Each step counts its keys over all rows and leaves the keys that more than one
row holds; the next step looks at rows of such keys alone. Rows find out about their key through a bit
table: the surviving keys set bits by their hash, and a row asks for the word that holds its bit. The bit
table has at most ``WORDS`` rows at any number of keys, so it can always be broadcast, and no text is
ever shuffled. A row that hits a bit set by another key costs a needless hash and nothing else, because
groups are told apart by the full hash alone.

Texts are compared after lower-casing A-Z; equal SHA-256 digests are taken as equal texts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvein.session import Scratch

#: Characters of the prefix that is hashed in the second step.
PREFIX = 256
#: Most 64-bit words of a bit table: 4 MB of rows to broadcast.
WORDS = 1 << 18
#: A class with more than this share of all rows is hot; there are at most as many as the inverse.
HOT_SHARE = 1 / 256


def lower_az(text: Column) -> Column:
    """The text with A-Z as a-z and nothing else changed; null is empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _bit(keys: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(WORDS * 64))


def _bit_table(keys: DataFrame) -> DataFrame:
    """(word, bits): one bit per key."""
    rows = keys.select(_bit([F.col(c) for c in keys.columns]).alias("bit"))
    return rows.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63L AS INT)))").alias("bits"))


def _marked(rows: DataFrame, table: DataFrame, name: str, keys: list[Column], among: Column) -> DataFrame:
    """``rows`` with a flag ``name``: the row is ``among`` those asked about and its key's bit is set."""
    rows = rows.withColumn("bit", F.when(among, _bit(keys))).withColumn("word", F.shiftright("bit", 6))
    rows = rows.join(F.broadcast(table), "word", "left")
    hit = F.expr("shiftrightunsigned(bits, CAST(bit & 63L AS INT)) & 1L") == 1
    return rows.withColumn(name, F.coalesce(hit, F.lit(False))).drop("word", "bits", "bit")


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(*keys)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """Every row's id with ``keep_id``, ``group_size``, ``kept``, and the columns of ``carry`` by name.

    Of rows with equal texts the one with the largest id stays. ``carry`` are expressions over ``docs``
    that come back beside each row; other columns of ``docs`` are not read, whatever their names.

    * A null text is an empty one; all empty texts are one group.
    * Texts of any length are hashed whole, in one piece.
    * A null id is smaller than any other. Rows with one id and one text are a group as well, and one of
      them stays.
    * An empty table gives no rows.
    """
    carry = carry or {}
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    given = F.struct(*[value.alias(name) for name, value in carry.items()]) if carry else F.lit(None).cast("boolean")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), given.alias("given"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")
    prefix = F.xxhash64(lower_az(F.substring("text", 1, PREFIX)))

    lengths = scratch.write(_bit_table(_repeated(rows.select(size), "size")), "lengths")
    rows = _marked(rows.withColumn("size", size), lengths, "same_length", [F.col("size")], F.lit(True))
    rows = rows.withColumn("prefix", F.when(F.col("same_length"), prefix))
    starts = _repeated(rows.where("same_length").select("size", "prefix"), "size", "prefix")
    starts = scratch.write(_bit_table(starts), "starts")
    rows = _marked(rows, starts, "same_start", [F.col("size"), F.col("prefix")], F.col("same_length"))
    digest = F.when(F.col("same_start"), F.sha2(lower_az(F.col("text")).cast("binary"), 256))
    rows = scratch.write(rows.select("id", "given", digest.alias("digest"), F.monotonically_increasing_id().alias("row")), "rows")

    classes, seen = scratch.write_counted(
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct("id", "row")).alias("keep"))
        .where("copies > 1"),
        "classes",
        copies=F.sum("copies"),
    )
    return _with_class(rows, classes, (seen["copies"] or 0) * HOT_SHARE).select(
        F.col("id").alias(id_col),
        F.coalesce(F.col("keep.id"), F.col("id")).alias("keep_id"),
        F.coalesce(F.col("copies"), F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"),
        *[F.col("given")[name].alias(name) for name in carry],
    )


def _with_class(rows: DataFrame, classes: DataFrame, hot: float) -> DataFrame:
    """Rows beside their class. Hot classes, few by their definition, are broadcast; others are joined by digest."""
    large = classes.where(F.col("copies") > hot).select("digest", F.struct("copies", "keep").alias("large"))
    small = classes.where(F.col("copies") <= hot).select(F.col("digest").alias("key"), F.struct("copies", "keep").alias("small"))
    rows = rows.join(F.broadcast(large), "digest", "left")
    # A row without a small class gets a key of its own, so that such rows do not meet in one task.
    alone = F.col("digest").isNull() | F.col("large").isNotNull()
    rows = rows.withColumn("key", F.when(alone, F.col("row").cast("string")).otherwise(F.col("digest")))
    rows = rows.join(small, "key", "left").withColumn("class", F.coalesce("large", "small"))
    return rows.select("id", "row", "given", F.col("class.copies").alias("copies"), F.col("class.keep").alias("keep"))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were; cases as in ``duplicate_groups``."""
    whole = {f"c{i}": F.col(f"`{name}`") for i, name in enumerate(docs.columns)}
    kept = duplicate_groups(docs, id_col, text_col, carry=whole).where("kept")
    return kept.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


#: The same groups in one pass, for tables that fit one machine.
EXACT_DEDUP_SQL = """
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM lowered
"""
