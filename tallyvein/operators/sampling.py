"""Fixed-size samples and the trending tags of a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvein.functions.ranking import with_top_counts
from tallyvein.functions.text import tags


def sample_rank(id_col: Column, seed: int) -> Column:
    """A fixed pseudo-random place for every id; another seed gives an independent order."""
    return F.md5(F.concat_ws("|", id_col.cast("string"), F.lit(str(seed))))


def fixed_sample(df: DataFrame, id_col: str, n: int = 100, seed: int = 28) -> DataFrame:
    """n rows drawn uniformly without replacement: those with the n smallest ranks.

    The smallest n of a union are among the smallest n of its parts, so tasks keep n rows each, and
    the sample of a stream is kept by merging the old sample with each batch.
    """
    ranked = df.withColumn("_rank", sample_rank(F.col(id_col), seed))
    return ranked.orderBy("_rank", id_col).limit(n).drop("_rank")


def sample_size(rows: int, most: int = 40, share: int = 5) -> int:
    """At most 40 rows, and at most a fifth of them."""
    return min(most, rows // share)


def tag_frequency(messages: DataFrame, text: str = "text") -> DataFrame:
    """(tag, cnt) over all tags of all messages; a tag counts once for each time it is written."""
    return messages.select(F.explode(tags(F.col(text))).alias("tag")).groupBy("tag").agg(F.count("*").alias("cnt"))


def trending_tags(messages: DataFrame, text: str = "text", top: int = 3) -> DataFrame:
    """Tags with one of the ``top`` highest distinct counts, by falling count and rising tag."""
    return with_top_counts(tag_frequency(messages, text), "cnt", top).orderBy(F.desc("cnt"), "tag")


def tagged_only(messages: DataFrame, text: str = "text") -> DataFrame:
    """Messages with at least one tag: the population the sample is drawn from."""
    return messages.where(F.size(tags(F.col(text))) > 0)
