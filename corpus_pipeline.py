"""A corpus clean-up in stages, each one operator of ``tallyvein.llm``."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvein.llm.bpe import tokenized
from tallyvein.llm.decontamination import without_leaks
from tallyvein.llm.ngram_join import ngram_components
from tallyvein.llm.quality import keep_quality
from tallyvein.llm.queries import WORD_BPE, quality_model
from tallyvein.llm.secrets import free_prefix, redact
from tallyvein.session import Scratch
from tallyvein.sources.readers import table


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labelled documents among ``docs``."""
    return keep_quality(docs, quality_model(spark, docs, folder))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id, once.

    Groups are connected by a Jaccard similarity of 0.8 or more of five-word shingles. Documents without
    an id or without words stay. Columns may have any names.
    """
    text = f"{free_prefix(docs.columns)}text"
    classed = ngram_components(docs, "doc_id", "text", 5, Fraction(8, 10))
    kept = classed.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(*docs.columns, F.xxhash64("text").alias(text))
    named = named.dropDuplicates(["doc_id", text]).drop(text)
    return named.unionByName(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return without_leaks(docs, table(spark, folder, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Live-looking secrets are replaced in the text; all documents stay."""
    clean = redact(docs, "doc_id", "text", F.col("doc_id"), F.col("source"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def bpe(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    return tokenized(docs, WORD_BPE)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("BPE encoding and decoding", bpe),
]

#: The first stage is learned and the last is a tokenizer: SQL expresses neither. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, folder, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(stage(spark, docs, folder), f"stage-{i}")
        if i:
            scratch.drop(f"stage-{i - 1}")
    return STAGES[-1][1](spark, docs, folder)
