"""One query per operator, over whole tables and whole texts."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvein.llm.alignment import align_corpus
from tallyvein.llm.bpe import token_digests
from tallyvein.llm.decontamination import leaks
from tallyvein.llm.exact_dedup import EXACT_DEDUP_SQL, duplicate_groups, lower_az
from tallyvein.llm.fingerprints import edited_fingerprints
from tallyvein.llm.html import extract_main
from tallyvein.llm.language import fit_languages, identify
from tallyvein.llm.licenses import LICENSE_SQL, license_report
from tallyvein.llm.ngram_join import ngram_components
from tallyvein.llm.quality import ACCEPT, Model, fit_quality, quality_scores
from tallyvein.llm.registry import QUERIES, SQL, query  # noqa: F401
from tallyvein.llm.secrets import EXAMPLE_OWNERS, secret_report
from tallyvein.llm.suffix_dedup import repeated_strings
from tallyvein.llm.whitening import whitened
from tallyvein.sources.readers import table

#: Fixed by the query's contract.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@query()
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_components(table(spark, folder, "documents"), "doc_id", "text", 3, Fraction(9, 10))


@query()
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"), WORD_BPE)


@query()
def op9_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """A document is a repository here, its source the owner."""
    return secret_report(table(spark, folder, "documents"), "doc_id", "text", F.col("doc_id"), F.col("source"), EXAMPLE_OWNERS - 1)


@query()
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Leaking documents only, with the items and stretches."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def part(parts: int) -> Column:
    """The remainder that decides about held-out documents."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def quality_model(spark: SparkSession, docs: DataFrame, folder: str) -> Model:
    return fit_quality(docs, table(spark, folder, "labels"), learn=part(5) != 0)


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality_scores(docs, quality_model(spark, docs, folder))
    return scored.select("doc_id", (part(5) == 0).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


@query()
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    named = identify(docs, fit_languages(docs, learn=part(4) != 2))
    return named.select("doc_id", (part(4) == 2).alias("held_out"), "lang_pred", "score")


@query(LICENSE_SQL)
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_report(table(spark, folder, "documents"), every_start=True)


@query()
def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_main(table(spark, folder, "pages"), "page_id", "html", ("url",))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(spark, folder, "documents"))


@query()
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_strings(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query(EXACT_DEDUP_SQL)
def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return duplicate_groups(docs, carry={"text_sha256": F.sha2(lower_az(F.col("text")).cast("binary"), 256)})


@query()
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_corpus(table(spark, folder, "documents"), BYTE_BPE, PIECE_BPE)


@query()
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings"))
