"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept. All but the last return the columns of ``documents``. Decisions are
carried by row, so rows that repeat an id, or have none, are judged one by one, and
extra columns are carried through; a null text has no letter, so the first stage
rejects it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, decontaminate, langid, near_dup, secrets
from corpusmill.llm.common import materialize, table

RANKS = "byte_bpe_50k.tiktoken"
#: Similarity, in percent, from which documents are near copies.
NEAR_PERCENT = 80
#: Margin below which the language of a text of some length is rejected.
REJECT_BELOW = 0.004
#: Column that numbers rows within a stage.
ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number each: the id where all ids differ; else one that is stored, so that a lost task does not number them anew."""
    rows, distinct = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).head()
    if rows == distinct:
        return docs.withColumn(ROW, F.col("doc_id").cast("long"))
    return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters or in no language; where the margin is clear, the language found replaces the stated one."""
    found = langid.classify(docs, langid.fit(docs), reject_below=REJECT_BELOW, out="__lang", score="__margin")
    known = found.where(F.col("__lang") != langid.UNKNOWN)
    clear = F.col("lang").isNull() | (F.col("__margin") >= langid.NARROW)
    return known.withColumn("lang", F.when(clear, F.col("__lang")).otherwise(F.col("lang"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group of near copies."""
    rows = numbered(docs)
    found = near_dup.near_duplicates(rows, key=ROW, percent=NEAR_PERCENT).select(F.col(ROW).alias("row"), F.col("component_id").alias("group"))
    ranked = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    first = found.join(rows.select("doc_id", ROW), F.col("row") == F.col(ROW)).groupBy("group").agg(F.min(ranked)[ROW].alias(ROW))
    return rows.join(first, ROW, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that a benchmark passage occurs in."""
    return decontaminate.clean(numbered(docs), table(spark, sf_dir, "benchmark"), ROW).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in texts; all documents stay."""
    masked = secrets.mask_corpus(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back."""
    path = public_tokenizers.path(RANKS)
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        bpe.n_tokens().alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe", encode),
]

#: No stage can be stated in SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written as a table and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
