"""The registered ``opN_*`` queries: thin views over the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_text, langid, near_dup, repeats, secrets, suffix_tree, vectors, warc
from .common import table

RANKS = "byte_bpe_50k.tiktoken"


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids, and give digests of both."""
    path = public_tokenizers.path(RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of a label whose cosine is 0.93 or more."""
    found = vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to seekable bundles and read all records back."""
    folder = warc.new_folder(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = warc.write(warc.plan(pages, "page_id", "url", "html"), folder)
    return warc.read(index, folder, with_payload=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose word shingle sets have a similarity of 0.85 or more."""
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every byte that lies in a string of 100 bytes that starts earlier, too."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every document, and added ones that the corpus says are somebody's own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets.scan_corpus(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.render("base"), 256).alias("base_sha256"),
        secrets.render("spans").alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with a suffix tree learned from nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return suffix_tree.score(docs, held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document from dictionaries of labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.fit(docs.where(~held_out))
    return langid.classify(docs.drop("lang"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = decontaminate.n_hit()
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        decontaminate.digest().alias("items_sha256"),
        (hits > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


QUERIES = {
    "op1_bpe_roundtrip": op1_bpe_roundtrip,
    "op2_near_vectors": op2_near_vectors,
    "op3_warc": op3_warc,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_html_text": op5_html_text,
    "op6_repeats": op6_repeats,
    "op7_secret_scan": op7_secret_scan,
    "op8_lm_score": op8_lm_score,
    "op9_language_id": op9_language_id,
    "op10_decontaminate": op10_decontaminate,
}
ORACLES: dict[str, str] = {}
