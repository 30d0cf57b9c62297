"""Word, token, sentence and paragraph counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sentences import Splitter, document_sentences, split_text
from ..functions.text import count_tokens, is_blank, word_count
from .clean import lines


def split_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", splitter: Splitter = split_text) -> DataFrame:
    """(key, sentences) of each document."""
    return docs.select(key, document_sentences(text, splitter).alias("sentences"))


def rows_of(split: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, sent_no from 1, sentence) of split documents."""
    exploded = split.select(key, F.posexplode("sentences").alias("at", "sentence"))
    return exploded.select(key, (F.col("at") + 1).alias("sent_no"), "sentence")


def counts_of(split: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, NumberSentences, NumberWords, NumberTokens) of split documents."""
    add = lambda f: F.aggregate("sentences", F.lit(0), lambda n, s: n + f(s))
    return split.select(
        key,
        F.size("sentences").alias("NumberSentences"),
        add(word_count).alias("NumberWords"),
        add(count_tokens).alias("NumberTokens"),
    )


def sentence_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", splitter: Splitter = split_text) -> DataFrame:
    """(key, sent_no from 1, sentence)."""
    return rows_of(split_documents(docs, key, text, splitter), key)


def sentence_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", splitter: Splitter = split_text) -> DataFrame:
    """(key, NumberSentences, NumberWords, NumberTokens), computed in place: no row moves."""
    return counts_of(split_documents(docs, key, text, splitter), key)


def paragraph_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, NumberParagraphs): runs of non-blank lines, one at least. Gaps and islands over each document's lines."""
    order = Window.partitionBy(key).orderBy("line_no")
    marked = lines(docs, key, text).withColumn("blank", is_blank("raw"))
    started = marked.withColumn("start", ~F.col("blank") & F.coalesce(F.lag("blank").over(order), F.lit(True)))
    runs = started.groupBy(key).agg(F.count_if("start").alias("n"))
    return docs.select(key).join(runs, key, "left").select(key, F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)).alias("NumberParagraphs"))


def run_totals(counts: DataFrame) -> DataFrame:
    """One row: documents, those without sentences, and sums of the counts."""
    return counts.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("NumberSentences") == 0).alias("errors"),
        F.coalesce(F.sum("NumberSentences"), F.lit(0)).alias("sentences"),
        F.coalesce(F.sum("NumberWords"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("NumberTokens"), F.lit(0)).alias("tokens"),
    )
