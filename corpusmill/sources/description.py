"""Corpora described by a tab-separated list of files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sentences import split_text
from ..functions.text import estimate_tokens, java_lines, split_on_space, split_tabs
from ..operators.metadata import FIELDS, append_all, seed_record
from .base import read_files

# Columns of the list, by what they hold; the last one may be absent.
COLUMNS = {
    "stem": 0, "path": 1, "CollectionDate": 2, "Author": 4, "DocumentTitle": 8, "PublicationDate": 9,
    "Url": 12, "TranslatedDocument": 13, "Type": 17, "Domain": 19, "Subdomain": 21,
}
LEAST_COLUMNS = 20
PREFIX = "bg_bnc_"
STYLE = "Administrative"
RESTRICTED = ("B-Science/", "C-MassMedia/", "D-Fiction/")
FREE_LICENCE, FREE_LINK = "CC0", "https://creativecommons.org/public-domain/cc0/"


def parse_description(rows: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed rows of the list, and the rows that are too short to use."""
    cut = rows.select(F.col(value).alias("value"), split_tabs(value).alias("f"))
    good = cut.where(F.size("f") >= LEAST_COLUMNS)
    named = good.select(*[F.coalesce(F.get("f", F.lit(i)), F.lit("")).alias(k) for k, i in COLUMNS.items()])
    return named, cut.where(F.size("f") < LEAST_COLUMNS).select("value")


def is_mass_media(path: Column) -> Column:
    return path.contains("C-MassMedia/")


def is_informal(path: Column) -> Column:
    return path.contains("F-InformalFiction")


def licence(path: Column) -> tuple[Column, Column]:
    """Licence and its link, by sub-corpus."""
    closed = F.lit(False)
    for part in RESTRICTED:
        closed = closed | path.contains(part)
    return F.when(closed, "Restricted").otherwise(FREE_LICENCE), F.when(closed, "").otherwise(FREE_LINK)


def normal_date(c: str | Column) -> Column:
    """Dots made hyphens, order as it is."""
    return F.replace(F.col(c) if isinstance(c, str) else c, F.lit("."), F.lit("-"))


def selected(description: DataFrame, included: Callable[[Column], Column], exclude_url: str | None = "setimes") -> DataFrame:
    """Rows of the wanted sub-corpus; those whose URL holds a word are left out, case counting."""
    kept = description.where(included(F.col("path")))
    return kept if exclude_url is None else kept.where(~F.col("Url").contains(exclude_url))


def text_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, NumberWords, NumberSentences, NumberParagraphs, NumberTokens): every line is a paragraph, sentences are found line by line; null has none."""
    cut = docs.select(key, java_lines(F.coalesce(F.col(text), F.lit(""))).alias("l")).withColumn("s", F.flatten(F.transform("l", split_text)))
    add = lambda f: F.aggregate("s", F.lit(0), lambda n, x: n + f(x))
    return cut.select(
        key,
        add(lambda x: F.size(split_on_space(x))).alias("NumberWords"),
        F.size("s").alias("NumberSentences"),
        F.size("l").alias("NumberParagraphs"),
        add(estimate_tokens).alias("NumberTokens"),
    )


def join_files(description: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their text, and rows whose file (path, text) is missing."""
    return description.join(files.select("path", "text"), "path"), description.join(files.select("path"), "path", "left_anti")


def extract_rows(matched: DataFrame, free: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents and seed records; ``free`` gives all the open licence."""
    named = matched.withColumn("doc_id", F.concat(F.lit(PREFIX), "stem"))
    counts = text_counts(named)
    rows = named.drop("text").join(counts, "doc_id")
    name, link = (F.lit(FREE_LICENCE), F.lit(FREE_LINK)) if free else licence(F.col("path"))
    values = {k: F.col(k) for k in COLUMNS if k in FIELDS} | {k: F.col(k) for k in counts.columns if k in FIELDS}
    values |= {"Licence": name, "LicenceLink": link, "Style": F.lit(STYLE), "PublicationDate": normal_date("PublicationDate")}
    seed = [values.get(k, c).alias(k) for k, c in zip(FIELDS, seed_record(F.col("doc_id")))]
    return named.select("doc_id", F.col("path").alias("file_name"), "text"), rows.select(*seed)


@dataclass(frozen=True)
class DescriptionSource:
    """Files named by a list; ``included`` chooses the sub-corpus by path."""

    description_path: str
    included: Callable[[Column], Column] = is_mass_media
    exclude_url: str | None = "setimes"
    free: bool = False

    def extract(self, spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
        listed, _ = parse_description(spark.read.text(self.description_path))
        root = path.rstrip("/") + "/"
        files = read_files(spark, path).withColumn("path", F.substring_index("path", root, -1))
        matched, _ = join_files(selected(listed, self.included, self.exclude_url), files)
        return extract_rows(matched, self.free)


def wiki_source(description_path: str) -> DescriptionSource:
    """The informal sub-corpus: openly licensed, no URL left out."""
    return DescriptionSource(description_path, is_informal, None, True)


def append_seeds(existing: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Seed records added to those there are; nothing there is a fresh start."""
    return batch if existing is None else append_all(existing, batch)
