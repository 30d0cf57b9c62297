"""Boilerplate lines: learn frequent ones, filter by them and by patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, java_lines, java_trim

#: Lines shorter than this are always kept.
SHORTEST = 3

# Patterns whose presence anywhere in a trimmed line drops the line.
PATTERNS = {
    "P01": r"(?i)^\s*<[^>]+>\s*$",
    "P02": r"(?i)<(script|style|head|meta|link|iframe)[^>]*>",
    "P03": r"(?i)</(script|style|head|body|html)>",
    "P04": r"(?i)<!--.*-->",
    "P05": r"(?i)&(nbsp|amp|lt|gt|quot|apos);",
    "P06": r"(?i)<\?php",
    "P07": r"\?>",
    "P08": r"<%.*%>",
    "P09": r"(?i)^\s*(home|начало|меню|menu|навигация|navigation|търсене|search|вход|login|изход|logout"
    r"|регистрация|register|контакти|contacts|за нас|about us|sitemap|карта на сайта)\s*$",
    "P10": r"(?i)^\s*(next|prev|previous|следващ|предишен|напред|назад|нагоре|back|forward|top|горе)\s*$",
    "P11": r"^\s*\|.*\|\s*$",
    "P12": r"^\s*(>\s*){2,}",
    "P13": r"^\s*(\d+\.?\s+){3,}$",
    "P14": r"(?i)\bhttps?://\S+",
    "P15": r"(?i)\bwww\.\S+\.\S+",
    "P16": r"(?i)\bftp://\S+",
    "P17": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}",
    "P18": r"(?i)(бисквитки|cookies|gdpr|privacy policy|поверителност|приемам|accept all|отхвърлям|decline|consent"
    r"|лични данни|personal data|условия за ползване|terms of (use|service)|политика за)",
    "P19": r"(?i)^\s*(share|сподели|like|харесай|tweet|retweet|pinterest|linkedin|facebook|twitter|instagram"
    r"|google\+?|youtube|tiktok|viber|whatsapp)\s*$",
    "P20": r"(?i)google.analytics",
    "P21": r"(?i)ga\s*\(\s*['\"]",
    "P22": r"(?i)gtag\s*\(",
    "P23": r"(?i)_gaq\.push",
    "P24": r"(?i)^\s*страница\s+\d+\s*(от\s+\d+)?\s*$",
    "P25": r"(?i)^\s*page\s+\d+\s*(of\s+\d+)?\s*$",
    "P26": r"^\s*©",
    "P27": r"(?i)^\s*all rights reserved",
    "P28": r"(?i)^\s*права запазени",
    "P29": r"^[\s\p{Punct}]+$",
}


def check_threshold(threshold: float) -> float:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError(f"a threshold lies in [0, 1], not at {threshold}")
    return threshold


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no from 1, raw, line) with ``line`` trimmed; a document without lines has no rows."""
    exploded = docs.select(key, F.posexplode(java_lines(text)).alias("at", "raw"))
    return exploded.select(key, (F.col("at") + 1).alias("line_no"), "raw", java_trim("raw").alias("line"))


def learn_blocklist(docs: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(line, n_files) of lines in at least ``threshold`` of all documents, each counted once per document.

    Empty documents count towards the total. Line counts are summed in two steps,
    by line and document first, so a line that all documents share is spread.
    """
    check_threshold(threshold)
    counted = line_frequency(docs, key, text)
    total = docs.agg(F.countDistinct(key).alias("total"))
    return counted.crossJoin(F.broadcast(total)).where(F.col("n_files") >= F.lit(threshold) * F.col("total")).drop("total")


def line_frequency(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(line, n_files) of all trimmed lines of at least three characters."""
    own = lines(docs, key, text).where(F.length("line") >= SHORTEST).select("line", key).distinct()
    return own.groupBy("line").agg(F.count(F.lit(1)).alias("n_files"))


def pattern_hit(line: str | Column = "line") -> Column:
    """Whether any pattern is found in a trimmed line."""
    hit = F.lit(False)
    for pattern in PATTERNS.values():
        hit = hit | col(line).rlike(pattern)
    return hit


def judged_lines(docs: DataFrame, blocklist: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines with ``removed``: cheapest test first; the blocklist is joined by equality and broadcast only if it is small."""
    own = lines(docs, key, text)
    listed = blocklist.select("line", F.lit(True).alias("listed")).distinct()
    joined = own.join(listed, "line", "left")
    removed = (F.length("line") >= SHORTEST) & (F.coalesce("listed", F.lit(False)) | pattern_hit())
    return joined.select(key, "line_no", "raw", "line", removed.alias("removed"))


def clean(docs: DataFrame, blocklist: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, lines_removed): kept lines in order, each ended by a line feed. All documents stay.

    Documents that lose nothing keep their text as it is.
    """
    judged = judged_lines(docs, blocklist, key, text)
    kept = F.collect_list(F.when(~F.col("removed"), F.struct("line_no", "raw")))
    joined = F.concat_ws("", F.transform(F.array_sort(kept), lambda x: F.concat(x["raw"], F.lit("\n"))))
    cleaned = judged.groupBy(key).agg(joined.alias("cleaned"), F.count_if("removed").alias("lines_removed"))
    return docs.select(key, text).join(cleaned, key, "left").select(
        key,
        F.when(F.col("lines_removed") > 0, F.col("cleaned")).otherwise(F.col(text)).alias(text),
        F.coalesce("lines_removed", F.lit(0)).alias("lines_removed"),
    )


def top_lines(frequency: DataFrame, n: int = 20) -> DataFrame:
    """The most frequent lines, ties in alphabetical order."""
    return frequency.orderBy(F.desc("n_files"), "line").limit(n)


def render_blocklist(blocklist: DataFrame, threshold: float) -> DataFrame:
    """(at, value): the lines of a blocklist file, three comments and a blank before the entries."""
    head = blocklist.agg(F.count(F.lit(1)).alias("n")).select(
        F.posexplode(
            F.array(
                F.lit("# corpus blocklist"),
                F.concat(F.lit(f"# threshold={threshold}  entries="), F.col("n").cast("string")),
                F.lit("# Format: <frequency TAB line>"),
                F.lit(""),
            )
        ).alias("at", "value")
    )
    rank = F.struct((-F.col("n_files")).alias("f"), F.col("line").alias("l"))
    body = blocklist.select(F.lit(4).alias("at"), F.concat_ws("\t", F.col("n_files").cast("string"), "line").alias("value"), rank.alias("rank"))
    return head.select("at", "value", F.lit(None).cast(body.schema["rank"].dataType).alias("rank")).unionByName(body).orderBy("at", "rank").select("at", "value")


def parse_blocklist(rows: DataFrame, value: str = "value") -> DataFrame:
    """(line) of blocklist file lines: comments and blanks skipped, text after the first tab, trimmed, distinct."""
    from ..functions.text import is_blank

    content = F.regexp_replace(F.col(value), r"^[^\t]*\t", "")
    kept = rows.where(~F.col(value).startswith("#") & ~is_blank(value) & ~is_blank(content))
    return kept.select(java_trim(content).alias("line")).distinct()
