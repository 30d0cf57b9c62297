"""Bias lexicons from tab-separated files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank, java_lines, java_trim, split_tabs
from .base import read_files

#: Rows of fewer columns are skipped.
LEAST_COLUMNS = 10


def parse_lexicon(rows: DataFrame, value: str = "value", line_no: str = "line_no") -> DataFrame:
    """Entries of lexicon lines numbered from 0, of which line 0 is the header.

    Blank and short lines are skipped; booleans are ``true`` in any case; numbers
    that cannot be read are 0; the forms are the word and those listed, trimmed,
    in lower case, without blanks.
    """
    f = split_tabs(value, keep_trailing=True)
    cut = rows.where((F.col(line_no) > 0) & ~is_blank(value)).select(F.col(line_no).alias("line_no"), f.alias("f")).where(F.size("f") >= LEAST_COLUMNS)
    at = lambda i: java_trim(F.coalesce(F.get("f", F.lit(i)), F.lit("")))
    flag = lambda i: F.lower(at(i)) == "true"
    number = lambda i: F.coalesce(at(i).try_cast("double"), F.lit(0.0))
    listed = F.transform(F.split(at(10), r"\|", -1), lambda x: F.lower(java_trim(x)))
    forms = F.array_distinct(F.filter(F.concat(F.array(F.lower(at(0))), listed), lambda x: x != ""))
    return cut.select(
        "line_no",
        at(0).alias("word"),
        at(1).alias("pos"),
        flag(2).alias("signal"),
        at(3).alias("bias_type"),
        at(4).alias("bias_value"),
        flag(5).alias("derogatory"),
        flag(6).alias("colloquial"),
        number(8).alias("positivity"),
        number(9).alias("negativity"),
        forms.alias("forms"),
    )


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    files = read_files(spark, path)
    return parse_lexicon(files.select(F.posexplode(java_lines("text")).alias("line_no", "value")))


def unknown_types(lexicon: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """Entries whose type is none of the known ones; they match but pair with nothing."""
    typed: Column = F.col("bias_type") != ""
    return lexicon.where(typed & ~F.col("bias_type").isin(list(known)))
