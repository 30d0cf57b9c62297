"""Text primitives as Column expressions.

Lines, trimming, blanks and splitting follow the conventions of the corpus
format: line ends of Unicode text files, trimming of control characters and
spaces but not of no-break spaces, and splits that drop trailing empty parts.
Null input gives null (or null arrays) throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define lines, trimming, blanks, punctuation and word characters.
RX_LINE = r"\r\n|[\n\r\u2028\u2029\u0085]"
RX_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
RX_BLANK = r"^[\s\x1c-\x1f\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]*$"
RX_PUNCT = r"[.,;:!?()\-]"
RX_PII_CHARS = r"[^\p{L}\p{N}@._+\-]"
RX_BIAS_CHARS = r"[^\p{L}\s]"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_lines(c: str | Column) -> Column:
    """Lines of a text; a final line end adds no line, and the empty text has none."""
    parts = F.split(col(c), RX_LINE, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def java_trim(c: str | Column) -> Column:
    """Without characters up to U+0020 at both ends."""
    return F.regexp_replace(col(c), RX_TRIM, "")


def is_blank(c: str | Column) -> Column:
    """Nothing but white space, no-break spaces not counting as such."""
    return col(c).rlike(RX_BLANK)


def split_space(c: str | Column) -> Column:
    """Parts between runs of ASCII white space; a leading empty part stays, trailing ones go."""
    text = col(c)
    cut = F.split(F.regexp_replace(text, r"\s+$", ""), r"\s+", -1)
    return F.when(text == "", F.array(F.lit(""))).when(~text.rlike(r"\S"), F.slice(cut, 1, 0)).otherwise(cut)


def word_count(c: str | Column) -> Column:
    """Number of parts of ``split_space``."""
    return F.size(split_space(c))


def split_on_space(c: str | Column) -> Column:
    """Parts between single spaces; inner empty parts stay, trailing ones go."""
    text = col(c)
    cut = F.split(F.rtrim(text), " ", -1)
    return F.when(text == "", F.array(F.lit(""))).when(F.rtrim(text) == "", F.slice(cut, 1, 0)).otherwise(cut)


def split_tabs(c: str | Column, keep_trailing: bool = False) -> Column:
    """Fields between tabs; trailing empty fields go unless they are asked for."""
    text = col(c)
    if keep_trailing:
        return F.split(text, "\t", -1)
    cut = F.split(F.regexp_replace(text, r"\t+$", ""), "\t", -1)
    return F.when(text == "", F.array(F.lit(""))).when(text.rlike(r"^\t+$"), F.slice(cut, 1, 0)).otherwise(cut)


def punctuation_count(c: str | Column) -> Column:
    text = col(c)
    return F.length(text) - F.length(F.regexp_replace(text, RX_PUNCT, ""))


def estimate_tokens(c: str | Column) -> Column:
    """Parts between single spaces plus punctuation marks."""
    return F.size(split_on_space(c)) + punctuation_count(c)


def count_tokens(c: str | Column) -> Column:
    """White-space separated words plus punctuation marks."""
    return word_count(c) + punctuation_count(c)


def every_shingle(c: str | Column, size: int = 5) -> Column:
    """Lower-case substrings of ``size`` characters, in linear time (a look-ahead, not repeated substrings)."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def shingles(c: str | Column, size: int = 5) -> Column:
    """Distinct lower-case substrings of ``size`` characters."""
    return F.array_distinct(every_shingle(c, size))
