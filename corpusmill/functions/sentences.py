"""Rule-based sentence splitting as Column expressions.

A sentence ends after one or more of ``. ! ? …``, with closing quotes or
brackets, where white space and a capital, a digit or an opening quote follow.
There is no boundary after a listed abbreviation or a lone capital initial. The
rules use no look-around, so other engines can state them, too. Functions that take a
``splitter`` work with any other one: a text column in, an array of sentences out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, is_blank, java_lines, java_trim, word_count

#: Abbreviations that do not end a sentence.
ABBREVIATIONS = ("г", "ул", "др", "гр", "бл", "проф", "стр", "чл", "ал", "т", "Dr", "Mr", "Mrs", "St", "vs")
#: Texts shorter than this are one sentence.
SHORTEST = 5
_MARK, _HOLD, _ESCAPE = "\u0001", "\u0002", "\u0003"
#: How the three marks are written where a text holds them itself.
_WRITTEN = {_ESCAPE: _ESCAPE + "c", _HOLD: _ESCAPE + "b", _MARK: _ESCAPE + "a"}
Splitter = Callable[[str | Column], Column]
_PROTECT = rf"(^|[\s(„\"])({'|'.join(ABBREVIATIONS)}|[A-ZА-Я])\."
_BOUNDARY = r"([.!?…]+[»”\"')\]]*)\s+([\p{Lu}\p{N}„«“\"'(])"


def _restored(c: Column) -> Column:
    for mark, written in reversed(_WRITTEN.items()):
        c = F.replace(c, F.lit(written), F.lit(mark))
    return c


def split_text(c: str | Column) -> Column:
    """Sentences of a text: null and blank give none, a very short text itself."""
    text = java_trim(c)
    free = text
    for mark, written in _WRITTEN.items():
        free = F.replace(free, F.lit(mark), F.lit(written))
    held = F.regexp_replace(free, _PROTECT, f"$1$2{_HOLD}")
    # neighbouring boundaries share a character, so two passes mark all of them
    marked = F.regexp_replace(held, _BOUNDARY, f"$1{_MARK}$2")
    marked = F.regexp_replace(marked, _BOUNDARY, f"$1{_MARK}$2")
    parts = F.transform(F.split(marked, _MARK, -1), lambda s: java_trim(_restored(F.translate(s, _HOLD, "."))))
    none = F.filter(F.array(F.lit("")), lambda s: s != "")
    return (
        F.when(text.isNull() | (text == ""), none)
        .when(F.length(text) < SHORTEST, F.array(text))
        .otherwise(F.filter(parts, lambda s: s != ""))
    )


def split_paragraphs(paragraphs: str | Column, splitter: Splitter = split_text) -> Column:
    """Sentences of all non-blank paragraphs in order; null gives none."""
    kept = F.filter(F.coalesce(col(paragraphs), F.array().cast("array<string>")), lambda p: p.isNotNull() & ~is_blank(p))
    return F.flatten(F.transform(kept, lambda p: splitter(p)))


def split_and_filter(c: str | Column, min_words: int, splitter: Splitter = split_text) -> Column:
    """Sentences of at least ``min_words`` white-space separated words."""
    return F.filter(splitter(c), lambda s: word_count(s) >= min_words)


def sentence_probabilities(c: str | Column) -> Column:
    """A rule has no confidence: null for every sentence."""
    return F.transform(split_text(c), lambda s: F.lit(None).cast("double"))


def document_sentences(c: str | Column, splitter: Splitter = split_text) -> Column:
    """Sentences as a sidecar file keeps them: one line each, trimmed, blanks dropped, so inner line ends split too."""
    lines = F.flatten(F.transform(splitter(F.array_join(java_lines(c), "\n")), java_lines))
    return F.filter(F.transform(lines, java_trim), lambda s: ~is_blank(s))


def joined_sentences(c: str | Column, splitter: Splitter = split_text) -> Column:
    """Sentences of the lines joined by spaces, as the directory reports take them."""
    return splitter(F.array_join(java_lines(c), " "))
