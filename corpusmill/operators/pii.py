"""Personal data in sentences: spans, flagged tokens and coverage.

Detectors are patterns with validators. Spans are found in the order of the
policy; a token that several spans touch has the type of the last one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import RX_PII_CHARS, col, java_trim, split_space

#: Sentences of fewer tokens are not searched.
MIN_WORDS = 3


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def luhn(s: Column) -> Column:
    """The check sum of card numbers, from the last digit on."""
    d = F.split(F.reverse(_digits(s)), "")
    d = F.filter(d, lambda x: x != "")
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 1, x.cast("int") * 2).otherwise(x.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda n, x: n + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def mod97(s: Column) -> Column:
    """The check of international account numbers."""
    plain = F.upper(F.regexp_replace(s, r"\s", ""))
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    values = F.transform(
        F.filter(F.split(moved, ""), lambda x: x != ""),
        lambda x: F.when(x.rlike("[0-9]"), F.try_to_number(x, F.lit("9")).cast("int")).otherwise(F.ascii(x) - 55),
    )
    return F.aggregate(values, F.lit(0), lambda n, v: (n * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def octets(s: Column) -> Column:
    return F.forall(F.split(s, r"\."), lambda x: x.cast("int") <= 255) | s.contains(":")


def vin_check(s: Column) -> Column:
    """The ninth character of a vehicle number."""
    weights = (8, 7, 6, 5, 4, 3, 2, 10, 0, 9, 8, 7, 6, 5, 4, 3, 2)
    plain = F.translate(F.upper(s), "ABCDEFGHJKLMNPRSTUVWXYZ", "12345678123457923456789")
    total = sum((F.substring(plain, i + 1, 1).cast("int") * w for i, w in enumerate(weights)), F.lit(0)) % 11
    return F.substring(F.upper(s), 9, 1) == F.when(total == 10, "X").otherwise(total.cast("string"))


@dataclass(frozen=True)
class Detector:
    pattern: str
    valid: Callable[[Column], Column] | None = None


#: The default policy: fourteen types found by pattern; the fifteenth, ``person``, comes with a dictionary (``policy_with_people``).
POLICY: dict[str, Detector] = {
    "emailAddress": Detector(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"),
    "phoneNumber": Detector(r"\+[0-9]{1,3}[ \-]?\(?[0-9]{2,4}\)?[ \-]?[0-9]{3}[ \-]?[0-9]{3,4}"),
    "ipAddress": Detector(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){7}", octets),
    "url": Detector(r"https?://[^\s]+|www\.[^\s]+\.[^\s]+"),
    "creditCard": Detector(r"[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}", luhn),
    "ssn": Detector(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "ibanCode": Detector(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?", mod97),
    "bankAccountNumber": Detector(r"(?:acct|account)[.: #]*[0-9]{8,17}"),
    "date": Detector(r"[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    "age": Detector(r"[0-9]{1,3}[ \-](?:years?[ \-]old|годин[аи])"),
    "macAddress": Detector(r"[0-9A-Fa-f]{2}(?:[:\-][0-9A-Fa-f]{2}){5}"),
    "bitcoinAddress": Detector(r"(?:bc1|[13])[a-km-zA-HJ-NP-Z1-9]{25,39}"),
    "vin": Detector(r"[A-HJ-NPR-Z0-9]{17}", vin_check),
    "zipCode": Detector(r"[0-9]{5}-[0-9]{4}"),
}


#: Found in every text that a detector of the default policy matches in; most sentences have none of it.
HINT = r"[0-9@]|www\.|https?://|[A-Fa-f]{2}[:\-][A-Fa-f]{2}|(?:[A-Fa-f]{1,4}:){7}|[A-HJ-NPR-Z]{17}"


def policy_with_people(names: list[str], base: dict[str, Detector] | None = None) -> dict[str, Detector]:
    """The policy with a dictionary of personal names."""
    import re

    found = dict(POLICY if base is None else base)
    if names:
        found["person"] = Detector("|".join(re.escape(n) for n in sorted(names, key=lambda n: (-len(n), n))))
    return found


def pii_tokens(sentence: str | Column) -> Column:
    """Tokens with all but letters, digits and ``@ . _ + -`` deleted; empty ones dropped."""
    cut = F.transform(split_space(java_trim(sentence)), lambda t: F.regexp_replace(t, RX_PII_CHARS, ""))
    return F.filter(cut, lambda t: t != "")


def spans_of(sentence: str | Column, kind: str, detector: Detector) -> Column:
    """(start, end, type) of one detector: lengths of what lies between matches and of the matches, added up."""
    text = col(sentence)
    found = F.regexp_extract_all(text, F.lit(f"({detector.pattern})"), F.lit(1))
    between = F.split(text, detector.pattern, -1)
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,type:string>>").alias("out"))

    def step(acc, pair):
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("type"))
        good = detector.valid(pair["hit"]) if detector.valid else F.lit(True)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, none, step, lambda acc: acc["out"])).otherwise(none["out"])


def all_spans(sentence: str | Column, policy: dict[str, Detector] | None = None) -> Column:
    """Spans of all detectors, in the order of the policy."""
    found = [spans_of(sentence, k, d) for k, d in (POLICY if policy is None else policy).items()]
    return F.concat(*found) if found else F.array().cast("array<struct<start:int,end:int,type:string>>")


def token_offsets(sentence: str | Column, tokens: str | Column) -> Column:
    """(start, end) of each token, each searched from the end of the one found before; one not found starts there and does not move it."""
    text = col(sentence)
    none = F.struct(F.lit(0).alias("cursor"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, token):
        at = F.position(token, text, acc["cursor"] + 1) - 1
        start = F.when(at < 0, acc["cursor"]).otherwise(at)
        end = start + F.length(token)
        place = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        return F.struct(F.when(at < 0, acc["cursor"]).otherwise(end).cast("int").alias("cursor"), F.concat(acc["out"], F.array(place)).alias("out"))

    return F.aggregate(col(tokens), none, step, lambda acc: acc["out"])


def score_sentences(sentences: DataFrame, sentence: str = "sentence", policy: dict[str, Detector] | None = None) -> DataFrame:
    """Add totalWords, spans, tokenTypes (null where no span touches), piiTokens, piiCoverage and typeFrequency.

    Sentences of fewer than three tokens have a zero score.
    """
    none = F.array().cast("array<struct<start:int,end:int,type:string>>")
    counted = sentences.withColumn("tokens", pii_tokens(sentence)).withColumn("totalWords", F.size("tokens"))
    worth = F.col("totalWords") >= MIN_WORDS
    if all(POLICY.get(k) == d for k, d in (policy or {}).items()):
        worth &= col(sentence).rlike(HINT)
    searched = counted.withColumn("spans", F.when(worth, all_spans(sentence, policy)).otherwise(none))
    placed = searched.withColumn("offsets", F.when(F.size("spans") > 0, token_offsets(sentence, "tokens")))
    touches = lambda t: F.filter("spans", lambda s: (t["start"] < s["end"]) & (t["end"] > s["start"]))
    touching = F.transform("offsets", lambda t: F.get(F.reverse(touches(t)), F.lit(0))["type"])
    typed = placed.withColumn("tokenTypes", F.coalesce(touching, F.array().cast("array<string>")))
    held = typed.withColumn("piiTypes", F.filter("tokenTypes", lambda t: t.isNotNull()))
    kinds = F.array_distinct("piiTypes")
    return (
        held.withColumn("piiTokens", F.size("piiTypes"))
        .withColumn("piiCoverage", F.coalesce(F.try_divide(F.col("piiTokens"), F.col("totalWords")), F.lit(0.0)))
        .withColumn(
            "typeFrequency",
            F.map_from_arrays(kinds, F.transform(kinds, lambda k: F.size(F.filter("piiTypes", lambda t: t == k)))),
        )
        .drop("offsets")
    )


def span_count(kind: str, spans: str = "spans") -> Column:
    """Number of spans of one type."""
    return F.size(F.filter(spans, lambda s: s["type"] == kind))


def type_frequency_text(c: str | Column = "typeFrequency") -> Column:
    """``type=count`` in alphabetical order, joined by semicolons."""
    entries = F.array_sort(F.map_entries(col(c)))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")


def report(scored: DataFrame, file: str, sentence: str = "sentence") -> DataFrame:
    """Rows of the report: sentences with personal data only, tabs made spaces."""
    return scored.where("piiTokens > 0").select(
        F.col(file).alias("file"),
        F.translate(sentence, "\t", " ").alias("sentence"),
        "totalWords",
        "piiTokens",
        F.round("piiCoverage", 4).alias("piiCoverage"),
        F.round(F.col("piiCoverage") * 100, 2).alias("piiCoveragePercent"),
        F.array_join(F.array_sort(F.map_keys("typeFrequency")), ";").alias("distinctPiiTypes"),
        type_frequency_text().alias("typeFrequency"),
    )
