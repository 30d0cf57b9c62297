"""Secret scan with corpus-wide ownership frequency.

One pass finds candidates in whole texts: three base kinds that are always
reported, and further kinds that are reported only where the corpus says that
they belong to somebody. For that, candidate values are hashed and counted by
distinct owners and repositories: a value that many owners hold is a copied
example, one that a single owner holds and that looks random is a live-looking
credential.

Defined results: a null text is the empty text without spans; owners or
repositories that are null count as one owner or repository of their own;
repeated documents count once per repository; rows that repeat a key, or have
none, get the spans of their own text; overlapping spans of different kinds are
all reported; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from .common import add_columns, join_keyed, materialize

# The base kinds, in the order in which spans at one place are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")

#: Further kinds, with what tells them apart.
ADDED = {
    "private_key": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    "jwt": re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    "vendor": re.compile(r"\b(?:gh[pousr]_|xox[abprs]-|sk_live_|glpat-|AIza)[A-Za-z0-9_-]{16,}"),
    "random": re.compile(r"[A-Za-z0-9+/_-]{20,}"),
}
KINDS = (*BASE, *ADDED)
#: A value held by at least so many owners is a copied example.
EXAMPLE_OWNERS = 3
#: Bits per character from which a value of kind ``random`` looks random.
RANDOM_BITS = 3.5

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("value_hash", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("lively", T.BooleanType()),
    ]
)


def _bits(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _looks_random(value: str) -> bool:
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return kinds >= 2 and any(c.isdigit() for c in value) and _bits(value) >= RANDOM_BITS


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def scan(text: str | None) -> list[tuple]:
    """Candidates of one text as (kind, start, end, hash, rank of kind, looks live), by start, then rank."""
    if not text:
        return []
    found = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            found.append((0, *m.span(), m[2]))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 20:
            found.append((1, *m.span(), m[0]))
    found += [(2, *m.span(), m[0]) for m in HEX.finditer(text)]
    taken = bytearray(len(text)) if found else bytearray()
    for _, start, end, _ in found:
        taken[start:end] = b"\1" * (end - start)
    for rank, (kind, pattern) in enumerate(ADDED.items(), len(BASE)):
        if kind == "random" and not any(c in text for c in "0123456789"):
            continue
        for m in pattern.finditer(text):
            start, end = m.span()
            if kind == "random" and (not _looks_random(m[0]) or taken.find(1, start, end) >= 0):
                continue
            found.append((rank, start, end, m[0]))
            taken = taken or bytearray(len(text))
            taken[start:end] = b"\1" * (end - start)
    found.sort(key=lambda x: (x[1], x[0], x[2]))
    return [(KINDS[k], a, b, _hash(v), k, k not in (0, 2) or _bits(v) >= 2.5) for k, a, b, v in found]


def candidates(df: DataFrame, text: str = "text", out: str = "candidates") -> DataFrame:
    """Add the array of candidate spans of the whole text; code points, ends exclusive."""
    return add_columns(df, lambda: lambda texts: {out: [scan(x) for x in texts]}, text, **{out: T.ArrayType(SPAN)})


def ownership(found: DataFrame, owner: str, repo: str) -> DataFrame:
    """By ``value_hash``: distinct owners, distinct repositories, and occurrences.

    Counted in three steps of partial sums, so a value that a third of all rows
    hold never gathers its rows in one task.
    """
    pairs = found.groupBy("value_hash", F.col(owner).alias("owner"), F.col(repo).alias("repo")).count()
    by_owner = pairs.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("count").alias("n"))
    return by_owner.groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_found")
    )


def _spans(scanned: DataFrame) -> DataFrame:
    """row and its spans, of rows that have any, from (row, owner, repo, candidates)."""
    found = scanned.select("row", "owner", "repo", F.explode("candidates").alias("c")).select("row", "owner", "repo", "c.*")
    found = materialize(found, "candidates")
    owned = materialize(ownership(found, "owner", "repo"), "ownership")
    judged = join_keyed(found.drop("owner", "repo"), owned, "value_hash", "n_found").withColumn(
        "live", F.col("lively") & (F.col("n_owners") < EXAMPLE_OWNERS)
    )
    kept = judged.where((F.col("rank") < len(BASE)) | F.col("live"))
    return kept.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind", "live"))).alias("spans")
    )


def scan_corpus(
    df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id"
) -> DataFrame:
    """Spans of every document: base ones, and added ones that have one or few owners.

    Returns key, ``base`` and ``spans`` (arrays of kind, start, end, rank, live),
    by start, then rank. ``live`` is false for values that at least
    ``EXAMPLE_OWNERS`` owners hold and for repetitive ones.
    """
    texts = df.select(F.col(key).alias("key"), F.col(owner).alias("owner"), F.col(repo).alias("repo"), F.col(text).alias("text"))
    scanned = candidates(texts).drop("text").withColumn("row", F.monotonically_increasing_id())
    scanned = materialize(scanned, "secrets")  # rows keep their numbers from here on
    spans = _spans(scanned)
    empty = F.array().cast(spans.schema["spans"].dataType)
    joined = scanned.select("key", "row").join(spans, "row", "left").withColumn("spans", F.coalesce("spans", empty))
    return joined.select(F.col("key").alias(key), "spans", F.filter("spans", lambda s: s["rank"] < len(BASE)).alias("base"))


def render(spans: str):
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, text: str = "text", spans: str = "spans", mask: str = "[SECRET]") -> DataFrame:
    """Replace every span of the text by ``mask``; spans that overlap become one."""
    kind = df.schema[text].dataType

    def cut(row_text, row_spans):
        out, done = [], 0
        for s in row_spans or ():
            start, end = s["start"], s["end"]
            if end <= done:
                continue
            if start >= done:
                out += [row_text[done:start], mask]
            done = end
        return "".join(out) + row_text[done:]

    packed = df.withColumn("__both", F.struct(F.col(text).alias("text"), F.col(spans).alias("spans")))

    def make():
        return lambda rows: {text: [cut(r["text"], r["spans"]) if r["spans"] else r["text"] for r in rows]}

    return add_columns(packed, make, "__both", **{text: kind}).drop("__both").select(*df.columns)


def mask_corpus(df: DataFrame, text: str = "text", owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """``df`` with every span that ``scan_corpus`` finds masked.

    Base spans are masked where they are found; only rows with candidates that
    the corpus must judge are joined to its verdict, by a number of their own.
    """
    rows = candidates(df.withColumn("__row", F.monotonically_increasing_id()), text, "__candidates")
    rows = materialize(rows, "secrets")
    spans = _spans(rows.select(F.col("__row").alias("row"), F.col(owner).alias("owner"), F.col(repo).alias("repo"), F.col("__candidates").alias("candidates")))
    asked = F.exists("__candidates", lambda c: c["rank"] >= len(BASE))
    judged = rows.where(asked).join(spans.select(F.col("row").alias("__row"), F.col("spans").alias("__spans")), "__row", "left")
    certain = redact(rows.where(~asked), text, "__candidates").select(*df.columns)
    return certain.unionByName(redact(judged, text, "__spans").select(*df.columns))
