"""Bias counts of sentences against a lexicon that each worker can hold: one pass, no rows move."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.batches import mapped
from ..functions.text import col

#: Fields of a lexicon entry that the counts need.
FIELDS = ("form", "word", "typed", "bias_type", "signal", "modifier", "evaluative", "derogatory", "colloquial")
#: The column that holds what ``token_text`` gives.
TOKENS = "__tokens"


def token_text(sentence: str | Column) -> Column:
    """The tokens of ``bias_tokens`` joined by spaces; empty ones stay."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(col(sentence)), r"\s+$", ""), r"\s+", " ")
    return F.regexp_replace(flat, r"[^\p{L} ]", "")


def near(at: int, others: list[int], window: int) -> bool:
    """Whether another one of the ascending ``others`` is at most ``window`` away."""
    k = bisect_left(others, at - window)
    if k < len(others) and others[k] == at:
        k += 1
    return k < len(others) and others[k] <= at + window


class Walk:
    """Counts of sentences: words, lemmas, then signals, modifiers in pairs and pairs of each type, then three totals."""

    def __init__(self, entries: list[dict], types: tuple[str, ...], window: int, least: int):
        self.types, self.window, self.least = types, window, least
        places = {t: (k,) for k, t in enumerate(types)}
        every = tuple(range(len(types)))
        self.forms, self.parts = {}, {}
        for e in entries:
            if not e["form"]:
                continue
            kinds = places.get(e["bias_type"], ()) if e["typed"] else every
            self.forms[e["form"]] = (e["word"], kinds, *(bool(e[k]) for k in ("signal", "modifier", "evaluative", "derogatory", "colloquial")))
            parts = e["form"].split(" ")
            self.parts[parts[0]] = max(len(parts), self.parts.get(parts[0], 0))
        self.nothing = ([], *[0] * (3 * len(types) + 3))

    def hits(self, tokens: list[str]) -> tuple[int, list]:
        """Tokens that count, and (place among them, entry) of those with one: the longest of three, two or one tokens wins."""
        forms, parts, found, at, i, n = self.forms, self.parts, [], 0, 0, len(tokens)
        while i < n:
            token = tokens[i]
            if token:
                most = parts.get(token, 0)
                if not most:
                    at, i = at + 1, i + 1
                    continue
                # empty tokens that follow belong to a form, too
                if most == 1 and (i + 1 == n or tokens[i + 1]):
                    sizes = (1,)
                else:
                    sizes = (3, 2, 1)
            else:
                sizes = (3, 2)
            for size in sizes:
                if i + size <= n and (entry := forms.get(" ".join(tokens[i : i + size]).strip(" "))):
                    found += [(at + k, entry) for k in range(size)]
                    at, i = at + size, i + size
                    break
            else:
                at, i = at + (token != ""), i + 1
        return at, found

    def counts(self, found: list) -> tuple:
        signals, modifiers = [[] for _ in self.types], [[] for _ in self.types]
        totals, lemmas = [0, 0, 0], {}
        for at, (word, kinds, signal, modifier, *flags) in found:
            lemmas[word] = None
            for k, flag in enumerate(flags):
                totals[k] += flag
            for t in kinds:
                if signal:
                    signals[t].append(at)
                if modifier:
                    modifiers[t].append(at)
        out = []
        for s, m in zip(signals, modifiers):
            pairs = set()
            if s and m:
                own = set(m)
                pairs = {x for x in s if x in own or near(x, m, self.window)} | {y for y in m if near(y, s, self.window)}
            out += [len(s), sum(y in pairs for y in m) if pairs else 0, len(pairs)]
        return list(lemmas), *out, *totals

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        words, rows = [], []
        for text in batch.column(TOKENS).to_pylist():
            n, found = self.hits(text.split(" ")) if text is not None else (None, [])
            words.append(n)
            rows.append(self.counts(found) if found and n >= self.least else self.nothing)
        kept = [k for k in batch.schema.names if k != TOKENS]
        lemmas, *numbers = zip(*rows) if rows else ((),) * len(self.nothing)
        cols = [pa.array(words, pa.int32()), pa.array(lemmas, pa.list_(pa.string())), *(pa.array(x, pa.int32()) for x in numbers)]
        return pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + cols, names=kept + names(self.types))


def names(types: tuple[str, ...]) -> list[str]:
    per_type = [f"{t}_{k}" for t in types for k in ("signals", "evaluators", "pairs")]
    return ["totalWords", "matchedLemmas", *per_type, "totalBiasWords", "totalDerogatory", "totalColloquial"]


def walked(sentences: DataFrame, index: DataFrame, sentence: str, types: tuple[str, ...], window: int, least: int) -> DataFrame:
    """Add the columns of ``names``."""
    entries = [r.asDict() for r in index.select(*FIELDS).collect()]
    walk = Walk(entries, types, window, least)
    kinds = [T.ArrayType(T.StringType()) if k == "matchedLemmas" else T.IntegerType() for k in names(types)]
    schema = T.StructType(sentences.schema.fields + [T.StructField(k, t) for k, t in zip(names(types), kinds)])
    return mapped(sentences.withColumn(TOKENS, token_text(sentence)), lambda: walk, schema)
