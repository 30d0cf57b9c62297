"""Dictionary-based bias: entries found in sentences, paired within a window.

A lexicon row is a signal, an evaluator, or both, of one bias type or of all.
Sentences are matched longest n-gram first; a signal counts with an evaluator of
its type at most ten tokens away. A lexicon of up to ``FORMS_AT_ONCE`` forms is sent
to the sentences, which then stay where they are (``bias_walk``); its size is found
when they are scored. A larger one is joined by equality on n-gram keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import RX_BIAS_CHARS, col, is_blank, java_trim, split_space
from . import bias_walk

# The bias types, in report order, the window and the least number of tokens.
TYPES = ("gender", "race_ethnicity", "religion", "disability", "appearance")
WINDOW, MIN_WORDS, LONG_SENTENCE = 10, 6, 200
#: Forms of a lexicon that workers hold at a time.
FORMS_AT_ONCE = 200_000


def with_predicates(lexicon: DataFrame) -> DataFrame:
    """Add typed, evaluative and modifier to lexicon rows."""
    return (
        lexicon.withColumn("typed", F.coalesce(F.col("bias_type"), F.lit("")) != "")
        .withColumn("evaluative", (F.coalesce(F.col("bias_value"), F.lit("")) != "") & (F.col("bias_value") != "neutral"))
        .withColumn(
            "modifier",
            F.coalesce(F.col("evaluative"), F.lit(False))
            | F.col("derogatory")
            | F.col("colloquial")
            | (F.col("positivity") > 0.5)
            | (F.col("negativity") > 0.5),
        )
    )


def form_index(lexicon: DataFrame) -> DataFrame:
    """One entry for each form: the first row that lists it."""
    rows = with_predicates(lexicon).select("*", F.explode("forms").alias("form")).drop("forms")
    entry = F.struct(*[c for c in rows.columns if c != "form"])
    return rows.groupBy("form").agg(F.min_by(entry, "line_no").alias("e")).select("form", "e.*")


def form_conflicts(lexicon: DataFrame) -> DataFrame:
    """One row: how often a form was already taken by an earlier row."""
    rows = lexicon.select("line_no", F.explode(F.array_distinct("forms")).alias("form"))
    return rows.groupBy("form").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("conflicts"))


def lemma_index(lexicon: DataFrame) -> DataFrame:
    """One entry for each lemma in lower case: the last row."""
    rows = with_predicates(lexicon).drop("forms").withColumn("lemma", F.lower("word"))
    entry = F.struct(*[c for c in rows.columns if c != "lemma"])
    return rows.groupBy("lemma").agg(F.max_by(entry, "line_no").alias("e")).select("lemma", "e.*")


def lookup(keys: DataFrame, index: DataFrame, key: str = "key") -> DataFrame:
    """Rows of ``keys`` with their entry; keys are trimmed and lower-cased, null and blank ones match nothing."""
    wanted = keys.where(F.col(key).isNotNull() & ~is_blank(key)).withColumn("form", F.lower(java_trim(key)))
    return wanted.join(index, "form")


def by_type(lexicon: DataFrame, kind: str) -> DataFrame:
    """Entries of a type and untyped ones; the type in any case."""
    rows = with_predicates(lexicon)
    return rows.where(~F.col("typed") | (F.lower("bias_type") == kind.lower()))


def signals(lexicon: DataFrame, kind: str | None = None) -> DataFrame:
    """Signal entries, of one type or of all."""
    rows = with_predicates(lexicon) if kind is None else by_type(lexicon, kind)
    return rows.where("signal")


def clean_token(t: Column) -> Column:
    return java_trim(F.regexp_replace(t, RX_BIAS_CHARS, ""))


def bias_tokens(sentence: str | Column) -> Column:
    """Lower-case parts between white space with all but letters deleted; empty ones stay."""
    return F.transform(split_space(F.lower(col(sentence))), clean_token)


def matched_tokens(sentences: DataFrame, index: DataFrame, key: str, sentence: str = "sentence") -> DataFrame:
    """Add ``emitted``: (token, word, ...) of each token that counts, entry fields null where nothing matched.

    At each place the longest of three, two or one tokens that is a form wins and
    gives all its tokens the entry. Keys are trimmed, so a form followed by empty
    tokens takes those with it; other empty tokens are dropped.
    """
    own = sentences.withColumn("tokens", bias_tokens(sentence))
    gram = lambda i, n: java_trim(F.concat_ws(" ", *[F.get("tokens", i + k) for k in range(n)]))
    places = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0))),
            lambda i: F.filter(
                F.array(*[F.struct(i.alias("at"), F.lit(n).alias("n"), F.when(i + n <= F.size("tokens"), gram(i, n)).alias("form")) for n in (1, 2, 3)]),
                lambda g: F.coalesce(g["form"], F.lit("")) != "",
            ),
        )
    )
    fields = [c for c in index.columns if c not in ("form", "line_no", "pos")]
    exploded = own.select(key, F.explode(places).alias("g")).select(key, "g.at", "g.n", "g.form")
    hits = exploded.join(index.select("form", F.struct(*fields).alias("entry")), "form")
    longest = hits.groupBy(key, "at").agg(F.max_by(F.struct("n", "entry"), "n").alias("hit"))
    found = longest.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("at", "hit"))).alias("hits"))
    joined = own.join(found, key, "left")

    token_kind = index.select(F.struct(*fields).alias("entry")).schema["entry"].dataType.simpleString()
    start = F.struct(F.lit(0).alias("skip"), F.lit(None).cast(token_kind).alias("entry"), F.array().cast(f"array<struct<token:string,entry:{token_kind}>>").alias("out"))

    def step(acc, i):
        hit = F.when(acc["skip"] == 0, F.get(F.array(F.col("hits")[i]), F.lit(0)))
        inside = acc["skip"] > 0
        entry = F.when(inside, acc["entry"]).otherwise(hit["entry"])
        token = F.element_at("tokens", i + 1)
        emits = inside | hit.isNotNull() | (token != "")
        item = F.struct(token.alias("token"), entry.alias("entry"))
        left = F.when(inside, acc["skip"] - 1).otherwise(F.coalesce(hit["n"] - 1, F.lit(0)))
        return F.struct(left.alias("skip"), entry.alias("entry"), F.when(emits, F.concat(acc["out"], F.array(item))).otherwise(acc["out"]).alias("out"))

    walk = F.aggregate(F.sequence(F.lit(0), F.size("tokens") - 1), start, step, lambda acc: acc["out"])
    plain = F.transform(F.filter("tokens", lambda t: t != ""), lambda t: F.struct(t.alias("token"), start["entry"].alias("entry")))
    # only sentences with a hit are walked
    return joined.withColumn("emitted", F.when(F.col("hits").isNull(), plain).otherwise(walk)).drop("hits", "tokens")


def _near(at: Column, others: Column) -> Column:
    return F.exists(others, lambda y: (y != at) & (F.abs(at - y) <= WINDOW))


def _paired(signals: Column, modifiers: Column) -> Column:
    """Positions of pairs: a signal with a modifier in the window, or one that is both."""
    left = F.filter(signals, lambda x: F.array_contains(modifiers, x) | _near(x, modifiers))
    return F.array_union(left, F.filter(modifiers, lambda y: _near(y, signals)))


def _among(positions: Column, others: Column) -> Column:
    return F.filter(positions, lambda y: F.array_contains(others, y))


def score_sentences(sentences: DataFrame, index: DataFrame, key: str, sentence: str = "sentence") -> DataFrame:
    """Bias scores of each sentence.

    Adds totalWords, matchedLemmas, and for each type {type}_signals,
    {type}_evaluators and {type}_coverage; totalBiasWords, totalDerogatory,
    totalColloquial, multiType, totalCoverage, long_sentence. Sentences of fewer
    than six tokens have a zero score. Entries of an unknown type match, but pair
    in no type. ``key`` must identify sentences.
    """
    if index.limit(FORMS_AT_ONCE + 1).count() <= FORMS_AT_ONCE:
        counted = bias_walk.walked(sentences, index, sentence, TYPES, WINDOW, MIN_WORDS)
    else:
        counted = _joined(sentences, index, key, sentence)
    share = {t: F.coalesce(F.try_divide(F.col(f"{t}_pairs"), F.col("totalWords")), F.lit(0.0)) for t in TYPES}
    coverage, types = F.lit(0.0), F.lit(0)
    for t in TYPES:
        coverage, types = coverage + share[t], types + (F.col(f"{t}_pairs") > 0).cast("int")
    return counted.withColumns(
        {f"{t}_coverage": share[t] for t in TYPES}
        | {"multiType": types >= 2, "totalCoverage": coverage, "long_sentence": F.col("totalWords") > LONG_SENTENCE}
    ).drop(*[f"{t}_pairs" for t in TYPES])


def _joined(sentences: DataFrame, index: DataFrame, key: str, sentence: str) -> DataFrame:
    """The counts of ``bias_walk`` for any lexicon. Only matched positions are exploded; they are grouped by sentence and type, then by sentence."""
    walked = matched_tokens(sentences, index, key, sentence)
    at = F.transform("emitted", lambda x, i: F.struct(i.alias("__i"), x["entry"].alias("e")))
    found = walked.select(key, F.size("emitted").alias("words"), F.filter(at, lambda x: x["e"].isNotNull()).alias("f"))
    rows = found.where(F.col("words") >= MIN_WORDS).select(key, F.explode("f").alias("f")).select(key, "f.__i", "f.e.*")
    totals = rows.groupBy(key).agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("__i", "word"))), lambda x: x["word"])).alias("matchedLemmas"),
        F.count_if(F.coalesce("evaluative", F.lit(False))).cast("int").alias("totalBiasWords"),
        F.count_if("derogatory").cast("int").alias("totalDerogatory"),
        F.count_if("colloquial").cast("int").alias("totalColloquial"),
    )
    kinds = F.when(F.col("typed"), F.array("bias_type")).otherwise(F.array(*[F.lit(t) for t in TYPES]))
    by_type = rows.select(key, "__i", "signal", "modifier", F.explode(kinds).alias("kind")).groupBy(key, "kind").agg(
        F.collect_list(F.when(F.col("signal"), F.col("__i"))).alias("s"), F.collect_list(F.when(F.col("modifier"), F.col("__i"))).alias("m")
    )
    paired = by_type.select(key, "kind", F.size("s").alias("n_s"), "m", _paired(F.col("s"), F.col("m")).alias("p"))
    sized = paired.select(key, "kind", "n_s", F.size(_among(F.col("m"), F.col("p"))).alias("n_m"), F.size("p").alias("n_p"))
    of = lambda t, c: F.coalesce(F.max(F.when(F.col("kind") == t, F.col(c))), F.lit(0))
    wide = sized.groupBy(key).agg(
        *[e for t in TYPES for e in (of(t, "n_s").alias(f"{t}_signals"), of(t, "n_m").alias(f"{t}_evaluators"), of(t, "n_p").alias(f"{t}_pairs"))]
    )
    out = sentences.join(found.select(key, F.col("words").alias("totalWords")), key).join(totals, key, "left").join(wide, key, "left")
    numbers = [f"{t}_{k}" for t in TYPES for k in ("signals", "evaluators", "pairs")] + ["totalBiasWords", "totalDerogatory", "totalColloquial"]
    return out.fillna(0, numbers).withColumn("matchedLemmas", F.coalesce("matchedLemmas", F.array().cast("array<string>")))


def pair_coverage(kind: str | None) -> Column:
    """Coverage of a type, in any case; blank or none for the total; unknown types have none."""
    if kind is None or not kind.strip():
        return F.col("totalCoverage")
    return F.col(f"{kind.strip().lower()}_coverage") if kind.strip().lower() in TYPES else F.lit(0.0)


def is_biased() -> Column:
    return F.col("totalCoverage") > 0


def report(scored: DataFrame, file: str, sentence: str = "sentence") -> DataFrame:
    """Rows of the report: the file, then 23 columns, of biased sentences only."""
    per_type = [c for t in TYPES for c in (F.col(f"{t}_signals"), F.col(f"{t}_evaluators"), F.round(f"{t}_coverage", 4).alias(f"{t}_coverage"))]
    return scored.where(is_biased()).select(
        F.col(file).alias("file"),
        F.col(sentence).alias("sentence"),
        "totalWords",
        F.array_join("matchedLemmas", ";").alias("matchedLemmas"),
        *per_type,
        "totalBiasWords",
        "totalDerogatory",
        "totalColloquial",
        F.col("multiType").cast("int").alias("multiType"),
        F.round("totalCoverage", 4).alias("totalCoverage"),
    )


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of highest ``order`` for each key."""
    ranked = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order))))
    return ranked.where("__n = 1").drop("__n")
