"""Near-duplicate lines between a new batch and a corpus.

Exact mode finds candidates by a prefix filter over shingles in ascending document
frequency and verifies the similarity in integers; sketch mode compares MinHash
signatures, with bands chosen so that no pair that the full signatures accept is
lost. A corpus that a worker can hold is sent to the new lines (``probe``), of which
only matches move; for a larger one both sides are shuffled, shingles and bands with
digests of their lines. The size of the corpus is found when a function is called.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batches import mapped
from ..functions.text import col, every_shingle, is_blank, java_lines, java_trim, shingles
from . import probe
from .clean import check_threshold, lines

SHINGLE, THRESHOLD, HASHES = 5, 0.90, 200


def share(threshold: float) -> Fraction:
    """The threshold as it is written in decimal, so that comparisons are exact in integers."""
    return Fraction(str(check_threshold(threshold)))


def eligible(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(key, line_no, line) of trimmed lines long enough to have a shingle."""
    return lines(docs, key, text).where(F.length("line") >= size).select(key, "line_no", "line")


def digest(line: str | Column) -> Column:
    """Sixteen bytes that stand for a line where only its identity counts."""
    return F.unhex(F.md5(col(line).cast("binary")))


def hashed_shingles(line: str | Column, size: int = SHINGLE) -> Column:
    """The shingles of a line as 64-bit hashes, repeated ones included."""
    return F.transform(every_shingle(line, size), lambda x: F.xxhash64(x))


def shingle_sets(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(line, shingles) of distinct texts; shingles as 64-bit hashes."""
    return texts.select("line").distinct().select("line", F.array_distinct(hashed_shingles("line", size)).alias("shingles"))


def _probed(texts: DataFrame, work, schema: str, size: int) -> DataFrame:
    return mapped(texts.select("line", hashed_shingles("line", size).alias("shingles")), lambda: work, schema)


def vocabulary(corpus: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(shingle) of all corpus lines."""
    return corpus.select(F.explode(shingles("line", size)).alias("shingle")).distinct()


def restricted_sets(new: DataFrame, corpus: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Sets of both sides, those of the new side cut to the corpus vocabulary; new lines that keep none are gone."""
    held = shingle_sets(corpus, size)
    small = probe.load(held)
    if small is not None:
        return _probed(new.select("line").distinct(), probe.Cut(small[1]), "line string, shingles array<bigint>", size), held
    return _shuffled_sets(new, held, size), held


def _shuffled_sets(new: DataFrame, held: DataFrame, size: int) -> DataFrame:
    """The sets of new lines cut to the shingles of ``held``, by a join."""
    known = held.select(F.explode("shingles").alias("shingle")).distinct()
    texts = new.select("line").distinct()
    own = texts.select(digest("line").alias("id"), F.explode(F.array_distinct(hashed_shingles("line", size))).alias("shingle"))
    cut = own.join(known, "shingle", "left_semi").groupBy("id").agg(F.collect_set("shingle").alias("shingles"))
    return texts.withColumn("id", digest("line")).join(cut, "id").select("line", "shingles")


def _ceil_share(size: str, least: Fraction):
    """The least integer of ``size`` times ``least`` or more."""
    total = F.col(size).cast("long") * least.numerator + (least.denominator - 1)
    return ((total - total % least.denominator) / least.denominator).cast("int")


def _prefixes(sets: DataFrame, frequency: DataFrame, least: Fraction) -> DataFrame:
    """(id, size, shingle) of the rarest shingles, enough of them that sets alike share one."""
    rows = sets.select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle")).join(frequency, "shingle", "left")
    ranked = rows.groupBy("id", "size").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shingle"))).alias("order")
    )
    take = F.col("size") - _ceil_share("size", least) + 1
    return ranked.select("id", "size", F.explode(F.slice("order", F.lit(1), take)).alias("o")).select("id", "size", "o.shingle")


def similar_texts(new: DataFrame, corpus: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(new_line, corpus_line, shared, joint): all pairs of texts with shared / joint >= threshold, in integers."""
    least = share(threshold)
    if not least:
        raise ValueError("the prefix filter needs a threshold above 0")
    held = shingle_sets(corpus, size)
    small = probe.load(held)
    if small is not None:
        return _probed(new, probe.Similar(small, least), "new_line string, corpus_line string, shared int, joint int", size).distinct()
    return _shuffled_texts(_shuffled_sets(new, held, size), held, least)


def _stored(sets: DataFrame) -> DataFrame:
    """Sets with the digests of their lines; several steps read them, and blocks are computed again if an executor is lost."""
    return sets.withColumn("id", digest("line")).persist(StorageLevel.DISK_ONLY)


def _shuffled_texts(new: DataFrame, corpus: DataFrame, least: Fraction) -> DataFrame:
    """The pairs of two tables of sets, by joins."""
    a, b = _stored(new), _stored(corpus)
    frequency = b.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    left = _prefixes(a, frequency, least).withColumnsRenamed({"id": "new_id", "size": "na"})
    right = _prefixes(b, frequency, least).withColumnsRenamed({"id": "corpus_id", "size": "nb"})
    over, under = (F.lit(x).cast("long") for x in (least.denominator, least.numerator))
    near_sizes = F.least("na", "nb") * over >= F.greatest("na", "nb") * under
    pairs = left.join(right, "shingle").where(near_sizes).select("new_id", "corpus_id").distinct()
    with_a = pairs.join(a.withColumnsRenamed({"id": "new_id", "line": "new_line", "shingles": "sa"}), "new_id")
    both = with_a.join(b.withColumnsRenamed({"id": "corpus_id", "line": "corpus_line", "shingles": "sb"}), "corpus_id")
    shared = F.size(F.array_intersect("sa", "sb"))
    counted = both.select("new_line", "corpus_line", shared.alias("shared"), (F.size("sa") + F.size("sb")).alias("both"))
    joint = counted.select("new_line", "corpus_line", "shared", (F.col("both") - F.col("shared")).alias("joint"))
    return joint.where(F.col("shared") * over >= F.col("joint") * under)


def signatures(sets: DataFrame, hashes: int = HASHES) -> DataFrame:
    """(line, signature): the least hash of the set for each of ``hashes`` seeds; empty sets have none."""
    full = sets.where(F.size("shingles") > 0).select("line", "shingles")
    return mapped(full, lambda: probe.Signed(hashes), "line string, signature array<bigint>")


def bands_for(hashes: int, threshold: float) -> int:
    """Bands such that signatures that agree in threshold * hashes places agree in a whole band."""
    misses = hashes - ceil(share(threshold) * hashes)
    for bands in range(1, hashes + 1):
        if hashes % bands == 0 and bands > misses:
            return bands
    return hashes


def similar_sketches(
    new: DataFrame, corpus: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, hashes: int = HASHES
) -> DataFrame:
    """(new_line, corpus_line, agree): pairs whose signatures agree in threshold * hashes places or more."""
    needed, bands = ceil(share(threshold) * hashes), bands_for(hashes, threshold)
    held = shingle_sets(corpus, size)
    small = probe.load(held)
    if small is not None:
        return _probed(new, probe.Sketched(small, hashes, bands, needed), "new_line string, corpus_line string, agree int", size).distinct()
    return _shuffled_sketches(_shuffled_sets(new, held, size), held, hashes, bands, needed)


def _shuffled_sketches(new: DataFrame, corpus: DataFrame, hashes: int, bands: int, needed: int) -> DataFrame:
    """The pairs of two tables of sets whose signatures agree in ``needed`` places, by joins."""
    rows = hashes // bands

    def banded(sets, line, id, signature):
        signed = _stored(signatures(sets, hashes)).withColumnsRenamed({"line": line, "id": id, "signature": signature})
        keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.xxhash64(k, F.slice(signature, k * rows + 1, F.lit(rows))))
        return signed, signed.select(id, F.explode(keys).alias("band"))

    left, left_bands = banded(new, "new_line", "new_id", "x")
    right, right_bands = banded(corpus, "corpus_line", "corpus_id", "y")
    pairs = left_bands.join(right_bands, "band").select("new_id", "corpus_id").distinct()
    agree = F.size(F.filter(F.arrays_zip("x", "y"), lambda z: z["x"] == z["y"]))
    counted = pairs.join(left, "new_id").join(right, "corpus_id").select("new_line", "corpus_line", agree.alias("agree"))
    return counted.where(F.col("agree") >= needed)


def duplicate_pairs(new: DataFrame, corpus: DataFrame, similar: DataFrame, skip_same_document: bool = False) -> DataFrame:
    """Fan pairs of texts out to lines: (new_file, new_line, corpus_file, corpus_line, shared, joint, new_text, corpus_text).

    ``new`` and ``corpus`` are (file, line_no, line). All matches are kept.
    """
    # texts come from the pairs; lines are joined by digests of theirs
    left = new.select(F.col("file").alias("new_file"), F.col("line_no").alias("new_line"), digest("line").alias("new_id"))
    right = corpus.select(F.col("file").alias("corpus_file"), F.col("line_no").alias("corpus_line"), digest("line").alias("corpus_id"))
    named = similar.withColumnsRenamed({"new_line": "new_text", "corpus_line": "corpus_text"})
    named = named.withColumns({"new_id": digest("new_text"), "corpus_id": digest("corpus_text")})
    pairs = named.join(right, "corpus_id").join(left, "new_id").drop("new_id", "corpus_id")
    return pairs.where(F.col("new_file") != F.col("corpus_file")) if skip_same_document else pairs


def flagged(new: DataFrame, similar: DataFrame) -> DataFrame:
    """Lines of the new batch with a near-duplicate, each once."""
    found = similar.select(digest("new_line").alias("__id")).distinct()
    return new.withColumn("__id", digest("line")).join(found, "__id", "left_semi").drop("__id")


def remove_flagged(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(key, text, lines_removed): flagged lines removed; documents left without a non-blank line are dropped.

    Documents that lose no line are kept as they are. Only marks meet texts: lines are
    cut where their document is.
    """
    marks = gone.groupBy(key).agg(F.collect_set("line_no").alias("__gone"))
    marked = docs.select(key, text).join(marks, key, "left").withColumn("__raw", F.when(F.col("__gone").isNotNull(), java_lines(text)))
    line = lambda n: F.get("__raw", n - 1)
    cut = marked.withColumn("__gone", F.filter("__gone", lambda n: F.length(java_trim(line(n))) >= size))
    cut = cut.withColumn("lines_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
    rest = F.transform(F.array_except(F.sequence(F.lit(1), F.size("__raw")), "__gone"), line)
    kept = cut.withColumn("__kept", F.when(F.col("lines_removed") > 0, rest))
    joined = F.concat_ws("", F.transform("__kept", lambda x: F.concat(x, F.lit("\n"))))
    alive = (F.col("lines_removed") == 0) | F.exists("__kept", lambda x: ~is_blank(x))
    return kept.where(alive).select(key, F.when(F.col("lines_removed") > 0, joined).otherwise(F.col(text)).alias(text), "lines_removed")


def report(pairs: DataFrame) -> DataFrame:
    """Report rows by falling similarity, then file and line; four decimals, tabs and line feeds made spaces."""
    flat = lambda c: F.regexp_replace(F.translate(c, "\t\n", "  "), "\r", "")
    ratio = F.col("shared") / F.col("joint")
    ordered = pairs.orderBy(F.desc(ratio), "new_file", "new_line", "corpus_file", "corpus_line")
    return ordered.select(
        F.col("new_file").alias("NEW_FILE"),
        F.col("new_line").alias("NEW_LINE"),
        F.col("corpus_file").alias("CORPUS_FILE"),
        F.col("corpus_line").alias("CORPUS_LINE"),
        F.format_string("%.4f", ratio).alias("SIMILARITY"),
        flat("new_text").alias("NEW_SENTENCE"),
        flat("corpus_text").alias("CORPUS_SENTENCE"),
    )


def corpus_lines(docs: DataFrame, key: str, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(file, line_no, line) of the lines that can be compared."""
    return eligible(docs, key, text, size).withColumnRenamed(key, "file")


def batch_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.explode(F.transform(java_lines(text), java_trim)).alias("line"))
