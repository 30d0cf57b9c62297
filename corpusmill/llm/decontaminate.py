"""Benchmark decontamination by a distributed positional inverted index.

The index is stored: documents are dealt into shards, and a shard has its distinct
terms, as hashes in ascending order, and for each term the ascending list of its
positions (postings), packed. Test windows are answered shard by shard from these
lists alone. A window starts with the positions of its rarest term in the shard;
adjusted by the term's offset, they are intersected with the list of the next
rarer term, and so on. Proximity matches let every other term stand up to
``slack`` places off from where the rarest one puts it, so two terms may be
``2 * slack`` off from each other.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, told apart by
64-bit hashes. Defined results: a null or wordless text has no words and no hits; a
null or wordless item has no windows; items of fewer words than a window are one
window of their own length; repeated items all count; a null item id is reported as
the text ``null``; rows that repeat an id, or have none, are searched one by one;
columns of the same name as an output column are replaced by ``search`` and left
alone by ``clean``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from .common import forget, materialize, small_batches
from .words import hashed_words

#: Words of a window, and words of a shard of the index.
WINDOW, SHARD_WORDS = 10, 1_000_000
#: Bytes of test items that one pass over the index broadcasts (about 80 bytes of memory each); more items take more passes.
BLOCK_BYTES = 2 << 20
#: Places that a term may be off in a proximity match.
SLACK = 2
#: Candidates that are intersected at a time.
_AT_ONCE = 500_000

_SEPARATES = np.array([not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80) for b in range(256)])
_PLACE = np.uint64(32)


class Windows:
    """The distinct windows of test items, as hashes of their terms."""

    def __init__(self, items: list[tuple[str, str | None]], size: int = WINDOW, shortest: int = 1):
        self.size = size
        terms, n = hashed_words([(text or "").encode("utf-8", "replace") for _, text in items], _SEPARATES)
        holders: dict[bytes, set[str]] = {}
        for (item, _), end, count in zip(items, np.cumsum(n).tolist(), n.tolist()):
            own = terms[end - count : end]
            for at in range(max(1, count - size + 1) if count and count >= shortest else 0):
                holders.setdefault(own[at : at + size].tobytes(), set()).add(item)
        self.items = [tuple(sorted(x)) for x in holders.values()]
        self.length = np.array([len(x) // 8 for x in holders], np.int32)
        self.terms = np.zeros((len(holders), size), np.uint64)
        for row, window in enumerate(holders):
            self.terms[row, : len(window) // 8] = np.frombuffer(window, np.uint64)


def postings(ids: np.ndarray, n: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents with ``n`` words each: distinct terms, how often each occurs, and all positions by term.

    Positions run through the shard; documents are ``gap`` places apart, so no match crosses them.
    """
    place = np.arange(len(ids)) + gap * np.repeat(np.arange(1, len(n) + 1), n)
    order = np.argsort(ids, kind="stable")
    ranked = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(ids)])
    return ranked[first], np.diff(np.append(first, len(ids))), place[order]


class Shard:
    """The postings of a run of documents, ready to be searched."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, places: np.ndarray):
        self.terms, self.counts = terms, counts
        self.bounds = np.cumsum(counts) - counts
        # the lists one after the other, each entry preceded by the number of its term, are one ascending list
        self.entries = np.repeat(np.arange(len(terms), dtype=np.uint64), counts) << _PLACE | places.astype(np.uint64)

    def matches(self, windows: Windows, slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Windows and starts of all matches, every term at most ``slack`` places off its own."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(self.terms) and len(windows.items):
            number = np.minimum(np.searchsorted(self.terms, windows.terms), len(self.terms) - 1)
            inside = np.arange(windows.size) < windows.length[:, None]
            known = self.terms[number] == windows.terms
            live = np.flatnonzero((known | ~inside).all(axis=1))
            often = np.where(inside, self.counts[number], np.iinfo(np.int64).max)[live]
            rank = np.argsort(often, axis=1, kind="stable")
            many = np.take_along_axis(often, rank[:, :1], 1)[:, 0]
            first = 0
            while first < len(live):
                last = max(first + 1, int(np.searchsorted(np.cumsum(many[first:]), _AT_ONCE, "right")) + first)
                found.append(self._intersected(windows, number, live[first:last], rank[first:last], many[first:last], slack))
                first = last
        return tuple(np.concatenate(x) for x in zip(*found))

    def _intersected(self, windows: Windows, number, rows, rank, many, slack: int):
        which = np.repeat(np.arange(len(rows)), many)
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        offset = rank[:, 0]
        own = self.entries[self.bounds[number[rows, offset]][which] + nth] & np.uint64(0xFFFFFFFF)
        rows, rank, starts = rows[which], rank[which], own.astype(np.int64) - offset[which]
        for k in range(1, windows.size):
            if not len(rows):
                break
            offset = rank[:, k]
            past = offset >= windows.length[rows]
            term = number[rows, offset].astype(np.uint64) << _PLACE
            wanted = term | (starts + offset - slack).astype(np.uint64)
            at = np.minimum(np.searchsorted(self.entries, wanted), len(self.entries) - 1)
            met = self.entries[at]
            fits = past | ((met >= wanted) & (met - wanted <= np.uint64(2 * slack)))
            rows, rank, starts = rows[fits], rank[fits], starts[fits]
        return rows, starts


_INDEX = "rows array<long>, n array<int>, gap int, terms binary, counts binary, places binary"


def _pack(values: np.ndarray, kind: str) -> bytes:
    raw = np.ascontiguousarray(values, kind)
    return zstandard.ZstdCompressor(level=1).compress(raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes())


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def index(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Store the postings of all words of (row, text), shard by shard; no shuffle.

    A document longer than a shard is one of its own. Positions are kept as
    differences within a term's list.
    """
    gap, shard_words = 2 * window + 2 * SLACK, SHARD_WORDS

    def run(batches):
        rows, parts, words = [], [], 0

        def close():
            ids, n = (np.concatenate(x) for x in zip(*parts))
            terms, counts, places = postings(ids, n, gap)
            first = np.cumsum(counts) - counts
            steps = np.diff(places, prepend=0)
            steps[first] = places[first]
            cells = (_pack(np.diff(terms, prepend=np.uint64(0)), "<u8"), _pack(counts, "<u4"), _pack(steps, "<u4"))
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            cols = [pa.array([c], k) for c, k in zip((rows, n, gap, *cells), kinds)]
            return pa.RecordBatch.from_arrays(cols, names=["rows", "n", "gap", "terms", "counts", "places"])

        for batch in batches:
            texts, waiting = [], 0
            last = len(batch) - 1
            for i, (row, text) in enumerate(zip(batch.column("row"), batch.column("text"))):
                rows.append(row.as_py())
                texts.append(bytes(text.as_buffer()) if text.is_valid else b"")
                waiting += len(texts[-1])
                if i == last or waiting >= 4 * shard_words:
                    parts.append(hashed_words(texts, _SEPARATES))
                    words += len(parts[-1][0])
                    texts, waiting = [], 0
                if words >= shard_words:
                    yield close()
                    rows, parts, words = [], [], 0
        if rows:
            yield close()

    small_batches(docs.sparkSession)
    return materialize(docs.mapInArrow(run, _INDEX), "postings")


HITS = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("near_items", T.ArrayType(T.StringType())),
    ]
)


def _answer(r: dict, blocks: list, slack: int) -> pa.RecordBatch:
    """Of each document of a shard: words, starts and ends of runs of hit words, items, items found nearby only."""
    n, counts, steps = np.array(r["n"], np.int64), _unpack(r["counts"], "<u4").astype(np.int64), _unpack(r["places"], "<u4")
    first = np.cumsum(counts) - counts
    places = np.cumsum(steps, dtype=np.int64)
    places -= np.repeat(places[first] - steps[first], counts) if len(counts) else 0
    shard = Shard(np.cumsum(_unpack(r["terms"], "<u8"), dtype=np.uint64), counts, places)
    begin = np.cumsum(n) - n + r["gap"] * np.arange(1, len(n) + 1)
    marks = np.zeros(int(n.sum()) + r["gap"] * (len(n) + 1) + 1, np.int32)
    exact, close = ([set() for _ in n] for _ in range(2))
    for block in blocks:
        windows = block.value
        rows, starts = shard.matches(windows)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + windows.length[rows], -1)
        _gather(exact, windows, rows, np.searchsorted(begin, starts, "right") - 1)
        if slack:
            rows, starts = shard.matches(windows, slack)
            _gather(close, windows, rows, np.searchsorted(begin, starts, "right") - 1)
    hit = np.cumsum(marks) > 0
    runs = [
        np.flatnonzero(np.diff(hit[b : b + k], prepend=False, append=False)).tolist() if found else []
        for b, k, found in zip(begin.tolist(), n.tolist(), exact)
    ]
    listed = pa.list_(pa.string())
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), listed, listed)
    cells = (r["rows"], n, runs, [sorted(x) for x in exact], [sorted(y - x) for x, y in zip(exact, close)])
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=HITS.names)


def _gather(found: list[set], windows: Windows, rows: np.ndarray, docs: np.ndarray) -> None:
    """Add the items of matched windows to their documents."""
    if len(rows):
        for d, row in np.unique(np.stack([docs, rows], 1), axis=0).tolist():
            found[d].update(windows.items[row])


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, shortest: int) -> list:
    """The windows of the items in broadcasts of bounded size; the driver holds one at a time."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    n, out = -(-size // BLOCK_BYTES) or 1, []
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        windows = Windows([(r["item"], r["text"]) for r in part.collect()], window, shortest)
        out.append(benchmark.sparkSession.sparkContext.broadcast(windows))
    return out


def answered(stored: DataFrame, benchmark: DataFrame, item: str, item_text: str, window: int, slack: int, shortest: int) -> DataFrame:
    """row, n_words, hits, items and near_items of every document of a stored index."""
    blocks = _blocks(benchmark, item, item_text, window, shortest)

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                yield _answer(batch.slice(i, 1).to_pylist()[0], blocks, slack)

    return stored.mapInArrow(run, HITS)


def search(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slack: int = SLACK,
    shortest: int = 1,
) -> DataFrame:
    """key, n_words, hits (starts and ends of the runs of hit words), items, near_items of every document.

    Items of fewer than ``shortest`` words are left out. Keys that are no integers are joined to the answers by row.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if docs.schema["key"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        kind = docs.schema["key"].dataType
        stored = index(docs.select(F.col("key").cast("long").alias("row"), "text"), window)
        found = answered(stored, benchmark, item, item_text, window, slack, shortest)
        return found.withColumn("row", F.col("row").cast(kind)).withColumnRenamed("row", key)
    numbered = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = answered(index(numbered.select("row", "text"), window), benchmark, item, item_text, window, slack, shortest)
    return numbered.select("key", "row").join(found, "row").drop("row").withColumnRenamed("key", key)


def clean(
    df: DataFrame, benchmark: DataFrame, row: str | None = None, text: str = "text", item: str = "item_id", item_text: str = "text", shortest: int = 5
) -> DataFrame:
    """The rows of ``df`` that no window of an item of at least ``shortest`` words occurs in.

    ``row`` is an integer column that tells rows apart; without one they are numbered and stored.
    """
    rows = df if row else materialize(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    row = row or "__row"
    stored = index(rows.select(F.col(row).alias("row"), F.col(text).alias("text")))
    found = answered(stored, benchmark, item, item_text, WINDOW, 0, shortest)
    leaks = materialize(found.where(F.size("hits") > 0).select(F.col("row").alias(row)), "leaks")
    forget(stored)
    return rows.join(leaks, row, "left_anti").select(*df.columns)


def n_hit(hits: str = "hits"):
    """Words covered: the alternating sum of starts and ends."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda done, edge: edge - done)


def digest(items: str = "items"):
    return F.sha2(F.array_join(items, ","), 256)
