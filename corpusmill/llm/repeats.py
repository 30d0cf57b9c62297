"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of ``width`` bytes that covers it also starts earlier in
the corpus: in a document of smaller id, or earlier in the same one. The first
copy stays. In terms of the longest-previous-factor (LPF) array of the corpus:
bytes i .. i+width-1 go where LPF[i] >= width.

One suffix array of a whole corpus cannot be spread, so the corpus is first cut
where it cannot matter. Every window of ``width`` bytes has an anchor, the
substring of ``ANCHOR`` bytes whose hash is smallest in it; equal windows have
equal anchors. Anchors that occur once rule out all windows around them. Of
anchors that recur with the same bytes on both sides, as far as windows reach,
all but the first are removed. What is left are the edges of repeats: their
surroundings are brought together by anchor, suffix-sorted, and judged by LPF.
Anchors with very many different surroundings are split by whole windows, so
none is gathered in one task.

Anchors, equal surroundings and the windows of hot anchors are told apart by 64-bit
hashes, so two of n different ones are taken for equal with a probability of about
n * n / 4e19; all else is compared byte by byte.

Defined results: a null text is the empty text; documents shorter than ``width``
keep all bytes; rows that repeat an id are documents of their own, in the order of a
hash of their texts; rows without an id come last; strings are judged on the input,
never on what is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions

WIDTH, ANCHOR = 100, 32
#: Bytes of a document that are hashed at a time, and bytes of one suffix array.
SEGMENT, ARRAY_BYTES = 1 << 20, 1 << 20
#: Different surroundings of an anchor beyond which it is split by windows: in one batch, and in all.
LOCAL_HOT, HOT = 256, 4096

_rng = np.random.default_rng(11)
_BYTE = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out, step = np.ones(1, np.uint64), base
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(step)])
                step = step * step & _MASK
            _powers.append(out)
    return _powers[0], _powers[1]


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of every run of ``width``."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return x if done == width else pick(x[: len(x) - (width - done)], x[width - done :])


class Hashed:
    """Hashes of all substrings of a byte string."""

    def __init__(self, data: np.ndarray):
        up, self.down = _tables(max(len(data), 1 << 12))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def runs(self, width: int) -> np.ndarray:
        """Of all substrings of one width."""
        n = len(self.sums) - width
        return _mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def anchors(data: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of anchors in a document, their hashes, and hashes of their surroundings."""
    n, reach = len(data), width - ANCHOR
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    places, keys, around = [], [], []
    for begin in range(0, n, SEGMENT):
        low, high = max(0, begin - width), min(n, begin + SEGMENT + 2 * width)
        if high - low < width:
            continue
        hashed = Hashed(data[low:high])
        grams = hashed.runs(ANCHOR)
        least = _slide(grams, reach + 1, np.minimum)
        pad = np.zeros(reach, np.uint64)
        held = _slide(np.concatenate([pad, least, pad]), reach + 1, np.maximum) == grams
        at = np.flatnonzero(held)
        at = at[(at + low >= begin) & (at + low < begin + SEGMENT)]
        left, right = np.maximum(at + low - reach, 0), np.minimum(at + low + width, n)
        shape = (at + low - left).astype(np.uint64) << np.uint64(32) | (right - at - low).astype(np.uint64)
        places.append(at + low)
        keys.append(grams[at])
        around.append(_mix(hashed.of(left - low, right - low) + shape * np.uint64(_BASE)))
    return np.concatenate(places), np.concatenate(keys), np.concatenate(around)


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Of each place the nearest one before it with a smaller value, -1 for none; by following such answers of others."""
    out = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero((out >= 0) & (values[out] > values))
    while len(open_):
        out[open_] = out[out[open_]]
        open_ = open_[(out[open_] >= 0) & (values[out[open_]] > values[open_])]
    return out


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    fresh = np.empty(len(key), np.int64)
    ranked = key[order]
    fresh[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
    return fresh


def longest_previous_factors(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """LPF among the given suffixes, which are in corpus order and hold ``width`` bytes, up to ``width``, in steps of 8 bytes.

    Suffixes are ranked by their first ``width`` bytes by prefix doubling, ties by
    corpus order. Of the suffixes before one in the corpus, those that share most
    with it are its previous and its next smaller position in that order; the
    bytes of both are compared with its own.
    """
    padded = np.concatenate([data, np.zeros(width + 8, np.uint8)])
    size = 4  # four bytes make a first key without sorting
    rank = sum(padded[k : len(padded) - 3 + k].astype(np.int64) << 8 * (3 - k) for k in range(4))
    rank = _dense(rank)
    while size < width:
        step = min(size, width - size)
        rank = _dense(rank[: len(rank) - step] * len(padded) + rank[step:])
        size += step
    order = np.lexsort((np.arange(len(starts)), rank[starts]))
    del rank
    before = previous_smaller(order)
    after = len(order) - 1 - previous_smaller(order[::-1])[::-1]
    eight = np.zeros(len(padded) - 7, np.uint64)
    for k in range(8):
        eight |= padded[k : len(padded) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    offsets = [*range(0, width - 7, 8), width - 8]
    out = np.zeros(len(starts), np.int64)
    for other in (before, after):
        here = np.flatnonzero((other >= 0) & (other < len(order)))
        own, far = starts[order[here]], starts[order[other[here]]]
        shared = np.zeros(len(here), np.int64)
        same = np.arange(len(here))
        for at in offsets:
            same = same[eight[own[same] + at] == eight[far[same] + at]]
            shared[same] = at + 8
        out[order[here]] = np.maximum(out[order[here]], shared)
    return out


def _compress(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, byte by byte, compressed."""
    raw = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)
    return _compress(raw)


def _unpack(packed: bytes, *kinds) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, out, at = len(raw) // sum(sizes), [], 0
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table of columns has another row than before."""
    fresh = np.ones(len(columns[0]), bool)
    if len(fresh):
        fresh[1:] = False
        for c in columns:
            fresh[1:] |= c[1:] != c[:-1]
    return fresh


def _dealt(bucket: np.ndarray, *columns: np.ndarray):
    """(bucket, packed rows) for each bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    edges = np.flatnonzero(_new(bucket)).tolist() + [len(bucket)]
    for a, b in zip(edges, edges[1:]):
        yield int(bucket[a]), _pack(*(c[a:b] for c in columns))


# What a packed row holds: anchors; anchors dealt by surroundings; anchors dealt so by some task; runs that go.
_COLD, _SPREAD, _HOT_KEYS, _RUNS = 0, 1, 2, 3
_DEALT = "bucket int, kind int, packed binary"
_JUDGED = "key long, start int, end int, anchor long, hot boolean"
_ANCHOR_COLUMNS = (np.uint64, np.uint64, np.int64, np.int32)


def _sorted_anchors(h, c, d, p):
    order = np.lexsort((p, d, c, h))
    return h[order], c[order], d[order], p[order]


def _sorted_windows(w, d, s):
    """Windows by hash and place; one place, which several anchors may show, counts once."""
    order = np.lexsort((s, d, w))
    w, d, s = w[order], d[order], s[order]
    once = _new(w, d, s)
    return w[once], d[once], s[once]


def _cut(buckets: int, width: int):
    """Batches of (key, text) to packed anchors; of equal ones in a batch only the first."""

    def run(batches):
        for batch in batches:
            found = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                if text.is_valid and key is not None:
                    p, h, c = anchors(np.frombuffer(text.as_buffer(), np.uint8), width)
                    if len(p):
                        found.append((h, c, np.full(len(p), key, np.int64), p.astype(np.int32)))
            if not found:
                continue
            h, c, d, p = _sorted_anchors(*(np.concatenate(x) for x in zip(*found)))
            first = _new(h, c)
            rows = []
            gone = ~first
            if gone.any():
                a, b, e = _merged(d[gone], np.maximum(p[gone] - (width - ANCHOR), 0), p[gone] + width)
                rows += [(k, _RUNS, x) for k, x in _dealt((_mix(a.view(np.uint64)) % np.uint64(buckets)).astype(np.int32), a, b, e)]
            h, c, d, p = h[first], c[first], d[first], p[first]
            group = np.cumsum(_new(h)) - 1
            many = (np.bincount(group) > LOCAL_HOT)[group]
            for kind, some, by in ((_COLD, ~many, h), (_SPREAD, many, _mix(h ^ _mix(c)))):
                if some.any():
                    to = (by[some] % np.uint64(buckets)).astype(np.int32)
                    rows += [(k, kind, x) for k, x in _dealt(to, h[some], c[some], d[some], p[some])]
            if many.any():
                keys = np.unique(h[many])
                rows += [(k, _HOT_KEYS, x) for k, x in _dealt((keys % np.uint64(buckets)).astype(np.int32), keys)]
            yield _rows(rows, _DEALT)

    return run


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    named = [x.strip().split(" ") for x in schema.split(",")]
    cols = list(zip(*rows)) if rows else [()] * len(named)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, named)], names=[n for n, _ in named])


def _merged(d: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Runs of each document that touch or overlap, made one."""
    order = np.lexsort((start, d))
    d, start, end = d[order], start[order].astype(np.int32), end[order].astype(np.int32)
    _, doc = np.unique(d, return_inverse=True)
    reach = np.maximum.accumulate(end.astype(np.int64) + (doc.astype(np.int64) << 32)) if len(d) else end
    fresh = np.ones(len(d), bool)
    if len(d):
        fresh[1:] = (start[1:].astype(np.int64) + (doc[1:].astype(np.int64) << 32)) > reach[:-1]
    at = np.flatnonzero(fresh)
    return d[at], start[at], np.maximum.reduceat(end, at).astype(np.int32) if len(at) else end


def _by_bucket(batches):
    """(bucket, rows by kind) of batches that are sorted by bucket."""
    now, held = None, {}
    for batch in batches:
        for bucket, kind, packed in zip(*(batch.column(k).to_pylist() for k in ("bucket", "kind", "packed"))):
            if bucket != now and held:
                yield held
                held = {}
            now = bucket
            held.setdefault(kind, []).append(packed)
    if held:
        yield held


def _all(held: dict, kind: int, *kinds) -> list[np.ndarray]:
    parts = [_unpack(x, *kinds) for x in held.get(kind, ())]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def _judge(width: int):
    """Anchors of a bucket: runs that go for certain, and anchors whose surroundings must be compared."""

    def run(batches):
        for held in _by_bucket(batches):
            runs = [_all(held, _RUNS, np.int64, np.int32, np.int32)]
            asked = []
            hot_keys = np.unique(_all(held, _HOT_KEYS, np.uint64)[0])
            for kind in (_COLD, _SPREAD):
                h, c, d, p = _sorted_anchors(*_all(held, kind, *_ANCHOR_COLUMNS))
                if not len(h):
                    continue
                first = _new(h, c)
                runs.append([d[~first], np.maximum(p[~first] - (width - ANCHOR), 0), p[~first] + width])
                h, d, p = h[first], d[first], p[first]
                group = np.cumsum(_new(h)) - 1
                n = np.bincount(group)[group]
                hot = (n > HOT) | np.isin(h, hot_keys) | (kind == _SPREAD)
                open_ = (n > 1) | hot
                asked.append((d[open_], p[open_], h[open_], hot[open_]))
            a, b, e = _merged(*(np.concatenate(x) for x in zip(*runs)))
            yield _judged(a, b, e, None, None)
            for d, p, h, hot in asked:
                yield _judged(d, p, p, h.view(np.int64), hot)

    return run


def _judged(key, start, end, anchor, hot) -> pa.RecordBatch:
    n = len(key)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key, pa.int64()),
            pa.array(start.astype(np.int32)),
            pa.array(end.astype(np.int32)),
            pa.nulls(n, pa.int64()) if anchor is None else pa.array(anchor),
            pa.nulls(n, pa.bool_()) if hot is None else pa.array(hot),
        ],
        names=["key", "start", "end", "anchor", "hot"],
    )


def _surroundings(buckets: int, width: int):
    """Of each document, the bytes around the anchors in question; around hot ones, hashes of all windows."""
    reach = width - ANCHOR

    def run(batches):
        for batch in batches:
            head, bodies, wide = [], [], []
            for key, text, asked in zip(*(batch.column(k) for k in ("key", "text", "asked"))):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                key = key.as_py()
                p = asked.values.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
                h = asked.values.field("anchor").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                hot = asked.values.field("hot").to_numpy(zero_copy_only=False).astype(bool)
                for at, anchor in zip(p[~hot].tolist(), h[~hot].tolist()):
                    low, high = max(0, at - reach), min(len(data), at + width)
                    head.append((anchor, key, low, high - low))
                    bodies.append(data[low:high])
                if hot.any():
                    for at in p[hot].tolist():
                        low, high = max(0, at - reach), min(len(data), at + width)
                        windows = Hashed(data[low:high]).runs(width)
                        wide.append((windows, np.full(len(windows), key, np.int64), np.arange(low, low + len(windows), dtype=np.int32)))
            rows = []
            if head:
                columns = [np.array(x, k) for x, k in zip(zip(*head), (np.uint64, np.int64, np.int32, np.int32))]
                bucket = (columns[0] % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(_new(bucket[order])).tolist() + [len(order)]
                for a, b in zip(edges, edges[1:]):
                    own = order[a:b]
                    meta = _pack(*(c[own] for c in columns))
                    body = _compress(np.concatenate([bodies[i] for i in own.tolist()]).tobytes())
                    rows.append((int(bucket[own[0]]), _COLD, len(meta).to_bytes(4, "little") + meta + body))
            if wide:
                w, d, s = _sorted_windows(*(np.concatenate(x) for x in zip(*wide)))
                first = _new(w)
                a, b, e = _merged(d[~first], s[~first], s[~first] + np.int32(width))
                rows += [(k, _RUNS, x) for k, x in _dealt((_mix(a.view(np.uint64)) % np.uint64(buckets)).astype(np.int32), a, b, e)]
                w, d, s = w[first], d[first], s[first]
                rows += [(k, _SPREAD, x) for k, x in _dealt((w % np.uint64(buckets)).astype(np.int32), w, d, s)]
            if rows:
                yield _rows(rows, _DEALT)

    return run


def _compare(width: int):
    """Surroundings of a bucket to the runs that go."""

    def factors(h, d, low, size, data, at):
        """LPF over the surroundings of some anchors, which are in order of anchor, document and place."""
        pieces = [data[a : a + n] for a, n in zip(at.tolist(), size.tolist())]
        begin = np.concatenate([[0], np.cumsum(size[:-1])])
        per = size - width + 1
        which = np.repeat(np.arange(len(h)), per)
        inner = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        where = low[which] + inner
        place = np.stack([d[which], where])
        # one place may be seen from several anchors of the group; it is no copy of itself
        order = np.lexsort(place[::-1])
        order = order[_new(*place[:, order])]
        again = order[longest_previous_factors(np.concatenate(pieces), (begin[which] + inner)[order], width) >= width]
        return place[0, again], place[1, again].astype(np.int32)

    def run(batches):
        for held in _by_bucket(batches):
            runs = [_all(held, _RUNS, np.int64, np.int32, np.int32)]
            metas, bodies = [], []
            for packed in held.get(_COLD, ()):
                n = int.from_bytes(packed[:4], "little")
                metas.append(_unpack(packed[4 : 4 + n], np.uint64, np.int64, np.int32, np.int32))
                bodies.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[4 + n :]), np.uint8))
            if metas:
                h, d, low, size = (np.concatenate(x) for x in zip(*metas))
                data = np.concatenate(bodies)
                size = size.astype(np.int64)
                at = np.cumsum(size) - size
                order = np.lexsort((low, d, h))
                h, d, low, size, at = (x[order] for x in (h, d, low, size, at))
                edges = np.append(np.flatnonzero(_new(h)), len(h))
                volume = np.append(0, np.cumsum(size))[edges]
                a = 0
                while a < len(edges) - 1:
                    b = max(a + 1, int(np.searchsorted(volume, volume[a] + ARRAY_BYTES, "right")) - 1)
                    part = slice(edges[a], edges[b])
                    key, start = factors(h[part], d[part], low[part], size[part], data, at[part])
                    runs.append([key, start, start + np.int32(width)])
                    a = b
            w, d, s = _all(held, _SPREAD, np.uint64, np.int64, np.int32)
            if len(w):
                w, d, s = _sorted_windows(w, d, s)
                gone = ~_new(w)
                runs.append([d[gone], s[gone], s[gone] + np.int32(width)])
            yield _judged(*_merged(*(np.concatenate(x) for x in zip(*runs))), None, None)

    return run


def removals(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, runs) of documents that lose bytes: array of start and end, unsorted, overlapping, ends not clipped."""
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    buckets = 2 * parts
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition(parts, "bucket").sortWithinPartitions("bucket")

    first = materialize(dealt(docs.mapInArrow(_cut(buckets, width), _DEALT)).mapInArrow(_judge(width), _JUDGED), "anchors")
    asked = first.where("anchor is not null").groupBy("key").agg(F.collect_list(F.struct("start", "anchor", "hot")).alias("asked"))
    around = docs.where("text is not null").join(asked, "key").select("key", "text", "asked")
    second = materialize(
        dealt(around.mapInArrow(_surroundings(buckets, width), _DEALT)).mapInArrow(_compare(width), _JUDGED), "factors"
    )
    runs = first.where("anchor is null").unionByName(second).select("key", "start", "end")
    return runs.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("runs"))


CUT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """key, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes of every row."""
    docs = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, distinct = docs.agg(F.count(F.lit(1)), F.count_distinct("key")).head()
    if rows == distinct:
        docs = docs.withColumn("row", F.col("key").cast("long"))
    else:  # sorted rows are numbered in order
        ranked = docs.orderBy(F.col("key").asc_nulls_last(), F.xxhash64("text"))
        docs = materialize(ranked.withColumn("row", F.monotonically_increasing_id()), "numbered")
    runs = removals(docs, "row", "text", width).withColumnRenamed("key", "row")
    joined = docs.join(runs, "row", "left").select("key", "text", "runs")

    def run(batches):
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                data = np.frombuffer(text.as_buffer(), np.uint8) if len(text.as_buffer() or b"") else np.zeros(0, np.uint8)
                if not runs.is_valid:
                    out.append((len(data), 0, 0, data.tobytes()))
                    continue
                a = runs.values.field("start").to_numpy(zero_copy_only=False)
                b = np.minimum(runs.values.field("end").to_numpy(zero_copy_only=False), len(data))
                marks = np.zeros(len(data) + 1, np.int32)
                np.add.at(marks, a, 1)
                np.add.at(marks, b, -1)
                gone = np.cumsum(marks[:-1]) > 0
                spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                out.append((len(data), int(gone.sum()), spans, data[~gone].tobytes()))
            cols = list(zip(*out)) if out else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["key", *CUT.names]
            )

    schema = T.StructType([T.StructField("key", docs.schema["key"].dataType), *CUT.fields])
    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)
