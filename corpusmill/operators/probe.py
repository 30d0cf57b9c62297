"""Lines against a corpus that each worker can hold: sets are cut and compared where the lines are.

Sets of a batch are one sorted array of row * V + place, with V shingles in the
corpus. Only matches leave a worker, so what is shuffled does not grow with the texts.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shingles of all corpus sets together, and characters of its texts, up to which workers hold the corpus.
CORPUS_AT_ONCE = 4_000_000
#: Numbers that a step over a batch expands to at a time.
NUMBERS_AT_ONCE = 4_000_000
#: Bytes up to which the hashes of all shingles for all seeds are kept.
HASHES_KEPT = 64_000_000
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def load(sets: DataFrame) -> tuple[pa.Array, np.ndarray, np.ndarray] | None:
    """Texts, shingles and offsets of (line, shingles); none if the corpus is too large for a worker."""
    sizes = sets.agg(F.sum(F.size("shingles")), F.sum(F.length("line")), F.count(F.lit(1))).head()
    if max(n or 0 for n in sizes) > CORPUS_AT_ONCE:
        return None
    found = sets.toArrow().combine_chunks()
    lists = found["shingles"].combine_chunks()
    if not len(lists):
        return found["line"].combine_chunks(), np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    return found["line"].combine_chunks(), np.asarray(lists.flatten(), dtype=np.int64), np.asarray(lists.offsets, dtype=np.int64)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin at ``starts``, one after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def _blocks(counts: np.ndarray):
    """Slices whose counts add up to a bounded number; one that is larger is alone."""
    start, ends = 0, np.cumsum(counts)
    while start < len(counts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + NUMBERS_AT_ONCE, "right")))
        yield slice(start, stop)
        start = stop


class Vocabulary:
    """The distinct shingles of a corpus; ``number`` has what stands for each, its place if nothing else is given."""

    def __init__(self, shingles: np.ndarray):
        self.shingles = np.unique(shingles)
        self.number = np.arange(len(self.shingles))
        self.mask = (1 << (8 * len(self.shingles)).bit_length()) - 1
        self.hint = np.zeros(self.mask + 1, dtype=bool)
        self.hint[self.shingles & self.mask] = True

    def cut(self, lists: pa.ListArray) -> np.ndarray:
        """Sorted distinct row * V + number of the shingles that the corpus has."""
        offsets, values = np.asarray(lists.offsets, dtype=np.int64), np.asarray(lists.flatten(), dtype=np.int64)
        maybe = np.flatnonzero(self.hint[values & self.mask])
        if not len(maybe):
            return np.zeros(0, dtype=np.int64)
        found = values[maybe]
        at = np.minimum(np.searchsorted(self.shingles, found), len(self.shingles) - 1)
        good = self.shingles[at] == found
        rows = np.searchsorted(offsets - offsets[0], maybe[good], "right") - 1
        return np.unique(rows * len(self.shingles) + self.number[at[good]])


class Cut:
    """(line, shingles) of the lines that keep a shingle."""

    def __init__(self, shingles: np.ndarray):
        self.words = Vocabulary(shingles)

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        n = max(1, len(self.words.shingles))
        keys = self.words.cut(batch.column("shingles"))
        rows, counts = np.unique(keys // n, return_counts=True)
        kept = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(self.words.shingles[keys % n]))
        return pa.RecordBatch.from_arrays([batch.column("line").take(pa.array(rows)), kept], names=["line", "shingles"])


class Similar:
    """(new_line, corpus_line, shared, joint) of pairs with shared / joint >= ``least``, by a prefix filter and exact counts."""

    def __init__(self, corpus: tuple[pa.Array, np.ndarray, np.ndarray], least: Fraction):
        self.lines, shingles, offsets = corpus
        self.over, self.under = least.denominator, least.numerator
        self.words = Vocabulary(shingles)
        places = np.searchsorted(self.words.shingles, shingles)
        frequency = np.bincount(places, minlength=len(self.words.shingles))
        # numbers ascend with the number of corpus lines
        self.words.number[np.argsort(frequency, kind="stable")] = np.arange(len(frequency))
        self.sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        order = np.lexsort((self.words.number[places], owner))
        self.sets, self.starts = self.words.number[places][order], offsets[:-1] - offsets[0]
        first = np.arange(len(owner)) - self.starts[owner] < self._prefix(self.sizes)[owner]
        by_number = np.argsort(self.sets[first], kind="stable")
        self.posted = owner[first][by_number]
        self.posts = np.concatenate([[0], np.cumsum(np.bincount(self.sets[first], minlength=len(frequency)))])

    def _prefix(self, sizes: np.ndarray) -> np.ndarray:
        return sizes + (-sizes * self.under // self.over) + 1

    def _near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(a, b) * self.over >= np.maximum(a, b) * self.under

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, corpus = max(1, len(self.words.shingles)), max(1, len(self.sizes))
        keys = self.words.cut(batch.column("shingles"))
        rows = keys // n
        sizes = np.bincount(rows, minlength=len(batch))
        starts = np.cumsum(sizes) - sizes
        near = (sizes > 0) & (sizes * self.under <= max(self.sizes, default=0) * self.over)
        first = np.flatnonzero((np.arange(len(keys)) - starts[rows] < self._prefix(sizes)[rows]) & near[rows])
        row, number = rows[first], keys[first] % n
        many = self.posts[number + 1] - self.posts[number]
        candidates = [np.zeros(0, dtype=np.int64)]
        for part in _blocks(many):
            a, b = np.repeat(row[part], many[part]), self.posted[_spread(self.posts[number[part]], many[part])]
            good = self._near(sizes[a], self.sizes[b])
            candidates.append(np.unique(a[good] * corpus + b[good]))
        pairs = np.unique(np.concatenate(candidates))
        a, b = pairs // corpus, pairs % corpus
        shared = np.zeros(len(pairs), dtype=np.int64)
        for part in _blocks(self.sizes[b]):
            wanted = np.repeat(a[part], self.sizes[b[part]]) * n + self.sets[_spread(self.starts[b[part]], self.sizes[b[part]])]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            held = np.repeat(np.arange(len(pairs))[part], self.sizes[b[part]])[keys[at] == wanted]
            shared += np.bincount(held, minlength=len(pairs))
        joint = sizes[a] + self.sizes[b] - shared
        good = shared * self.over >= joint * self.under
        cols = [batch.column("line").take(pa.array(a[good])), self.lines.take(pa.array(b[good])), pa.array(shared[good], pa.int32()), pa.array(joint[good], pa.int32())]
        return pa.RecordBatch.from_arrays(cols, names=["new_line", "corpus_line", "shared", "joint"])


def _left(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def long_hash(values: np.ndarray) -> np.ndarray:
    """xxhash64 of longs as Spark has it, unsigned."""
    x = (np.uint64(42 + 8) + _P5) ^ (_left(values.view(np.uint64) * _P2, 31) * _P1)
    return _mixed(_left(x, 27) * _P1 + _P4)


def seeded(hashed: np.ndarray, seed: int) -> np.ndarray:
    """xxhash64 of (long, int) as Spark has it, of what ``long_hash`` gave for the long."""
    x = (hashed + (_P5 + np.uint64(4))) ^ np.uint64(seed * int(_P1) % 2**64)
    return _mixed(_left(x, 23) * _P2 + _P3).view(np.int64)


def minima(shingles: np.ndarray, at: np.ndarray, starts: np.ndarray, hashes: int, kept: dict | None = None) -> np.ndarray:
    """The least hash for each seed, a row for each set; sets are ``shingles[at]`` from ``starts`` on, none of them empty."""
    base, out = long_hash(shingles), np.empty((len(starts), hashes), dtype=np.int64)
    for k in range(hashes if len(starts) else 0):
        of_seed = kept.get(k) if kept is not None else None
        if of_seed is None:
            of_seed = seeded(base, k)
            if kept is not None and len(shingles) * hashes * 8 <= HASHES_KEPT:
                kept[k] = of_seed
        out[:, k] = np.minimum.reduceat(of_seed[at], starts)
    return out


class Signed:
    """(line, signature) of lines with their sets."""

    def __init__(self, hashes: int):
        self.hashes = hashes

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("shingles")
        offsets, shingles = np.asarray(lists.offsets, dtype=np.int64), np.asarray(lists.flatten(), dtype=np.int64)
        found = minima(shingles, np.arange(len(shingles)), offsets[:-1] - offsets[0], self.hashes)
        ends = pa.array(np.arange(len(batch) + 1) * self.hashes, pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("line"), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], names=["line", "signature"])


class Sketched:
    """(new_line, corpus_line, agree) of pairs whose signatures agree in ``needed`` places, found by bands that lose none."""

    def __init__(self, corpus: tuple[pa.Array, np.ndarray, np.ndarray], hashes: int, bands: int, needed: int):
        lines, shingles, offsets = corpus
        full = np.flatnonzero(np.diff(offsets))
        self.lines, self.hashes, self.bands, self.needed = lines.take(pa.array(full)), hashes, bands, needed
        self.words, self.kept = Vocabulary(shingles), {}
        places = np.searchsorted(self.words.shingles, shingles)
        self.signatures = minima(self.words.shingles, places, offsets[:-1][full], hashes)
        self.orders = [(order := np.argsort(key), key[order]) for key in self._keys(self.signatures)]

    def _keys(self, signatures: np.ndarray):
        rows = self.hashes // self.bands
        for band in range(self.bands):
            key = np.zeros(len(signatures), dtype=np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                key = _mixed(key * _P1 + signatures[:, k].view(np.uint64))
            yield key

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, corpus = max(1, len(self.words.shingles)), max(1, len(self.signatures))
        keys = self.words.cut(batch.column("shingles"))
        rows, starts = np.unique(keys // n, return_index=True)
        shingles, at = self.words.shingles, keys % n
        if n * self.hashes * 8 > HASHES_KEPT:
            used, at = np.unique(at, return_inverse=True)
            shingles = shingles[used]
        signatures = minima(shingles, at, starts, self.hashes, self.kept if shingles is self.words.shingles else None)
        candidates = [np.zeros(0, dtype=np.int64)]
        for key, (order, held) in zip(self._keys(signatures), self.orders):
            low, high = np.searchsorted(held, key), np.searchsorted(held, key, "right")
            for part in _blocks(high - low):
                many = (high - low)[part]
                candidates.append(np.unique(np.repeat(np.arange(len(rows))[part], many) * corpus + order[_spread(low[part], many)]))
        pairs = np.unique(np.concatenate(candidates))
        agree = np.zeros(len(pairs), dtype=np.int64)
        for part in _blocks(np.full(len(pairs), self.hashes)):
            agree[part] = (signatures[pairs[part] // corpus] == self.signatures[pairs[part] % corpus]).sum(axis=1)
        good = agree >= self.needed
        a, b = rows[pairs[good] // corpus], pairs[good] % corpus
        cols = [batch.column("line").take(pa.array(a)), self.lines.take(pa.array(b)), pa.array(agree[good], pa.int32())]
        return pa.RecordBatch.from_arrays(cols, names=["new_line", "corpus_line", "agree"])
