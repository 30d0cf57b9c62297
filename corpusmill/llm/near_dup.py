"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct word shingles. The sketch of a set keeps for
each bucket of hash space the smallest hash, compressed to the count of its
leading zeros and a few mantissa bits; empty buckets borrow from others in an
order fixed by hashing. Registers are cut into bands; sets that agree in a band
are candidates. Candidates pass if the share of equal registers, corrected for
registers that agree by chance, comes near the threshold, and are links if the
full sets say so.

Documents with the same set are one class, handled through its smallest id.
Within a band's bucket members are first compared with the smallest one only, and
then those of other components with the largest one. What is still apart is
compared pair by pair by sketches, in blocks, so no link that could join two
components is lost, and large groups of copies cost a few comparisons for each
member. Ids are integers.

Defined results: documents without text or words have the empty set and link
with nothing; fewer words than a shingle are one shingle; rows that repeat an id
have a row each, and where their texts differ links of the id may stem from any of
them; rows without an id are counted but link with nothing and have no component;
other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, types as T
from pyspark.sql import functions as F

from .common import forget, join_keyed, materialize, shuffle_partitions
from .graph import components

#: Words of a shingle; registers; registers of a band; mantissa bits of a register.
SHINGLE, REGISTERS, BAND, MANTISSA = 5, 128, 5, 10
#: Standard errors by which an estimate may miss the threshold and still be verified.
SLACK = 4.0
#: Members that one task compares with the same hub.
HUB_MEMBERS = 2000
#: Members of a block of a bucket.
BLOCK = 1024
#: Sets of up to so many shingles are kept beside the sketch, 32 bits of each hash.
SHORT = 512
#: Cells of a table of sets by shingles that a task builds at a time to count what pairs share.
CELLS = 4_000_000
#: Documents to verify, up to which their ids are broadcast to pick the texts; beyond, texts are shuffled.
BROADCAST_KEYS = 1_000_000
#: Words whose hashes a task keeps.
MAX_WORDS = 100_000

_BUCKET_BITS = REGISTERS.bit_length() - 1
_REST_BITS = 64 - _BUCKET_BITS
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _odd_numbers(n: int, salt: str) -> np.ndarray:
    raw = b"".join(hashlib.blake2b(f"{salt}{i}".encode(), digest_size=8).digest() for i in range(n))
    return np.frombuffer(raw, "<u8") | np.uint64(1)


_PLACE = _odd_numbers(64, "place")
#: For every bucket, the order in which it asks others for a value.
_PROBES = np.random.default_rng(7).integers(0, REGISTERS, (REGISTERS, 48))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler(dict):
    """Hashed shingle sets; as a dict, the hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found

    def shingles(self, text: str | None, size: int = SHINGLE) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles of a text."""
        words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, n)
        width = min(size, n)
        out = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            out += hashes[k : n - width + 1 + k] * _PLACE[k]
        return np.unique(_mix(out))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a set: leading zeros + 1 over mantissa bits; zeros for the empty set."""
    out = np.zeros(REGISTERS, np.uint16)
    if not len(shingles):
        return out
    bucket = (shingles >> np.uint64(_REST_BITS)).astype(np.int64)
    held, first = np.unique(bucket, return_index=True)
    rest = (shingles[first] & np.uint64((1 << _REST_BITS) - 1)).astype(np.float64)
    part, exponent = np.frexp(np.maximum(rest, 1.0))
    zeros = np.minimum(_REST_BITS - exponent, 62)
    out[held] = ((zeros + 1) << MANTISSA) | ((part * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    empty = np.flatnonzero(out == 0)
    if len(empty):
        asked = out[_PROBES[empty]]
        has = asked != 0
        which = has.argmax(axis=1)
        got = asked[np.arange(len(empty)), which]
        later = held[np.searchsorted(held, empty) % len(held)]
        filled = out.copy()
        filled[empty] = np.where(has.any(axis=1), got, out[later])
        out = filled
    return out


def bands(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    n = REGISTERS // BAND
    rows = registers[: n * BAND].reshape(n, BAND).astype(np.uint64)
    keys = np.arange(1, n + 1, dtype=np.uint64) * _PLACE[63]
    for k in range(BAND):
        keys = _mix(keys + rows[:, k] * _PLACE[k])
    return keys.view(np.int64)


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that registers of unequal minima agree, by the sizes of the two sets."""
    edges = 2.0 ** -np.arange(0, 41)
    low, high = edges[1:], edges[:-1]
    spread = lambda n: np.exp(-np.outer(n / REGISTERS, low)) - np.exp(-np.outer(n / REGISTERS, high))
    return (spread(a) * spread(b)).sum(axis=1) / (1 << MANTISSA)


def estimate(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard similarity of pairs of sketches with set sizes a and b."""
    agree, by_chance = (x == y).mean(axis=1), chance(a, b)
    return np.clip((agree - by_chance) / (1 - by_chance), 0, 1)


SKETCH = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("set_id", T.BinaryType()),  # 128 bits of hash and the size
        T.StructField("registers", T.BinaryType()),
        T.StructField("short", T.BinaryType()),
    ]
)


def sketches(docs: DataFrame) -> DataFrame:
    """key, n, set_id (128 bits that stand for the set), registers and, of small sets, short hashes of (key, text)."""
    schema = T.StructType([T.StructField("key", docs.schema["key"].dataType), *SKETCH.fields])

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                s = shingler.shingles(text.as_py())
                ident = np.array([s.sum(dtype=np.uint64), _mix(s * _PLACE[62]).sum(dtype=np.uint64), len(s)], "<u8").tobytes()
                few = (s & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() if len(s) <= SHORT else None
                rows.append((len(s), ident, sketch(s).astype("<u2").tobytes(), few))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["key", *SKETCH.names]
            )

    return docs.mapInArrow(run, schema)


def _banded(reps: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            keys = np.array([bands(np.frombuffer(r.as_py(), "<u2")) for r in batch.column("registers")])
            per = keys.shape[1]
            spread = np.repeat(np.arange(len(batch)), per)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column("key").take(spread), batch.column("n").take(spread)],
                names=["band", "key", "n"],
            )

    return reps.select("key", "n", "registers").mapInArrow(run, f"band long, key {reps.schema['key'].dataType.simpleString()}, n long")


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose corrected estimate comes near the threshold."""
    left = reps.select(F.col("key").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na"))
    right = reps.select(F.col("key").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb"))
    t = percent / 100

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, REGISTERS) for k in ("ra", "rb"))
            a, b = (batch.column(k).to_numpy().astype(float) for k in ("na", "nb"))
            error = np.sqrt(t * (1 - t) / np.minimum(REGISTERS, np.minimum(a, b)))
            fits = estimate(x, y, a, b) >= t - SLACK * error
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(fits))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ra", "rb", "na", "nb")
    return joined.mapInArrow(run, pairs.select("a", "b").schema)


def _shared(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How many hashes each two of some sets share, and how many a set has more than distinct ones."""
    n = len(codes)
    owner = np.repeat(np.arange(n), [len(c) for c in codes])
    known, at = np.unique(np.concatenate(codes), return_inverse=True)
    spare = np.array([len(c) - len(np.unique(c)) for c in codes])
    often = np.bincount(at, minlength=len(known)) > 1  # a hash of one set only is shared by none
    place = np.cumsum(often) - 1
    owner, at = owner[often[at]], place[at[often[at]]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    width, out = max(1, CELLS // max(n, 1)), np.zeros((n, n), np.float32)
    for first in range(0, int(often.sum()), width):
        i, j = np.searchsorted(at, (first, first + width))
        table = np.zeros((n, min(width, int(often.sum()) - first)), np.float32)
        table[owner[i:j], at[i:j] - first] = 1
        out += table @ table.T
    return out, spare


def _apart(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (a, b) of a bucket's members in different components.

    Buckets are cut into blocks, and pairs of blocks are compared within a task;
    only pairs whose estimate comes near the threshold leave it. A component of
    more members than a block has blocks of its own, which do not meet each other,
    so what a large group of copies leaves apart meets each of its members once.
    Of two small sets the short hashes must reach the threshold, too: they can only
    share more than the sets do, so no link is lost.
    """
    rows = members.select("band", "key", "component")
    held = rows.groupBy("band", "component").agg(F.count(F.lit(1)).alias("held"))
    own = F.when(F.col("held") > BLOCK, F.col("component"))
    grouped = held.select("band", "component", own.alias("own"), "held")
    sizes = grouped.groupBy("band", "own").agg(F.ceil(F.sum("held") / BLOCK).cast("int").alias("blocks"))
    whole = Window.partitionBy("band")
    upto = F.sum("blocks").over(whole.orderBy(F.col("own").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    placed = sizes.select("band", "own", "blocks", (upto - F.col("blocks")).cast("int").alias("low"), F.sum("blocks").over(whole).cast("int").alias("all"))
    dealt_to = grouped.select("band", "component", "own", "held").join(
        placed.withColumnsRenamed({"band": "__band", "own": "__own"}), (F.col("band") == F.col("__band")) & F.col("own").eqNullSafe(F.col("__own"))
    )
    dealt_to = materialize(dealt_to.select(F.struct("band", "component").alias("part"), "held", "own", "blocks", "low", "all"), "parts")
    cut = join_keyed(rows.withColumn("part", F.struct("band", "component")), dealt_to, "part", "held")
    cut = cut.withColumn("block", F.col("low") + F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    apart = F.col("own").isNull()
    others = F.filter(F.sequence(F.lit(0), F.col("all") - 1), lambda w: apart | (w < F.col("low")) | (w >= F.col("low") + F.col("blocks")))
    tiles = cut.withColumn("with", F.explode(others))
    tiles = tiles.withColumn("one", F.least("block", "with")).withColumn("two", F.greatest("block", "with"))
    tiles = tiles.join(reps.select("key", "n", "registers", "short"), "key")
    dealt = tiles.select("band", "one", "two", "block", "key", "n", "component", "registers", "short").repartition(
        shuffle_partitions(reps.sparkSession), "band", "one", "two"
    )
    t = percent / 100

    def tile(block, key, n, component, registers, short, one, two):
        small = np.array([x is not None for x in short])
        shared, spare = _shared([np.frombuffer(x or b"", "<u4") for x in short]) if small.any() else (None, None)

        def reach(p, q):
            """Whether pairs of small sets can reach the threshold; others may."""
            both = small[p] & small[q]
            if not both.any():
                return np.ones(len(p), bool)
            most = shared[p, q] + spare[p]
            return ~both | (100 * most >= percent * (n[p] + n[q] - most))

        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        for start in range(0, len(left), 256):
            some = left[start : start + 256]
            apart = component[some][:, None] < component[right][None, :]
            if one != two:
                apart |= component[some][:, None] > component[right][None, :]
            low, high = np.minimum(n[some][:, None], n[right]), np.maximum(n[some][:, None], n[right])
            i, j = np.nonzero(apart & (low * 100 >= high * percent))
            i, j = some[i], right[j]
            for at in range(0, len(i), 50_000):
                p, q = i[at : at + 50_000], j[at : at + 50_000]
                error = np.sqrt(t * (1 - t) / np.minimum(REGISTERS, np.minimum(n[p], n[q])))
                near = estimate(registers[p], registers[q], n[p], n[q]) >= t - SLACK * error
                p, q = p[near], q[near]
                near = reach(p, q)
                yield key[p[near]], key[q[near]]

    def run(batches):
        held, now = [], None

        def close():
            table = pa.Table.from_batches(held)
            block, key, n, component = (table.column(c).to_numpy() for c in ("block", "key", "n", "component"))
            registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
            short = table.column("short").to_pylist()
            found = list(tile(block, key, n.astype(float), component, registers, short, *now[1:]))
            a, b = (np.concatenate(x) for x in zip(*[(key[:0], key[:0]), *found]))
            return a, b

        for batch in batches:
            ids = list(zip(*(batch.column(c).to_pylist() for c in ("band", "one", "two"))))
            start, out = 0, []
            for at in range(1, len(ids) + 1):
                if at == len(ids) or ids[at] != ids[start]:
                    if ids[start] != now and held:
                        out.append(close())
                        held.clear()
                    now = ids[start]
                    held.append(batch.slice(start, at - start))
                    start = at
            if out:
                a, b = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        if held:
            a, b = close()
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return dealt.sortWithinPartitions("band", "one", "two").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of their full sets.

    The sets travel to their pair's hub ``a``; a hub with many members is spread
    over several tasks that hold a copy of its set each.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).alias("shares"))
    members = pairs.join(counts, "a").select(
        F.col("b").alias("key"), F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), "shares").cast("int").alias("share")
    )
    hubs = counts.select(
        F.col("a").alias("key"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("shares").cast("int") - 1)).alias("share")
    )
    routes = members.unionByName(hubs)
    kind = docs.schema["key"].dataType

    def sets(batches):
        shingler, held, packed = Shingler(), None, b""
        for batch in batches:
            out = []
            for key, text in zip(batch.column("key"), batch.column("text")):
                if key != held or held is None:
                    held, packed = key, shingler.shingles(text.as_py()).astype("<u8").tobytes()
                out.append(packed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("hub"), batch.column("share"), batch.column("key"), pa.array(out, pa.binary())],
                names=["hub", "share", "key", "shingles"],
            )

    def compare(batches):
        hub, own = None, None
        for batch in batches:
            a, b = [], []
            for h, k, packed in zip(*(batch.column(c) for c in ("hub", "key", "shingles"))):
                s = np.frombuffer(packed.as_buffer(), "<u8")
                if h == k:
                    hub, own = h, s
                    continue
                if h != hub:
                    raise RuntimeError("a hub's set is missing")
                common = int((own[np.minimum(np.searchsorted(own, s), len(own) - 1)] == s).sum())
                if 100 * common >= percent * (len(own) + len(s) - common):
                    a.append(h)
                    b.append(k)
            arrow = batch.schema.field("key").type
            yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in a], arrow), pa.array([x.as_py() for x in b], arrow)], names=["a", "b"])

    schema = T.StructType(
        [T.StructField("hub", kind), T.StructField("share", T.IntegerType()), T.StructField("key", kind), T.StructField("shingles", T.BinaryType())]
    )
    needed = routes.select("key").distinct()
    texts = docs.select("key", "text")
    if needed.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(needed), "key", "left_semi")
    loaded = routes.join(texts.hint("merge"), "key")
    routed = loaded.select("hub", "share", "key", "text").mapInArrow(sets, schema)
    met = routed.repartition(shuffle_partitions(docs.sparkSession), "hub", "share").sortWithinPartitions(
        "hub", "share", F.col("key") != F.col("hub")
    )
    return met.mapInArrow(compare, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """key, n_shingles and component (smallest key reachable by links) of every row."""
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    drawn = materialize(sketches(docs), "sketches")
    classes = drawn.where("n > 0 and key is not null").groupBy("set_id").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "classes")
    classed = materialize(join_keyed(drawn.select("key", "n", "set_id"), classes, "set_id", "copies", "left").select("key", "n", "rep"), "classed")
    # sets of up to t / (1 - t) shingles reach the threshold only if they are equal
    least = percent // (100 - percent) + (percent % (100 - percent) > 0)
    firsts = classes.select(F.col("rep").alias("key"), "set_id")
    reps = drawn.where(F.col("n") >= least).join(firsts, ["key", "set_id"], "left_semi").select("key", "n", "registers", "short")
    reps = materialize(reps, "reps")
    forget(drawn, classes)
    keyed = materialize(_banded(reps), "bands")
    hubs = keyed.groupBy("band").agg(F.min("key").alias("hub"), F.max("key").alias("last"), F.count(F.lit(1)).alias("members"))
    hubs = materialize(hubs.where("hub < last"), "hubs")
    shared = materialize(join_keyed(keyed, hubs, "band", "members"), "buckets")
    forget(keyed)

    def links(pairs: DataFrame) -> DataFrame:
        likely = materialize(_likely(pairs, reps, percent), "likely")
        found = materialize(verified(likely, docs, percent), "near-links")
        forget(likely)
        return found

    def unconnected(found: DataFrame) -> DataFrame:
        """Members of buckets that hold more than one component."""
        labels = components(found)
        named = shared.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
        named = materialize(named, "named")
        mixed = named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"))
        mixed = materialize(mixed.where("low < high").select("band", "members"), "mixed")
        left = materialize(join_keyed(named, mixed, "band", "members"), "left")
        forget(labels, named, mixed)
        return left

    star = shared.where("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    found = links(star)
    # then with the largest member, which joins most of what is left of a large group of copies
    left = unconnected(found)
    ends = left.where("key = last").groupBy("band").agg(F.max("key").alias("a"), F.max("component").alias("end"))
    sizes = left.groupBy("band").agg(F.count(F.lit(1)).alias("members"))
    ends = materialize(ends.join(sizes, "band"), "ends")
    second = join_keyed(left, ends, "band", "members").where(F.col("component") != F.col("end")).select("a", F.col("key").alias("b")).distinct()
    starred, more = found, links(second)
    found = materialize(starred.unionByName(more), "near-links")
    forget(left, ends, starred, more)
    # then whatever pairs of a bucket are still apart and alike enough by their sketches
    left = unconnected(found)
    third = materialize(_apart(left, reps, percent).distinct(), "likely")
    joined = components(found.unionByName(verified(third, docs, percent)))
    forget(left, third, found, shared, hubs, reps)
    return classed.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "rep", "key").alias("component_id"),
    )
