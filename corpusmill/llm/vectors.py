"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are chosen from a bounded sample, none close to
another. Every vector is described by its nearest pivots in order; inverted
lists hold, for each pivot, the vectors that have it among them. Two vectors of
a list that share enough pivots are candidates, and the exact cosine decides.
A pair is counted only in the list of the smallest pivot that both have, so
lists need not be compared with each other. Links are counted where they are
found; only sums and the edges of a spanning forest leave a task. Long lists are
cut into blocks, and pairs of blocks are separate groups.

Equal vectors of a label are one class with a weight. Defined results: vectors
that are null, empty, zero, or hold null or non-finite components, and vectors
without a label, link with nothing; vectors of different length do not link;
rows that repeat an id are separate vectors that share the id, with the links of
all of them added up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from .common import materialize
from .graph import components

#: Pivots that describe a vector, and pivots that candidates share.
NEAREST, SHARED = 8, 2
#: Pivots: a multiple of the root of the largest label, within bounds; sampled vectors for each pivot.
PIVOTS_PER_ROOT, FEWEST, MOST, SAMPLE = 4, 128, 4096, 4
#: Pivots may not be closer to each other.
APART = 0.8
#: Vectors of a block.
BLOCK = 2048
#: Lengths of vectors that get pivots of their own; others share one list and are compared in blocks.
MAX_LENGTHS = 16


def usable(col: str):
    """Whether a vector can link at all."""
    fine = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(col).isNotNull() & (F.size(col) > 0) & fine & F.exists(col, lambda x: x != 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(classes: DataFrame) -> dict[int, np.ndarray]:
    """Pivots by length of vector, from a sample of at most SAMPLE * MOST rows of (label, size, vector)."""
    counted = classes.groupBy("label", "size").count()
    sizes = counted.groupBy("size").agg(F.max("count").alias("most"), F.sum("count").alias("n"))
    out = {}
    for row in sizes.orderBy(F.desc("n"), "size").limit(MAX_LENGTHS).collect():
        wanted = int(min(MOST, max(FEWEST, PIVOTS_PER_ROOT * row["most"] ** 0.5)))
        same = classes.where(F.col("size") == row["size"])
        share = min(1.0, SAMPLE * wanted / row["n"])
        picked = same.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(SAMPLE * MOST)
        found = picked.select("vector").collect()
        if not found:
            continue
        x = np.unique(np.array([r["vector"] for r in found], float), axis=0)
        x = _unit(x[np.random.default_rng(3).permutation(len(x))])
        chosen = x[:1]
        for v in x[1:]:
            if len(chosen) >= wanted:
                break
            if (chosen @ v).max() < APART:
                chosen = np.vstack([chosen, v])
        out[row["size"]] = chosen
    return out


def describe(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``near``: the nearest pivots, nearest first ([-1] where there are none for the length)."""
    held = classes.sparkSession.sparkContext.broadcast(pivots)
    schema = T.StructType([*classes.schema.fields, T.StructField("near", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            near: list = [[-1]] * len(batch)
            for size in np.unique(sizes).tolist():
                points = held.value.get(size)
                if points is None:
                    continue
                at = np.flatnonzero(sizes == size)
                x = batch.column("vector").take(pa.array(at)).values.to_numpy().reshape(len(at), size).astype(float)
                k = min(NEAREST, len(points))
                for a in range(0, len(at), 2048):
                    far = -(_unit(x[a : a + 2048]) @ points.T)
                    some = np.argpartition(far, k - 1, axis=1)[:, :k]
                    order = np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable")
                    for i, row in zip(at[a : a + 2048].tolist(), np.take_along_axis(some, order, 1).tolist()):
                        near[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=schema.names)

    return classes.mapInArrow(run, schema)


_FOUND = "rep long, links long, hub long"


def _tile(threshold: float):
    """Links within one block, or between two blocks, of one pivot's list."""

    def run(table: pa.Table) -> pa.Table:
        pivot = table.column("pivot")[0].as_py()
        left, right = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        order = np.argsort(table.column("rep").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        rep, weight, block = (table.column(k).to_numpy() for k in ("rep", "weight", "block"))
        flat = table.column("vector").combine_chunks()
        x = _unit(flat.flatten().to_numpy().reshape(len(rep), -1).astype(float))
        near = table.column("near").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        least = min(SHARED, near.shape[1])
        rows, cols = (np.arange(len(rep)),) * 2 if left == right else (np.flatnonzero(block == left), np.flatnonzero(block == right))
        pivots, compact = np.unique(near, return_inverse=True)
        has = np.zeros((len(rep), len(pivots)), np.float32)
        np.put_along_axis(has, compact.reshape(near.shape), 1, axis=1)
        here = int(np.searchsorted(pivots, pivot))
        links, hub = np.zeros(len(rep), np.int64), np.arange(len(rep))
        found_a, found_b = [], []
        for a in range(0, len(rows), 512):
            some = rows[a : a + 512]
            near_enough = has[some] @ has[cols].T >= least
            if left == right:
                near_enough &= some[:, None] < cols[None, :]
            i, j = np.nonzero(near_enough)
            i, j = some[i], cols[j]
            for b in range(0, len(i), 100_000):
                p, q = i[b : b + 100_000], j[b : b + 100_000]
                same = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                p, q = p[same], q[same]
                found_a.append(p)
                found_b.append(q)
                first = (has[p] * has[q]).argmax(axis=1) == here
                np.add.at(links, p[first], weight[q[first]])
                np.add.at(links, q[first], weight[p[first]])
        i, j = np.concatenate(found_a or [rows[:0]]), np.concatenate(found_b or [rows[:0]])
        while len(i):
            low = np.minimum(hub[i], hub[j])
            before = hub.copy()
            np.minimum.at(hub, i, low)
            np.minimum.at(hub, j, low)
            hub = hub[hub]
            if (hub == before).all():
                break
        linked = np.unique(np.concatenate([i, j]))
        return pa.table({"rep": rep[linked], "links": links[linked], "hub": rep[hub[linked]]})

    return run


def near_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93
) -> DataFrame:
    """key, n_links and component_id (smallest key reachable) of every vector."""
    base = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    able = base.where(F.col("label").isNotNull() & usable("vector"))
    grouped = able.groupBy("label", "vector").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes = materialize(grouped.withColumn("size", F.size("vector")), "vector-classes")
    indexed = materialize(describe(classes, fit(classes)), "pivots")
    lists = indexed.select("*", F.explode("near").alias("pivot"))
    lengths = lists.groupBy("label", "size", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = lists.join(lengths, ["label", "size", "pivot"]).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    tiles = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    tiles = tiles.withColumn("one", F.least("block", "with")).withColumn("two", F.greatest("block", "with"))
    columns = ["label", "size", "pivot", "one", "two", "rep", "weight", "block", "vector", "near"]
    found = materialize(
        tiles.select(*columns).groupBy("label", "size", "pivot", "one", "two").applyInArrow(_tile(threshold), _FOUND), "vector-links"
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select("rep", "hub").distinct(), "rep", "hub")
    own = classes.select("label", "vector", "rep", "weight")
    members = base.join(own, ["label", "vector"], "left")
    return (
        members.join(counts, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("key").alias(key),
            (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("component", "rep", "key").alias("component_id"),
        )
    )
