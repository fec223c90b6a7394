"""Near-duplicate embeddings by random-hyperplane signs in several tables.

In each table a vector's key is the signs of its products with ``width`` random
hyperplanes; vectors at the threshold angle share a key with probability p =
(1 - angle / pi) ** width, and there are enough tables that such a pair misses
all of them with probability ``miss`` at most. ``width`` follows the number of
vectors, so keys stay short lists of random company at any size. Members of a
key are compared exactly, in double precision, block against block: a long list
is cut into chunks and every two chunks are a unit of work of their own, so no
list is gathered whole and no pair leaves the unit: per member it gives the
number of links and the smallest member it hangs together with. A pair that
meets in several tables counts in the first of them only.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own component; equal vectors are one class and
link with each other; vectors of different length never link; rows that repeat
a vec_id are one vertex for reachability, each with its own count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import Stages, components, partitions_for

CHUNK = 512


def table_shape(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(width, tables) for ``n`` vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    width = max(8, math.ceil(math.log2(max(n, 2))) - 4)
    return width, math.ceil(math.log(miss) / math.log1p(-agree ** width))


def _usable(v):
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def signatures(classes: DataFrame, width: int, tables: int, seed: int) -> DataFrame:
    """Adds keys, one per table, to ``classes`` (id, copies, vector)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(width, dtype=np.int64)
        for batch in batches:
            column = batch.column(2)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.diff(column.offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            keys = np.empty((len(sizes), tables), np.int64)
            for dim in np.unique(sizes).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, tables * width))
                at = np.flatnonzero(sizes == dim)
                for part in np.array_split(at, 1 + len(at) // 1024):
                    signs = values[starts[part][:, None] + np.arange(dim)] @ planes[dim] >= 0
                    keys[part] = signs.reshape(len(part), tables, width) @ powers
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(np.arange(0, keys.size + 1, tables, dtype=np.int32), keys.ravel())],
                ["id", "copies", "vector", "keys"])

    return classes.mapInArrow(sign, "id long, copies long, vector array<double>, keys array<long>")


def _connected(near: np.ndarray) -> np.ndarray:
    """The smallest member each member of a 0/1 matrix hangs together with."""
    label = np.arange(len(near))
    while True:
        lower = np.where(near, label, len(near)).min(axis=1)
        lower = np.minimum(lower, label)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _compare(rows: dict[str, np.ndarray], table: int, one: int, other: int, threshold: float):
    """(ids, links, first member) of one unit of work."""
    vectors, keys, chunk, ids, copies = rows["vector"], rows["keys"], rows["chunk"], rows["id"], rows["copies"]
    near = vectors @ vectors.T >= threshold
    if one != other:
        near &= chunk[:, None] != chunk[None, :]
    np.fill_diagonal(near, False)
    a, b = np.nonzero(np.triu(near))
    if table and len(a):  # pairs that already met in an earlier table
        met = (keys[a, :table] == keys[b, :table]).any(axis=1)
        near[a[met], b[met]] = near[b[met], a[met]] = False
    links = near @ copies
    linked = near.any(axis=1)
    return ids[linked], links[linked], ids[_connected(near)[linked]]


def near_embeddings(rows: DataFrame, stages: Stages, threshold: float = 0.95, miss: float = 1e-4, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows``
    (vec_id, embedding)."""
    vector = F.col("embedding").cast("array<double>")
    plain = rows.select("vec_id", F.transform(vector, lambda x: x + F.lit(0.0)).alias("vector"))  # no negative zeros
    classes = plain.filter(_usable(F.col("vector")) & F.col("vec_id").isNotNull()).groupBy("vector").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies")).select("id", "copies", "vector")
    classes = stages.keep(classes, "classes")
    width, tables = table_shape(classes.count(), threshold, miss)
    signed = stages.keep(signatures(classes, width, tables, seed), "signatures")
    # Lists of one need no comparison; long ones get chunks.
    short = signed.select("id", F.size("vector").alias("dim"), F.posexplode("keys").alias("table", "key"))
    lists = (short.groupBy("dim", "table", "key").agg(F.count("*").alias("n")).filter("n > 1")
             .select("dim", "table", "key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    members = (signed.select("id", "copies", "vector", "keys", F.size("vector").alias("dim"), F.posexplode("keys").alias("table", "key"))
               .join(lists, ["dim", "table", "key"])
               .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
               .withColumn("one", F.least("chunk", "other")).withColumn("other", F.greatest("chunk", "other")))
    unit = ["dim", "table", "key", "one", "other"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit_key, group in _units(batches):
            ids, links, first = _compare(group, unit_key[1], unit_key[3], unit_key[4], threshold)
            if len(ids):
                yield pa.RecordBatch.from_pydict({"id": ids, "links": links, "first": first})

    dealt = (members.select(*unit, "chunk", "id", "copies", "vector", "keys")
             .repartition(partitions_for(rows), *unit).sortWithinPartitions(*unit))
    found = stages.keep(dealt.mapInArrow(compare, "id long, links long, first long"), "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.filter("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")), stages)
    named = (classes.join(counts, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
             .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    out = plain.join(named, "vector", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _units(batches: Iterator[pa.RecordBatch]):
    """Runs of rows with equal unit columns, across batch borders; vectors come
    at unit length."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = np.column_stack([batch.column(i).to_numpy() for i in range(5)]).astype(np.int64)
        cuts = np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(unit)]
        for begin, end in zip(bounds, bounds[1:]):
            key = tuple(unit[begin].tolist())
            if last is not None and key != last:
                yield last, _arrays(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield last, _arrays(held)


def _arrays(parts: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    n = rows.num_rows
    vectors = rows.column(7 + 1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    norms = np.abs(vectors).max(axis=1, keepdims=True)  # huge components must not overflow
    vectors = vectors / norms
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return {"chunk": rows.column(5).to_numpy(), "id": rows.column(6).to_numpy(), "copies": rows.column(7).to_numpy(),
            "vector": vectors, "keys": rows.column(9).flatten().to_numpy().reshape(n, -1)}
