"""Embedding near-duplicates by cross-polytope hashing with fast Hadamard rotations.

1. Vectors become unit vectors; equal ones are one class from here on.
2. In each of ``tables`` tables, ``functions`` pseudo-random rotations (three rounds of
   random signs and a fast Hadamard transform) send a vector to its nearest signed
   axis; the axes together are its bucket. Multiprobe: the ``probes - 1`` buckets that cost the
   least (the second axis in place of the first in one function) take it too.
3. Buckets with one member are left out before any vector moves. In the others
   cosines are computed in double precision, and edges that connect the linked members are kept (never all pairs).
4. Components of the links (``components.roots``), then the links of every vector
   are counted within its component. All links lie inside components, so a pair that the
   buckets missed is counted too if its ends are connected.

Groups (buckets, components) above ``block`` members never meet in one task. Members
within half the threshold angle of the group's mean are all linked with each other: their edges
and counts need no comparing. The others are compared with all members in blocks. No
member is dropped or capped, and a crowd of near copies costs one pass.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing, nor do rows without an id (whose component is null; ``kept`` is true). Vectors of different lengths
aren't linked. Repeated rows are vectors of their own with the same component. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.components import roots


def fast_hadamard(x: np.ndarray) -> np.ndarray:
    """Hadamard transform of each row (a power of two long), unnormalised."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def buckets(x: np.ndarray, tables: int, functions: int, probes: int, seed: int) -> np.ndarray:
    """Bucket numbers of unit vectors: (rows, tables, probes), different for each table."""
    n, dim = x.shape
    d = 1 << max(1, dim - 1).bit_length() if dim > 1 else 2
    padded = np.zeros((n, d), np.float32)
    padded[:, :dim] = x
    rng = np.random.default_rng([seed, d])
    out = np.empty((n, tables, probes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, second, loss = [], [], []
        for _ in range(functions):
            y = padded
            for _ in range(3):
                y = fast_hadamard(y * rng.choice(np.array([-1, 1], np.float32), d)) * np.float32(d ** -0.5)
            size = np.abs(y)
            first = size.argmax(1)
            top = size[rows, first].copy()
            size[rows, first] = -1
            next_ = size.argmax(1)
            best.append(2 * first + (y[rows, first] < 0))
            second.append(2 * next_ + (y[rows, next_] < 0))
            loss.append(top - size[rows, next_])
        order = np.argsort(np.stack(loss), axis=0)
        for p in range(probes):
            value = np.full(n, t, np.int64)
            for f in range(functions):
                axis = best[f] if p == 0 else np.where(order[p - 1] == f, second[f], best[f])
                value = value * (2 * d) + axis
            out[:, t, p] = value
    return out


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """``(id, x)`` for ``(id, embedding)`` rows; x is null where the vector can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, np.float64) if v and None not in v else None
                if x is not None and np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                    x = x / top  # no overflow or underflow in the norm
                    out.append(x / np.sqrt(x @ x))
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.list_(pa.float64()))],
                                             names=["id", "x"])

    return vectors.mapInArrow(run, "id long, x array<double>")


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) of the vectors of each length in an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    starts = column.offsets.to_numpy()
    flat, lengths = column.values.to_numpy(), np.diff(starts)
    out = []
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        out.append((at, flat[starts[at][:, None] + np.arange(d)]))
    return out


def bucket_rows(classes: DataFrame, tables: int, functions: int, probes: int, seed: int) -> DataFrame:
    """``(key, id)``: every class in all its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, x in _matrix(batch.column(1)):
                for i in range(0, len(at), 2048):
                    keys = buckets(x[i:i + 2048], tables, functions, probes, seed).reshape(len(x[i:i + 2048]), -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), pa.array(np.repeat(ids[at[i:i + 2048]], keys.shape[1]))], names=["key", "id"])

    return classes.select("id", "x").mapInArrow(run, "key long, id long")


def connected(linked: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each position of a symmetric link matrix."""
    label = np.arange(len(linked))
    while True:
        new = np.where(linked, label[None, :], len(label)).min(1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns (sorted), one table at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        edges = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            now = tuple(k[:, lo])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def within_groups(members: DataFrame, threshold: float, block: int, count: bool) -> DataFrame:
    """Links inside the groups of ``(key, id, n, size, x)`` rows; n is the weight of a member, size that of its group in members.

    ``count=False``: edges ``(a, b)`` that connect the linked members. ``count=True``:
    parts of ``(id, linked weight)`` as ``(a, b)``, to be summed; an own weight counts less one.
    """
    angle = math.acos(threshold)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 1):
            ids, n = group["id"].to_numpy(), group["n"].to_numpy()
            for at, x in _matrix(group["x"]):
                if len(at) == 1 and not count:
                    continue
                linked = x @ x.T >= threshold
                np.fill_diagonal(linked, True)
                if count:
                    yield _pairs(ids[at], linked @ n[at] - 1)
                else:
                    to = connected(linked)
                    moved = np.flatnonzero(to != np.arange(len(at)))
                    if len(moved):
                        yield _pairs(ids[at[moved]], ids[at[to[moved]]])

    done = (members.where(F.col("size") <= block).repartition("key").sortWithinPartitions("key")
            .select("key", "id", "n", "x").mapInArrow(small, "a long, b long"))
    large = members.where(F.col("size") > block)
    longest = large.agg(F.max(F.size("x")).alias("d")).collect()[0]["d"]
    if longest is None:
        return done

    large = large.withColumn("dim", F.size("x"))
    means = cut(large.groupBy("key", "dim").agg(
        F.array(*[F.sum(F.coalesce(F.get("x", F.lit(i)), F.lit(0.0))) for i in range(longest)]).alias("mean")))

    def near_mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = np.zeros(batch.num_rows, bool)
            column, mean = batch.column(6), batch.column(5)
            for at, x in _matrix(column):
                m = np.stack([np.array(v[:x.shape[1]]) for v in mean.take(pa.array(at)).to_pylist()])
                cosine = (x * m).sum(1) / np.maximum(np.sqrt((m * m).sum(1)), 1e-300)
                core[at] = np.arccos(np.clip(cosine, -1, 1)) <= angle / 2 - 1e-6
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(core), column],
                                             names=["key", "dim", "id", "n", "size", "core", "x"])

    flagged = cut(large.join(means, ["key", "dim"]).select("key", "dim", "id", "n", "size", "mean", "x")
                  .mapInArrow(near_mean, "key long, dim int, id long, n long, size long, core boolean, x array<double>"))
    facts = cut(flagged.groupBy("key", "dim").agg(F.min(F.when(F.col("core"), F.col("id"))).alias("center"),
                                                  F.sum(F.when(F.col("core"), F.col("n"))).alias("weight"),
                                                  F.sum(F.when(~F.col("core"), 1).otherwise(0)).alias("others")))
    known = flagged.join(facts, ["key", "dim"])
    inside = known.where("core").select(F.col("id").alias("a"), (F.col("weight") - 1 if count else F.col("center")).alias("b"))

    lane = lambda of: F.pmod(F.xxhash64("id"), F.ceil(F.col(of) / block)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), (F.ceil(F.col(of) / block) - 1).cast("int")))
    columns = ["key", "dim", "r", "m", "left", "id", "n", "core", "x"]
    left = known.where(~F.col("core")).withColumn("r", lane("others")).withColumn("m", every("size")).withColumn("left", F.lit(True))
    right = known.where("others > 0").withColumn("m", lane("size")).withColumn("r", every("others")).withColumn("left", F.lit(False))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            side = group["left"].to_numpy(zero_copy_only=False)
            ids, n = group["id"].to_numpy(), group["n"].to_numpy()
            core = group["core"].to_numpy(zero_copy_only=False)
            if side.all() or not side.any():
                continue
            [(_, x)] = _matrix(group["x"])
            a, b = np.flatnonzero(side), np.flatnonzero(~side)
            linked = x[a] @ x[b].T >= threshold
            same = ids[a][:, None] == ids[b][None, :]
            if count:
                linked &= ~same
                yield _pairs(np.concatenate([ids[a], ids[b][core[b]]]),
                             np.concatenate([linked @ n[b], (n[a] @ linked)[core[b]]]))
            else:
                both = np.zeros((len(ids), len(ids)), bool)
                both[np.ix_(a, b)] = linked | same
                both |= both.T
                to = connected(both)
                moved = np.flatnonzero(to != np.arange(len(ids)))
                yield _pairs(ids[moved], ids[to[moved]])

    across = (left.select(*columns).unionByName(right.select(*columns)).repartition("key", "dim", "r", "m")
              .sortWithinPartitions("key", "dim", "r", "m").mapInArrow(blocks, "a long, b long"))
    own = known.where(~F.col("core")).select(F.col("id").alias("a"), (F.col("n") - 1).alias("b"))
    parts = done.union(inside).union(across)
    return parts.union(own) if count else parts


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.9, tables: int = 10, functions: int = 3, probes: int = 3,
                    block: int = 1000, lanes: int = 256, seed: int = 5, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    if not 1 <= probes <= functions + 1:
        raise ValueError("probes must be 1 to functions + 1")
    units = unit_vectors(vectors.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")))
    lane = F.pmod(F.xxhash64("id"), F.lit(lanes)).cast("int").alias("lane")
    units = cut(units.select("id", lane, "x"))
    usable = F.col("id").isNotNull() & F.col("x").isNotNull()
    per_lane = units.where(usable).groupBy("x", "lane").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    classes = cut(per_lane.groupBy("x").agg(F.min("id").alias("id"), F.sum("n").alias("n"),
                                            F.collect_list("lane").alias("lanes")))
    # an id with several vectors stands for several classes: number them by their place
    classes = cut(classes.withColumnRenamed("id", "least").withColumn("id", F.monotonically_increasing_id()))

    keys = cut(bucket_rows(classes, tables, functions, probes, seed))
    shared = cut(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    members = keys.join(shared, "key").join(classes.select("id", "n", "x"), "id").select("key", "id", "n", "size", "x")
    linked = cut(roots(within_groups(members, threshold, block, count=False)))

    sizes = cut(linked.groupBy(F.col("root").alias("key")).agg(F.count("*").alias("size"))
                .withColumnRenamed("key", "root"))
    grouped = (linked.join(sizes, "root").withColumnRenamed("node", "id").join(classes.select("id", "n", "x", "least"), "id"))
    grouped = cut(grouped.select(F.col("root").alias("key"), "id", "n", "size", "x", "least"))
    named = grouped.groupBy("key").agg(F.min("least").alias("component_id"))
    counted = (within_groups(grouped.drop("least"), threshold, block, count=True)
               .groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links")))
    told = grouped.select("key", "id").join(named, "key").join(counted, "id").select("id", "component_id", "links")
    every = (classes.join(told, "id", "left")
             .select("x", F.explode("lanes").alias("lane"), F.coalesce("component_id", "least").alias("component_id"),
                     F.coalesce("links", F.col("n") - 1).alias("n_links")))
    done = units.where(usable).join(every, ["x", "lane"]).select("id", "n_links", "component_id")
    alone = units.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return done.union(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id",
                                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
