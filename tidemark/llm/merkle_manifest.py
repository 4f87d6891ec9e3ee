"""Merkle dataset manifest: aligned builders write a postorder append log; proofs address it in closed form.

A row's leaf is the SHA-256 of its columns, each written as ``-`` (null) or as its length in UTF-8 bytes, ``:``
and its value. The leaves of a group, in the order of their ids, are the bottom of a binary tree; of an odd level the
last node is hashed alone. The subroots, in the order of their groups, are the bottom of one more such tree.

1. Leaves are range-partitioned by (group, id), sorted and checkpointed; rows per partition and group give every leaf
   its index (``ranked``).
2. A builder takes an aligned block of ``2^bits`` leaves and writes each node once its children are written. The
   blocks' roots are the leaves of the next round, until one block is left: rounds grow with the logarithm of the rows to the
   base ``2^bits``, and no builder sees more than a block.
3. A node's place in its block's log follows from the sizes of the subtrees before it and its own
   (``postorder_position``). Proofs go down from the last round: each block hands every leaf the siblings found at
   those places and the tail that the block was given itself.

Defined results: null ids come first, equal ids in the order of their leaves (equal rows are leaves of their own); a null group comes
before all others; an empty table has no rows. Other columns than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.operators.sizing import checked_broadcast

DIGEST = 32
LEAF_SCHEMA = "grp string, i long, n long, digest binary, item long, claimed binary"
SEGMENT_SCHEMA = "grp string, block long, n int, height int, log binary, items array<long>, claimed binary"


# ------------------------------------------------------------------ leaves
def encoded(column: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and value."""
    value = column.cast("string")
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, columns)).cast("binary"), 256))


def grouped(column: Column) -> Column:
    """A group as text that sorts null first, then by bytes."""
    return F.when(column.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), column.cast("string")))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with their 0-based index ``i`` in their group and the group's size ``n``.

    Rows are checkpointed before the range partitioning samples them, with a number that splits equal rows too.
    """
    rows = cut(rows.withColumn("_tie", F.monotonically_increasing_id()))
    keys = [F.col(group).asc(), *[F.col(c).asc_nulls_first() for c in order], F.col("_tie").asc()]
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumns({"_p": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    per_part = placed.groupBy(group, "_p").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(F.col(group).alias("_group"), F.col("_p").alias("_part"),
                             (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                             F.sum("_rows").over(whole).alias("n"))
    starts = checked_broadcast(cut(starts))  # one row a group and partition
    joined = placed.join(starts, (placed[group] == starts["_group"]) & (placed["_p"] == starts["_part"]))
    return joined.withColumn("i", F.col("_at") + F.col("_shift")).drop("_tie", "_p", "_at", "_group", "_part", "_shift")


# ------------------------------------------------------------------ the log of one tree
def parent(*children: bytes) -> bytes:
    return sha256("".join(map(bytes.hex, children)).encode()).digest()


def levels(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(n - 1, 0).bit_length()


def postorder_position(level: int, index: int, n: int) -> int:
    """Place of node ``index`` of ``level`` in the postorder log of n leaves, by the sizes of the complete subtrees before it and its own."""
    first, end = index << level, min((index + 1) << level, n)
    own = sum(-(-end // (1 << t)) - (first >> t) for t in range(level + 1))
    return 2 * first - first.bit_count() + own - 1


def postorder(leaves: list[bytes], height: int) -> bytes:
    """Log of a tree of the given height: nodes in the order of their completion."""
    out: list[bytes] = []
    waiting: list[bytes | None] = [None] * height

    def put(level: int, node: bytes) -> None:
        out.append(node)
        while level < height:
            left, waiting[level] = waiting[level], None
            if left is None:
                waiting[level] = node
                return
            level, node = level + 1, parent(left, node)
            out.append(node)

    for leaf in leaves:
        put(0, leaf)
    for level in range(height):  # what is left is the last node of its level, alone
        alone, waiting[level] = waiting[level], None
        if alone is not None:
            put(level + 1, parent(alone))
    return b"".join(out)


@lru_cache(maxsize=64)
def places(n: int, height: int) -> list[list[int]]:
    """Where the digests of all nodes start in a log, level by level."""
    return [[DIGEST * postorder_position(t, i, n) for i in range(-(-n // (1 << t)))] for t in range(height + 1)]


def siblings(log: bytes, n: int, height: int, index: int) -> tuple[str, bytes]:
    """The sides (L, R, or - where a node is alone) and digests of a leaf's siblings, bottom up."""
    sides, found = [], []
    for t, at in enumerate(places(n, height)[:height]):
        other = (index >> t) ^ 1
        if other >= len(at):
            sides.append("-")
            continue
        sides.append("RL"[(index >> t) & 1])
        found.append(log[at[other]:at[other] + DIGEST])
    return "".join(sides), b"".join(found)


def fold(digest: bytes, sides: str, proof: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    at = 0
    for side in sides:
        if side == "-":
            digest = parent(digest)
            continue
        other, at = proof[at:at + DIGEST], at + DIGEST
        digest = parent(other, digest) if side == "L" else parent(digest, other)
    return digest


# ------------------------------------------------------------------ builders
def _segments(leaves: DataFrame, bits: int) -> DataFrame:
    """The logs of all aligned blocks of the ranked ``leaves``."""
    width = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # group, block, leaves of the tree
        digests, items, claimed = [], [], []

        def block() -> pa.RecordBatch:
            grp, at, n = held
            height = min(bits, levels(n))
            return pa.RecordBatch.from_arrays(
                [pa.array([grp]), pa.array([at], pa.int64()), pa.array([len(digests)], pa.int32()), pa.array([height], pa.int32()),
                 pa.array([postorder(digests, height)], pa.binary()), pa.array([items], pa.list_(pa.int64())),
                 pa.array([b"".join(claimed)], pa.binary())],
                names=["grp", "block", "n", "height", "log", "items", "claimed"])

        for batch in batches:
            for grp, i, n, digest, item, other in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                key = (grp, i >> bits, n)
                if key != held:
                    if held is not None:
                        yield block()
                    held, digests, items, claimed = key, [], [], []
                digests.append(digest)
                items.append(item)
                claimed.append(other)
        if held is not None:
            yield block()

    placed = leaves.withColumn("block", F.expr(f"i div {width}"))
    placed = placed.repartition("grp", "block").sortWithinPartitions("grp", "i").select("grp", "i", "n", "digest", "item", "claimed")
    return placed.mapInArrow(run, SEGMENT_SCHEMA)


@dataclass(frozen=True)
class Log:
    """The logs of a tree for each group, one table a round, and their roots ``(grp, root)``."""

    rounds: list[DataFrame]
    roots: DataFrame


def append_log(leaves: DataFrame, bits: int = 10) -> Log:
    """Logs of the trees over ``leaves`` (columns of ``LEAF_SCHEMA``), written to the shared folder."""
    if not 1 <= bits <= 16:
        raise ValueError("a block holds 2 to 65,536 leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0
    rounds: list[DataFrame] = []
    top = F.substring("log", -DIGEST, DIGEST)
    while True:
        rounds.append(cut(_segments(leaves, bits)))
        most = -(-most // (1 << bits))
        if most <= 1:
            return Log(rounds, rounds[-1].select("grp", top.alias("root")))
        sizes = rounds[-1].groupBy("grp").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("grp", "_grp")
        blocks = rounds[-1].select("grp", F.col("block").alias("i"), top.alias("digest"))
        leaves = blocks.join(checked_broadcast(sizes), F.col("grp") == F.col("_grp")).select(
            "grp", "i", "n", "digest", F.lit(None).cast("long").alias("item"), F.col("digest").alias("claimed"))


# ------------------------------------------------------------------ proofs
_HANDED = "grp string, block long, subroot binary, root binary, sides string, proof binary"
_PROVEN = "item long, leaf binary, subroot binary, root binary, sides string, proof binary, folded binary"


def _handed(segments: DataFrame, tails: DataFrame, bits: int, last: bool = False) -> DataFrame:
    """What every leaf of the segments is handed: its siblings there, then its block's tail.

    ``last`` also folds each leaf's claimed digest; then ``items`` names the leaves.
    """
    names = [c.split()[0] for c in (_PROVEN if last else _HANDED).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a block at a time
                row = {name: batch.column(j)[k].as_py() for j, name in enumerate(batch.schema.names)}
                log, n, height, claimed = row["log"], row["n"], row["height"], row["claimed"]
                own = [siblings(log, n, height, i) for i in range(n)]
                sides = [s + row["sides"] for s, _ in own]
                proof = [p + row["proof"] for _, p in own]
                common = [pa.array([row[c]] * n, pa.binary()) for c in ("subroot", "root")]
                found = [pa.array(sides, pa.string()), pa.array(proof, pa.binary())]
                if not last:
                    first = row["block"] << bits
                    yield pa.RecordBatch.from_arrays([pa.array([row["grp"]] * n), pa.array(range(first, first + n), pa.int64()),
                                                      *common, *found], names=names)
                    continue
                leaves = [log[at:at + DIGEST] for at in places(n, height)[0]]
                folded = [fold(claimed[DIGEST * i:DIGEST * (i + 1)], s, p) for i, (s, p) in enumerate(zip(sides, proof, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(row["items"], pa.int64()), pa.array(leaves, pa.binary()), *common, *found,
                                                  pa.array(folded, pa.binary())], names=names)

    tails = tails.withColumnsRenamed({"grp": "_grp", "block": "_block"})
    joined = segments.join(tails, (segments["grp"] == tails["_grp"]) & (segments["block"] == tails["_block"])).drop("_grp", "_block")
    return joined.mapInArrow(run, _PROVEN if last else _HANDED)


def manifest(rows: DataFrame, columns: list[str], *, id_col: str = "doc_id", group_col: str = "lang",
             claim: Column | None = None, bits: int = 10) -> DataFrame:
    """One row per input row: ``item`` (its id), ``leaf``, ``subroot``, ``root``, its ``sides`` and ``proof`` and ``folded``.

    ``columns`` are hashed in the given order. ``claim`` is the digest that someone shows for the row (default: the
    leaf itself); ``folded`` is the root that it leads to with the row's siblings. Digests are binary.
    """
    own = leaf_digest([F.col(f"`{c}`") for c in columns])
    leaves = rows.select(grouped(F.col(f"`{group_col}`")).alias("grp"), F.col(f"`{id_col}`").cast("long").alias("item"),
                         own.alias("digest"), (own if claim is None else claim).alias("claimed"))
    of_groups = append_log(ranked(leaves, "grp", ["item", "digest"]), bits)
    subroots = of_groups.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("digest"))
    order = cut(ranked(subroots, "grp", ["name"]))
    top = append_log(order.withColumns({"item": F.lit(None).cast("long"), "claimed": F.col("digest")}), bits)
    tails = top.roots.select("grp", F.lit(0).cast("long").alias("block"), F.col("root").alias("subroot"), "root",
                             F.lit("").alias("sides"), F.unhex(F.lit("")).alias("proof"))
    for segments in reversed(top.rounds):
        tails = _handed(segments, tails, bits)
    tails = (order.select("name", "i", F.col("digest").alias("own")).join(tails.drop("grp", "subroot"), F.col("i") == F.col("block"))
             .select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), F.col("own").alias("subroot"), "root", "sides", "proof"))
    for segments in reversed(of_groups.rounds[1:]):
        tails = _handed(segments, tails, bits)
    return _handed(of_groups.rounds[0], tails, bits, last=True)
