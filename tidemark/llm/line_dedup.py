"""Exact line de-duplication with two Bloom filters.

1. Each task hashes the distinct line keys of its documents into a *once* and a
   *twice* filter: a key whose bits are already set goes to the second. Partial
   filters are merged as bits (set once in both sides = set twice), so every key
   that occurs in two documents is in the merged twice filter.
2. The twice filter (``2 ** filter_bits`` bits, a fixed size) is broadcast. Only
   keys found in it, the suspected repeats, are shuffled; grouping by the key
   itself confirms them exactly and picks the smallest document.
3. Confirmed keys go back to the documents that must lose them.

Repeats are confirmed exactly, so a filter that fills up costs more shuffled
suspects, never a wrong result. A key held by a third of all documents is spread
over lanes (``common.lanes_of_key``).

Defined results: null and empty texts are one empty line. A document is its id:
repeated rows of an id are one document and lose the same keys. Null ids count as
one document that is larger than all others. Other columns pass through; where a
result column's name (the text column, ``n_lines``, ``n_dropped``) is already
taken, the result stands in its place. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, lanes_of_key, slices, texts, tree_merge

PARTS = 64  #: a filter is kept and merged in so many parts


def line_keys(text: str) -> list[bytes]:
    """Key of each line: ASCII white space stripped at both ends, A-Z lower-cased."""
    return [line.strip() for line in text.encode("utf-8").lower().split(b"\n")]


def long_keys(text: str, min_length: int) -> list[bytes]:
    """The distinct keys of a text that have at least ``min_length`` code points."""
    return [k for k in set(line_keys(text))
            if len(k) >= min_length and (k.isascii() or len(k.decode("utf-8")) >= min_length)]


class TwoFilters:
    """Once-seen and twice-seen Bloom filters of two bits a key, in ``PARTS`` parts."""

    def __init__(self, filter_bits: int):
        self.filter_bits = filter_bits
        self.bits = np.zeros((2, PARTS, (1 << filter_bits) // PARTS // 8), np.uint8)

    def add(self, h: np.ndarray) -> None:
        """Take the keys of some documents (each key once a document)."""
        h, n = np.unique(h, return_counts=True)
        again = (n > 1) | holds(self.bits[0], places(h, self.filter_bits))
        for filter_, keys in ((self.bits[1], h[again]), (self.bits[0], h)):
            for part, byte, bit in places(keys, self.filter_bits):
                np.bitwise_or.at(filter_, (part, byte), bit)


def places(h: np.ndarray, filter_bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Part, byte and bit of both bits of each hash; the top six bits name the part."""
    mask = np.uint64((1 << filter_bits) // PARTS - 1)
    part = (h >> np.uint64(58)).astype(np.int64)
    out = []
    for shift in (0, 28):
        at = (h >> np.uint64(shift)) & mask
        out.append((part, (at >> np.uint64(3)).astype(np.int64),
                    np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))))
    return out


def holds(bits: np.ndarray, at: list) -> np.ndarray:
    """Which keys have all their bits set."""
    found = [(bits[part, byte] & bit) != 0 for part, byte, bit in at]
    return found[0] & found[1]


def pack_part(part: np.ndarray) -> bytes:
    """Bytes of one part of both filters: only the non-zero ones if they are few."""
    flat = part.reshape(-1)
    at = np.flatnonzero(flat)
    if len(at) * 5 < len(flat):
        return b"s" + at.astype("<u4").tobytes() + flat[at].tobytes()
    return b"d" + flat.tobytes()


def unpack_part(payload: bytes, size: int) -> np.ndarray:
    if payload[:1] == b"d":
        return np.frombuffer(payload, np.uint8, offset=1).reshape(2, -1)
    n = (len(payload) - 1) // 5
    flat = np.zeros(2 * size, np.uint8)
    flat[np.frombuffer(payload, "<u4", n, 1)] = np.frombuffer(payload, np.uint8, n, 1 + 4 * n)
    return flat.reshape(2, -1)


def twice_filter(docs: DataFrame, filter_bits: int, min_length: int) -> np.ndarray:
    """The merged twice filter of ``(id, text)`` rows, as (PARTS, bytes)."""
    size = (1 << filter_bits) // PARTS // 8

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = TwoFilters(filter_bits)
        for batch in batches:
            for rows in slices(batch):
                keys = [xxhash.xxh3_64_intdigest(k) for t in texts(rows.column(1)) for k in long_keys(t, min_length)]
                if keys:
                    filters.add(np.array(keys, np.uint64))
        parts = [p for p in range(PARTS) if filters.bits[0, p].any()]
        for p in parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([pack_part(filters.bits[:, p])], pa.binary())],
                names=["part", "payload"])

    def merge(held: bytes | None, payload: bytes) -> bytes:
        if held is None:
            return payload
        a, b = unpack_part(held, size), unpack_part(payload, size)
        return pack_part(np.stack([a[0] | b[0], a[1] | b[1] | (a[0] & b[0])]))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            twice = [np.ascontiguousarray(unpack_part(x.as_py(), size)[1]).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(twice, pa.binary())], names=["part", "payload"])

    merged = tree_merge(docs.mapInArrow(build, "part int, payload binary"), merge)
    out = np.zeros((PARTS, size), np.uint8)
    for row in merged.mapInArrow(second, "part int, payload binary").collect():  # PARTS rows of a fixed size
        out[row["part"]] = np.frombuffer(row["payload"], np.uint8)
    return out


def suspects(docs: DataFrame, filter_bits: int, min_length: int) -> DataFrame:
    """``(doc_id, key)`` of the keys in the twice filter, each once a row of ``docs``."""
    twice = docs.sparkSession.sparkContext.broadcast(twice_filter(docs, filter_bits, min_length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                ids, keys = [], []
                for doc, text in zip(rows.column(0).to_pylist(), texts(rows.column(1)), strict=True):
                    own = long_keys(text, min_length)
                    ids += [doc] * len(own)
                    keys += own
                if not keys:
                    continue
                h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
                found = np.flatnonzero(holds(twice.value, places(h, filter_bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in found], pa.int64()),
                     pa.array([keys[i].decode("utf-8") for i in found], pa.string())], names=["doc_id", "key"])

    return docs.mapInArrow(run, "doc_id long, key string")


def repeated_keys(docs: DataFrame, filter_bits: int, min_length: int) -> DataFrame:
    """``(doc_id, key)``: the keys each document must lose, confirmed on the keys themselves."""
    rows = cut(suspects(docs, filter_bits, min_length))
    spread = lanes_of_key(
        rows, "key", "doc_id",
        [F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max(F.col("doc_id").isNull()).alias("no_id")],
        lambda: [F.min("lo").alias("first"), F.max("hi").alias("last"), F.max("no_id").alias("no_id")])
    many = (F.col("first") < F.col("last")) | (F.col("no_id") & F.col("first").isNotNull())
    return spread.where(many & ~F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "key")


def _without(text: pa.Array, drop: pa.Array) -> pa.Array:
    kept, lines, dropped = [], [], []
    for t, d in zip(texts(text), drop.to_pylist(), strict=True):
        n = t.count("\n") + 1
        lines.append(n)
        if d:
            gone = {k.encode("utf-8") for k in d}
            stay = [line for line, key in zip(t.split("\n"), line_keys(t), strict=True) if key not in gone]
            kept.append("\n".join(stay))
            dropped.append(n - len(stay))
        else:
            kept.append(t)
            dropped.append(0)
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(lines, pa.int64()),
                                       pa.array(dropped, pa.int64())], names=["kept", "n_lines", "n_dropped"])


def without_lines(text: Column, drop: Column) -> Column:
    """Struct of the text without the lines whose key is in ``drop``, its lines and how many went."""
    def in_slices(text_: pa.Array, drop_: pa.Array) -> pa.Array:
        """Few texts are Python objects at a time, whatever the size of an Arrow batch."""
        step = 256
        return pa.concat_arrays([_without(text_.slice(i, step), drop_.slice(i, step)) for i in range(0, max(len(text_), 1), step)])

    return F.arrow_udf(in_slices, "kept string, n_lines long, n_dropped long")(text, drop)


def dedup_lines(docs: DataFrame, *, min_length: int = 10, filter_bits: int = 27,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the lines whose first occurrence is in a smaller document."""
    if not 9 <= filter_bits <= 34:
        raise ValueError("filter_bits must be 9 to 34")
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    drops = (repeated_keys(pairs, filter_bits, min_length).groupBy("doc_id")
             .agg(F.collect_set("key").alias("_drop")).withColumnRenamed("doc_id", "_of"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"))
    joined = rows.join(drops.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_of")), "left")
    done = joined.withColumn("_new", without_lines(F.col(f"_row.`{text_col}`"), F.col("_drop")))
    taken = {text_col: "kept", "n_lines": "n_lines", "n_dropped": "n_dropped"}
    keep = [F.col(f"_row.`{c}`") for c in docs.columns if c not in taken]
    return done.select(*keep, *[F.col(f"_new.{v}").alias(k) for k, v in taken.items()])
