"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in at most t of 64 bits, with the bits dealt into m parts
and thresholds T_i >= -1 with sum(T_i) = t - m + 1, agree in some part i up to T_i bits
(a threshold of -1 skips its part). The steps:

1. Fingerprints; equal ones are one class from here on.
2. Correlated bits (64 x 64 product sums over all classes) are grouped greedily into
   the same part, which leaves the parts nearly independent.
3. Counts of part values, projected to at most ``estimate_bits`` bits, are summed
   over all classes: an upper estimate of what a probe will meet, of fixed size.
4. For each class a dynamic programme over the parts deals out its thresholds so
   that probes and estimated candidates are fewest. Its probes (all part values
   within T_i bits) are joined with the index and verified on the whole 64 bits.
5. A class whose cheapest deal still costs more than ``hot_limit`` (a crowd of near
   copies) is not probed; it emits its 65 keys within one bit instead. Two
   fingerprints within two bits always share such a key, and all that share one
   are within two bits, so those groups (65 members at most) need no comparing.
   Index rows that only such classes could ask for are left out. Nothing is
   dropped: the work a class is bounded by ``hot_limit``, whatever the crowd.
6. Components of the links (``components.roots``).

Defined results: null and empty texts (no word) have fingerprint zero and link like any
other; a text with fewer words than a shingle has its whole word sequence as its
one shingle. Repeated rows each get a row; null ids get one too and are never
chosen as a component's id unless it has no other. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, slices, texts, tree_merge
from tidemark.llm.components import roots

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles (repeats included), 0 for a text without words."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        parts = [joined]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[:-1]]
        parts = [joined[s:e - 1] for s, e in zip(starts, ends[shingle - 1:])]
    hashed = np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in parts), np.uint64, len(parts))
    eight = hashed.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(parts) < 64:
        ones = np.unpackbits(eight, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(eight[:, j], minlength=256) @ _BITS_OF_BYTE for j in range(8)])
    return int(np.packbits(ones * 2 > len(parts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp)`` for ``(id, text)`` rows; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                fps = np.array([fingerprint(t, shingle, seed) for t in texts(rows.column(1))], np.uint64)
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(fps.view(np.int64))],
                                                 names=["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


def _longs(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones for each fingerprint, bit 0 first."""
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _add(dtype: str):
    def merge(held: bytes | None, payload: bytes) -> bytes:
        return payload if held is None else (np.frombuffer(held, dtype) + np.frombuffer(payload, dtype)).tobytes()
    return merge


def bit_products(classes: DataFrame) -> tuple[np.ndarray, int]:
    """Sums of products of all bit pairs over the classes, and the number of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            for rows in slices(batch, 8192):
                x = _bit_matrix(_longs(rows)).astype(np.float32)
                total += np.rint(x.T @ x).astype(np.int64)
                n += len(x)
        if n:
            payload = np.append(total.ravel(), n).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([payload], pa.binary())],
                                             names=["part", "payload"])

    merged = tree_merge(classes.select("fp").mapInArrow(run, "part int, payload binary"), _add("<i8")).collect()
    if not merged:
        return np.zeros((64, 64), np.int64), 0
    flat = np.frombuffer(merged[0]["payload"], "<i8")
    return flat[:-1].reshape(64, 64), int(flat[-1])


def correlated_parts(products: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Deal 64 bits into m parts of nearly equal width, correlated bits into the same part."""
    mean = np.diag(products) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs((products / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, parts = list(range(64)), []
    for i in range(m):
        width = (len(free) + m - i - 1) // (m - i)
        part = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < width:
            best = max(free, key=lambda b: (corr[b, part].mean(), -b))
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def part_values(fps: np.ndarray, parts: list[list[int]]) -> list[np.ndarray]:
    """The value of each part: its bits gathered into the low bits of a 64-bit integer."""
    out = []
    for part in parts:
        value = np.zeros(len(fps), np.uint64)
        for k, bit in enumerate(part):
            value |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
        out.append(value)
    return out


def value_counts(classes: DataFrame, parts: list[list[int]], bits: int) -> np.ndarray:
    """How many classes have each part value, by its low ``bits`` bits: (parts, 2 ** bits)."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(parts), 1 << bits), np.int64)
        for batch in batches:
            for i, v in enumerate(part_values(_longs(batch), parts)):
                held[i] += np.bincount((v & mask).astype(np.int64), minlength=1 << bits)
        for i, counts in enumerate(held):
            at = np.flatnonzero(counts)
            if len(at):
                payload = at.astype("<i8").tobytes() + counts[at].astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([payload], pa.binary())],
                                                 names=["part", "payload"])

    def merge(held: bytes | None, payload: bytes) -> bytes:
        if held is None:
            return payload
        both = [np.frombuffer(x, "<i8").reshape(2, -1) for x in (held, payload)]
        at, inverse = np.unique(np.concatenate([x[0] for x in both]), return_inverse=True)
        counts = np.zeros(len(at), np.int64)
        np.add.at(counts, inverse, np.concatenate([x[1] for x in both]))
        return at.astype("<i8").tobytes() + counts.astype("<i8").tobytes()

    out = np.zeros((len(parts), 1 << bits), np.int64)
    for row in tree_merge(classes.select("fp").mapInArrow(run, "part int, payload binary"), merge).collect():
        at, counts = np.frombuffer(row["payload"], "<i8").reshape(2, -1)
        out[row["part"], at] = counts
    return out


def flips(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of ``width`` bits."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(range(width), r)]
    return np.array(masks, np.uint64)


def probe_costs(values: list[np.ndarray], widths: list[int], counts: np.ndarray, distance: int, bits: int) -> np.ndarray:
    """Probes and estimated candidates of each part at each threshold from -1: (parts, distance + 2, rows)."""
    mask = np.uint64((1 << bits) - 1)
    cost = np.zeros((len(values), distance + 2, len(values[0])))
    for i, (value, width) in enumerate(zip(values, widths, strict=True)):
        for radius in range(distance + 1):
            masks = flips(width, radius)
            total = np.full(len(value), float(len(masks)))
            low, times = np.unique(masks & mask, return_counts=True)
            for flip, n in zip(low, times, strict=True):
                total += n * counts[i, ((value ^ flip) & mask).astype(np.int64)]
            cost[i, radius + 1] = total
    return cost


def deal_thresholds(cost: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Cheapest thresholds with sum distance - m + 1, by dynamic programming over the parts.

    Thresholds are counted from -1, so the m parts share distance + 1 steps.
    Returns the steps (m, rows) and the cost (rows).
    """
    m, steps, rows = cost.shape
    best = np.full((steps, rows), np.inf)
    best[0] = 0
    choice = np.zeros((m, steps, rows), np.int8)
    for i in range(m):
        grown = np.full((steps, rows), np.inf)
        for total in range(steps):
            for own in range(total + 1):
                c = best[total - own] + cost[i, own]
                better = c < grown[total]
                grown[total][better] = c[better]
                choice[i, total][better] = own
        best = grown
    left = np.full(rows, distance + 1)
    steps_of = np.zeros((m, rows), np.int8)
    for i in range(m - 1, -1, -1):
        steps_of[i] = choice[i, left, np.arange(rows)]
        left = left - steps_of[i]
    return steps_of, best[distance + 1]


def links(classes: DataFrame, distance: int, m: int, estimate_bits: int, hot_limit: int) -> DataFrame:
    """``(a, b)`` edges that connect all distinct fingerprints at most ``distance`` (1 or 2) bits apart."""
    sc = classes.sparkSession.sparkContext
    products, n = bit_products(classes)
    parts = correlated_parts(products, n, m)
    widths = [len(p) for p in parts]
    bits = min(estimate_bits, min(widths))
    known = sc.broadcast(value_counts(classes, parts, bits))
    mask = np.uint64((1 << bits) - 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of kind 0 (index), 1 (probe) and 2 (key of a crowd)."""
        counts = known.value

        def rows(kind: int, part: int, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            n = len(fp)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int8)), pa.array(np.full(n, part, np.int8)),
                 pa.array(value.view(np.int64)), pa.array(fp.view(np.int64))], names=["kind", "part", "value", "fp"])

        for batch in batches:
            for piece in slices(batch, 4096):
                fps = _longs(piece)
                values = part_values(fps, parts)
                steps, cost = deal_thresholds(probe_costs(values, widths, counts, distance, bits), distance)
                hot = cost > hot_limit
                for i, value in enumerate(values):
                    asked = counts[i, (value & mask).astype(np.int64)] <= hot_limit
                    yield rows(0, i, value[asked], fps[asked])
                    for radius in range(distance + 1):
                        own = ~hot & (steps[i] == radius + 1)
                        if own.any():
                            for flip in flips(widths[i], radius):
                                yield rows(1, i, value[own] ^ flip, fps[own])
                if hot.any():
                    for flip in flips(64, 1):
                        yield rows(2, 0, fps[hot] ^ flip, fps[hot])

    keyed = cut(classes.select("fp").mapInArrow(emit, "kind byte, part byte, value long, fp long"))
    index = keyed.where("kind = 0").select("part", "value", F.col("fp").alias("b"))
    probes = keyed.where("kind = 1").select("part", "value", F.col("fp").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    probed = (probes.join(index, ["part", "value"]).where(near & (F.col("a") != F.col("b")))
              .select("a", "b"))
    crowd = (keyed.where("kind = 2").groupBy("value").agg(F.collect_set("fp").alias("fps"))  # 65 at most
             .where(F.size("fps") > 1))
    # members of a group can be two bits apart, but each is within one bit of the group's value
    first = F.array_min("fps") if distance == 2 else F.when(F.array_contains("fps", F.col("value")), F.col("value"))
    crowd = crowd.select(first.alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return probed.union(crowd)


def near_duplicates(docs: DataFrame, *, shingle: int = 3, distance: int = 2, seed: int = 42, parts: int = 3,
                    estimate_bits: int = 18, hot_limit: int = 1000, lanes: int = 256,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row."""
    if distance not in (1, 2):
        raise ValueError("distance must be 1 or 2: crowds are linked by keys within one bit")
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    lane = F.pmod(F.xxhash64("doc_id"), F.lit(lanes)).cast("int")
    fps = cut(fingerprints(pairs, shingle, seed).withColumn("lane", lane))
    per_lane = fps.groupBy("fp", "lane").agg(F.min("doc_id").alias("least"))
    classes = cut(per_lane.groupBy("fp").agg(F.min("least").alias("least"), F.collect_list("lane").alias("lanes")))
    linked = roots(links(classes, distance, parts, estimate_bits, hot_limit))
    rooted = (classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least", "lanes", F.coalesce("root", "fp").alias("root")))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(first, "root").select("fp", F.explode("lanes").alias("lane"), "component_id")
    return (fps.join(named, ["fp", "lane"])
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
