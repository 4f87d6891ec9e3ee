"""Hard negatives by an inverted multi-index: two half-space codebooks, cells visited by bounds, certified windows.

A row is hard for an anchor and one of its positives if its label differs and its integer inner product with the
anchor is at least ``floor_pct`` percent of the positive's and at most the positive's.

1. Components become ``floor(scale * x)``. A bounded sample fits one codebook for either half of the vector; every row falls
   into the cell of its two nearest codewords. Codewords know the largest distance (radius) of their rows.
2. Rows are kept as blocks by (cell, lane): a cell has as many lanes as it fills blocks, so a vector that a third
   of all rows share is spread like any other rows.
3. An anchor's half scores with the codewords plus its half's norm times the radius bound what a cell can hold. The
   multi-sequence heap visits cells in the order of the summed bounds.
4. Positives: the first wave visits cells until ``first_rows`` rows are seen; the last one found so far is a certified
   bound, and the second wave visits only cells whose bound reaches it. Negatives: the same, for the windows below
   each positive; a window is certified when the bound of all cells left is below its last row or below the window.

Results are exact: codebooks, sample and waves decide only how many cells are opened. Anchors travel in blocks of
similar ones, rows in blocks of a cell; a task holds one pair of blocks and the best rows of the anchors it has seen.

Defined results: rows with a null id, a null label, a null vector, a null or non-finite component, or one of 2**20 or more in size take
no part; nor do rows of another vector length than the most frequent (of equally frequent: the smallest). The anchor's
own id is neither its positive nor its negative. Equal rows count once; rows of one id with different vectors or labels are
rows of their own, ordered by score, then id, and an anchor id with several rows gives the results of each, once. An
empty table has no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

LARGEST = 1 << 28  # products of two such components, summed over 64 of them, fit 64 bits
LOWEST = -(1 << 62)


# ------------------------------------------------------------------ rows
def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``(id, label, q, at)`` of the rows that take part; q holds the integer components."""
    at = F.col(f"`{vector_col}`")
    inside = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / scale)
    kept = rows.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & at.isNotNull() & F.coalesce(F.forall(at, inside), F.lit(False)))
    q = F.transform(at, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    return kept.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), q.alias("q"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column as one integer matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where every sum is exact in it."""
    reach = np.sqrt((a.astype(float) ** 2).sum(1).max(initial=0)) * np.sqrt((b.astype(float) ** 2).sum(1).max(initial=0))
    if reach < 2 ** 23:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if reach < 2 ** 52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


# ------------------------------------------------------------------ codebooks and cells
def nearest(x: np.ndarray, codewords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest codeword and the distance to it."""
    square = (x ** 2).sum(1)[:, None] - 2 * x @ codewords.T + (codewords ** 2).sum(1)
    best = square.argmin(1)
    return best, np.sqrt(((x - codewords[best]) ** 2).sum(1))


def codebook(x: np.ndarray, size: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Codewords of a half by Lloyd's rounds over sampled rows."""
    x = np.unique(x, axis=0)
    words = x[np.random.default_rng(seed).permutation(len(x))[:size]]
    for _ in range(rounds):
        own, _ = nearest(x, words)
        words = np.array([x[own == k].mean(0) if (own == k).any() else words[k] for k in range(len(words))])
    return words


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, their radii, and the rows and lanes of each non-empty cell."""

    halves: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    cells: dict[tuple[int, int], int]  # rows of a cell

    def bounds(self, anchor: np.ndarray) -> list[np.ndarray]:
        """Largest half score that a row of each codeword can have."""
        split = self.halves[0].shape[1]
        out = []
        for part, words, radius in zip((anchor[:split], anchor[split:]), self.halves, self.radii, strict=True):
            bound = words @ part + np.sqrt(part @ part) * radius
            out.append(bound + 1e-6 * (1 + np.abs(bound)))  # above rounding
        return out

    def visit(self, anchor: np.ndarray) -> Iterator[tuple[float, tuple[int, int]]]:
        """All non-empty cells in the order of their summed bounds, by the multi-sequence heap."""
        u, v = self.bounds(anchor)
        first, second = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
        heap = [(-(u[first[0]] + v[second[0]]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = (int(first[i]), int(second[j]))
            if cell in self.cells:
                yield -bound, cell
            if j + 1 < len(second):
                heapq.heappush(heap, (-(u[first[i]] + v[second[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-(u[first[i + 1]] + v[second[0]]), i + 1, 0))


def fit(rows: DataFrame, width: int, n: int, fit_rows: int, cell_rows: int, most_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks from about ``fit_rows`` rows, chosen by a hash; their size follows the number of rows."""
    size = int(min(most_words, max(2, round((n / cell_rows) ** 0.5))))
    part = min(1.0, fit_rows / n)
    sample = rows.where(F.abs(F.xxhash64("q", F.lit(5)) / float(1 << 63)) <= part).dropDuplicates(["q"]).select("q").toArrow()
    x = matrix(sample.column(0).combine_chunks(), width).astype(float)
    if not len(x):  # no row's hash is among them
        x = np.array([rows.select("q").first()[0]], float)
    return codebook(x[:, :width // 2], size), codebook(x[:, width // 2:], size, seed=12)


_CELL = "id long, label long, q array<int>, a int, b int, ra double, rb double"


def in_cells(rows: DataFrame, halves: tuple[np.ndarray, np.ndarray], width: int) -> DataFrame:
    """Rows with the codewords (a, b) of their halves and the distances to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), width).astype(float)
            a, ra = nearest(x[:, :width // 2], halves[0])
            b, rb = nearest(x[:, width // 2:], halves[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                                              pa.array(ra), pa.array(rb)], names=[c.split()[0] for c in _CELL.split(", ")])

    return rows.mapInArrow(run, _CELL)


_BLOCK = "a int, b int, lane int, ids binary, labels binary, rows binary"


def blocks(celled: DataFrame, lanes: Column, width: int, most: int = 4096) -> DataFrame:
    """Rows as blocks ``(a, b, lane, ids, labels, rows)`` of at most ``most`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            ids, labels = (table.column(c).to_numpy().astype("<i8") for c in ("id", "label"))
            q = matrix(table.column("q").combine_chunks(), width).astype("<i4")
            whole = np.hstack([ids.view("<i4").reshape(-1, 2), labels.view("<i4").reshape(-1, 2), q])
            _, kept = np.unique(whole, axis=0, return_index=True)  # equal rows count once
            ids, labels, q = (x[kept].tobytes() for x in (ids, labels, q))
            return pa.RecordBatch.from_arrays(
                [*[pa.array([k], pa.int32()) for k in held], *[pa.array([x], pa.binary()) for x in (ids, labels, q)]],
                names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for start, stop in zip([0, *ends], [*ends, len(keys)], strict=True):
                key = tuple(int(k) for k in keys[start])
                while start < stop:
                    room = most - sum(p.num_rows for p in parts)
                    if held is not None and (key != held or room <= 0):
                        yield block()
                        parts, room = [], most
                    held = key
                    parts.append(batch.slice(start, min(room, stop - start)))
                    start += min(room, stop - start)
        if parts:
            yield block()

    placed = celled.withColumn("lane", lanes).select("a", "b", "lane", "id", "label", "q")
    return placed.repartition("a", "b", "lane").sortWithinPartitions("a", "b", "lane").mapInArrow(run, _BLOCK)


# ------------------------------------------------------------------ search
_VISIT = "a int, b int, lane int, m int, keys binary, ids binary, labels binary, rows binary, lows binary, highs binary"


def visits(anchors: DataFrame, index, lane_rows: int, width: int, after: int, until: int, together: int = 256) -> DataFrame:
    """The cells that blocks of anchors open: in heap order, those met when at least ``after`` and less than ``until``
    rows lie before them and whose bound reaches the lowest window of the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book: Index = index.value
        for batch in batches:
            for start in range(0, batch.num_rows, together):
                part = batch.slice(start, together)
                q = matrix(part.column(3), width)
                lows, highs = ([x or [] for x in part.column(k).to_pylist()] for k in (4, 5))
                n_windows = max([1, *map(len, lows)])
                low = np.array([x + [1] * (n_windows - len(x)) for x in lows], "<i8")
                high = np.array([x + [0] * (n_windows - len(x)) for x in highs], "<i8")  # 1 to 0: no window
                wanted: dict[tuple[int, int], list[int]] = {}
                for i, windows in enumerate(lows):
                    if not windows:
                        continue
                    seen, need = 0, min(windows)
                    for bound, cell in book.visit(q[i].astype(float)):
                        if bound < need or seen >= until:
                            break
                        if seen >= after:
                            wanted.setdefault(cell, []).append(i)
                        seen += book.cells[cell]
                keys, ids, labels = (part.column(k).to_numpy().astype("<i8") for k in range(3))
                for (a, b), members in wanted.items():
                    data = [x[members].tobytes() for x in (keys, ids, labels, q.astype("<i4"), low, high)]
                    lanes = range(lanes_of(book.cells[a, b], lane_rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x] * len(lanes), pa.int32()) for x in (a, b)] + [pa.array(lanes, pa.int32())]
                        + [pa.array([len(members)] * len(lanes), pa.int32())] + [pa.array([x] * len(lanes), pa.binary()) for x in data],
                        names=[c.split()[0] for c in _VISIT.split(", ")])

    return anchors.select("key", "id", "label", "q", "lows", "highs").mapInArrow(run, _VISIT)


def lanes_of(rows: int, lane_rows: int) -> int:
    return -(-rows // lane_rows)


def first_in_order(score: np.ndarray, ids: np.ndarray, take: int) -> list[tuple[int, int]]:
    """The first ``take`` different (score, id), higher scores first, then smaller ids."""
    if len(score) > 4 * take:  # the take-th largest bounds the rows to be sorted
        kept = score >= np.partition(score, -take)[-take]
        found = _ordered(score[kept], ids[kept], take)
        if len(found) == take:
            return found
    return _ordered(score, ids, take)


def _ordered(score: np.ndarray, ids: np.ndarray, take: int) -> list[tuple[int, int]]:
    order = np.lexsort((ids, -score))
    return list(dict.fromkeys(zip(score[order].tolist(), ids[order].tolist(), strict=True)))[:take]


_FOUND = "key long, win int, score long, other long"


def _opened(joined: DataFrame, width: int, same: bool, take: int, most_held: int = 200_000) -> DataFrame:
    """The first rows of every window among the opened blocks, once a task (more often if it holds many anchors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[int, int]]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(key, win, s, other) for (key, win), best in held.items() for s, other in best]
            held.clear()
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                              names=["key", "win", "score", "other"])

        for batch in batches:
            names = batch.schema.names
            for k in range(batch.num_rows):  # one block of anchors and one of rows at a time
                row = {name: batch.column(j)[k].as_py() for j, name in enumerate(names)}
                long = lambda name: np.frombuffer(row[name], "<i8")
                keys, ids, labels, others, marks = map(long, ("keys", "ids", "labels", "other_ids", "other_labels"))
                lows, highs = (long(name).reshape(row["m"], -1) for name in ("lows", "highs"))
                s = scores(np.frombuffer(row["rows"], "<i4").reshape(-1, width), np.frombuffer(row["other_rows"], "<i4").reshape(-1, width))
                fits = (labels[:, None] == marks) if same else (labels[:, None] != marks)
                fits &= ids[:, None] != others
                for i, key in enumerate(keys.tolist()):
                    own, own_ids = s[i][fits[i]], others[fits[i]]
                    for win, (low, high) in enumerate(zip(lows[i].tolist(), highs[i].tolist(), strict=True)):
                        inside = (own >= low) & (own <= high)
                        if inside.any():
                            best = first_in_order(own[inside], own_ids[inside], take)
                            before = held.get((key, win))
                            held[key, win] = best if before is None else sorted({*before, *best}, key=lambda x: (-x[0], x[1]))[:take]
                if len(held) >= most_held:
                    yield flush()
        if held:
            yield flush()

    return joined.mapInArrow(run, _FOUND)


def search(anchors: DataFrame, kept: DataFrame, index, *, same: bool, take: int, first_rows: int, lane_rows: int, width: int) -> DataFrame:
    """``(key, win, rank, score, other)``: the first ``take`` rows in each window of each anchor.

    ``anchors`` has ``(key, id, label, q, lows, highs)``. Two waves: the second opens what the windows that the first one
    left uncertified still need.
    """
    theirs = kept.select("a", "b", "lane", F.col("ids").alias("other_ids"), F.col("labels").alias("other_labels"), F.col("rows").alias("other_rows"))
    rank = lambda df: best_of(df, take)
    wave = lambda who, after, until: _opened(
        visits(who, index, lane_rows, width, after, until).join(theirs, ["a", "b", "lane"]), width, same, take)
    first = cut(rank(wave(anchors, 0, first_rows)))
    reached = first.where(F.col("rank") == take).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("reached"))
    raised = F.transform("lows", lambda low, i: F.greatest(low, F.coalesce(F.try_element_at("reached", i), low)))
    closer = anchors.join(reached, "key", "left").withColumn("lows", raised)
    return rank(first.drop("rank").unionByName(wave(closer, first_rows, 1 << 62)))


def best_of(found: DataFrame, take: int) -> DataFrame:
    order = Window.partitionBy("key", "win").orderBy(F.col("score").desc(), "other")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take)


def hard_negatives(rows: DataFrame, is_anchor: Callable[[Column], Column], *, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, scale: int = 256, n_positives: int = 5, n_negatives: int = 5, floor_pct: int = 80,
                   fit_rows: int = 8192, cell_rows: int = 256, lane_rows: int = 1024, first_rows: int = 2048,
                   most_words: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for every anchor and positive.

    ``is_anchor`` takes the id column; ``label`` is a column of ``rows`` (default: ``label``). ``fit_rows`` bounds the
    rows that the codebooks are fitted on (about that many), ``most_words`` a codebook's size.
    """
    spark = rows.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    valid = cut(usable(rows, id_col, vector_col, F.col("label") if label is None else label, scale))
    common = valid.where(F.size("q") > 0).groupBy(F.size("q").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if common is None:
        return spark.createDataFrame([], out)
    width, n = common["width"], common["count"]
    valid = valid.where(F.size("q") == width)
    halves = fit(valid, width, n, fit_rows, cell_rows, most_words)
    celled = cut(in_cells(valid, halves, width).withColumn("at", F.monotonically_increasing_id()))
    cells = celled.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("ra").alias("ra"), F.max("rb").alias("rb")).collect()  # most_words^2 at most
    radii = tuple(np.array([max([0.0, *(c[r] for c in cells if c[k] == j)]) for j in range(len(words))])
                  for k, r, words in (("a", "ra", halves[0]), ("b", "rb", halves[1])))
    index = spark.sparkContext.broadcast(Index(halves, radii, {(c["a"], c["b"]): c["n"] for c in cells}))
    lanes = spark.createDataFrame([(c["a"], c["b"], lanes_of(c["n"], lane_rows)) for c in cells], "a int, b int, lanes int")
    kept = cut(blocks(celled.join(F.broadcast(lanes), ["a", "b"]), F.expr("CAST(pmod(at, lanes) AS INT)"), width))

    distinct = celled.where(is_anchor(F.col("id"))).dropDuplicates(["id", "label", "q"])
    order = ["a", "b", "id", "at"]
    anchors = cut(distinct.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select(F.monotonically_increasing_id().alias("key"), "id", "label", "q"))
    whole = lambda low: F.array(F.lit(low).cast("long"))
    options = {"first_rows": first_rows, "lane_rows": lane_rows, "width": width}
    positives = cut(search(anchors.withColumns({"lows": whole(LOWEST), "highs": whole(-LOWEST)}), kept, index, same=True,
                           take=n_positives, **options).select("key", F.col("rank").alias("place"), "score", F.col("other").alias("positive_id")))
    # a window from floor_pct percent of a positive's score up to it; below zero there is none
    usable_ones = positives.where("score >= 0")
    ordered = F.array_sort(F.collect_list(F.struct("place", "score")))
    windows = usable_ones.groupBy("key").agg(ordered.alias("w")).select(
        "key", F.transform("w", lambda w: F.ceil(w["score"] * F.lit(floor_pct) / F.lit(100).cast("decimal(5,0)")).cast("long")).alias("lows"),
        F.transform("w", lambda w: w["score"]).alias("highs"))
    found = search(anchors.join(windows, "key"), kept, index, same=False, take=n_negatives, **options)
    # places of an anchor's positives without a gap: scores fall, so those below zero are the last
    pairs = found.join(usable_ones.select("key", (F.col("place") - 1).alias("win"), F.col("score").alias("positive_score"), "positive_id"), ["key", "win"])
    return pairs.join(anchors.select("key", F.col("id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).distinct()
