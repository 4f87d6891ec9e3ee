"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. Each text becomes a vector of document statistics (length, repetition, symbols,
   case, lines, compressibility; nothing else of the row is read).
2. Cosines of random projections (fixed seed) approximate a Gaussian kernel on the
   standardised statistics.
3. Normal equations of ridge regression are summed over partitions, one sum for each
   of ``FOLDS`` folds, and merged in two levels; their size does not depend on the data.
4. Scores of each labelled row by the equations of the *other* folds are counted in
   fixed bins, and pooled adjacent violators turn the counts into a monotone map
   from score to probability.
5. All documents are scored with all folds' equations and mapped.

All labelled training rows are used. Defined results: null and empty texts have statistics of an
empty text and are scored like any other; null ids are scored, never learned from
and not held out; several labels of one id are several training rows, null labels
none; without training rows every score is 0.5, with one class only it is that
class. Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, slices, texts, tree_merge

FOLDS, BINS, LANES = 4, 1024, 16
MARKS = "#*%$&|!@~^_=<>{}[]\\"  #: counted together as symbols


def statistics(text: str) -> list[float]:
    """The document statistics of one text."""
    words = text.split()
    n, chars = len(words), len(text)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1, np.int64)
    counts = Counter(words)
    pairs = max(n - 1, 1)
    lines = text.split("\n")
    raw = text.encode("utf-8")
    per_word, per_char = 1 / max(n, 1), 1 / max(chars, 1)
    return [
        math.log1p(chars), math.log1p(n), float(lengths.mean()), float(lengths.std()),
        len(counts) * per_word, math.log1p(len(counts)) / math.log(n + 2),
        (max(counts.values()) if n else 0) * per_word,
        sum(map(eq, words, words[1:])) / pairs,
        len(set(zip(words, words[1:]))) / pairs,
        sum(map(str.isupper, words)) * per_word, sum(map(str.istitle, words)) * per_word,
        sum(map(text.count, "0123456789")) * per_char,
        sum(map(text.count, MARKS)) * per_char,
        text.count("|") * per_word, text.count("!") * per_word, text.count(".") * per_word, text.count(",") * per_word,
        len(lines) * per_word, math.log1p(chars / len(lines)),
        sum(len(x) < 20 for x in lines) / len(lines), 1 - len(set(lines)) / len(lines),
        sum(not w[-1].isalnum() for w in words) * per_word,
        (len(raw) - chars) * per_char, text.count(" ") * per_char,
        len(zlib.compress(raw, 1)) / (len(raw) + 16), math.log1p(len(set(text))),
    ]


N_STATISTICS = len(statistics(""))


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, x, row)`` for ``(id, text, row)`` rows; x holds the statistics as 64-bit floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                x = [np.array(statistics(t)).tobytes() for t in texts(rows.column(1))]
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(x, pa.binary()), rows.column(2)],
                                                 names=["doc_id", "x", "row"])

    return docs.mapInArrow(run, "doc_id long, x binary, row long")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.float64).reshape(-1, N_STATISTICS)


def _sums(rows: DataFrame, per_batch, size: int, folds: int, lanes: int) -> np.ndarray:
    """Sum over all rows of the vectors ``per_batch(batch) -> {fold: vector}``: (folds, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 4096):
                for fold, vector in per_batch(part).items():
                    held[fold] = held[fold] + vector if fold in held else vector
        for fold, vector in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([vector.tobytes()], pa.binary())],
                                             names=["part", "payload"])

    def merge(held: bytes | None, payload: bytes) -> bytes:
        return payload if held is None else (np.frombuffer(held) + np.frombuffer(payload)).tobytes()

    out = np.zeros((folds, size))
    for row in tree_merge(rows.mapInArrow(run, "part int, payload binary"), merge, lanes).collect():  # one row a fold
        out[row["part"]] = np.frombuffer(row["payload"])
    return out


class Features:
    """Standardised statistics to random Fourier features (and a constant one)."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, n_features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, deviation
        self.w = rng.standard_normal((N_STATISTICS, n_features)) / width
        self.b = rng.uniform(0, 2 * np.pi, n_features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -6, 6) @ self.w + self.b
        return np.hstack([np.cos(z) * np.sqrt(2 / self.w.shape[1]), np.ones((len(x), 1))])


def pooled_violators(total: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Least-squares non-decreasing rate for ordered bins with ``total`` rows, ``positive`` of them 1.

    Bins without rows take the rate by linear interpolation of their neighbours.
    """
    blocks: list[list[float]] = []  # rows, ones, bins
    used = np.flatnonzero(total)
    for i in used:
        blocks.append([total[i], positive[i], 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, ones, bins = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + ones, blocks[-1][2] + bins]
    rate = np.concatenate([np.full(int(bins), ones / n) for n, ones, bins in blocks])
    return np.interp(np.arange(len(total)), used, rate)


class Model:
    """Ridge weights on Fourier features, then the monotone map over score bins."""

    LOW, HIGH = -0.5, 1.5

    def __init__(self, features: Features | None, weights: np.ndarray | None, rate: np.ndarray | None, constant: float):
        self.features, self.weights, self.rate, self.constant = features, weights, rate, constant

    @classmethod
    def place(cls, raw: np.ndarray) -> np.ndarray:
        """Position of raw scores on the scale of bins."""
        return np.clip((raw - cls.LOW) / (cls.HIGH - cls.LOW) * (BINS - 1), 0, BINS - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        at = self.place(self.features(x) @ self.weights)
        return np.clip(np.interp(at, np.arange(BINS), self.rate), 0, 1)


def fit(training: DataFrame, n_features: int = 192, width: float = 3.0, ridge: float = 0.01, seed: int = 7) -> Model:
    """Fit on ``(x binary, y int, fold int)`` rows; everything brought to the driver has a fixed size."""

    def moments(rows: pa.RecordBatch) -> dict[int, np.ndarray]:
        x, y = _matrix(rows.column(0)), rows.column(1).to_numpy(zero_copy_only=False)
        return {0: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])}

    m = _sums(training, moments, 2 + 2 * N_STATISTICS, 1, LANES)[0]
    n, ones = m[0], m[1]
    if n == 0 or ones in (0, n):
        return Model(None, None, None, 0.5 if n == 0 else float(ones > 0))
    mean = m[2:2 + N_STATISTICS] / n
    deviation = np.sqrt(np.maximum(m[2 + N_STATISTICS:] / n - mean ** 2, 0))
    deviation[deviation < 1e-9] = 1
    features = Features(mean, deviation, n_features, width, seed)
    size = n_features + 1
    upper = np.triu_indices(size)

    def equations(rows: pa.RecordBatch) -> dict[int, np.ndarray]:
        z, y = features(_matrix(rows.column(0))), rows.column(1).to_numpy(zero_copy_only=False)
        fold = rows.column(2).to_numpy(zero_copy_only=False)
        out = {}
        for f in np.unique(fold):
            own = z[fold == f]
            out[int(f)] = np.concatenate([(own.T @ own)[upper], own.T @ y[fold == f]])
        return out

    sums = _sums(training, equations, len(upper[0]) + size, FOLDS, LANES)

    def solve(s: np.ndarray) -> np.ndarray:
        a = np.zeros((size, size))
        a[upper] = s[:len(upper[0])]
        a = a + np.triu(a, 1).T + ridge * np.eye(size)
        return np.linalg.solve(a, s[len(upper[0]):])

    weights = solve(sums.sum(0))
    others = np.stack([solve(sums.sum(0) - s) for s in sums])

    def bins(rows: pa.RecordBatch) -> dict[int, np.ndarray]:
        z, y = features(_matrix(rows.column(0))), rows.column(1).to_numpy(zero_copy_only=False)
        raw = (z * others[rows.column(2).to_numpy(zero_copy_only=False)]).sum(1)
        at = np.rint(Model.place(raw)).astype(int)
        return {0: np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)]).astype(float)}

    total, positive = _sums(training, bins, 2 * BINS, 1, LANES)[0].reshape(2, BINS)
    return Model(features, weights, pooled_violators(total, positive), 0.5)


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_id_col: str = "doc_id", label_col: str = "quality", row_col: str | None = None, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row.

    Ids whose crc32 (of the id as text) modulo 3 is 1 are held out of the fit.
    ``row_col`` names a column of longs that is returned as ``row``.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    given = F.col(row_col).cast("long") if row_col else F.lit(None).cast("long")
    stats = cut(document_statistics(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col), given.alias("row"))))
    marked = (labels.select(F.col(label_id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(remainder != 1))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FOLDS)).cast("int").alias("fold")
    training = cut(stats.join(marked, "doc_id").select("x", "y", fold))
    model = stats.sparkSession.sparkContext.broadcast(fit(training, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 4096):
                score = model.value.score(_matrix(rows.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), rows.column(2)],
                    names=["doc_id", "score", "predicted", "row"])

    scored = stats.mapInArrow(run, "doc_id long, score double, predicted int, row long")
    kept = ["row"] if row_col else []
    return scored.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score", "predicted", *kept)
