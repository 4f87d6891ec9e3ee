"""Language ID: a linear-chain conditional random field labels words, forward-backward gives their marginals.

1. Words are the runs of letters and marks of the lower-cased text. Their features are hashed character n-grams of
   ``^word$`` (those at an end are the affixes) and the word's shares among the learned languages in a lexicon.
2. The model is fitted on a bounded sample of the labelled documents, about ``per_lang`` rows a language. Half of the
   sample makes the lexicon (words of two documents at least), the other half the sequences: spans of documents
   are strung together across languages, so that transitions are learned from code-switched text with known labels.
3. The gradient of the penalised likelihood is summed over partitions and merged in two levels; its size depends on the
   feature space and the number of languages only. The driver takes the steps.
4. Every document is labelled by exact forward-backward over its whole text: long texts are cut into segments,
   the product of each segment's transition matrices carries the messages exactly over its ends, and segments are
   worked on together. A document's language has the largest mean marginal of its words (equal: the
   first name); the score is that mean.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is every text if nothing can be
learned from. With one learned language every text with a letter has that one, score 1. Rows with a null id are labelled, never
learned from and not held out; repeated rows are labelled each and learned from once; an empty table gives an empty
result. More than ``max_langs`` learned values raise an error (the label set, not the documents, is bounded).
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, text_slices, tree_merge

FEATURES = 1 << 16
GRAMS = (2, 3, 4)
SEGMENT, TOGETHER = 512, 1024  # words of a segment, segments worked on at a time
UNDEFINED = "und"
LANES = 32


# ------------------------------------------------------------------ words and their features
def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of an Arrow text column, the word numbers of all texts, and each text's number of words."""
    split = pc.utf8_split_whitespace(pc.fill_null(column, ""))
    tokens = split.flatten().dictionary_encode()
    runs = pc.split_pattern_regex(pc.utf8_lower(tokens.dictionary), r"[^\p{L}\p{M}]+")
    pieces = runs.flatten().dictionary_encode()
    real = pc.match_substring_regex(pieces.dictionary, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
    number = np.cumsum(real) - 1
    piece = pieces.indices.to_numpy()
    token = np.repeat(np.arange(len(runs)), pc.list_value_length(runs).to_numpy())
    token, piece = token[real[piece]], number[piece[real[piece]]]
    size = np.bincount(token, minlength=len(runs))
    start = np.cumsum(size) - size
    at = tokens.indices.to_numpy()
    n = size[at]
    ends = np.cumsum(n)
    codes = piece[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[at] - ends + n, n)]
    of_token = np.concatenate([[0], ends])
    bounds = of_token[np.cumsum(np.concatenate([[0], pc.list_value_length(split).to_numpy()]))]
    return pieces.dictionary.filter(pa.array(real)), codes.astype(np.int32), np.diff(bounds)


def _points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of ``^word$`` for all words, and their lengths."""
    joined = "".join([f"\x02{w}\x03" for w in words.to_pylist()])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), pc.utf8_length(words).to_numpy() + 2


def grams_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature) of every n-gram, and the weight of the grams of each word."""
    points, length = _points(words)
    owner = np.repeat(np.arange(len(length)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(points))  # places up to the word's end
    rows, features = [], []
    for n in GRAMS:
        h = np.full(len(points), n, np.uint64)
        for k in range(n):
            h[:len(points) - k] = (h[:len(points) - k] ^ points[k:]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        whole = left >= n
        rows.append(owner[whole])
        features.append((h[whole] >> np.uint64(40)).astype(np.int64) % FEATURES)
    rows = np.concatenate(rows)
    return rows, np.concatenate(features), 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=len(length)), 1))


def word_hash(words: pa.Array) -> np.ndarray:
    """A 63-bit polynomial hash of each word."""
    points, length = _points(words)
    if not len(points):
        return np.zeros(0, np.int64)
    start = np.cumsum(length) - length
    place = np.arange(len(points)) - np.repeat(start, length)
    power = np.uint64(0xD1342543DE82EF95) ** np.arange(length.max(), dtype=np.uint64)
    h = np.add.reduceat((points + np.uint64(1)) * power[place], start)
    return ((h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)).astype(np.int64)


@dataclass(frozen=True)
class Lexicon:
    """Hashes of known words, ascending, and each one's smoothed shares among the languages."""

    hashes: np.ndarray
    shares: np.ndarray

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Shares of all words (none for unknown ones) and which are known."""
        h = word_hash(words)
        if not len(self.hashes):
            return np.zeros((len(h), self.shares.shape[1])), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        known = self.hashes[at] == h
        return np.where(known[:, None], self.shares[at], 0), known


# ------------------------------------------------------------------ the chain
@dataclass(frozen=True)
class Weights:
    """Views of one parameter vector: n-grams, lexicon shares, bias of unknown and known words, transitions, first word."""

    grams: np.ndarray
    lexicon: np.ndarray
    bias: np.ndarray
    steps: np.ndarray
    first: np.ndarray

    @staticmethod
    def size(n: int) -> int:
        return FEATURES * n + 2 * n * n + 3 * n

    @classmethod
    def of(cls, x: np.ndarray, n: int) -> Weights:
        cuts = np.cumsum([FEATURES * n, n * n, 2 * n, n * n])
        g, lexicon, bias, steps, first = np.split(x, cuts)
        return cls(g.reshape(-1, n), lexicon.reshape(n, n), bias.reshape(2, n), steps.reshape(n, n), first)

    def emissions(self, rows, features, weight, shares, known) -> np.ndarray:
        """Log potentials (words, languages) of different words."""
        n = self.grams.shape[1]
        out = np.stack([np.bincount(rows, self.grams[features, k], len(weight)) for k in range(n)], 1) * weight[:, None]
        return out + shares @ self.lexicon + self.bias[known.astype(int)]


def _scaled(emissions: np.ndarray) -> np.ndarray:
    return np.exp(emissions - emissions.max(1, keepdims=True))


class Part(NamedTuple):
    """A group of segments; arrays of messages are (step, segment, language), zero beyond a segment's end."""

    start: np.ndarray  # place of the first word among all words
    size: np.ndarray
    seq: np.ndarray  # the sequence it belongs to
    first: np.ndarray  # whether it starts its sequence
    come: np.ndarray  # scaled message that enters it
    alpha: np.ndarray  # scaled message before a word's potential
    psi: np.ndarray
    beta: np.ndarray
    marginal: np.ndarray

    def inside(self) -> tuple[np.ndarray, np.ndarray]:
        """(step, segment) of all words."""
        return np.nonzero(np.arange(self.psi.shape[0])[:, None] < self.size)


class Chain:
    """Exact forward-backward for sequences of words, in segments."""

    def __init__(self, weights: Weights, potential: np.ndarray):
        """``potential``: scaled potentials of the different words."""
        self.a, self.first = _scaled(weights.steps.reshape(1, -1)).reshape(weights.steps.shape), _scaled(weights.first[None])[0]
        self.potential, self.n = potential, potential.shape[1]

    def segments(self, codes: np.ndarray, lengths: np.ndarray):
        """Start, length, sequence and place in the sequence of each segment."""
        count = -(-lengths // SEGMENT)
        seq = np.repeat(np.arange(len(lengths)), count)
        place = np.arange(len(seq)) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(np.cumsum(lengths) - lengths, count) + place * SEGMENT
        return start, np.minimum(SEGMENT, np.repeat(lengths, count) - place * SEGMENT), seq, place

    def _padded(self, codes, start, size) -> np.ndarray:
        """(step, segment, language) potentials; segments are ordered by falling size."""
        at = start + np.minimum(np.arange(size[0])[:, None], size - 1)
        return self.potential[codes[at]]

    def _products(self, codes, start, size) -> np.ndarray:
        """The product of step matrices over each segment, scaled: (segment, incoming, outgoing)."""
        psi = self._padded(codes, start, size)
        out = np.broadcast_to(np.eye(self.n), (len(size), self.n, self.n)).copy()
        for t in range(size[0]):
            k = int(np.searchsorted(-size, -t, side="left"))  # segments longer than t
            m = (out[:k].reshape(-1, self.n) @ self.a).reshape(k, self.n, self.n) * psi[t, :k, None, :]
            out[:k] = m / m.sum((1, 2), keepdims=True)
        return out

    def parts(self, codes: np.ndarray, lengths: np.ndarray) -> Iterator[Part]:
        """All segments with their messages, in groups."""
        start, size, seq, place = self.segments(codes, lengths)
        n_seg = len(start)
        come, go = np.zeros((n_seg, self.n)), np.ones((n_seg, self.n))
        if place.any():  # some sequence has several segments: carry the messages over their ends
            product = np.empty((n_seg, self.n, self.n))
            for group in self._groups(size, np.flatnonzero(place)):
                product[group] = self._products(codes, start[group], size[group])
            by_place = np.argsort(place, kind="stable")
            steps = np.split(by_place, np.flatnonzero(np.diff(place[by_place])) + 1)
            for now, after in zip(steps, steps[1:], strict=False):
                before = after - 1  # the same sequences, one segment earlier
                inner = self._products_from_first(codes, start, size, before) if place[before[0]] == 0 else \
                    np.einsum("si,sij->sj", come[before], product[before])
                come[after] = inner / inner.sum(1, keepdims=True)
            for after in reversed(steps[1:]):
                back = np.einsum("sij,sj->si", product[after], go[after])
                go[after - 1] = back / back.sum(1, keepdims=True)
        for group in self._groups(size, np.arange(n_seg)):
            s, first = size[group], place[group] == 0
            psi = self._padded(codes, start[group], s)
            alpha, beta = np.zeros_like(psi), np.ones_like(psi)
            message = come[group]
            for t in range(s[0]):
                k = int(np.searchsorted(-s, -t, side="left"))
                alpha[t, :k] = message[:k] @ self.a
                if t == 0:
                    alpha[0][first] = self.first
                m = alpha[t, :k] * psi[t, :k]
                message = m / m.sum(1, keepdims=True)
            end = go[group]
            for t in range(s[0] - 1, -1, -1):
                k = int(np.searchsorted(-s, -t, side="left"))
                last = s[:k] == t + 1
                if t + 1 < s[0]:
                    later = int(np.searchsorted(-s, -(t + 1), side="left"))
                    m = (psi[t + 1, :later] * beta[t + 1, :later]) @ self.a.T
                    beta[t, :later] = m / m.sum(1, keepdims=True)
                beta[t, :k][last] = end[:k][last]
            marginal = alpha * psi * beta
            marginal /= np.maximum(marginal.sum(2, keepdims=True), 1e-300)  # beyond a segment's end all are zero
            yield Part(start[group], s, seq[group], first, come[group], alpha, psi, beta, marginal)

    def _products_from_first(self, codes, start, size, which) -> np.ndarray:
        """Messages after first segments, whose first word has no step before it."""
        out = np.empty((len(which), self.n))
        where = np.argsort(which)
        for own in self._groups(size, which):
            psi = self._padded(codes, start[own], size[own])
            m = self.first * psi[0]
            for t in range(1, size[own][0]):  # segments before another one are full
                m = (m / m.sum(1, keepdims=True)) @ self.a * psi[t]
            out[where[np.searchsorted(which[where], own)]] = m
        return out

    def _groups(self, size: np.ndarray, which: np.ndarray) -> Iterator[np.ndarray]:
        order = which[np.argsort(-size[which], kind="stable")]
        most = max(1, TOGETHER * 16 // max(16, self.n * self.n))
        for i in range(0, len(order), most):
            yield order[i:i + most]


def mean_marginals(weights: Weights, potential: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mean marginals of each sequence (zeros for empty ones)."""
    total = np.zeros((len(lengths), potential.shape[1]))
    for part in Chain(weights, potential).parts(codes, lengths):
        np.add.at(total, part.seq, part.marginal.sum(0))
    return total / np.maximum(lengths, 1)[:, None]


def word_marginals(weights: Weights, potential: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Marginals (words, languages) of all words, in their order."""
    out = np.zeros((len(codes), potential.shape[1]))
    for part in Chain(weights, potential).parts(codes, lengths):
        t, s = part.inside()
        out[part.start[s] + t] = part.marginal[t, s]
    return out


# ------------------------------------------------------------------ learning
def drawn_spans(texts: list[np.ndarray], rng: np.random.Generator, longest: int = 48, sequence: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of 1 to ``longest`` words that cover all texts, in random order, as sequences of about ``sequence`` words.

    Returns the word's place in the concatenated texts, its text, and the sequences' lengths.
    """
    spans, at = [], 0
    for i, codes in enumerate(texts):
        cuts = np.cumsum(rng.integers(1, longest + 1, len(codes) // (longest // 2) + 2))
        cuts = np.unique(np.concatenate([[0], cuts[cuts < len(codes)], [len(codes)]]))
        spans += [(at + a, at + b, i) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        at += len(codes)
    spans = [spans[k] for k in rng.permutation(len(spans))]
    where = np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b) for a, b, _ in spans]])
    owner = np.repeat(np.array([i for *_, i in spans], np.int64), [b - a for a, b, _ in spans])
    lengths, held = [], 0
    for a, b, _ in spans:
        held += b - a
        if held >= sequence:
            lengths.append(held)
            held = 0
    return where, owner, np.array(lengths + [held] * (held > 0), np.int64)


def likelihood(x: np.ndarray, n: int, lexicon: Lexicon, chunk: dict) -> tuple[float, np.ndarray]:
    """Log likelihood of a chunk's labels and its gradient."""
    weights = Weights.of(x, n)
    rows, features, weight = chunk["rows"], chunk["features"], chunk["weight"]
    shares, known = chunk["shares"], chunk["known"]
    codes, labels, lengths = chunk["codes"], chunk["labels"], chunk["lengths"]
    e = weights.emissions(rows, features, weight, shares, known)
    chain = Chain(weights, _scaled(e))
    marginal, steps, norm = np.zeros((len(codes), n)), np.zeros((n, n)), 0.0
    for part in chain.parts(codes, lengths):
        t, s = part.inside()
        leaving = part.alpha * part.psi
        z = leaving.sum(2)
        marginal[part.start[s] + t] = part.marginal[t, s]
        norm += np.log(z[t, s]).sum()
        before = np.concatenate([part.come[None], (leaving / np.maximum(z, 1e-300)[:, :, None])[:-1]])
        inner = (t > 0) | ~part.first[s]
        t, s = t[inner], s[inner]
        right = part.psi[t, s] * part.beta[t, s]
        steps += before[t, s].T @ (right / (part.alpha[t, s] * right).sum(1, keepdims=True)) * chain.a
    first = np.cumsum(lengths) - lengths
    inner = np.ones(len(codes), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    gold = (e[codes, labels] - e.max(1)[codes]).sum() + (weights.steps - weights.steps.max())[labels[at - 1], labels[at]].sum() \
        + (weights.first - weights.first.max())[labels[first]].sum()
    observed = np.zeros((n, n))
    np.add.at(observed, (labels[at - 1], labels[at]), 1)
    wrong = -marginal
    wrong[np.arange(len(codes)), labels] += 1
    g = np.stack([np.bincount(codes, wrong[:, k], len(e)) for k in range(n)], 1)
    by_gram = np.stack([np.bincount(features, (g[:, k] * weight)[rows], FEATURES) for k in range(n)], 1)
    bias = np.stack([g[~known].sum(0), g[known].sum(0)])
    gradient = np.concatenate([by_gram.ravel(), (shares.T @ g).ravel(), bias.ravel(), (observed - steps).ravel(), wrong[first].sum(0)])
    return float(gold - norm), gradient


def climb(value_and_gradient: Callable[[np.ndarray], tuple[float, np.ndarray]], size: int, steps: int, memory: int = 6) -> np.ndarray:
    """Maximise a concave function by limited-memory quasi-Newton steps, halved until the value rises."""
    x = np.zeros(size)
    value, g = value_and_gradient(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d = g.copy()
        kept = []
        for s, y in reversed(past):
            a = s @ d / (s @ y)
            d -= a * y
            kept.append(a)
        d *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(np.abs(g).sum(), 1e-12)
        for (s, y), a in zip(past, reversed(kept), strict=True):
            d += (a - y @ d / (s @ y)) * s
        slope = d @ g
        if slope <= 1e-9 * max(1.0, abs(value)):
            break
        rate = 1.0
        while True:
            there, g_there = value_and_gradient(x + rate * d)
            if there >= value + 1e-4 * rate * slope or rate < 1e-4:
                break
            rate /= 4
        if there <= value:
            break
        s, y = rate * d, g - g_there
        if s @ y > 1e-12:
            past = [*past, (s, y)][-memory:]
        x, value, g = x + s, there, g_there
    return x


@dataclass(frozen=True)
class Model:
    languages: list[str]
    lexicon: Lexicon
    x: np.ndarray
    key: str  # of its contents: workers remember potentials by it

    def potentials(self, words: pa.Array) -> np.ndarray:
        """Scaled potentials (words, languages)."""
        if not len(words):
            return np.ones((0, len(self.languages)))
        return _scaled(Weights.of(self.x, len(self.languages)).emissions(*grams_of(words), *self.lexicon(words)))


class Remembered:
    """Potentials of words seen by this worker; at most ``limit`` words and those of one piece of a batch."""

    def __init__(self, model: Model, limit: int = 300_000):
        self.model, self.limit = model, limit
        self.at: dict[str, int] = {}
        self.table = np.empty((0, len(model.languages)), np.float32)

    def __call__(self, words: pa.Array) -> np.ndarray:
        listed = words.to_pylist()
        at = np.fromiter((self.at.get(w, -1) for w in listed), np.int64, len(listed))
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.at) + len(new) > self.limit:
                self.at, self.table, new = {}, self.table[:0], np.arange(len(listed))
                at[:] = -1
            made = self.model.potentials(words.take(pa.array(new)))
            at[new] = len(self.table) + np.arange(len(new))
            self.table = np.concatenate([self.table, made.astype(np.float32)])
            short = [k for k in new.tolist() if len(listed[k]) <= 64]
            self.at.update((listed[k], int(at[k])) for k in short)
        out = self.table[at].astype(float)
        if len(self.table) > 2 * self.limit:
            self.at, self.table = {}, self.table[:0]
        return out


_HELD: dict[str, Remembered] = {}


# ------------------------------------------------------------------ Spark
def _share(h: Column) -> Column:
    """A hash as a number from 0 to 1."""
    return F.abs(h / float(1 << 63))


def sample_of(docs: DataFrame, per_lang: int, max_langs: int) -> tuple[list[str], DataFrame]:
    """Learned languages and the sample ``(text, y, h)``; h is a hash of the row, so equal rows are one."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labelled = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (remainder != 2))
    counts = labelled.groupBy("lang").count().orderBy("lang").limit(max_langs + 1).collect()
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} languages to learn")
    spark = docs.sparkSession
    rates = spark.createDataFrame([(r["lang"], i, min(1.0, per_lang / r["count"])) for i, r in enumerate(counts)], "lang string, y int, rate double")
    hashed = labelled.where(F.col("text").isNotNull()).select("text", "lang", F.xxhash64("doc_id", "lang", "text").alias("h"))
    chosen = hashed.join(F.broadcast(rates), "lang").where(_share(F.xxhash64("h", F.lit(3))) <= F.col("rate"))
    return [r["lang"] for r in counts], cut(chosen.select("text", "y", "h").dropDuplicates(["h"]))


def lexicon_of(rows: DataFrame, n: int, least_docs: int = 2) -> Lexicon:
    """Words of at least ``least_docs`` documents, with their shares among the languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 0, 4 << 20):
                words, codes, lengths = words_of(part.column(0))
                doc = np.repeat(np.arange(part.num_rows), lengths)
                pair = np.unique(doc * max(len(words), 1) + codes)
                y = part.column(1).to_numpy()[pair // max(len(words), 1)]
                key, docs = np.unique((pair % max(len(words), 1)) * n + y, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word_hash(words)[key // n]), pa.array((key % n).astype(np.int32)), pa.array(docs)],
                                                 names=["word", "y", "docs"])

    counted = rows.select("text", "y").mapInArrow(run, "word long, y int, docs long").groupBy("word", "y").agg(F.sum("docs").alias("docs"))
    listed = (counted.groupBy("word").agg(F.sum("docs").alias("all"), F.collect_list(F.struct("y", "docs")).alias("of"))
              .where(F.col("all") >= least_docs).select("word", "all", F.explode("of").alias("of")).select("word", "all", "of.y", "of.docs"))
    found = listed.toArrow()  # words of a bounded sample
    hashes, at = np.unique(found["word"].to_numpy(), return_inverse=True)
    shares = np.zeros((len(hashes), n))
    shares[at, found["y"].to_numpy()] = found["docs"].to_numpy()
    return Lexicon(hashes.astype(np.int64), (shares + 0.1) / (shares.sum(1, keepdims=True) + 0.1 * n))


def training_chunks(rows: DataFrame, lexicon, n: int, chunk_docs: int = 48) -> DataFrame:
    """Arrays of the sequences strung together from ``chunk_docs`` documents at a time, as ``payload``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, chunk_docs):
                part = batch.slice(start, chunk_docs)
                words, codes, lengths = words_of(part.column(0))
                if not len(codes):
                    continue
                y = part.column(1).to_numpy()
                rng = np.random.default_rng(part.column(2)[0].as_py() & 0x7FFFFFFF)
                where, owner, sequences = drawn_spans(np.split(codes, np.cumsum(lengths)[:-1]), rng)
                grams, features, weight = grams_of(words)
                shares, known = lexicon.value(words)
                held = io.BytesIO()
                np.savez(held, rows=grams.astype(np.int32), features=features.astype(np.int32), weight=weight, shares=shares, known=known,
                         codes=codes[where], labels=y[owner], lengths=sequences)
                yield pa.RecordBatch.from_arrays([pa.array([held.getvalue()], pa.binary())], names=["payload"])

    placed = rows.repartition(F.col("h")).sortWithinPartitions("h")  # by hash: languages are mixed
    return placed.select("text", "y", "h").mapInArrow(run, "payload binary")


def fit(docs: DataFrame, *, per_lang: int = 400, max_langs: int = 1000, steps: int = 12, penalty: float = 1.0) -> Model | None:
    """A model of the labelled documents ``(doc_id, text, lang)``; None if there are none."""
    spark = docs.sparkSession
    languages, sample = sample_of(docs, per_lang, max_langs)
    n = len(languages)
    if n == 0:
        return None
    half = F.pmod(F.xxhash64("h", F.lit(9)), F.lit(2))
    lexicon = lexicon_of(sample.where(half == 0), n)
    x = np.zeros(Weights.size(n))
    if n > 1:
        shared = spark.sparkContext.broadcast(lexicon)
        chunks = cut(training_chunks(sample.where(half == 1), shared, n))

        def value_and_gradient(at: np.ndarray) -> tuple[float, np.ndarray]:
            given = spark.sparkContext.broadcast(at)

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                held = None
                for batch in batches:
                    for payload in batch.column(0):
                        with np.load(io.BytesIO(payload.as_py())) as chunk:
                            value, g = likelihood(given.value, n, shared.value, dict(chunk))
                        one = np.concatenate([[value], g])
                        held = one if held is None else held + one
                if held is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([held.tobytes()], pa.binary())], names=["part", "payload"])

            merge = lambda a, b: b if a is None else (np.frombuffer(a) + np.frombuffer(b)).tobytes()
            out = np.zeros(1 + len(at))
            for row in tree_merge(chunks.mapInArrow(run, "part int, payload binary"), merge, LANES).collect():  # one row
                out = np.frombuffer(row["payload"])
            given.destroy()
            return float(out[0] - penalty * (at @ at) / 2), out[1:] - penalty * at

        x = climb(value_and_gradient, len(x), steps)
    return Model(languages, lexicon, x, sha256(x.tobytes() + lexicon.hashes.tobytes() + repr(languages).encode()).hexdigest())


def languages_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row.

    Ids whose crc32 (of the id as text) modulo 4 is 2 are held out: the model doesn't learn from them.
    """
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                      F.col(f"`{lang_col}`").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(fit(own, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = model.value
        if m is not None and m.key not in _HELD:
            _HELD.clear()
            _HELD[m.key] = Remembered(m)
        for batch in batches:
            for part in text_slices(batch, 1, 4 << 20):
                words, codes, lengths = words_of(part.column(1))
                if m is None:
                    name, score = [UNDEFINED] * part.num_rows, np.zeros(part.num_rows)
                else:
                    mean = mean_marginals(Weights.of(m.x, len(m.languages)), _HELD[m.key](words), codes, lengths)
                    best, score = mean.argmax(1), np.clip(mean.max(1), 0, 1)
                    name = [m.languages[k] if some else UNDEFINED for k, some in zip(best.tolist(), (lengths > 0).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(name, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return own.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def word_languages(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, runs)``: the runs of words with one most likely language, as ``(lang, words, score)``, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in text_slices(batch, 1, 4 << 20):
                words, codes, lengths = words_of(part.column(1))
                marginal = word_marginals(Weights.of(m.x, len(m.languages)), m.potentials(words), codes, lengths)
                found, ends = [], np.cumsum(lengths)
                for start, end in zip((ends - lengths).tolist(), ends.tolist(), strict=True):
                    own = marginal[start:end]
                    best = own.argmax(1) if len(own) else np.zeros(0, int)
                    edges = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(best)]
                    found.append([{"lang": m.languages[best[a]], "words": b - a, "score": float(own[a:b, best[a]].mean())}
                                  for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=["doc_id", "runs"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id long, runs array<struct<lang string, words long, score double>>")
