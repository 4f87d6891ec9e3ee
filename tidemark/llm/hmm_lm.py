"""Hidden Markov language model: Baum-Welch over partitions, exact scaled forward scores.

1. Word counts of the training texts (summed in the tasks, then by shuffle).
2. Every training word is a symbol with emission counts of its own. The ``core_words`` most frequent
   ones have them from the first round on; the others are tied to classes by their last letters
   until the last round, which counts each word's states by itself. Its emission is that of its class
   times its share there: own counts plus at most ``PRIOR`` counts spread like the class's. Each class keeps a share for unknown words.
3. One pass turns every text into symbol ids and sums what the counts of words in
   memory give. Some ``known_words`` words are held in memory; the others' state counts are summed by a
   shuffle on the word and sent back to the documents that hold it (as 16-bit shares). As the most frequent ones
   are in memory, none of these has more than one in ``known_words`` of all tokens.
4. Baum-Welch: tasks run scaled forward-backward over whole texts. These are computed in pieces of
   ``segment`` tokens; the messages over the pieces' ends come from products of the pieces' transfer
   matrices, so posteriors are those of the uncut text. Expected counts of a fixed size are merged in two levels.
5. The score is the scaled forward recursion over the whole text, uncut.

Nothing brought to the driver grows with the corpus: a histogram, about
``known_words`` words with counts, model tables.

Defined results: null and empty texts are the end token alone; null ids are learned
from and not held out; repeated rows are learned from and scored each; without
training texts every count is zero. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, slices, texts, tree_merge

SMOOTH = 0.1  #: added to every word count
CLASSES = 512
ONE = (1 << 16) - 1  #: a share of 1
PRIOR = 2  #: counts of a word that are spread over the states like its class's
CHUNKS = 4  #: the counts of symbols, and those of words in memory, are merged in so many parts each


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def word_counts(training: DataFrame, flush: int = 400_000) -> DataFrame:
    """``(word, n)`` over a column of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            pairs = list(held.items())
            held.clear()
            for i in range(0, len(pairs), 50_000):
                part = pairs[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in part], pa.binary()).cast(pa.string()), pa.array([n for _, n in part], pa.int64())],
                    names=["word", "n"])

        for batch in batches:
            for rows in slices(batch, 256):
                for text in texts(rows.column(0)):
                    held.update(words_of(text))
                if len(held) > flush:
                    yield from out()
        yield from out()

    return training.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> Column:
    """Condition that about ``most`` words meet, none before a clearly more frequent one.

    A histogram of counts in quarter powers of two (some 150 bins) says which bins fit; of the first that doesn't, a share by hash is taken.
    """
    step = F.floor(F.log2("n") * 4).cast("int")
    above = 0
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        if above + row["count"] > most:
            share = int((most - above) / row["count"] * (1 << 20))
            return (step > row["step"]) | ((step == row["step"]) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share))
        above += row["count"]
    return F.lit(True)


class Vocabulary:
    """Words in memory with their counts, symbols and the class masses; the first ``core`` words have symbols to themselves."""

    def __init__(self, known: pa.Table, core_words: int, ends: int, total: int, distinct: int, of_classes: np.ndarray):
        known = known.sort_by([("n", "descending"), ("word", "ascending")])
        words = known["word"].cast(pa.binary()).to_pylist()
        self.index = {w: i for i, w in enumerate(words)}
        self.counts = known["n"].to_numpy().astype(np.float64)
        core = min(core_words, len(words))
        self.core, self.end, self.symbols = core, core, core + 1 + CLASSES
        classes = np.array([class_of(w) for w in words], np.int64)
        own = _class_sums(classes[:core], self.counts[:core])
        tied = of_classes - own  # whole numbers: exact
        self.mass = tied[0] + SMOOTH * (tied[1] + 1)
        self.prior = tied[2] + 2 * SMOOTH * (tied[1] + 1)
        self.symbol = np.where(np.arange(len(words)) < core, np.arange(len(words)), core + 1 + classes).astype(np.uint16)
        self.log_count = np.log10(self.counts + SMOOTH)
        self.ends, self.total, self.distinct = ends, total, distinct
        mass = np.concatenate([self.counts[:core] + SMOOTH, [ends + SMOOTH], self.mass])
        self.unigram = mass / mass.sum()
        self.log_end = math.log10(ends + SMOOTH)
        self.log_all = math.log10(total + SMOOTH * (distinct + 1))


def _class_sums(classes: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(classes, x, CLASSES) for x in (n, np.ones(len(n)), np.minimum(n, PRIOR))])


def class_counts(counts: DataFrame) -> np.ndarray:
    """Tokens, distinct words and prior counts of each class, over ``(word, n)`` rows: (3, CLASSES)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, CLASSES))
        for batch in batches:
            at = np.fromiter((class_of(w.encode("utf-8")) for w in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            held += _class_sums(at, batch.column(1).to_numpy())
        if held[1].any():
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([held.tobytes()], pa.binary())],
                                             names=["part", "payload"])

    merged = tree_merge(counts.mapInArrow(run, "part int, payload binary"), _add_floats).collect()
    return np.frombuffer(merged[0]["payload"]).reshape(3, CLASSES) if merged else np.zeros((3, CLASSES))


def _add_floats(held: bytes | None, payload: bytes) -> bytes:
    return payload if held is None else (np.frombuffer(held) + np.frombuffer(payload)).tobytes()


ENCODED = ("row long, doc_id long, held_out boolean, ids binary, own binary, n_tokens long, n_known long, "
           "log_counts double, words binary, times array<int>")


def encode(docs: DataFrame, vocabulary) -> DataFrame:
    """Symbol ids and count sums of ``(doc_id, text, held_out)`` rows; words that aren't in memory are listed (joined by blanks) with their times.

    ``own`` tells the words behind the class symbols, in text order: the place of one in memory, or the size of the memory plus its place in the list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        get, absent, row = v.index.get, repeat(-1), TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows in slices(batch, 256):
                out: list[list] = [[] for _ in range(10)]
                for doc, held, text in zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(), texts(rows.column(1)), strict=True):
                    words = words_of(text)
                    at = np.fromiter(map(get, words, absent), np.int64, len(words))
                    seen = at[at >= 0]
                    ids = np.empty(len(words) + 1, np.uint16)
                    ids[:-1] = v.symbol[at] if len(v.symbol) else 0
                    ids[-1] = v.end
                    place: dict[bytes, int] = {}
                    times: list[int] = []
                    if len(seen) < len(words):
                        missing = np.flatnonzero(at < 0)
                        lost = [words[i] for i in missing]
                        at[missing] = len(v.index) + np.fromiter((place.setdefault(w, len(place)) for w in lost), np.int64, len(lost))
                        of = np.fromiter((class_of(w) for w in place), np.int64, len(place))
                        ids[missing] = v.core + 1 + of[at[missing] - len(v.index)]
                        times = np.bincount(at[missing] - len(v.index)).tolist()
                    values = (row, doc, held, ids.tobytes(), at[at >= v.core].astype(np.int32).tobytes(), len(ids),
                              len(seen) + (v.ends > 0), v.log_count[seen].sum() + v.log_end, b" ".join(place), times)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    row += 1
                kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64(),
                         pa.binary(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                                 names=[x.split(" ")[0] for x in ENCODED.split(", ")])

    return docs.mapInArrow(run, ENCODED)


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, unigram: np.ndarray, states: int, seed: int) -> "Model":
        """Sticky states whose emissions are the unigram shares, each disturbed differently."""
        noise = np.random.default_rng(seed).lognormal(0, 0.7, (len(unigram), states))
        emit = unigram[:, None] * noise
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, unigram: np.ndarray, share: float) -> "Model":
        """Probabilities from expected counts; ``share`` of each state's emissions follows the unigram shares."""
        start = start + 1
        move = move + 1
        emit = emit + 1e-9
        emit = (1 - share) * emit / emit.sum(0) + share * unigram[:, None]
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order from longest to shortest, and how many sequences are longer than t for each t."""
    order = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")
    return order, active


def emitted(emit: np.ndarray, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``emit[ids[places]]``; numpy takes rows in a third of the time that it indexes them."""
    return emit.take(ids.take(places), 0)


PAIRS = [np.repeat(np.eye(n, dtype=np.float32), 2, axis=0) for n in (4, 2, 1)]


def row_sums(a: np.ndarray) -> np.ndarray:
    """Sums of rows as a column. Eight numbers are added in pairs, as numpy does, by products (to the bit the same), which takes a third of the time."""
    if a.shape[1] != 8 or a.dtype != np.float32:
        return a.sum(1, keepdims=True)
    return a @ PAIRS[0] @ PAIRS[1] @ PAIRS[2]


def transfers(model: Model, ids: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Scaled transfer matrix of each piece: from the state at its first token to the state after its last, its tokens emitted."""
    order, active = by_length(lengths)
    offsets, states = offsets[order], len(model.move)
    a = np.tile(np.eye(states), (len(lengths), 1, 1))
    for t, k in enumerate(active):
        moved = (a[:k] * emitted(model.emit, ids, offsets[:k] + t)[:, None, :]).reshape(-1, states) @ model.move
        a[:k] = moved.reshape(k, states, states)
        if t % 16 == 15:  # emissions are above 1e-15, so nothing gets lost in between
            a[:k] /= a[:k].sum((1, 2), keepdims=True)
    out = np.empty_like(a)
    out[order] = a / a.sum((1, 2), keepdims=True)
    return out


class Pieces:
    """Pieces of up to ``segment`` tokens of whole sequences, with the messages that reach them over their ends.

    ``before`` is the state distribution at the first token given all earlier ones; ``after`` the likelihood of all
    later tokens by the state that follows the last (scaled; ones at the end of a text).
    """

    def __init__(self, model: Model, sequences: list[np.ndarray], segment: int):
        lengths = np.array([len(x) for x in sequences])
        self.ids = np.concatenate(sequences)
        n = -(-lengths // segment)
        text = np.repeat(np.arange(len(n)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.offsets = (np.cumsum(lengths) - lengths)[text] + nth * segment
        self.lengths = np.minimum(segment, lengths[text] - nth * segment)
        self.first, self.last = nth == 0, nth == n[text] - 1
        self.before = np.tile(model.start, (len(text), 1))
        self.after = np.ones_like(self.before)
        long = np.flatnonzero(n[text] > 1)
        at = dict(zip(long.tolist(), range(len(long)), strict=True))
        if not at:
            return
        step = 512
        m = np.concatenate([transfers(model, self.ids, self.offsets[long[i:i + step]], self.lengths[long[i:i + step]])
                            for i in range(0, len(long), step)])
        for i in at:
            if not self.first[i]:
                p = self.before[i - 1] @ m[at[i - 1]]
                self.before[i] = p / p.sum()
        for i in reversed(at):
            if not self.last[i]:
                p = m[at[i + 1]] @ self.after[i + 1]
                self.after[i] = p / p.sum()

    def batches(self, tokens: int) -> Iterator[tuple[int, int]]:
        """Ranges of pieces with up to ``tokens`` tokens (one piece at least); all at once if there are at most twice as many."""
        ends, at = np.cumsum(self.lengths), 0
        if ends[-1] <= 2 * tokens:
            tokens = 2 * tokens
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + tokens, side="right")))
            yield at, to
            at = to


def expected_counts(model: Model, pieces: Pieces, lo: int, hi: int):
    """Expected start and move counts of the pieces ``lo`` to ``hi``, and the state posteriors of their tokens in order."""
    order, active = by_length(pieces.lengths[lo:hi])
    order = order + lo
    offsets = pieces.offsets[order]
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    states, longest, base = len(move), len(active), pieces.offsets[lo]
    alphas, scales = [], []
    active, a = active.tolist(), None
    for t, k in enumerate(active):
        a = (pieces.before[order].astype(np.float32) if t == 0 else a[:k] @ move) * emitted(emit, pieces.ids, offsets[:k] + t)
        c = row_sums(a)
        a /= c
        alphas.append(a)
        scales.append(c)
    after = pieces.after[order]
    ahead_of_end = (after @ model.move.T).astype(np.float32)
    ends = np.empty((len(order), states))
    moved, posterior = np.zeros((states, states)), np.empty((pieces.lengths[lo:hi].sum(), states), np.float32)
    n, b = 0, None
    for t in range(longest - 1, -1, -1):
        k = active[t]
        now = np.empty((k, states), np.float32)
        if n:
            ahead = emitted(emit, pieces.ids, offsets[:n] + (t + 1)) * b / scales[t + 1]
            moved += alphas[t][:n].T @ ahead
            now[:n] = ahead @ move.T
        if n < k:  # pieces that end here
            ends[n:k] = alphas[t][n:k]
            now[n:k] = ahead_of_end[n:k] / (alphas[t][n:k] * ahead_of_end[n:k]).sum(1, keepdims=True)
        posterior[offsets[:k] + t - base] = alphas[t] * now
        n, b = k, now
    over = ~pieces.last[order]
    cross = ends[over][:, :, None] * model.move * after[over][:, None, :]
    cross = (cross / cross.sum((1, 2), keepdims=True)).sum(0) if over.any() else 0
    start = posterior[pieces.offsets[lo:hi][pieces.first[lo:hi]] - base].sum(0)
    return start, moved * model.move + cross, posterior


def _payload(x: np.ndarray) -> bytes:
    return x.dtype.str.encode().ljust(8) + x.tobytes()


def _of_payload(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, payload[:8].decode().strip(), offset=8)


def _add_payloads(held: bytes | None, payload: bytes) -> bytes:
    return payload if held is None else _payload(_of_payload(held) + _of_payload(payload))


def _by_state(at: np.ndarray, posterior: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(at, posterior[:, s], size) for s in range(posterior.shape[1])], 1)


def whole_texts(columns: list[str], batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[pa.Table]:
    """Tables of whole rows with some ``tokens`` symbol ids in the column ``ids`` (one row at least)."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, 128):
            held.append(part.select(columns))
            size += (pc.sum(pc.binary_length(part.column("ids"))).as_py() or 0) // 2
            if size >= tokens:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def baum_welch(ids: DataFrame, first: Model, unigram: np.ndarray, rounds: int, segment: int, share: float,
               memory: tuple[int, int] = (0, 0), batch_tokens: int = 800_000):
    """Rounds of expectation over all rows of symbol ids (and ``own`` words) and maximisation of the merged counts.

    Returns the model, the one before the last round, and what the last round
    counted: for the symbols, and for the words in memory from ``memory[0]`` to ``memory[1]``.
    """
    sc = ids.sparkSession.sparkContext
    model, states, symbols, (core, known) = first, len(first.move), len(unigram), memory
    before, emit, words = first, np.zeros((symbols, states)), np.zeros((known - core, states))
    columns = ids.columns

    def expect(batches: Iterator[pa.RecordBatch], now, last: bool) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)), np.zeros((known - core if last else 0, states))]
        for rows in whole_texts(columns, batches, batch_tokens):
            pieces = Pieces(now.value, [np.frombuffer(x.as_py(), np.uint16) for x in rows["ids"]], segment)
            if last:
                own = np.full(len(pieces.ids), -1, np.int32)
                own[pieces.ids > core] = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in rows["own"]])
            for lo, hi in pieces.batches(batch_tokens):
                start, move, posterior = expected_counts(now.value, pieces, lo, hi)
                part = slice(pieces.offsets[lo], pieces.offsets[lo] + len(posterior))
                held[0] += start
                held[1] += move
                held[2] += _by_state(pieces.ids[part], posterior, symbols)
                if last:
                    mine = (own[part] >= core) & (own[part] < known)
                    held[3] += _by_state(own[part][mine] - core, posterior[mine], known - core)
        if held[0].any():
            small = np.concatenate([held[0], held[1].ravel()])
            held[3] = held[3].astype(np.float32)  # rarer words: small counts
            for i, x in enumerate([small, *(p for h in held[2:] for p in np.array_split(h, CHUNKS))]):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_payload(x)], pa.binary())],
                                                 names=["part", "payload"])

    for r in range(rounds):
        now, last = sc.broadcast(model), r == rounds - 1 and known > core
        rows = ids.mapInArrow(lambda b, now=now, last=last: expect(b, now, last), "part int, payload binary")
        merged = {r["part"]: _of_payload(r["payload"]) for r in tree_merge(rows, _add_payloads, 16).collect()}
        now.unpersist()
        if not merged:
            break
        start, move = merged[0][:states], merged[0][states:].reshape(states, states)
        emit = np.concatenate([merged[i + 1] for i in range(CHUNKS)]).reshape(symbols, states)
        words = np.concatenate([merged[i + 1 + CHUNKS] for i in range(CHUNKS)]).reshape(-1, states)
        before, model = model, Model.of_counts(start, move, emit, unigram, share)
    return model, before, emit, words


class Untied:
    """Shares of the words in their classes, state by state, from the words' own expected counts."""

    def __init__(self, v: Vocabulary, model: Model, emit: np.ndarray, words: np.ndarray):
        self.model, self.core, self.known = model, v.core, len(v.index)
        tied = emit[v.core + 1:]
        self.spread = (tied + 1 / tied.shape[1]) / (tied.sum(1, keepdims=True) + 1)
        self.whole = tied + v.prior[:, None] * self.spread
        classes = v.symbol[v.core:].astype(np.int64) - v.core - 1
        self.share = self.of(classes, v.counts[v.core:], words).astype(np.float32)

    def of(self, classes: np.ndarray, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (counts + (np.minimum(n, PRIOR) + 2 * SMOOTH)[:, None] * self.spread[classes]) / self.whole[classes]

    def emissions(self, ids: np.ndarray, own: np.ndarray, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A row a token; ``own`` beyond the words in memory points to rows of ``n`` and ``counts``."""
        out = self.model.emit.take(ids, 0)
        at = np.flatnonzero(ids > self.core)
        out[at[own < self.known]] *= self.share[own[own < self.known] - self.core]
        rare = own >= self.known
        listed = own[rare] - self.known
        out[at[rare]] *= self.of(ids[at[rare]].astype(np.int64) - self.core - 1, n[listed], counts[listed])
        return out


def listed_counts(encoded: DataFrame, model, states: int, core: int, known: int, segment: int, batch_tokens: int) -> DataFrame:
    """``(row, j, n, p0, ...)``: training count and shares of the states, over all texts, of each listed word of each row.

    Words without a count are left out. Shares travel as 16 bits each, four to a long."""
    names = [f"p{i}" for i in range(-(-states // 4))]
    columns = ["row", "held_out", "ids", "own", "words", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_texts(columns, batches, batch_tokens):
            times = rows["times"].combine_chunks()
            lengths = times.value_lengths().to_numpy().astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            e = np.zeros((lengths.sum(), states))
            learned = ~rows["held_out"].to_numpy()
            if learned.any():
                taken = rows.filter(pa.array(learned))
                pieces = Pieces(model.value, [np.frombuffer(x.as_py(), np.uint16) for x in taken["ids"]], segment)
                own = np.full(len(pieces.ids), -1, np.int64)
                own[pieces.ids > core] = np.concatenate(
                    [np.where(x < known, -1, x - known + at) for x, at in
                     zip((np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in taken["own"]), starts[learned], strict=True)])
                for lo, hi in pieces.batches(batch_tokens):
                    posterior = expected_counts(model.value, pieces, lo, hi)[2]
                    part = own[pieces.offsets[lo]:pieces.offsets[lo] + len(posterior)]
                    e += _by_state(part[part >= 0], posterior[part >= 0], len(e))
            words = pa.array([w for x in rows["words"].to_pylist() for w in x.split(b" ")], pa.binary()).cast(pa.string())
            times = times.flatten().to_numpy(zero_copy_only=False)
            shares = packed_shares(e / times[:, None])
            values = [words, pa.array(np.repeat(rows["row"].to_numpy(), lengths)),
                      pa.array((np.arange(len(e)) - np.repeat(starts, lengths)).astype(np.int32)),
                      pa.array(np.where(np.repeat(learned, lengths), times, 0).astype(np.int32)),
                      *(pa.array(shares[:, i]) for i in range(len(names)))]
            out = pa.RecordBatch.from_arrays(values, names=["word", "row", "j", "n", *names])
            yield from slices(out, 20_000)

    schema = "word string, row long, j int, n int, " + ", ".join(f"{x} long" for x in names)
    pairs = encoded.where(F.size("times") > 0).select(*columns).mapInArrow(run, schema)
    word = Window.partitionBy("word")
    sums = [F.sum(F.col("n") * F.shiftrightunsigned(x, 16 * i).bitwiseAND(ONE)).over(word).alias(f"{x}_{i}") for x in names for i in range(4)]
    summed = pairs.select("row", "j", F.sum("n").over(word).alias("n"), *sums).where("n > 0")
    mean = lambda x, i: F.shiftleft(F.round(F.col(f"{x}_{i}") / F.col("n")).cast("long"), 16 * i)
    return summed.select("row", "j", "n", *[reduce(lambda a, b: a.bitwiseOR(b), [mean(x, i) for i in range(4)]).alias(x) for x in names])


def packed_shares(shares: np.ndarray) -> np.ndarray:
    """Rows of shares (0 to 1) as rows of longs with four 16-bit parts each."""
    padded = np.zeros((len(shares), -(-shares.shape[1] // 4) * 4), "<u2")
    padded[:, :shares.shape[1]] = np.rint(np.clip(shares, 0, 1) * ONE)
    return padded.view("<i8")


def unpacked_shares(longs: np.ndarray, states: int) -> np.ndarray:
    return np.ascontiguousarray(longs, "<i8").view("<u2")[:, :states] / ONE


def forward_log10(start: np.ndarray, move: np.ndarray, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact log10 probability of each whole sequence, by the emissions of its tokens, by the scaled forward recursion."""
    order, active = by_length(lengths)
    offsets = (np.cumsum(lengths) - lengths)[order]
    total = np.zeros(len(lengths))
    ones, a = np.ones((len(move), 1)), None
    for t, k in enumerate(active.tolist()):
        a = (start if t == 0 else a[:k] @ move) * emissions.take(offsets[:k] + t, 0)
        c = a @ ones
        a /= c
        total[:k] += np.log10(c[:, 0])
    out = np.empty(len(lengths))
    out[order] = total
    return out


def score_texts(docs: DataFrame, *, states: int = 8, rounds: int = 4, core_words: int = 20_000,
                known_words: int = 400_000, segment: int = 1024, share: float = 0.05, seed: int = 11,
                batch_tokens: int = 800_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Ids whose crc32 (of the id as text) modulo 10 is 0 are held out of all learning.
    ``core_words`` and ``known_words`` say what is held in memory and tied in the first rounds, not what is learned.
    """
    if core_words + 1 + CLASSES > 1 << 16:
        raise ValueError("symbols must fit in 16 bits")
    sc = docs.sparkSession.sparkContext
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = cut(word_counts(training.select("text")))
    ends = training.count()
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).collect()[0]
    known = counts.where(most_frequent(counts, known_words)).toArrow()  # about known_words
    v = Vocabulary(known, core_words, ends, sums["n"] + ends, sums["words"] + (ends > 0), class_counts(counts))
    core, memory = v.core, len(v.index)
    encoded = cut(encode(rows, sc.broadcast(v)))
    first = Model.first(v.unigram, states, seed)
    model, before, emit, words = baum_welch(encoded.where(~F.col("held_out")).select("ids", "own"), first, v.unigram, rounds,
                                            segment, share, (core, memory), batch_tokens)
    untied = sc.broadcast(Untied(v, model, emit, words))
    listed = listed_counts(encoded, sc.broadcast(before), states, core, memory, segment, batch_tokens)
    # shuffled as plain rows: lists made before the shuffle would be larger
    back = listed.repartition("row").groupBy("row").agg(F.collect_list(F.struct(*[c for c in listed.columns if c != "row"])).alias("listed"))
    kept = ["doc_id", "held_out", "n_tokens", "n_known", "log_counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = untied.value
        for part in whole_texts(["ids", "own", "times", "listed", *kept], batches, batch_tokens // 2):
            ids = [np.frombuffer(x.as_py(), np.uint16) for x in part["ids"]]
            times = part["times"].combine_chunks()
            sizes = times.value_lengths().to_numpy()
            starts, times = np.cumsum(sizes) - sizes, times.flatten().to_numpy(zero_copy_only=False)
            found = part["listed"].combine_chunks()
            at = np.repeat(starts, found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            j, n_found, *shares = found.flatten().flatten()
            at = at + j.to_numpy()
            n, e = np.zeros(len(times), np.int64), np.zeros((len(times), len(u.model.move)))
            n[at] = n_found.to_numpy()
            e[at] = n[at][:, None] * unpacked_shares(np.stack([x.to_numpy() for x in shares], 1), e.shape[1])
            own = np.concatenate([np.where(x < u.known, x, x + s) for x, s in
                                  zip((np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in part["own"]), starts, strict=True)])
            lengths = np.array([len(x) for x in ids])
            scores = forward_log10(u.model.start, u.model.move, u.emissions(np.concatenate(ids), own, n, e), lengths)
            of = np.repeat(np.arange(len(ids)), sizes)
            log_counts = part["log_counts"].to_numpy() + np.bincount(of, times * np.log10(n + SMOOTH), len(ids))
            n_known = part["n_known"].to_numpy() + np.bincount(of, times * (n > 0), len(ids)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(part[c].combine_chunks() for c in kept[:3]), pa.array(n_known), pa.array(log_counts), pa.array(scores)],
                names=[*kept, "score"])

    scored = encoded.select("row", "ids", "own", "times", *kept).join(back, "row", "left").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"),
                         (F.col("log_counts") - F.col("n_tokens") * F.lit(v.log_all)).alias("base_score"), "score")
