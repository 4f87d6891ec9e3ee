"""The hidden Markov language model against enumeration and plain counts."""
import collections
import itertools
import math
import re
import sys
import zlib

import numpy as np
import pytest
from edges import edge_docs, empty_docs, rows_of

from tidemark.llm.hmm_lm import CLASSES, PRIOR, SMOOTH, Model, Pieces, baum_welch, class_of, expected_counts, forward_log10, most_frequent, row_sums, score_texts


def enumerated(model, ids):
    """Probability of a sequence as the sum over all state paths."""
    states = range(len(model.move))
    total = 0.0
    for path in itertools.product(states, repeat=len(ids)):
        p = model.start[path[0]] * model.emit[ids[0], path[0]]
        for a, b, x in zip(path, path[1:], ids[1:]):
            p *= model.move[a, b] * model.emit[x, b]
        total += p
    return total


def whole_scores(model, sequences):
    return forward_log10(model.start, model.move, model.emit[np.concatenate(sequences)], np.array([len(x) for x in sequences]))


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(1)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return Model(norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((6, 3)), 0))


def test_forward_is_the_sum_over_paths(small):
    sequences = [np.array(x, np.uint16) for x in ([0], [5, 1], [2, 2, 4, 0, 1], [3, 0, 5, 5, 1, 2, 4])]
    want = [math.log10(enumerated(small, x)) for x in sequences]
    assert np.allclose(whole_scores(small, sequences), want)


@pytest.mark.parametrize("segment", [1, 2, 3, 100])
@pytest.mark.parametrize("tokens", [1, 100])
def test_expected_counts_are_the_posterior_sums(small, segment, tokens):
    """Whatever the pieces that a text is computed in, and how many of them at a time."""
    sequences = [[0, 3, 1], [5], [2, 4, 1, 1, 0, 5, 3]]
    pieces = Pieces(small, [np.array(x, np.uint16) for x in sequences], segment)
    parts = [expected_counts(small, pieces, lo, hi) for lo, hi in pieces.batches(tokens)]
    start, move, posterior = sum(p[0] for p in parts), sum(p[1] for p in parts), np.concatenate([p[2] for p in parts])
    s, m, e = np.zeros(3), np.zeros((3, 3)), np.zeros((len(posterior), 3))
    at = 0
    for x in sequences:
        whole = enumerated(small, x)
        for path in itertools.product(range(3), repeat=len(x)):
            p = small.start[path[0]] * small.emit[x[0], path[0]]
            for a, b, y in zip(path, path[1:], x[1:]):
                p *= small.move[a, b] * small.emit[y, b]
            s[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                m[a, b] += p / whole
            for i, b in enumerate(path):
                e[at + i, b] += p / whole
        at += len(x)
    assert np.allclose(start, s, atol=1e-4) and np.allclose(move, m, atol=1e-4) and np.allclose(posterior, e, atol=1e-4)


def by_hand(spark, rows, memory, states, rounds, share, seed):
    """Scores by a plain whole-text Baum-Welch in which every word's states are counted in a dictionary."""
    words = lambda t: t.lower().encode().split()
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    c = collections.Counter(w for d, t in rows if not held(d) for w in words(t))
    counts = spark.createDataFrame([(w.decode(), n) for w, n in c.items()], "word string, n long")
    known = [r.word.encode() for r in counts.where(most_frequent(counts, memory[1])).collect()]
    core = {w: i for i, w in enumerate(sorted(known, key=lambda w: (-c[w], w))[:memory[0]])}
    k, ends = len(core), sum(not held(d) for d, _ in rows)
    tied = [[n for w, n in c.items() if w not in core and class_of(w) == i] for i in range(CLASSES)]
    mass = [sum(x) + SMOOTH * (len(x) + 1) for x in tied]
    unigram = np.array([c[w] + SMOOTH for w in core] + [ends + SMOOTH] + mass)
    unigram /= unigram.sum()
    ids = lambda t: [core.get(w, k + 1 + class_of(w)) for w in words(t)] + [k]
    model = Model.first(unigram, states, seed)
    for _ in range(rounds):
        start, move, emit, own = np.zeros(states), np.zeros((states, states)), np.zeros((len(unigram), states)), collections.defaultdict(float)
        for d, t in rows:
            if held(d):
                continue
            x = ids(t)
            a, b = [model.start * model.emit[x[0]]], [np.ones(states)]
            for y in x[1:]:
                a.append(a[-1] @ model.move * model.emit[y])
            for y in x[:0:-1]:
                b.insert(0, model.move @ (model.emit[y] * b[0]))
            p = a[-1].sum()
            start += a[0] * b[0] / p
            for i, y in enumerate(x):
                g = a[i] * b[i] / p
                emit[y] += g
                if y > k:
                    own[words(t)[i]] += g
                if i:
                    move += a[i - 1][:, None] * model.move * model.emit[y] * b[i] / p
        model = Model.of_counts(start, move, emit, unigram, share)

    def emission(w):
        if w in core:
            return model.emit[core[w]]
        i = class_of(w)
        e = emit[k + 1 + i]
        spread = (e + 1 / states) / (e.sum() + 1)
        prior = sum(min(n, PRIOR) for n in tied[i]) + 2 * SMOOTH * (len(tied[i]) + 1)
        return model.emit[k + 1 + i] * (own[w] + (min(c[w], PRIOR) + 2 * SMOOTH) * spread) / (e + prior * spread)

    out = {}
    for d, t in rows:
        a = model.start
        for i, w in enumerate(words(t)):
            a = (a if not i else a @ model.move) * emission(w)
        a = (a @ model.move if words(t) else a) * model.emit[k]
        out[d] = math.log10(a.sum())
    return out


@pytest.mark.parametrize(("core", "known"), [(5, 12), (0, 0), (3, 10_000), (10_000, 10_000)])
def test_every_word_learns_whatever_is_held_in_memory(spark, core, known):
    rng = np.random.default_rng(5)
    names = [f"{a}{b}{c}" for a in "bdkm" for b in "aeiou" for c in ("st", "n", "ll")]
    rows = [(i, " ".join(rng.choice(names[i % 2::2], size=rng.integers(0, 30)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = score_texts(docs, states=3, rounds=3, core_words=core, known_words=known, segment=4, batch_tokens=50).collect()
    want = by_hand(spark, rows, (core, known), 3, 3, 0.05, 11)
    assert np.allclose([r.score for r in got], [want[r.doc_id] for r in got], rtol=1e-4)


def test_words_of_one_count_learn(spark):
    """25,000 words of count 4, in two kinds of texts, none of them among the core words: states still tell the kinds apart."""
    rng = np.random.default_rng(6)
    kinds = [[f"w{i}x{k}" for i in range(12_500)] for k in (0, 1)]
    rows, i = [], 0
    for _ in range(4):
        for k in (0, 1):
            for part in np.array_split(rng.permutation(kinds[k]), 250):
                rows.append((i, " ".join(part)))
                i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    few = score_texts(docs, core_words=100, known_words=200, rounds=4).where("held_out").collect()
    assert sum(r.score for r in few) > sum(r.base_score for r in few)


def test_rounds_raise_the_likelihood(spark):
    rng = np.random.default_rng(2)
    texts = [rng.choice([[0, 1, 2], [3, 4, 5]][i % 2], size=80).astype(np.uint16) for i in range(60)]
    ids = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "ids binary").repartition(4)
    unigram = np.full(6, 1 / 6)
    first = Model.first(unigram, 2, 3)
    scores = [whole_scores(baum_welch(ids, first, unigram, r, 32, 0.01)[0], texts).sum() for r in (0, 1, 4)]
    assert scores[0] < scores[1] < scores[2]
    assert scores[2] > 60 * 80 * math.log10(1 / 3.4)  # two kinds of texts of three symbols each


def brute(rows):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    c = collections.Counter()
    for d, t in rows:
        if not held(d):
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    return sorted(((d, held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                    sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))) for d, t in rows), key=str)


@pytest.mark.parametrize("sizes", [(20, 60), (100_000 // 2, 400_000), (0, 0)])
def test_base_scores_whatever_is_held_in_memory(spark, sizes):
    docs = edge_docs(spark).unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80), allowMissingColumns=True)
    docs = docs.repartition(3, "source").cache()
    got = score_texts(docs, core_words=sizes[0], known_words=sizes[1], rounds=1).collect()
    got = sorted([tuple(r)[:5] + (r.base_score,) for r in got], key=str)
    want = brute(rows_of(docs, "doc_id", "text"))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_held_out_texts_are_likelier_than_by_counts_alone(spark):
    got = score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), rounds=3).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert np.mean([r.score > r.base_score for r in got]) > 0.9


def test_words_in_memory_and_empty_table(spark):
    counts = spark.createDataFrame([(f"w{i}", i) for i in range(1, 101)] + [(f"t{i}", 200) for i in range(4000)], "word string, n long")
    for most in (0, 1000, 3000, 4000, 4050, 9000):
        kept = counts.where(most_frequent(counts, most)).collect()
        assert abs(len(kept) - min(most, 4100)) <= 0.05 * most + 1
        assert most <= 4000 or sum(r.n == 200 for r in kept) == 4000
    assert score_texts(empty_docs(spark)).count() == 0


def test_a_step_makes_few_calls_and_gives_the_posteriors_of_single_precision():
    """Steps take rows and sum by products; the sums over a short axis and the double indexing took half of a step."""
    rng = np.random.default_rng(3)
    model = Model.first(rng.random(30) / 15, 8, 5)
    sequences = [rng.integers(0, 30, n).astype(np.uint16) for n in (1, 2, 40, 7, 300)]
    pieces = Pieces(model, sequences, 64)
    short = rng.random((500, 8)).astype(np.float32)
    assert all(np.array_equal(row_sums(x), x.sum(1, keepdims=True)) for x in (short, short[:, :5].copy(), short.astype(np.float64)))
    calls = []
    profiled = lambda frame, event, f: calls.append(f.__name__) if event == "c_call" else None
    sys.setprofile(profiled)
    try:
        _, moved, posterior = expected_counts(model, pieces, 0, len(pieces.lengths))
    finally:
        sys.setprofile(None)
    steps = int(pieces.lengths.max())
    assert calls.count("take") == 2 * (2 * steps - 1)
    assert calls.count("reduce") < steps  # only where pieces end
    assert np.abs(posterior.sum(1) - 1).max() < 1e-5 and abs(moved.sum() - sum(len(x) - 1 for x in sequences)) < 1e-3
