"""SimHash near-duplicates against brute force."""
import random
import re

import numpy as np
import pytest
import xxhash
from edges import edge_docs, empty_docs, rows_of

from tidemark.llm.simhash_gph import (correlated_parts, deal_thresholds, fingerprint, flips, links, near_duplicates,
                                      part_values)


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(shingles))


def brute_components(fps, distance=2):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    least: dict = {}
    for (doc, _), c in zip(rows, comp):
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return sorted(((d, f"{f:016x}", least.get(c)) for (d, _), f, c in zip(rows, fps, comp)), key=str)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    got = sorted(rows_of(near_duplicates(docs), "doc_id", "fingerprint", "component_id"), key=str)
    assert got == brute(rows_of(docs, "doc_id", "text"))
    assert near_duplicates(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("hot_limit", [0, 30, 100_000])
def test_links_connect_what_is_near(spark, hot_limit):
    """The same components whether classes are probed or linked as a crowd."""
    rng = random.Random(5)
    fps = set()
    for base in [rng.getrandbits(64) for _ in range(25)] + [0]:
        for _ in range(12):
            f = base
            for _ in range(rng.randrange(5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = [(fps[signed.index(a)], fps[signed.index(b)]) for a, b in rows_of(links(classes, 2, 3, 18, hot_limit), "a", "b")]
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)
    label = {f: f for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        label[max(find(a), find(b))] = min(find(a), find(b))
    want = brute_components(fps)
    pairs = {(find(f), w) for f, w in zip(fps, want)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_thresholds_are_the_cheapest_deal():
    rng = np.random.default_rng(2)
    cost = np.cumsum(rng.random((3, 4, 50)), axis=1)
    cost[:, 0] = 0
    steps, best = deal_thresholds(cost, 2)
    assert (steps.sum(0) == 3).all()
    for r in range(50):
        every = [sum(cost[i, s, r] for i, s in enumerate((a, b, 3 - a - b))) for a in range(4) for b in range(4 - a)]
        assert np.isclose(best[r], min(every))


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3] ^ (rng.random(4000) < 0.02)
    parts = correlated_parts(bits.T @ bits, 4000, 3)
    assert sorted(sum(parts, [])) == list(range(64))
    assert any(3 in p and 40 in p for p in parts)


def test_part_values_and_flips():
    fps = np.array([0, 2**64 - 1, 0b1010], np.uint64)
    assert [v.tolist() for v in part_values(fps, [[1, 3], [0, 2]])] == [[0, 3, 3], [0, 3, 0]]
    assert len(flips(22, 2)) == 1 + 22 + 231 and len(flips(64, 1)) == 65


def test_fingerprint_of_long_text():
    text = " ".join(str(i % 313) for i in range(5000))
    assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("hot_limit", [0, 1000])
def test_one_bit_links_in_crowds_as_elsewhere(spark, hot_limit):
    """1, 2 and 4 are two bits apart and share keys; 8 and 9 are one bit apart."""
    classes = spark.createDataFrame([(x << 20,) for x in (1, 2, 4, 8, 9)], "fp long")
    got = {frozenset(x >> 20 for x in r) for r in links(classes, 1, 3, 18, hot_limit).collect()}
    assert got == {frozenset(p) for p in ((1, 9), (8, 9))}
