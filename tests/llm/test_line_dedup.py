"""Line de-duplication against brute force."""
import random

import numpy as np
import pytest
from edges import edge_docs, empty_docs, rows_of

from tidemark.llm.line_dedup import TwoFilters, dedup_lines, holds, pack_part, places, unpack_part


def key_of(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_length=10):
    order = lambda d: (d is None, d or 0)
    holders: dict = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(key_of(x)) < min_length or len(holders[key_of(x)]) < 2
                or min(holders[key_of(x)], key=order) == doc]
        out.append((doc, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


def run(df, **options):
    return sorted(rows_of(dedup_lines(df, **options), "doc_id", "text", "n_lines", "n_dropped"), key=str)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    assert run(docs) == brute(rows_of(docs, "doc_id", "text"))
    done = dedup_lines(docs)
    assert sorted(done.columns) == sorted(docs.columns)  # n_lines and n_dropped stand in for the clashing ones
    assert dedup_lines(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("bits", [9, 14, 27])
def test_random_documents_whatever_the_filter(spark, bits):
    """A filter too small for the data makes more suspects, never another result."""
    rng = random.Random(bits)
    lines = ["x" * n + str(i % 40) for i, n in enumerate(rng.choices(range(14), k=120))] + ["", "  The Hot Line ever  ", "the hot line EVER"]
    rows = [(rng.randrange(150), "\n".join(rng.choices(lines, k=rng.randrange(9)))) for _ in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert run(docs, filter_bits=bits) == brute(rows)


def test_merged_filters_hold_every_key_of_two_sides():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (500, 3000, 3000))
    sides = []
    for own in (a, b):
        f = TwoFilters(20)
        for chunk in np.array_split(np.concatenate([own, shared]), 5):
            f.add(chunk)
        sides.append(f.bits)
    size = sides[0].shape[2]
    sides = [np.stack([unpack_part(pack_part(s[:, p]), size) for p in range(64)], 1) for s in sides]
    twice = sides[0][1] | sides[1][1] | (sides[0][0] & sides[1][0])
    assert holds(twice, places(shared, 20)).all()
    assert holds(twice, places(rng.integers(0, 2**63, 2000).astype(np.uint64), 20)).mean() < 0.05
