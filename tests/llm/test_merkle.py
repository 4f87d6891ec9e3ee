"""The dataset manifest against a plain level-by-level tree."""
import zlib
from hashlib import sha256

import pytest
from edges import edge_docs, empty_docs

from tidemark.llm.merkle_manifest import DIGEST, fold, levels, manifest, parent, postorder, postorder_position, siblings
from tidemark.llm.queries import op12_merkle_manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    n = row.n_chars + more if row.n_chars is not None else None
    fields = [row.doc_id, row.source, row.lang, n, row.text]
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels_, i):
    """(left neighbour or None, right neighbour or None) of each level."""
    out = []
    for nodes in levels_[:-1]:
        out.append((nodes[i - 1] if i % 2 else None, nodes[i + 1] if i % 2 == 0 and i + 1 < len(nodes) else None))
        i //= 2
    return out


def brute(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault("" if r.lang is None else "=" + r.lang, []).append(r)
    names = sorted(groups, key=str.encode)
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[name] = tree([leaf(r) for r in groups[name]])
    top = tree([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for i, r in enumerate(groups[name]):
            steps = path(trees[name], i) + path(top, k)
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            h = leaf(r, int(bad))
            for left, right in steps:
                h = H(*[x for x in (left, h, right) if x])
            said = H("".join(x for s in steps for x in s if x))
            out.append((r.doc_id, leaf(r), trees[name][-1][0], top[-1][0], said, h, h == top[-1][0]))
    return sorted(out, key=str)


def test_positions_are_the_order_of_completion():
    for n in [*range(1, 40), 64, 100, 128]:
        leaves = [sha256(str(i).encode()).digest() for i in range(n)]
        for height in {levels(n), levels(n) + 2}:
            log = postorder(leaves, height)
            want = [leaves]
            for _ in range(height):
                want.append([parent(*want[-1][i:i + 2]) for i in range(0, len(want[-1]), 2)])
            assert len(log) == DIGEST * sum(map(len, want))
            for t, nodes in enumerate(want):
                for i, node in enumerate(nodes):
                    at = DIGEST * postorder_position(t, i, n)
                    assert log[at:at + DIGEST] == node
            for i in range(n):
                assert fold(leaves[i], *siblings(log, n, height, i)) == log[-DIGEST:]


@pytest.mark.parametrize("bits", [2, 10])
def test_whole_table_in_several_rounds(spark, bits, monkeypatch):
    """Blocks of four leaves need several rounds; the result is the same."""
    from tidemark.llm import queries

    monkeypatch.setattr(queries, "manifest", lambda *a, **o: manifest(*a, **o, bits=bits))
    sf = "/root/testdata/sf0.001"
    got = sorted((tuple(r) for r in op12_merkle_manifest(spark, sf).collect()), key=str)
    want = brute(spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert got == want
    assert 0 < sum(not r[-1] for r in want) < len(want)


def test_edge_rows(spark):
    docs = edge_docs(spark).unionByName(empty_docs(spark), allowMissingColumns=True)
    more = spark.createDataFrame([(5, "x", "", None, None), (5, "y", "", None, 2), (9, "z", "é", "s", 1), (9, "z", "z", "s", 1)], empty_docs(spark).schema)
    docs = docs.unionByName(more, allowMissingColumns=True).repartition(3)
    rows = docs.collect()
    got = manifest(docs, COLUMNS, bits=2).collect()
    want = brute(rows)
    assert sorted(((r.item, r.leaf.hex(), r.subroot.hex(), r.root.hex()) for r in got), key=str) == sorted((w[:4] for w in want), key=str)
    assert all(r.folded == r.root and fold(r.leaf, r.sides, r.proof) == r.root for r in got)
    assert manifest(empty_docs(spark), COLUMNS).count() == 0
    one = manifest(docs.where("doc_id = 7"), COLUMNS).first()
    assert one.leaf == one.subroot == one.root == one.folded and one.sides == ""


def test_a_hot_group_and_equal_rows(spark):
    """Two thirds of all rows are one row of one group."""
    docs = spark.range(600).selectExpr("IF(id % 3 = 0, id, 1) AS doc_id", "IF(id % 3 = 0, CAST(id AS STRING), 'same') AS text",
                                       "IF(id % 9 = 0, 'de', 'en') AS lang", "'s' AS source", "1L AS n_chars").where("lang = 'en' OR doc_id <> 1")
    got = manifest(docs, COLUMNS, bits=3).collect()
    assert sorted(((r.item, r.leaf.hex(), r.subroot.hex(), r.root.hex()) for r in got), key=str) == sorted((w[:4] for w in brute(docs.collect())), key=str)
    assert all(r.folded == r.root for r in got)
