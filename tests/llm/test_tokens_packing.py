"""Token counts and packing against the tokenizers library."""
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edges import LONG_WORD, TEXTS, edge_docs, empty_docs, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.bpe_counts import TokenCounter, token_counts
from tidemark.llm.packing import PieceIds, pack, piece_lengths

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["a  b", "\n\na\n b", "x<|endoftext|>y <|endoftext|>", "it's we'll  \t tab nb 　 end ", "é́ Ωs ΣΑΣ. İx 123 4567\r\n x",
       "foo\n", " foo", "foo \nbar", "\x1cfoo\x1d bar\x85baz", "J̌ H̱a, <|STARTOFTEXT|>, K, Å. x², ½, 5.", "\"a\", (b). c,, d.. e_, f_."]
COUNTER, PIECES = TokenCounter(BYTES), PieceIds(WORDS)
ALPHABET = st.text(st.sampled_from(list(" \n\t.,!?:'abJHséÉ́̌Σİ1_<|")), max_size=60)


def library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_counts_are_the_librarys(text):
    assert COUNTER.count(text) == len(library_bytes.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_piecewise_ids_are_the_librarys(text):
    assert PIECES.ids(pa.array([text]))[0].tolist() == library_words.encode(text, add_special_tokens=False).ids


library_bytes, library_words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


def test_counts_of_edge_rows(spark):
    got = sorted(rows_of(token_counts(edge_docs(spark), BYTES), "doc_id", "n_bytes", "n_tokens", "over_limit"), key=str)
    texts = rows_of(edge_docs(spark), "doc_id", "text")
    counts = [(i, t or "", len(library(BYTES, t))) for i, t in texts]
    assert got == sorted(((i, len(t.encode()), n, n > 512) for i, t, n in counts), key=str)
    assert token_counts(empty_docs(spark), BYTES).count() == 0


def test_caches_are_bounded_and_forget_safely():
    counter = TokenCounter(BYTES)
    counter.chunks._limit = counter.pretokens._limit = 50
    pieces = PieceIds(WORDS, limit=50)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(40)) for _ in range(60)]
    for t in texts + texts:
        assert counter.count(t) == len(library_bytes.encode(t).ids)
        assert PieceIds.ids(pieces, pa.array([t]))[0].tolist() == library_words.encode(t, add_special_tokens=False).ids
    assert len(pieces.young) <= 50 + 41 and len(counter.chunks) <= 50 + 41


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 4095, 4096, 4097, 10_000])
def test_piece_lengths_are_the_binary_form(n):
    out = piece_lengths(n, 4096)
    assert sum(out) == n and out == sorted(out, reverse=True)
    assert all(x & (x - 1) == 0 and x <= 4096 for x in out)
    assert len([x for x in out if x < 4096]) == len({x for x in out if x < 4096})


def test_pack_round_trip_and_sequences(spark):
    docs = edge_docs(spark)
    got = pack(docs, WORDS, 2).collect()
    assert len({r.sequence_id for r in got}) == len(got)  # no sequence crosses documents
    assert all(r.length == r.bucket and r.length & (r.length - 1) == 0 and r.offset == 0 for r in got)
    by_row: dict = {}
    for r in got:
        by_row.setdefault((r.doc_id, r.sequence_id >> 40), []).append(r)
    whole: dict = {}
    for (doc, _), pieces in by_row.items():
        pieces.sort(key=lambda r: r.sequence_id)
        run = []
        for r in pieces:
            if r.start == 0 and run:
                whole.setdefault(doc, []).append(run)
                run = []
            assert r.start == len(run)
            run += np.frombuffer(r.ids, "<u4").tolist()
        whole.setdefault(doc, []).append(run)
        assert all(r.doc_tokens == len(x) for r, x in [(pieces[-1], whole[doc][-1])])
    want: dict = {}
    for doc, text in rows_of(docs, "doc_id", "text"):
        want.setdefault(doc, []).append([*library(WORDS, text), 2])
    assert whole == want
    assert pack(empty_docs(spark), WORDS, 2).count() == 0


def test_pack_query_digest(spark):
    from tidemark.llm.queries import op3_packing

    got = op3_packing(spark, "/root/testdata/sf0.001").limit(500).collect()
    text = dict(rows_of(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id", "text"))
    for r in got[::25]:
        ids = np.array([*library(WORDS, text[r.doc_id]), 2], "<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


def test_wrong_kind_of_tokenizer_is_refused():
    with pytest.raises(ValueError):
        PieceIds(BYTES)


def test_odd_texts():
    for t in ODD + [x for x in TEXTS if x] + [LONG_WORD]:
        assert COUNTER.count(t) == len(library(BYTES, t))
        assert PIECES.ids(pa.array([t]))[0].tolist() == library(WORDS, t)
