"""Language ID: exact marginals by enumeration, the gradient, held-out accuracy, code-switched text, defined cases."""
import itertools

import numpy as np
import pyarrow as pa
import pytest
from edges import TEXTS, edge_docs, empty_docs, rows_of

from tidemark.llm import language_crf as crf
from tidemark.llm.language_crf import Lexicon, Weights, languages_of, likelihood, mean_marginals, word_languages, word_marginals, words_of

SF = "/root/testdata/sf0.01"


def by_enumeration(w, e, codes):
    """Marginals of one sequence and its log partition sum, from all labellings."""
    n, total, out = e.shape[1], 0.0, np.zeros((len(codes), e.shape[1]))
    for path in itertools.product(range(n), repeat=len(codes)):
        s = w.first[path[0]] + sum(e[c, k] for c, k in zip(codes, path, strict=True)) + sum(w.steps[a, b] for a, b in zip(path, path[1:], strict=False))
        total += np.exp(s)
        out[np.arange(len(codes)), path] += np.exp(s)
    return out / total, np.log(total)


def some_weights(n, seed):
    return Weights.of(np.random.default_rng(seed).standard_normal(Weights.size(n)) * 0.7, n)


@pytest.mark.parametrize("segment", [1, 2, 3, 512])
def test_marginals_are_exact_over_segments(monkeypatch, segment):
    monkeypatch.setattr(crf, "SEGMENT", segment)
    monkeypatch.setattr(crf, "TOGETHER", 4)
    rng = np.random.default_rng(segment)
    for n in (1, 2, 3):
        w, e = some_weights(n, n), rng.standard_normal((5, n))
        lengths = np.array([0, 1, 7, 3, 0, 2, 6, 5])
        codes = rng.integers(0, 5, lengths.sum())
        want = [by_enumeration(w, e, c)[0] if len(c) else np.zeros((0, n)) for c in np.split(codes, np.cumsum(lengths)[:-1])]
        assert np.allclose(word_marginals(w, crf._scaled(e), codes, lengths), np.concatenate(want))
        assert np.allclose(mean_marginals(w, crf._scaled(e), codes, lengths), [x.mean(0) if len(x) else np.zeros(n) for x in want])


def chunk_of(texts, labels, lexicon, n):
    words, codes, lengths = words_of(pa.array(texts))
    rows, features, weight = crf.grams_of(words)
    shares, known = lexicon(words)
    return {"rows": rows, "features": features, "weight": weight, "shares": shares, "known": known, "codes": codes,
            "labels": np.array(labels), "lengths": lengths}


@pytest.mark.parametrize("segment", [2, 512])
def test_likelihood_and_gradient(monkeypatch, segment):
    monkeypatch.setattr(crf, "SEGMENT", segment)
    n = 3
    words, *_ = words_of(pa.array(["der hund la casa"]))
    lexicon = Lexicon(np.sort(crf.word_hash(words)), np.array([[0.2, 0.5, 0.3], [0.7, 0.1, 0.2], [0.1, 0.1, 0.8], [0.3, 0.3, 0.4]]))
    chunk = chunk_of(["der hund a b c", "la casa", "hund"], [0, 1, 2, 1, 1, 0, 2, 1], lexicon, n)
    x = np.random.default_rng(8).standard_normal(Weights.size(n)) * 0.3
    w = Weights.of(x, n)
    e = w.emissions(*(chunk[k] for k in ("rows", "features", "weight", "shares", "known")))
    want, at = 0.0, 0
    for length in chunk["lengths"]:
        codes, labels = chunk["codes"][at:at + length], chunk["labels"][at:at + length]
        want += w.first[labels[0]] + e[codes, labels].sum() + w.steps[labels[:-1], labels[1:]].sum() - by_enumeration(w, e, codes)[1]
        at += length
    value, gradient = likelihood(x, n, lexicon, chunk)
    assert np.isclose(value, want)
    tail = Weights.size(n) - crf.FEATURES * n
    for i in [*(crf.FEATURES * n + np.arange(tail)), *(chunk["features"][:4].astype(int) * n + 1)]:
        d = np.zeros_like(x)
        d[i] = 1e-5
        assert np.isclose(gradient[i], (likelihood(x + d, n, lexicon, chunk)[0] - likelihood(x - d, n, lexicon, chunk)[0]) / 2e-5, atol=1e-5)


def test_words_are_runs_of_letters_and_marks():
    texts = [None, "", "12 ²!", "Don't stop", "naïve—Ünï  x1y\tz", "हिन्दी ́ 日本語。テスト", "a" * 70_000]
    words, codes, lengths = words_of(pa.array(texts))
    listed = np.array(words.to_pylist(), object)[codes].tolist()
    assert [listed[e - n:e] for e, n in zip(np.cumsum(lengths), lengths, strict=True)] == [
        [], [], [], ["don", "t", "stop"], ["naïve", "ünï", "x", "y", "z"], ["हिन्दी", "日本語", "テスト"], ["a" * 70_000]]


def test_spans_cover_all_words_once():
    rng = np.random.default_rng(3)
    texts = [np.arange(n) for n in (0, 1, 500, 47, 90)]
    where, owner, lengths = crf.drawn_spans(texts, rng)
    assert sorted(where.tolist()) == list(range(638)) and lengths.sum() == 638
    starts = np.cumsum([0, *map(len, texts)])
    assert all(starts[o] <= w < starts[o + 1] for w, o in zip(where, owner, strict=True))


def test_held_out_accuracy_and_code_switched_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in languages_of(docs).collect()}
    held = [(got[d], lang) for d, lang, n in rows_of(docs, "doc_id", "lang", "n_chars") if got[d].held_out]
    assert len(held) > 200 and np.mean([r.lang_pred == lang for r, lang in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    model = crf.fit(docs)
    texts = {lang: t for d, lang, t in rows_of(docs, "doc_id", "lang", "text") if got[d].held_out and len(t) > 1500}
    words = {lang: [w for w in t.split() if w.isalpha()][:40] for lang, t in texts.items()}
    mixed = spark.createDataFrame([(1, " ".join(words["de"] + words["en"] + words["fr"]))], "doc_id long, text string")
    runs = word_languages(mixed, model).first().runs
    labels = [r.lang for r in runs for _ in range(r.words)]
    want = ["de"] * 40 + ["en"] * 40 + ["fr"] * 40
    assert len(labels) == 120 and np.mean([a == b for a, b in zip(labels, want, strict=True)]) > 0.9


def test_only_text_counts_and_held_out_rows_are_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2"
    turned = docs.selectExpr("doc_id", "text", f"IF({held}, 'xx', lang) AS lang", "'other' AS source", "1 AS n_chars")
    first, again = ({r.doc_id: r for r in languages_of(x, steps=6).collect()} for x in (docs, turned))
    assert all(first[d].lang_pred == again[d].lang_pred and np.isclose(first[d].score, again[d].score, atol=1e-6) for d in first)
    assert sum(r.held_out for r in first.values()) == docs.where(held).count() > 0


def test_edge_rows(spark):
    docs = edge_docs(spark).replace("src0", "src9")
    more = spark.createDataFrame([(i, t, lang, None, None) for i, (t, lang) in enumerate(
        [("der hund und die katze", "de"), ("ein haus und der baum", "de"), ("la casa y el perro", None), ("日本語の文章", "ja")] * 3, 1000)], empty_docs(spark).schema)
    rows = docs.unionByName(more, allowMissingColumns=True)
    got = languages_of(rows, steps=4).collect()
    assert len(got) == rows.count() and [r.held_out for r in got if r.doc_id is None] == [False]
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(TEXTS):
        has = any(c.isalpha() for c in text or "")
        assert (by_id[20 * i].lang_pred == "und") == (not has) and (has or by_id[20 * i].score == 0)
    assert {r.lang_pred for r in got} <= {"de", "en", "ja", "und"}
    one = languages_of(edge_docs(spark)).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0), ("und", 0.0)}
    none = languages_of(edge_docs(spark).where("doc_id IS NULL")).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert languages_of(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        languages_of(rows, max_langs=1)
