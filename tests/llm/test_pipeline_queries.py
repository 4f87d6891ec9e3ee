"""The pipeline against brute force, and the registered SQL."""
import os
import sys

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import ROOT, SF_SMALL
from edges import edge_docs, rows_of
from pyspark.sql import functions as F
from test_line_dedup import brute as brute_lines
from test_simhash import brute as brute_groups
from tokenizers import Tokenizer

import corpus_pipeline as P
from tidemark.llm import queries
from tidemark.llm.packing import piece_lengths
from tidemark.llm.rff_quality import quality_scores
from tidemark.llm.template_decontam import contaminated

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import TABLES, rows_of as sorted_rows  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(queries.SQL[name]).df()
    assert sorted_rows(got) == sorted_rows(want)


def test_ten_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as E

    names = list(E.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert 4 <= len(P.STAGES) <= 5


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    accepted = {d for d, p in rows_of(quality_scores(docs, labels), "doc_id", "predicted") if p}
    rows = [r for r in rows_of(docs, "doc_id", "text") if r[0] in accepted]
    rows = [(d, t) for d, t, _, _ in brute_lines(rows)]
    rows = [(d, t) for d, t in rows if (d, d) in {(g[0], g[2]) for g in brute_groups(rows)}]
    bad = {d for d, in rows_of(contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items), "doc_id")}
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for d, t in rows:
        if d not in bad:
            ids, start = [*words.encode(t, add_special_tokens=False).ids, 2], 0
            for n in piece_lengths(len(ids), 4096):
                want[d, start] = (n, ids[start:start + n])
                start += n
    got = {(r.doc_id, r.start): (r.length, np.frombuffer(r.ids, "<u4").tolist()) for r in P.run(spark, SF_SMALL).collect()}
    assert got == want and len(want) > 100


def test_stages_keep_the_columns_of_documents(spark):
    docs = edge_docs(spark)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert sorted(out.columns) == sorted(docs.columns), name
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name
        out.count()


def test_near_copies_leave_one_of_each_group(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "nothing like the others at all here"), (None, "z y x w")]
    out = P.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_SMALL)
    assert sorted(rows_of(out, "doc_id"), key=str) == [(3,), (9,), (None,)]


def test_rows_of_one_id_and_null_ids_are_decided_on_their_own(spark):
    texts = ["z y x w", "nothing like the others at all here", "rivers seldom forget the valleys that they carved"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (4, texts[1]), (7, "one two three four"), (7, "some other words of it")]
    out = P.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_SMALL)
    want = [(None, texts[0]), (None, texts[2]), (4, texts[1]), *rows[5:]]
    assert sorted(rows_of(out, "doc_id", "text"), key=str) == sorted(want, key=str)


def test_a_rejected_row_removes_no_other_row(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    bad = {r[0] for r in rows_of(contaminated(docs, items), "doc_id")}
    assert bad
    rows = [(None if d % 2 else 1, t) for d, t in rows_of(docs, "doc_id", "text")]
    want = [(None if d % 2 else 1, t) for d, t in rows_of(docs, "doc_id", "text") if d not in bad]
    out = P.decontamination(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_SMALL)
    assert sorted(rows_of(out, "doc_id", "text"), key=str) == sorted(want, key=str)


def test_quality_is_decided_row_by_row(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").unionByName(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("doc_id", F.lit(None).cast("long")))
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    want = {(d, p) for d, p in rows_of(quality_scores(docs, labels), "doc_id", "predicted") if d is not None}
    accepted = {d for d, p in want if p}
    text_of = dict(rows_of(docs.where("doc_id is not null"), "doc_id", "text"))
    out = rows_of(P.quality(spark, docs, SF_SMALL), "doc_id", "text")
    assert 0 < len(accepted) < len(text_of)
    assert sorted(t for d, t in out if d is None) == sorted(text_of[d] for d in accepted)
