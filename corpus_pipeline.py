"""The corpus pipeline: five stages that each call one operator of ``tidemark.llm``.

Every stage works on all rows its predecessor kept. Its result is written as
Parquet in the shared folder and read again as the next stage's documents. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.packing import pack
from tidemark.llm.rff_quality import quality_scores
from tidemark.llm.simhash_gph import near_duplicates
from tidemark.llm.template_decontam import contaminated
from tidemark.session import shared_dir


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of the whole row, under a name they don't hold; it is the same on every try.

    Stages decide by this key: ids may be null or repeated. Equal rows are decided alike.
    """
    name = "_row_hash"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return docs.withColumn(name, F.xxhash64(*docs.columns)), name


def _of_rows(keyed: DataFrame, key: str, listed: DataFrame, how: str) -> DataFrame:
    """Rows of ``keyed`` whose key is (left_semi) or is not (left_anti) in the first column of ``listed``; the texts are not sorted."""
    listed = listed.toDF("_listed").distinct().hint("shuffle_hash")
    return keyed.join(listed, keyed[key] == listed["_listed"], how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.5), row by row."""
    keyed, key = _keyed(docs)
    scored = quality_scores(keyed, table(spark, sf_dir, "labels"), row_col=key)
    return _of_rows(keyed, key, scored.where("predicted = 0").select("row"), "left_anti").drop(key)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a smaller document has; ``n_chars`` follows the text."""
    done = dedup_lines(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id (null after all others), of each group of near copies."""
    keyed, key = _keyed(docs)
    groups = near_duplicates(keyed, shingle=3, distance=2, seed=42, id_col=key).select("doc_id", "component_id").distinct()
    ids = keyed.select(F.col(key).alias("_of"), F.col("doc_id").alias("_id")).distinct()
    least = F.min(F.struct(F.col("_id").isNull(), "_id", "_of")).alias("least")
    first = groups.join(ids, groups["doc_id"] == ids["_of"]).groupBy("component_id").agg(least)
    return _of_rows(keyed, key, first.select("least._of"), "left_semi").dropDuplicates([key, "doc_id"]).drop(key)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, row by row."""
    keyed, key = _keyed(docs)
    found = contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
    return _of_rows(keyed, key, found.select("doc_id"), "left_anti").drop(key)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, with their ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_copies),
          ("benchmark decontamination", decontamination), ("packing", packing)]

#: Learned, tokenizing and hashing stages can't be expressed in SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = shared_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(out)
        docs = spark.read.parquet(out)
    return docs
