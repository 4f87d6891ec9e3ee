"""File sources: a folder of one-table-per-file (or per-directory) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIXTURE_TABLES = ("region nation customer supplier part orders lineitem events documents "
                  "embeddings pages benchmark labels conversations").split()


def table_path(root: str, name: str, fmt: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{name}.{fmt}"


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(table_path(root, name, fmt))
