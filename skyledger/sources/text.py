"""Text sources for the word count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DOCUMENTS_INPUT_SCHEMA
from .spread import spread_narrow


def read_text_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line of the text files, column ``text``."""
    return spread_narrow(spark.read.text(paths).select(F.col("value").alias("text")))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table, only its ``text`` column is read."""
    return spread_narrow(
        spark.read.schema(DOCUMENTS_INPUT_SCHEMA).parquet(f"{sf_dir}/documents.parquet")
    )
