"""The corpus pipeline: quality rules, near duplicates, repeated strings, benchmark text, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  All but the last return the columns of ``documents``; the
last returns the packed pieces.  ``run`` applies them in order, each stage
written to the shared checkpoint folder and read again by the next.

Null texts have no words and go with the first stage, as do all others that
fail its base rule.  Stages keep columns that they do not know.  An empty
table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, read_table
from skyledger.llm.jaccard_join import first_of_each_class
from skyledger.llm.packing import pack_documents
from skyledger.llm.quality_rules import keep_good
from skyledger.llm.queries import tokenizer_path
from skyledger.llm.suffix_dedup import without_repeats
from skyledger.llm.winnowing import clean_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return first_of_each_class(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that an earlier document, or part, has too."""
    kept = without_repeats(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no run of words with a benchmark item."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, packed into sequences."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), keep_encoder=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_text", benchmark_text),
    ("packed", packed),
]

# EM, connected components and token packing have no SQL form; tests/llm/ holds the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
