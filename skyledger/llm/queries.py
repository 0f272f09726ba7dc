"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .common import id_remainder, read_table, text_of
from .jaccard_join import join_similar
from .line_dedup import MIN_CHARS, kept_text, mark_lines
from .merkle import as_hex, ascii_lower, fold, leaves_of, merkle_manifest, proof_digest
from .packing import pack_documents
from .ppm import score_documents
from .quality_rules import judge_quality
from .rule_ensemble import score_quality
from .suffix_dedup import remove_repeats
from .token_counts import Vocabulary, count_tokens
from .toxicity import score_toxicity
from .url_filter import RULES, judge_urls
from .whitening import whiten
from .winnowing import decontaminate


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return pack_documents(documents, tokenizer_path("word_bpe_49k.json"))


def op2_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = score_quality(documents, labels, learn=id_remainder("doc_id", 3) != 1)
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = remove_repeats(documents)
    kept = F.octet_length("kept").cast("bigint")
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - kept).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_similar(read_table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "n_shingles")


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 7) == 2
    scored = score_documents(read_table(spark, sf_dir, "documents"), train=~held_out)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.from_sentencepiece(tokenizer_path("piece_bpe_32k.model"))
    return count_tokens(read_table(spark, sf_dir, "documents"), vocabulary)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(read_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good",
    )


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = decontaminate(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(read_table(spark, sf_dir, "pages"), listed)


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = score_toxicity(documents, labels, learn=id_remainder("doc_id", 5) != 0)
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op11_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    marked = mark_lines(documents, F.struct("doc_id", "text"), "doc_id", "text", MIN_CHARS)
    text = F.col("carried")["text"]
    kept = F.when(F.col("n_dropped") == 0, text_of(text)).otherwise(kept_text(text, F.col("keep")))
    return marked.select(
        F.col("carried")["doc_id"].alias("doc_id"),
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.col("n_dropped").cast("bigint").alias("n_dropped"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    tampered = F.col("doc_id").isNotNull() & (id_remainder("doc_id", 3) == 0)
    proven = merkle_manifest(leaves_of(documents, tampered, ascii_lower(F.col("text"))))
    folded = proven.withColumn("folded_root", as_hex(fold(F.col("presented"), F.col("path"))))
    return folded.select(
        F.col("id").alias("doc_id"),
        as_hex(F.col("digest")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        as_hex(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == as_hex(F.col("root"))).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_rule_ensemble": op2_rule_ensemble,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_ppm": op5_ppm,
    "op6_token_counts": op6_token_counts,
    "op7_quality_rules": op7_quality_rules,
    "op8_winnowing": op8_winnowing,
    "op9_url_filter": op9_url_filter,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_cholesky_whitening": op11_cholesky_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

# DuckDB SQL with the same rows, where SQL can express the query.
ORACLE_SQL: dict[str, str] = {
    "op8_winnowing": oracle.WINNOWING,
    "op9_url_filter": oracle.URL_FILTER,
    "op12_line_dedup": oracle.LINE_DEDUP,
    "op13_merkle_manifest": oracle.MERKLE,
}
