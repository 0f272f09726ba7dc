"""Clashing column names, very long inputs and the release of intermediate tables."""

import os
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import common
from skyledger.llm import suffix_dedup as S
from skyledger.llm.jaccard_join import first_of_each_class
from skyledger.llm.suffix_dedup import remove_repeats, without_repeats
from skyledger.llm.url_filter import judge_urls
from skyledger.llm.winnowing import clean_documents
from skyledger.session import checkpoint_path

SF = "/root/testdata/sf0.001"
CLASHING = (
    "row_key", "keep_id", "_hit_id", "_hit_key", "_id", "_text", "_chunk", "_row", "kept", "spans", "n_bytes",
    "label_id", "id", "row", "own_key", "node", "n_words", "votes", "length", "x", "bits",
)


def clash(docs):
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_whatever_their_names(spark, stage):
    name, run = corpus_pipeline.STAGES[stage]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = run(spark, clash(docs), SF)
    assert found.columns == [*docs.columns, *CLASHING], name
    plain = {(r["doc_id"], r["text"]) for r in run(spark, docs, SF).collect()}
    rows = found.collect()
    assert {(r["doc_id"], r["text"]) for r in rows} == plain and len(rows) == len(plain)
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)


def test_packing_takes_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    name, run = corpus_pipeline.STAGES[4]
    assert {r["doc_id"] for r in run(spark, clash(docs), SF).collect()} == {r["doc_id"] for r in docs.collect()}


def test_results_take_the_place_of_columns_with_their_names(spark, docs_of):
    docs = clash(docs_of(["abc " * 60, "abc " * 60, ""]))
    found = remove_repeats(docs)
    assert sorted(found.columns) == sorted(set(docs.columns) - {"text"})
    assert [r["n_bytes"] for r in found.orderBy("doc_id").collect()] == [240, 240, 0]


def test_of_equal_rows_the_first_as_json_stays(spark):
    text = "one two three four five six seven"
    rows = [(1, text, c) for c in "cab"] + [(2, text, "z"), (None, "", "b"), (None, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, other string")
    kept = sorted(((r["doc_id"], r["other"]) for r in first_of_each_class(docs).collect()), key=repr)
    assert (1, "a") in kept and all(k != (2, "z") for k in kept)
    assert clean_documents(clash(docs), docs.select(F.lit(1).alias("item_id"), F.lit("x y").alias("text"))).count() == 6


def test_dealt_tables_are_bounded_shared_and_released(spark, docs_of, monkeypatch):
    monkeypatch.setattr(common, "MAX_BUCKETS", 16)
    monkeypatch.setattr(S, "SMALLEST_CHUNK", 1)
    monkeypatch.setattr(S, "LARGEST_CHUNK", 1)
    texts = [f"{k % 30} " + "passage of words that repeats " * (40 + k % 30) for k in range(120)]
    plan = S.Plan(sum(map(len, texts)), 100)
    assert plan.n_chunks > 150_000
    common.release(spark)
    folder = checkpoint_path(spark, "llm").removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    stored = set(os.listdir(warehouse)) if os.path.isdir(warehouse) else set()
    cut = {r["doc_id"]: r["text"] for r in without_repeats(docs_of(texts)).collect()}
    monkeypatch.setattr(S, "LARGEST_CHUNK", 1 << 25)
    monkeypatch.setattr(S, "SMALLEST_CHUNK", 1 << 25)
    whole = {r["doc_id"]: r["text"] for r in without_repeats(docs_of(texts)).collect()}
    assert cut == whole
    assert (set(os.listdir(warehouse)) if os.path.isdir(warehouse) else set()) == stored
    assert set(os.listdir(folder)) > before
    common.release(spark)
    assert set(os.listdir(folder)) == before
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("skyledger_parts_")]


def test_url_filter_takes_very_long_hosts_and_paths(spark):
    long = ".".join(["a"] * 100_000)
    urls = [f"http://{long}.example.org/es/x", f"http://{long}/fr/", "https://b.example.org/" + "p/" * 100_000, "//"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    listed = spark.createDataFrame(
        [("org", "/", "allow"), ("example.org", "/es/", "block"), ("x.example.org", "/", "block")],
        "host string, path string, verdict string",
    )
    began = time.time()
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(pages, listed).collect()}
    assert found == {0: ("example.org/es/", "block"), 1: (None, "allow"), 2: ("org/", "allow"), 3: (None, "allow")}
    assert time.time() - began < 60
