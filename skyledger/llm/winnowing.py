"""Benchmark decontamination by winnowing, with built-in functions only.

A document word is hit when it lies inside a run of ``window`` consecutive
words that some benchmark item has too (an item shorter than that is one run
by itself).  Each run of L words has L - k + 1 hashes of k words
(k = min(5, L)); its fingerprint is the smallest of them, so two equal runs
always have equal fingerprints: every shared span of L words is found.
Fingerprints of the benchmark are kept in a bit table of at most 8 MB, which
lets a document's run pass as a candidate; candidates are joined on
fingerprint and on the run's words themselves, and hits extend to the union
of the runs.  False candidates vanish in the join.

Scale: documents are read and split once; what leaves that pass is a row per
document with its (few) candidate runs.  The join's benchmark side has one
row per distinct run.  Hit runs are grouped per document.  A passage that a
third of all documents holds is many rows with one join key, which adaptive
execution splits, as no side needs a key's rows together.  The bit table is
full only for very large benchmarks (over a million distinct fingerprints);
then more runs are candidates, and results stay the same.

Defined results: a null text or item has no words and no hits; an item
without words matches nothing; a null item id makes hits but is in no list;
repeated rows give repeated results; other columns are ignored.  Empty
tables: no documents give no rows, no items give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import bit_table, let, power_of_two
from .common import materialize, text_of

WINDOW = 10  # words of a run
GRAM = 5  # words of a hash
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Lower-cased (A-Z) words: maximal runs of 0-9, a-z and non-ASCII characters."""
    parts = F.split(F.translate(text, _UPPER, _UPPER.lower()), _BREAKS)
    return F.filter(parts, lambda w: w != "")


def fingerprints(words: Column, length: int) -> Column:
    """array<bigint>: of every run of ``length`` words its smallest k-word hash."""
    gram = min(GRAM, length)
    per_run = length - gram + 1

    def grams(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - gram)
        return F.transform(
            starts, lambda i: F.xxhash64(F.lit(length), *(F.get(hashes, i + j) for j in range(gram)))
        )

    def smallest(keys: Column) -> Column:
        if per_run == 1:
            return keys
        starts = F.sequence(F.lit(0), F.size(keys) - per_run)
        return F.transform(starts, lambda i: F.least(*(F.get(keys, i + j) for j in range(per_run))))

    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) < length, none).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(grams(h), smallest))
    )


def _probes(key: Column, n_words: int) -> list[tuple[Column, Column]]:
    """The (word, bit) places of a fingerprint: two, from different bits of the hash."""
    one = F.lit(1).cast("bigint")
    places = []
    for shift in (0, 27):
        moved = F.shiftrightunsigned(key, shift)
        word = F.shiftrightunsigned(moved, 6).bitwiseAND(F.lit(n_words - 1)).cast("int")
        places.append((word, F.call_function("shiftleft", one, moved.bitwiseAND(F.lit(63)).cast("int"))))
    return places


def _run_text(words: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start + 1, F.lit(length)), " ")


def benchmark_runs(benchmark: DataFrame, item_column: str, text_column: str, window: int) -> DataFrame:
    """One row per distinct run: ``length``, ``fingerprint``, ``run`` (its words), ``items``."""
    items = benchmark.select(
        F.col(item_column).cast("string").alias("item"), word_list(text_of(text_column)).alias("words")
    ).filter(F.size("words") > 0)

    def runs_of(length: int) -> Column:
        def run(f: Column, i: Column) -> Column:
            words = _run_text(F.col("words"), i, length)
            return F.struct(F.lit(length).alias("length"), f.alias("fingerprint"), words.alias("run"))

        return F.transform(fingerprints(F.col("words"), length), run)

    runs = None
    for length in range(1, window + 1):
        fits = F.size("words") == length if length < window else F.size("words") >= length
        part = items.filter(fits).select("item", F.explode(runs_of(length)).alias("r")).select("item", "r.*")
        runs = part if runs is None else runs.unionByName(part)
    return runs.groupBy("length", "fingerprint", "run").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )


def _covered(spans: Column) -> Column:
    """Number of places in the union of sorted (start, length) spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total"))

    def add(seen: Column, span: Column) -> Column:
        end = F.greatest(seen["end"], span["start"] + span["length"])
        fresh = end - F.greatest(seen["end"], span["start"])
        return F.struct(end.alias("end"), (seen["total"] + fresh).alias("total"))

    return F.aggregate(spans, start, add, lambda seen: seen["total"])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per document: id, ``row_key`` (hash of its text), ``n_words``, ``n_hit``,
    ``spans`` (start, length of each hit run, in words), ``items`` (sorted ids as text)."""
    runs = materialize(benchmark_runs(benchmark, item_column, item_text_column, window), "runs")
    sizes = runs.groupBy("length").agg(F.countDistinct("fingerprint").alias("n")).collect()  # <= window rows
    lengths = sorted(r["length"] for r in sizes)
    n_words = power_of_two(sum(r["n"] for r in sizes))
    masks = [
        F.struct(word.alias("word"), mask.alias("mask")) for word, mask in _probes(F.col("fingerprint"), n_words)
    ]
    table = bit_table(runs.select(F.explode(F.array(*masks)).alias("m")).select("m.*"), n_words)
    bits = materialize(table, "bits").scalar()

    def candidates(table: Column, words: Column, length: int) -> Column:
        def listed(f: Column) -> Column:
            tests = [F.get(table, w).bitwiseAND(m) != 0 for w, m in _probes(f, n_words)]
            return tests[0] & tests[1]

        def run(f: Column, i: Column) -> Column:
            return F.struct(i.alias("start"), F.lit(length).alias("length"), f.alias("fingerprint"))

        found = F.filter(F.transform(fingerprints(words, length), run), lambda r: listed(r["fingerprint"]))
        return F.transform(found, lambda r: r.withField("run", _run_text(words, r["start"], length)))

    none = F.array().cast("array<struct<start:int,length:int,fingerprint:bigint,run:string>>")

    def judged(table: Column, words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.concat(none, *(candidates(table, words, n) for n in lengths)).alias("candidates"),
        )

    # One reference to the table's column: the optimiser puts the subquery in its place, so that no
    # row carries the table.
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"), bits.alias("bits"))
    scanned = rows.select(
        "id",
        F.xxhash64("text").alias("row_key"),
        let(F.col("bits"), lambda t: let(word_list(F.col("text")), lambda w: judged(t, w))).alias("x"),
    ).select("id", "row_key", "x.*")
    scanned = materialize(scanned, "scanned")

    found = scanned.select("id", "row_key", F.explode("candidates").alias("c")).select("id", "row_key", "c.*")
    hits = (
        found.join(runs, ["length", "fingerprint", "run"])
        .groupBy("id", "row_key")
        .agg(
            F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select(F.col("id").alias("hit_id"), F.col("row_key").alias("hit_key"), "spans", "items")
    )
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("row_key") == F.col("hit_key"))
    no_spans = F.array().cast("array<struct<start:int,length:int>>")
    return scanned.join(hits, same, "left").select(
        F.col("id").alias(id_column),
        "row_key",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("spans", no_spans).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` without a hit, all their columns unchanged."""
    id_column, text_column = columns.get("id_column", "doc_id"), columns.get("text_column", "text")
    hit = decontaminate(docs, benchmark, **columns).filter("n_hit > 0")
    hit = hit.select(F.col(id_column).alias("_hit_id"), F.col("row_key").alias("_hit_key")).distinct()
    # The caller's columns travel in a struct, so that none of their names can clash.
    given = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_column).alias("id"),
        F.xxhash64(text_of(text_column)).alias("own_key"),
    )
    same = F.col("id").eqNullSafe(F.col("_hit_id")) & (F.col("own_key") == F.col("_hit_key"))
    return given.join(hit, same, "left_anti").select("row.*")
