"""Line dedup: lines that an earlier document has too are marked in keep bitmaps.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased.  Only keys of at least ``min_chars`` code points count.  Their
128-bit hashes are dealt by ranges and sorted by hash, document and position;
going through them in that order, the first row of a hash names the document
that keeps its lines, and every row of another document is a dropped line.  The
dropped positions of a document come back as its keep bitmap in compressed
form, the runs (start, length) of lines that stay; no text moves for that.

Built-in functions only.  Hashes are two seeded 64-bit hashes; among 10^13
different lines the chance that any two agree in both is below 10^-12.

Scale.  The hash rows are written once (32 bytes a line, before compression).
A hash that many lines share would be one long run in one task, so hashes with
at least 1 / (4 x partitions) of all rows are set apart: there are at most 4 x
partitions of them, however many rows come in, which bounds the table of their
first documents that is broadcast.  They are found exactly, by counts of hash
buckets and then counts of the hashes in buckets that are full enough; both
are combined before the shuffle.  What is left is in runs well below a
partition.

Defined results.  A null or empty text is one empty line.  Rows with the same
id are one document: each is split on its own, and none loses a line to the
other.  A null id is a document of its own, before all others.  A text of any
length is split whole; a key is as long as its line.  Ties do not arise, as a
document is first or not.  Other columns are ignored by ``keep_bitmaps`` and
unchanged in ``drop_lines``.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bits import let
from .common import materialize, text_of

MIN_CHARS = 10
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEED = 7  # of the second hash
_BUCKETS_A_PART = 64
_HOT_A_PART = 4


def lines_of(text: Column) -> Column:
    return F.split(text_of(text), "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped, A-Z lower-cased; a line of one byte a character takes the quicker way."""
    stripped = F.btrim(line, F.lit(_SPACE))
    plain = F.octet_length(line) == F.char_length(line)
    return F.when(plain, F.lower(stripped)).otherwise(F.translate(stripped, _UPPER, _LOWER))


def hash_rows(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """(``h1``, ``h2``, ``id``, ``row_key``, ``at``): a row for each line whose key counts.

    ``row_key`` tells rows of equal id apart by their texts.
    """
    text = text_of(F.col(text_column))
    lines = docs.select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("row_key"), F.posexplode(lines_of(text)).alias("at", "line")
    )
    keys = lines.filter(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return keys.filter(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(_SEED), "key").alias("h2"), "id", "row_key", "at"
    )


def hot_hashes(rows: DataFrame, parts: int) -> DataFrame:
    """(``h1``, ``h2``, ``first``): hashes with at least 1 / (4 x ``parts``) of all ``rows`` and their
    first document; at most 4 x ``parts`` of them."""
    bucket = F.pmod(F.col("h1"), F.lit(parts * _BUCKETS_A_PART))
    counts = materialize(rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")), "buckets")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(2, total // (parts * _HOT_A_PART))
    full = F.broadcast(counts.filter(F.col("n") >= least).select("bucket"))  # at most 4 x parts buckets
    exact = rows.withColumn("bucket", bucket).join(full, "bucket", "left_semi").groupBy("h1", "h2")
    found = exact.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id")).alias("first"))
    return materialize(found.filter(F.col("n") >= least).drop("n"), "hot")


def dropped_lines(rows: DataFrame) -> DataFrame:
    """(``id``, ``row_key``, ``at``) of the lines that an earlier document has."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_hashes(rows, parts)
    marked = rows.join(F.broadcast(hot), ["h1", "h2"], "left")
    later = F.struct("id") > F.col("first")  # structs of one field: a null id is the least
    by_hand = marked.filter(F.col("first").isNotNull() & later).select("id", "row_key", "at")

    cold = marked.filter(F.col("first").isNull()).drop("first").repartitionByRange(parts, "h1", "h2")
    in_order = Window.partitionBy("h1", "h2").orderBy(F.col("id").asc_nulls_first(), "at")
    streamed = cold.withColumn("first", F.first(F.struct("id")).over(in_order))
    return by_hand.unionByName(streamed.filter(later).select("id", "row_key", "at"))


def kept_runs(dropped: Column, n_lines: Column) -> Column:
    """The keep bitmap as runs (``start``, ``length``) from the sorted positions of dropped lines."""
    before, behind = F.concat(F.array(F.lit(-1)), dropped), F.concat(dropped, F.array(n_lines))

    def run(gap: Column) -> Column:
        start = gap["before"] + 1
        return F.struct(start.alias("start"), (gap["behind"] - start).alias("length"))

    gaps = F.arrays_zip(before.alias("before"), behind.alias("behind"))
    return F.filter(F.transform(gaps, run), lambda r: r["length"] > 0)


def mark_lines(docs: DataFrame, carried: Column, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """(``carried``, ``n_lines``, ``n_dropped``, ``keep``) for every row of ``docs``."""
    rows = materialize(hash_rows(docs, id_column, text_column, min_chars), "line_hashes")
    gone = dropped_lines(rows).groupBy("id", "row_key").agg(F.array_sort(F.collect_set("at")).alias("gone"))
    gone = gone.select(F.col("id").alias("gone_id"), F.col("row_key").alias("gone_key"), "gone")
    given = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text_of(text_column)).alias("row_key"),
        F.size(lines_of(F.col(text_column))).alias("n_lines"),
        carried.alias("carried"),
    )
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("row_key") == F.col("gone_key"))
    # The bitmaps are small and the rows may hold texts: only the bitmaps go into a hash table, no text is sorted.
    joined = given.join(gone.hint("shuffle_hash"), same, "left")
    dropped = F.coalesce("gone", F.array().cast("array<int>"))
    return joined.select(
        "carried", "n_lines", F.size(dropped).alias("n_dropped"), kept_runs(dropped, F.col("n_lines")).alias("keep")
    )


def keep_bitmaps(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """Per document: its id, ``n_lines``, ``n_dropped`` and ``keep``, the runs of lines that stay."""
    marked = mark_lines(docs, F.col(id_column), id_column, text_column, min_chars)
    return marked.withColumnRenamed("carried", id_column)


def kept_text(text: Column, keep: Column) -> Column:
    """The lines in the runs ``keep``, joined by line ends."""

    def taken(lines: Column) -> Column:
        return F.flatten(F.transform(keep, lambda run: F.slice(lines, run["start"] + 1, run["length"])))

    return let(lines_of(text), lambda lines: F.array_join(taken(lines), "\n"))


def drop_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """The rows of ``docs`` without the dropped lines, all other columns unchanged."""
    marked = mark_lines(docs, F.struct(*docs.columns), id_column, text_column, min_chars)
    text = F.when(F.col("n_dropped") == 0, F.col("carried")[text_column]).otherwise(
        kept_text(F.col("carried")[text_column], F.col("keep"))
    )
    return marked.select(
        *[(text if c == text_column else F.col("carried")[c]).alias(c) for c in docs.columns]
    )
