"""URL filter: a blocked Bloom filter before an exact join with the listed URLs.

A listed URL is a canonical host and a path prefix.  It fits a page whose
host is that host or a subdomain and whose path starts with that prefix; the
longest listed URL that fits decides.  A page's candidates are its host's
suffixes of as many labels, with its path's prefixes of as many characters, as
occur in the list.  Every candidate is probed in a blocked Bloom filter (one block of 512
bits per candidate, four bits in it); the few that pass are joined exactly
with the list, which removes false positives.

Scale: the filter has a fixed bound of 8 MB, so it may travel to every task;
the list itself is joined, not broadcast by hand.  Only candidates that pass
the filter are shuffled.

Defined results: a null URL, or one without "://", has empty host and path
and no rule.  A host or path may be of any length: only so many suffixes and
prefixes of it are formed as the list has label counts and path lengths.  Repeated rows give repeated results.  A listed URL given twice
counts once (block before allow).  Other columns are ignored.  An empty list
gives the default verdict for every page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import bit_table, let, power_of_two
from .common import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK_WORDS = 8  # 512 bits, one cache line
BITS_PER_URL = 4
DEFAULT_VERDICT = "allow"  # of a page that no listed URL fits

# The listed URLs of the registered query (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def _rest(url: Column) -> Column:
    """What follows the first '://', or empty."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _block_and_bits(host: Column, path: Column, n_words: int) -> list[tuple[Column, Column]]:
    """(word, mask) of the bits of a URL: all in one block of eight words."""
    key = F.xxhash64(host, path)
    block = F.pmod(key, F.lit(n_words // BLOCK_WORDS)) * BLOCK_WORDS
    spread = F.xxhash64(key, F.lit(1))
    places = []
    for k in range(BITS_PER_URL):
        place = F.shiftrightunsigned(spread, 9 * k).bitwiseAND(F.lit(511))
        word = (block + F.shiftrightunsigned(place, 6)).cast("int")
        bit = place.bitwiseAND(F.lit(63)).cast("int")
        places.append((word, F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)))
    return places


def bloom_filter(listed: DataFrame) -> tuple[DataFrame, int]:
    """The filter of (``rule_host``, ``rule_path``) rows: one row ``bits``, and its number of words."""
    n_words = power_of_two(listed.count())  # 64 bits a URL
    places = [
        F.struct(w.alias("word"), m.alias("mask"))
        for w, m in _block_and_bits(F.col("rule_host"), F.col("rule_path"), n_words)
    ]
    return bit_table(listed.select(F.explode(F.array(*places)).alias("p")).select("p.*"), n_words), n_words


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default_verdict: str = DEFAULT_VERDICT,
) -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule`` (the listed URL that decides, or null), ``verdict``.

    ``listed`` has string columns host, path and verdict (allow or block).
    """
    listed = listed.groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).agg(
        F.max("verdict").alias("rule_verdict")
    )
    listed = materialize(listed, "listed")
    table, n_words = bloom_filter(listed)
    bits = materialize(table, "bloom").scalar()
    lengths = listed.agg(F.sort_array(F.collect_set(F.length("rule_path"))).alias("n")).scalar()
    labels = listed.agg(F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("n")).scalar()

    def suffixes(host: Column, counts: Column) -> Column:
        def joined(own: Column) -> Column:
            fitting = F.filter(counts, lambda n: n <= F.size(own))
            return F.transform(fitting, lambda n: F.array_join(F.slice(own, F.size(own) - n + 1, n), "."))

        return let(F.split(host, r"\."), joined)

    def keys(host: Column, path: Column, lengths: Column, counts: Column) -> Column:
        fitting = F.filter(lengths, lambda n: n <= F.length(path))
        prefixes = F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))
        return let(
            prefixes,
            lambda ps: F.flatten(
                F.transform(
                    suffixes(host, counts),
                    lambda h: F.transform(ps, lambda p: F.struct(h.alias("host"), p.alias("path"))),
                )
            ),
        )

    def passes(table: Column, key: Column) -> Column:
        test = F.lit(True)
        for word, mask in _block_and_bits(key["host"], key["path"], n_words):
            test = test & (F.get(table, word).bitwiseAND(mask) != 0)
        return test

    url = F.coalesce(F.col(url_column), F.lit(""))
    split_urls = pages.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    candidates = keys(F.col("host"), F.col("path"), F.col("lengths"), F.col("labels"))
    possible = let(F.col("bits"), lambda t: F.filter(candidates, lambda k: passes(t, k)))
    found = (
        split_urls.select("host", "path")
        .distinct()
        .select("host", "path", bits.alias("bits"), lengths.alias("lengths"), labels.alias("labels"))
        .select("host", "path", F.explode(possible).alias("key"))
        .join(
            listed,
            (F.col("key.host") == F.col("rule_host")) & (F.col("key.path") == F.col("rule_path")),
        )
        .withColumn("rule", F.concat("rule_host", "rule_path"))
        .groupBy(F.col("host").alias("fit_host"), F.col("path").alias("fit_path"))
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best"))
    )
    same = (F.col("host") == F.col("fit_host")) & (F.col("path") == F.col("fit_path"))
    return split_urls.join(found, same, "left").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default_verdict)).alias("verdict"),
    )
