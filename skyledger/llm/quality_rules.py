"""Quality rules by weak supervision.

Every rule votes good (+1), bad (-1) or abstains (0) on a document's text
statistics.  How often each rule votes each way on good and on bad documents
is estimated by expectation-maximisation over all documents (a Dawid-Skene
model without labels), and the posterior probability of "good" replaces the
usual "all rules must pass".

Scale: one pass computes the statistics and votes without a shuffle.  EM runs
on the counts of distinct vote patterns, an aggregate with at most 3^R rows
whatever the number of documents (R = 9 rules: at most 19,683), so only that
bounded table reaches the driver.  The fitted log-odds return as a column
expression.

Defined results: a null or empty text has no words, all counts 0, fails the
base rule.  Rows are judged one by one: repeated rows and ids give repeated
results, other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, field, materialize, slices, text_of

WINDOW = 5  # words in a repeated window
MIN_WORDS = 10  # base rule: fewer words fail
MAX_REPEAT_PERCENT = 20  # base rule: more repeated words than this fail
_SLICE_BYTES = 8 << 20

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_PUNCT = b"!?"
# Frequent function words of English, German, French and Spanish.
_STOP_WORDS = frozenset(
    b"the of and to in a is that for with on as was are by this from at an be it or "
    b"der die das und den von zu mit ein eine im f\xc3\xbcr ist des auf dem nicht "
    b"le la les de des et un une du en est que pour dans pas au "
    b"el los las del y una por con para es se lo su al".split()
)
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)  # odd 64-bit constants, one per place in the window

_COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_marks", "n_stop_words", "n_distinct_words",
    "n_doubled_words",
)


def repeated_words(ids: np.ndarray) -> int:
    """Places of ``ids`` inside a window of five that occurs at least twice."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        keys = sum(ids[k : k + n] * _MULTIPLIERS[k] for k in range(WINDOW))
    in_order = np.sort(keys)
    same = in_order[1:] == in_order[:-1]
    if not same.any():
        return 0
    # Equal keys are only candidates; the windows themselves decide.
    places = np.flatnonzero(np.isin(keys, in_order[1:][same]))
    windows = list(zip(*(ids[places + k].tolist() for k in range(WINDOW)), strict=True))
    seen = Counter(windows)
    places = places[[seen[w] > 1 for w in windows]]
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(covered, places, 1)
    np.add.at(covered, places + WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def text_counts(text: bytes, vocabulary: defaultdict) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``_COUNTS``."""
    words = text.split()
    solid = text.translate(None, _SPACE)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    ids = np.fromiter((vocabulary[w] for w in words), dtype=np.uint64, count=len(words))
    letters = len(solid)
    return (
        len(words),
        len(solid.decode("utf-8", "replace")),
        letters - len(solid.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        letters - len(solid.translate(None, _UPPER)),
        letters - len(solid.translate(None, _LOWER)),
        letters - len(solid.translate(None, _PUNCT)),
        sum(map(_STOP_WORDS.__contains__, words)),
        len(set(words)),
        int((ids[1:] == ids[:-1]).sum()),
    )


def _count_stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, text) to (id, the counts of the text)."""
    for batch in slices(batches, 1, _SLICE_BYTES):
        vocabulary: defaultdict = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        rows = [text_counts(text, vocabulary) for text in byte_values(batch, 1)]
        arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, names=[batch.schema.names[0], *_COUNTS])


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and the counts of ``_COUNTS`` (bigint)."""
    schema = T.StructType(
        [field(docs, id_column), *(T.StructField(c, T.LongType()) for c in _COUNTS)]
    )
    pairs = docs.select(F.col(id_column), text_of(text_column).alias("text"))
    return pairs.mapInArrow(_count_stage, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        vote = F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)
        return vote.cast("int").alias(self.name)


# Documented parameters of the default rules.  All are ratios within a text.
RULES = (
    Rule("v_length", "n_words < 10", "n_words >= 30"),
    Rule("v_word_length", "word_chars > 14 * n_words or word_chars < 2 * n_words", "word_chars between 3 * n_words and 11 * n_words"),
    Rule("v_symbols", "2 * n_symbols > n_words", "20 * n_symbols <= n_words"),
    Rule("v_lines", "2 * n_dup_lines > n_lines", "10 * n_dup_lines <= n_lines and n_lines > 0"),
    Rule("v_repeats", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words and n_words >= 10"),
    Rule("v_case", "n_upper > n_lower and n_upper > 20", "5 * n_upper <= n_lower and n_lower > 0"),
    Rule("v_marks", "3 * n_marks > n_words", "10 * n_marks <= n_words and n_words > 0"),
    Rule("v_stop_words", "n_stop_words = 0 and n_words >= 40", "20 * n_stop_words >= n_words and n_words > 0"),
    Rule("v_variety", "4 * n_distinct_words < n_words and n_words < 400", "2 * n_distinct_words >= n_words and n_words >= 10"),
)


@dataclass(frozen=True)
class VoteModel:
    """Fitted votes: prior of good, and per rule the rate of each vote given the class."""

    rules: tuple[Rule, ...]
    prior_good: float
    rates: np.ndarray  # [rule, class (0 bad, 1 good), vote + 1]

    def log_odds(self) -> Column:
        """log P(good | votes) - log P(bad | votes), as one column expression."""
        total = F.lit(math.log(self.prior_good) - math.log(1 - self.prior_good))
        for j, rule in enumerate(self.rules):
            weight = np.log(self.rates[j, 1]) - np.log(self.rates[j, 0])
            vote = F.col(rule.name)
            total = total + F.when(vote == -1, float(weight[0])).when(
                vote == 0, float(weight[1])
            ).otherwise(float(weight[2]))
        return total

    def accuracies(self) -> dict[str, float]:
        """Of each rule, the estimated share of its votes that are right."""
        share = np.array([1 - self.prior_good, self.prior_good])
        right = self.rates[:, 0, 0] * share[0] + self.rates[:, 1, 2] * share[1]
        cast = right + self.rates[:, 0, 2] * share[0] + self.rates[:, 1, 0] * share[1]
        return {r.name: float(a / max(b, 1e-12)) for r, a, b in zip(self.rules, right, cast, strict=True)}


def fit_votes(
    patterns: np.ndarray, counts: np.ndarray, rules: tuple[Rule, ...], rounds: int = 200
) -> VoteModel:
    """EM over vote patterns (rows of -1, 0, 1) with their document counts.

    Starts from "a document with a bad vote is probably bad".  Each rule keeps
    a weak prior that its votes are better than chance, worth one document in
    a hundred, so that the two classes cannot swap their names.
    """
    n_rules = len(rules)
    if not len(patterns):
        return VoteModel(rules, 0.5, np.full((n_rules, 2, 3), 1 / 3))
    total = counts.sum()
    hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)  # [pattern, rule, vote]
    anchor = np.array([[[0.6, 0.3, 0.1], [0.1, 0.3, 0.6]]]) * max(1.0, 0.01 * total)
    n_bad = (patterns < 0).sum(1)
    good = np.where(n_bad == 0, 0.95, np.where(n_bad == 1, 0.4, 0.05))
    prior, rates = 0.5, np.zeros((n_rules, 2, 3))
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        rates = np.einsum("cp,pjv->jcv", weight, hot) + anchor
        rates /= rates.sum(2, keepdims=True)
        prior = float(np.clip((weight[1].sum() + 1) / (total + 2), 1e-3, 1 - 1e-3))
        logs = np.einsum("pjv,jcv->pc", hot, np.log(rates))
        odds = logs[:, 1] - logs[:, 0] + math.log(prior / (1 - prior))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        moved = float(np.abs(new - good).max())
        good = new
        if moved < 1e-9:
            break
    return VoteModel(rules, prior, rates)


def supervise(votes: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """Fit the votes of all documents.  Collects one row per vote pattern (at most 3^R)."""
    names = [r.name for r in rules]
    rows = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted(tuple(r) for r in rows)
    patterns = np.array([r[:-1] for r in rows], dtype=np.int64).reshape(len(rows), len(names))
    return fit_votes(patterns, np.array([r[-1] for r in rows], dtype=float), rules)


def judge_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """Per document: id, counts, votes, ``p_good``, ``base_failed`` and ``kept``.

    ``kept`` is false where the base rule fails, else whether the posterior
    probability of good reaches ``threshold``.
    """
    counts = text_statistics(docs, id_column, text_column)
    votes = materialize(counts.select("*", *(r.vote() for r in rules)), "votes")
    model = supervise(votes, rules)
    p_good = 1 / (1 + F.exp(-model.log_odds()))
    return (
        votes.withColumn("p_good", p_good)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
    )


def keep_good(docs: DataFrame, text_column: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, all columns unchanged."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_column).alias("text"))
    return judge_quality(rows, "row", "text", **parameters).filter("kept").select("row.*")
