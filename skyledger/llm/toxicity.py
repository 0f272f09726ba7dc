"""Toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary labelled documents each give a model of lower-cased words
as byte sequences: the probability of every byte (and of the word's end) after
the up to seven bytes before it in the word.  A class's counts are discounted,
and what the discount frees is spread by a Kneser-Ney model whose counts both
classes share (continuation counts below the longest context), so expressions
that are rare in a class are judged alike by both.  A word's evidence is the
difference of its two log-likelihoods.  Differences up to a margin are what
two samples of ordinary language show anyway and count as none; a document's
statistic is the sum of the evidence above the margin over its length.  A
logistic curve, and the margin, are fitted crosswise: the labelled rows are
halved, and each half's evidence comes from models of the other half; the
final models learn from both halves.

Scale.  Models and curve are fitted on a bounded sample of labelled rows (at
most ``FIT_ROWS`` expected rows per class and half, drawn by a hash of the id).  Their n-grams are counted by Spark, and only the distinct ones of
that bounded sample reach the driver; the finished tables travel to the tasks.
All documents are then scored in one pass without a shuffle; the evidence of a
word is worked out once per slice of texts, in arrays.

Defined results: a null or empty text has no evidence and the curve's score
there.  A document labelled more than once is toxic if any label says so;
labels without id or class are not used.  Repeated rows give repeated results,
other columns are ignored.  Without labels of both classes every score is the
share of toxic labels (0.5 if there is none).  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, field, materialize, slices, text_of

ORDER = 7  # bytes of context; a cell is a context and the byte after it
DISCOUNT = 0.75  # of the shared model
CLASS_DISCOUNT = 3.0  # of a class's counts
FIT_ROWS = 1000  # labelled rows per class and half that models and curve are fitted on
MARGINS = (1.0, 2.0, 3.0)  # nats of evidence that count as none; the best is taken
STEADY = 10  # words added to a document's length, so that one word does not decide alone
_BUCKETS = 1 << 20
_SLICE_BYTES = 8 << 20
_END = 0x20  # ends a word; before a word's first byte there are zeros


def text_words(texts: list[bytes]) -> list[list[bytes]]:
    return [t.decode("utf-8", "replace").lower().encode().split() for t in texts]


def word_cells(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All cells of the words, one after the other, and their number per word."""
    pad, end = bytes(ORDER), bytes([_END])
    sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(pad + w + end for w in words), dtype=np.uint8)
    starts = np.cumsum(sizes + ORDER) - sizes
    here = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    here += np.arange(len(here))
    cells = data[here].astype(np.uint64)
    for k in range(1, ORDER + 1):  # the nearest byte of the context comes first
        cells |= data[here - k].astype(np.uint64) << np.uint64(8 * (ORDER + 1 - k))
    return cells, sizes


def _shorter(cells: np.ndarray) -> np.ndarray:
    """The cells with one context byte less."""
    return (cells >> np.uint64(16) << np.uint64(8)) | (cells & np.uint64(255))


@dataclass(frozen=True)
class Contrast:
    """log P(byte | context, toxic) - log P(byte | context, ordinary)."""

    cells: np.ndarray  # seen by either class, sorted
    difference: np.ndarray
    contexts: np.ndarray  # sorted
    backoff: np.ndarray  # difference for a byte that neither class saw in the context

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """The evidence of each word."""
        if not words:
            return np.zeros(0)
        cells, sizes = word_cells(words)
        seen, value = _find(self.cells, self.difference, cells)
        value = np.where(seen, value, 0.0)
        known, weight = _find(self.contexts, self.backoff, cells[~seen] >> np.uint64(8))
        value[~seen] = np.where(known, weight, 0.0)
        return np.add.reduceat(value, np.cumsum(sizes) - sizes)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys) or not len(wanted):
        return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, values[at]


class _Contexts:
    """The contexts of sorted cells: where each begins, and the context of each cell."""

    def __init__(self, cells: np.ndarray):
        context = cells >> np.uint64(8)
        new = np.ones(len(cells), dtype=bool)
        new[1:] = context[1:] != context[:-1]
        self.first = np.flatnonzero(new)
        self.of_cell = np.cumsum(new) - 1
        self.values = context[self.first]

    def sums(self, counts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(counts.astype(float), self.first) if len(self.first) else np.zeros(0)


def shared_model(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney probability of each (sorted, distinct) cell."""
    levels = [(cells, counts)]
    for _ in range(ORDER):  # continuation counts: how many longer cells end in this one
        found, n = np.unique(_shorter(levels[-1][0]), return_counts=True)
        levels.append((found, n))
    below = None
    for found, n in reversed(levels):
        contexts = _Contexts(found)
        total, kinds = contexts.sums(n)[contexts.of_cell], contexts.sums(n > 0)[contexts.of_cell]
        lower = np.full(len(found), 1 / 257) if below is None else below[1][np.searchsorted(below[0], _shorter(found))]
        below = (found, (np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds * lower) / total)
    return below[1]


def fit_contrast(cells: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Contrast:
    """The two models from the class counts of sorted distinct cells."""
    shared = shared_model(cells, toxic + ordinary)
    contexts = _Contexts(cells)
    chances, weights = [], []
    for n in (toxic, ordinary):
        total = contexts.sums(n)
        freed = contexts.sums(np.minimum(n, CLASS_DISCOUNT))
        weight = np.where(total > 0, freed / np.maximum(total, 1), 1.0)
        kept = np.maximum(n - CLASS_DISCOUNT, 0) / np.maximum(total, 1)[contexts.of_cell]
        chances.append(kept + weight[contexts.of_cell] * shared)
        weights.append(weight)
    difference, backoff = (np.log(a) - np.log(b) for a, b in (chances, weights))
    return Contrast(cells, difference.astype(np.float32), contexts.values, backoff.astype(np.float32))


def _share(n: int, bound: int) -> int:
    """Hash buckets out of ``_BUCKETS`` that hold about ``bound`` of ``n`` rows."""
    return _BUCKETS if n <= bound else int(_BUCKETS * bound / n)


def _samples(labels: DataFrame, id_column: str, label_column: str) -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample of the labelled ids: (id, ``toxic``, ``half``); rows of each class."""
    rows = (
        labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1))
        .groupBy(F.col(id_column).alias("label_id"))
        .agg(F.max(label_column).cast("int").alias("toxic"))
        .withColumn("half", F.pmod(F.xxhash64("label_id", F.lit("half")), F.lit(2)).cast("int"))
        .withColumn("place", F.pmod(F.xxhash64("label_id"), F.lit(_BUCKETS)))
    )
    rows = materialize(rows, "labelled")
    counts = {(r["toxic"], r["half"]): r["n"] for r in rows.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    keep = F.lit(False)
    for (toxic, half), n in counts.items():
        inside = F.col("place") < _share(n, FIT_ROWS)
        keep = keep | ((F.col("toxic") == toxic) & (F.col("half") == half) & inside)
    sample = rows.filter(keep).select("label_id", "toxic", "half")
    return sample, {k: sum(n for (t, _), n in counts.items() if t == k) for k in (0, 1)}


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1, _SLICE_BYTES):
        counts = {(half, toxic): Counter() for half in (0, 1) for toxic in (0, 1)}
        rows = (batch.column(2).to_pylist(), batch.column(0).to_pylist(), text_words(byte_values(batch, 1)))
        for half, toxic, words in zip(*rows, strict=True):
            counts[half, toxic].update(words)
        for half in (0, 1):
            words = list(counts[half, 0].keys() | counts[half, 1].keys())
            if not words:
                continue
            cells, sizes = word_cells(words)
            found, which = np.unique(cells, return_inverse=True)
            arrays = [pa.array(found.view(np.int64)), pa.array([half] * len(found), pa.int32())]
            for toxic in (1, 0):
                times = np.repeat(np.array([counts[half, toxic][w] for w in words], dtype=np.int64), sizes)
                arrays.append(pa.array(np.bincount(which, times, len(found)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(arrays, names=["cell", "half", "toxic", "ordinary"])


def _statistics(contrast: Contrast, names: list[str]) -> Callable:
    """Evidence above each margin, and the number of words, of every text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, _SLICE_BYTES):
            texts = text_words(byte_values(batch, 1))
            distinct = list(set().union(*texts))
            number = dict(zip(distinct, range(len(distinct)), strict=True))
            evidence = contrast.of_words(distinct)
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            ids = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
            text_of_word = np.repeat(np.arange(len(texts)), sizes)
            arrays = [batch.column(0), pa.array(sizes)]
            for margin in MARGINS:
                above = np.maximum(evidence - margin, 0)[ids]
                arrays.append(pa.array(np.bincount(text_of_word, above, len(texts)).astype(np.float64)))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return score


@dataclass(frozen=True)
class Curve:
    """score = 1 / (1 + exp(-(slope * evidence / (n_words + STEADY) + base)))"""

    slope: float
    base: float
    margin: int  # which of MARGINS

    def column(self) -> Column:
        rate = F.col(f"above{self.margin}") / (F.col("n_words") + STEADY)
        return 1 / (1 + F.exp(-(rate * self.slope + self.base)))


def fit_curve(above: list[np.ndarray], n_words: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Curve:
    """Logistic regression on the length-normalised evidence, for the best margin."""
    best = None
    for margin, evidence in enumerate(above):
        x = evidence / (n_words + STEADY)
        scale = float(np.std(x)) or 1.0
        design = np.stack([x / scale, np.ones(len(x))], axis=1)
        beta = np.zeros(2)
        ridge = np.diag([1e-3, 1e-6]) * weight.sum()
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            slope = design.T @ (weight * (label - p)) - ridge @ beta
            bend = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + ridge
            step = np.clip(np.linalg.solve(bend, slope), -2, 2)
            beta += step
            if np.abs(step).max() < 1e-9:
                break
        p = np.clip(1 / (1 + np.exp(-np.clip(design @ beta, -30, 30))), 1e-9, 1 - 1e-9)
        loss = -float((weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum())
        if best is None or loss < best[0]:
            best = (loss, Curve(float(beta[0] / scale), float(beta[1]), margin))
    return best[1]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> DataFrame:
    """Per document: id, ``n_words``, ``above0``... (evidence above each of MARGINS), ``score``.

    ``labels`` has an id of the same name and the label; only its rows where
    ``learn`` holds are used.
    """
    sample, rows = _samples(labels.filter(learn), id_column, label_column)
    pairs = docs.select(F.col(id_column), text_of(text_column).alias("text"))
    # The sample's size is bounded by FIT_ROWS.
    labelled = pairs.join(F.broadcast(sample), F.col(id_column) == F.col("label_id"))
    labelled = materialize(labelled.select("toxic", "text", "half"), "sample")

    cells = labelled.select("toxic", "text", "half").mapInArrow(
        _count_cells, "cell bigint, half int, toxic bigint, ordinary bigint"
    )
    counted = cells.groupBy("cell", "half").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    table = counted.toArrow()

    def contrast_of(rows: pa.Table) -> Contrast:
        keys = rows.column("cell").to_numpy().view(np.uint64)
        cells, which = np.unique(keys, return_inverse=True)
        counts = (np.bincount(which, rows.column(c).to_numpy(), len(cells)) for c in ("toxic", "ordinary"))
        return fit_contrast(cells, *counts)

    contrast = contrast_of(table)
    parts = T.StructType([T.StructField("toxic", T.IntegerType())])
    statistic = T.StructType([field(docs, id_column)])
    for schema in (parts, statistic):
        schema.add("n_words", T.LongType())
        for k in range(len(MARGINS)):
            schema.add(f"above{k}", T.DoubleType())
    held = []
    for half in (0, 1):
        other = contrast_of(table.filter(pa.compute.equal(table.column("half"), 1 - half)))
        judged = labelled.filter(F.col("half") == half).select("toxic", "text")
        held.append(judged.mapInArrow(_statistics(other, parts.names), parts))
    held = held[0].unionByName(held[1]).toPandas()  # bounded by FIT_ROWS
    share = rows[1] / (rows[0] + rows[1]) if sum(rows.values()) else 0.5
    label = held["toxic"].to_numpy(dtype=float)
    if rows[0] and rows[1] and 0 < label.sum() < len(label):
        seen = label.mean()
        weight = np.where(label == 1, share / seen, (1 - share) / (1 - seen))
        above = [held[f"above{k}"].to_numpy() for k in range(len(MARGINS))]
        curve = fit_curve(above, held["n_words"].to_numpy(), label, weight)
    else:
        limit = min(max(share, 1e-6), 1 - 1e-6)
        curve = Curve(0.0, float(np.log(limit / (1 - limit))), 0)
    scored = pairs.mapInArrow(_statistics(contrast, statistic.names), statistic)
    return scored.withColumn("score", curve.column())
