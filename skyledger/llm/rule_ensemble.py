"""Quality classifier: a sparse ensemble of rules.

A random forest of shallow trees is grown on statistics of the texts.  Every
path from a root to a node is a conjunction of threshold tests, a rule; the
distinct rules become 0/1 features of a logistic regression with an L1
penalty, which drops most of them.  The rules that keep a weight are compiled
into one Spark column expression, so that scoring all documents is a plain
projection over their statistics.

Scale.  The statistics of all documents are worked out in one pass without a
shuffle and kept in the checkpoint folder.  Forest and regression are fitted
by Spark on the labelled rows' statistics (a few numbers a row, no texts), so
no sample is needed; only trees and weights reach the driver, bounded by
``TREES`` * 2^``DEPTH``.

Defined results: a null or empty text has all statistics 0 and the score of
such a row.  A document labelled more than once is good only if all its labels
say so; labels without id or class are not used.  Repeated rows give repeated
results, other columns are ignored.  Without labels of both classes every
score is the share of good labels (0.5 if there is none).  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .quality_rules import text_statistics

TREES, DEPTH = 30, 4
PENALTY = 0.0005  # of the L1 norm
SEED = 7

# The statistics that rules test, from the counts of ``text_statistics``.
STATISTICS = {
    "s_words": "n_words",
    "s_word_length": "word_chars / greatest(n_words, 1)",
    "s_symbols": "n_symbols / greatest(n_words, 1)",
    "s_dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "s_lines": "n_lines / greatest(n_words, 1)",
    "s_repeats": "n_repeat_words / greatest(n_words, 1)",
    "s_upper": "n_upper / greatest(n_upper + n_lower, 1)",
    "s_letters": "(n_upper + n_lower) / greatest(word_chars, 1)",
    "s_marks": "n_marks / greatest(n_words, 1)",
    "s_stop_words": "n_stop_words / greatest(n_words, 1)",
    "s_variety": "n_distinct_words / greatest(n_words, 1)",
    "s_doubled": "n_doubled_words / greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is greater, threshold) tests."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, greater, threshold in self.tests:
            out = out & ((F.col(name) > threshold) if greater else (F.col(name) <= threshold))
        return out


def simplified(tests: tuple[tuple[str, bool, float], ...]) -> Rule:
    """The same conjunction with one test per statistic and direction."""
    tightest: dict[tuple[str, bool], float] = {}
    for name, greater, threshold in tests:
        key = (name, greater)
        old = tightest.get(key)
        tightest[key] = threshold if old is None else (max if greater else min)(old, threshold)
    return Rule(tuple(sorted((n, g, t) for (n, g), t in tightest.items())))


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """The rules of all paths of one tree, from its printed form (one test a line, indented)."""
    rules, path = [], []
    for line in description.splitlines():
        test = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (-?[0-9.E+-]+)\)", line)
        if test:
            depth = len(test[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (names[int(test[2])], test[3] == ">", float(test[4]))))
            rules.append(simplified(tuple(t for _, t in path)))
    return rules


def _complement_free(rules: list[Rule]) -> list[Rule]:
    """Distinct rules; of a one-test rule and its negation only one."""
    kept: dict[Rule, None] = {}
    for rule in rules:
        if len(rule.tests) == 1:
            name, greater, threshold = rule.tests[0]
            if Rule(((name, not greater, threshold),)) in kept:
                continue
        kept.setdefault(rule)
    return list(kept)


@dataclass(frozen=True)
class Ensemble:
    """score = 1 / (1 + exp(-(base + sum of the weights of the rules that hold)))"""

    base: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        weights = [F.when(rule.column(), weight).otherwise(0.0) for rule, weight in self.rules]
        held = F.aggregate(F.array(*weights), F.lit(self.base), lambda a, b: a + b) if weights else F.lit(self.base)
        return 1 / (1 + F.exp(-held))


def fit_ensemble(labelled: DataFrame) -> Ensemble:
    """Fit on rows with the columns of ``STATISTICS`` and ``label`` (0 or 1)."""
    row = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("good")).first()
    if not row["n"] or row["good"] in (0, row["n"]):
        share = min(max(row["good"] / row["n"], 1e-6), 1 - 1e-6) if row["n"] else 0.5
        return Ensemble(math.log(share / (1 - share)), ())
    names = list(STATISTICS)
    rows = VectorAssembler(inputCols=names, outputCol="statistics").transform(labelled)
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
        minInstancesPerNode=5, subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=SEED,
    ).fit(rows.select("statistics", "label"))
    rules = _complement_free([r for tree in forest.trees for r in tree_rules(tree.toDebugString, names)])
    if not rules:
        return Ensemble(0.0, ())
    held = labelled.select("label", *(r.column().cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    columns = [f"r{k}" for k in range(len(rules))]
    design = VectorAssembler(inputCols=columns, outputCol="rules").transform(held).select("rules", "label")
    lasso = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, standardization=False,
        maxIter=60,
    ).fit(materialize(design, "design"))
    weights = lasso.coefficients.toArray().tolist()
    return Ensemble(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """Per document: id, the columns of ``STATISTICS``, and ``score``.

    ``labels`` has an id of the same name and the label; only its rows where
    ``learn`` holds are used.
    """
    counts = text_statistics(docs, id_column, text_column)
    statistics = [F.expr(e).cast("double").alias(n) for n, e in STATISTICS.items()]
    rows = materialize(counts.select(id_column, *statistics), "statistics")
    usable = F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1) & learn
    marks = (
        labels.filter(usable)
        .groupBy(F.col(id_column).alias("label_id"))
        .agg(F.min(label_column).cast("double").alias("label"))
    )
    labelled = rows.join(marks, F.col(id_column) == F.col("label_id")).select("label", *STATISTICS)
    ensemble = fit_ensemble(materialize(labelled, "labelled"))
    return rows.withColumn("score", ensemble.column())
