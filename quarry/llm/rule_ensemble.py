"""Quality classifier: a sparse rule ensemble over document statistics.

1. ``statistics``: one Spark projection of text statistics per document.
2. ``fit``: a small random forest is grown on labelled rows; every path from
   a root to a node becomes a conjunctive rule (``mean_word <= 6.1 and
   caps > 0.2``); a lasso-penalised logistic regression over the rule
   indicators keeps a few weighted rules.
3. ``RuleEnsemble.score``: the kept rules are compiled into one Spark column
   expression, so scoring is a projection without user functions or shuffle.

``fit`` learns from at most ``max_rows`` labelled rows (a documented bound on
the training sample, taken by hash order); scoring covers every row.

Defined results
* null or empty text: its statistics are those of an empty text; it is scored.
* null label: not learned from. Null id: scored, ``held_out`` false.
* labels all alike, or no labels at all: a constant score, the smoothed mean
  of the labels (0.5 without any).
* several labels for one id: each counts as a row of training.
* repeated rows and ties: every input row gives one output row.
* extra columns: only id and text are read.
* empty table: no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import count_chars, held_out, prepared, stage, word_array

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÎÏÔÖÙÛÜÑÁÍÓÚ"
DIGITS = "0123456789"
MARKS = "#*$%&|<>{}[]\\~^=+_@"
# Frequent function words of the languages served.
FUNCTION_WORDS = ["a", "and", "as", "das", "de", "der", "des", "die", "el", "en", "et", "for", "in", "is", "la",
                  "las", "le", "les", "los", "of", "on", "que", "the", "to", "un", "una", "und", "une", "y", "zu"]

FEATURES = ["log_words", "word_chars", "caps", "digits", "marks", "bangs", "bars", "types", "same_as_last",
            "function_words", "line_words", "dup_lines"]

MAX_ROWS = 10_000
THRESHOLD = 0.3


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns ``keep`` and the ``FEATURES`` of every row."""
    words = F.array(*[F.lit(w) for w in FUNCTION_WORDS])
    t = df.select(F.col(id_col).alias("doc_id"), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("t_"))
    t = t.withColumn("w_", word_array(F.col("t_"))).withColumn("l_", F.split("t_", "\n"))
    t = t.withColumn("n_", F.greatest(F.size("w_"), F.lit(1)).cast("double")) \
         .withColumn("c_", F.greatest(F.length("t_"), F.lit(1)).cast("double"))
    per_word = {
        "marks": count_chars(F.col("t_"), MARKS),
        "bangs": count_chars(F.col("t_"), "!?"),
        "bars": count_chars(F.col("t_"), "|"),
        "types": F.size(F.array_distinct("w_")),
        "same_as_last": F.size(F.filter("w_", lambda x, i: F.coalesce(x == F.get(F.col("w_"), i - 1), F.lit(False)))),
    }
    return t.select(
        "doc_id", *keep,
        F.log1p(F.size("w_").cast("double")).alias("log_words"),
        (F.length("t_") / F.col("n_")).alias("word_chars"),
        (count_chars(F.col("t_"), UPPER) / F.col("c_")).alias("caps"),
        (count_chars(F.col("t_"), DIGITS) / F.col("c_")).alias("digits"),
        *[(v / F.col("n_")).alias(k) for k, v in per_word.items()],
        F.size(F.array_intersect("w_", words)).cast("double").alias("function_words"),
        (F.size("w_") / F.size("l_").cast("double")).alias("line_words"),
        (F.lit(1.0) - F.size(F.array_distinct("l_")) / F.size("l_")).alias("dup_lines"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.bound if self.above else c <= self.bound


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def rule_hits(rule: Rule, x: np.ndarray) -> np.ndarray:
    """Rows of a matrix of ``FEATURES`` that the rule holds for."""
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        v = x[:, FEATURES.index(c.feature)]
        out &= v > c.bound if c.above else v <= c.bound
    return out


@dataclass
class RuleEnsemble:
    """Weighted conjunctive rules; ``score`` compiles them into a column."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        z = F.lit(self.intercept)
        for rule, w in self.weights.items():
            z = z + F.when(rule_column(rule), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def forest_rules(model) -> list[Rule]:
    """Every path from a root to a node of the forest, contradictions and
    repeats merged: of several bounds on one side of a feature the tightest."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[str, bool], float]):
        if path:
            rule = tuple(Condition(f, a, b) for (f, a), b in sorted(path.items()))
            found.setdefault(rule)
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, bound = FEATURES[split.featureIndex()], float(split.threshold())
        low, high = dict(path), dict(path)
        low[(name, False)] = min(bound, low.get((name, False), math.inf))
        high[(name, True)] = max(bound, high.get((name, True), -math.inf))
        walk(node.leftChild(), low)
        walk(node.rightChild(), high)

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def fit(train: DataFrame, label_col: str = "label", trees: int = 16, depth: int = 4, lasso: float = 0.0001,
        seed: int = 11) -> RuleEnsemble:
    """Fit on ``train`` (``FEATURES`` and a 0/1 label), a bounded sample; the
    same rows in any order give the same rules.

    The rows are sorted into one small file, so bagging sees them alike in
    every run, and both learners read files: the driver holds the statistics
    (12 numbers a row) while it looks for rules that agree, but no matrix of rules.
    """
    columns = [label_col, *FEATURES]
    rows = stage(train.select(*columns).coalesce(1).sortWithinPartitions(*columns), "quality-sorted")
    table = rows.toArrow()
    y = table[label_col].to_numpy().astype(float)
    x = np.column_stack([table[c].to_numpy() for c in FEATURES])
    del table
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    constant = RuleEnsemble(math.log(p / (1 - p)))
    if len(np.unique(y)) < 2:
        return constant
    label = F.col(label_col).cast("double").alias("label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=seed).fit(
        rows.select(array_to_vector(F.array(*FEATURES)).alias("features"), label))
    rules = forest_rules(forest)
    if not rules:  # no split helps: only the base rate is left
        return constant
    distinct: dict[bytes, Rule] = {}  # of rules that agree on every row, the first
    for r in rules:
        distinct.setdefault(np.packbits(rule_hits(r, x)).tobytes(), r)
    rules = list(distinct.values())
    del x, distinct

    def hits(batches):
        for batch in batches:
            x = np.column_stack([batch[c].to_numpy() for c in FEATURES])
            found = np.column_stack([rule_hits(r, x) for r in rules]).astype(float)
            values = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(rules)).cast(pa.list_(pa.float64()))
            yield pa.record_batch([values, batch["label"]], names=["x", "label"])

    matrix = stage(prepared(rows).select(label, *FEATURES).mapInArrow(hits, "x array<double>, label double"), "quality-rules")
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(
        matrix.select(array_to_vector("x").alias("features"), "label"))
    weights = {r: float(w) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if abs(w) > 1e-6}
    return RuleEnsemble(float(model.intercept), weights)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """Statistics and label of at most ``max_rows`` labelled documents that
    are not held out, chosen by the hash of their id."""
    picked = (labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label"))
              .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows))
    # at most max_rows ids and labels: a proven bound for the broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return stage(statistics(rows, keep=("label",)), "quality-train")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS,
             threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = fit(training_rows(docs, labels, label_col, max_rows))
    return statistics(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS,
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    model = fit(training_rows(docs, labels, label_col, max_rows))
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row_"))
    # exploded, or the filter would be pushed below the statistics and every
    # rule would compute its statistics anew
    scored = statistics(rows, keep=("row_",)).select("row_", F.explode(F.array(model.score())).alias("score_"))
    return scored.where(F.col("score_") >= threshold).select("row_.*")
