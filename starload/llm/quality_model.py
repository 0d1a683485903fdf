"""Quality classifier: a sparse ensemble of rules taken from trees over text statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import in_fold, label_sample
from starload.session import materialize

FOLDS, HELD = 5, 0
THRESHOLD = 0.3
# Labelled rows a fit uses at most.
FIT_ROWS = 40_000
# Rows of the sample that must meet a rule, and fail it.
LEAST_ROWS = 5
# Before the names of statistics that stand beside other columns.
_OWN = "quality_"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = (
    "n_chars", "n_words", "word_length", "symbols", "bangs", "upper", "digits", "stops",
    "distinct_words", "distinct_lines", "words_per_line", "lone_marks",
)


def statistics(text: Column) -> dict[str, Column]:
    """Counts and shares of one text, each a column expression; NULL counts as empty.

    Labels, language, source and id take no part.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    n_chars = F.length(text).cast("double")
    n_words = F.size(words).cast("double")
    n_lines = F.size(lines).cast("double")

    def share(characters: str) -> Column:
        rest = F.length(F.translate(text, characters, ""))
        return (n_chars - rest) / F.greatest(n_chars, F.lit(1.0))

    return {
        "n_chars": n_chars, "n_words": n_words,
        "word_length": n_chars / F.greatest(n_words, F.lit(1.0)),
        "symbols": share(SYMBOLS), "bangs": share("!"), "upper": share(UPPER),
        "digits": share("0123456789"), "stops": share(".,;"),
        "distinct_words": F.size(F.array_distinct(words)) / F.greatest(n_words, F.lit(1.0)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(n_lines, F.lit(1.0)),
        "words_per_line": n_words / F.greatest(n_lines, F.lit(1.0)),
        "lone_marks": F.size(F.filter(words, lambda w: F.length(w) == 1))
        / F.greatest(n_words, F.lit(1.0)),
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self, names: dict[str, str] | None = None) -> Column:
        value = F.col((names or {}).get(self.statistic, self.statistic))
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleModel:
    """Rules with weights; ``score`` is their compiled form."""

    intercept: float
    rules: tuple[tuple[float, Rule], ...]

    def score(self, names: dict[str, str] | None = None) -> Column:
        """Probability of label 1, as an expression over the statistics, maybe by other names."""
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total = total + F.when(_all(rule, names), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _all(rule: Rule, names: dict[str, str] | None = None) -> Column:
    test = rule[0].column(names)
    for condition in rule[1:]:
        test = test & condition.column(names)
    return test


def tree_rules(model) -> list[Rule]:
    """Each path from a root to a node of the trees, as the conjunction of its splits."""
    rules: dict[Rule, None] = {}

    def walk(node, path: Rule) -> None:
        if path:
            bounds: dict[tuple[str, bool], float] = {}
            for c in path:  # of several bounds on one statistic the tightest one stays
                old = bounds.get((c.statistic, c.above))
                pick = max if c.above else min
                bounds[c.statistic, c.above] = c.threshold if old is None else pick(old, c.threshold)
            rules[tuple(Condition(s, a, t) for (s, a), t in sorted(bounds.items()))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), (*path, Condition(name, False, at)))
        walk(node.rightChild(), (*path, Condition(name, True, at)))

    for tree in model.trees:
        walk(tree._call_java("rootNode"), ())
    return list(rules)


def marked(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(label, x): which rules each row meets."""
    return rows.select("label", array_to_vector(
        F.array(*[F.when(_all(r), 1.0).otherwise(0.0) for r in rules])
    ).alias("x"))


def supported(rows: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules, and their conditions alone, that enough rows meet and enough do not.

    A conjunction that as many rows meet as one of its conditions alone is left out: what it
    adds is chance.
    """
    singles = list(dict.fromkeys((c,) for r in rules for c in r))
    every = [*singles, *[r for r in rules if len(r) > 1]]
    if not every:
        return []
    found = marked(rows, every).agg(F.count("*").alias("n"), Summarizer.sum(F.col("x")).alias("x")).first()
    met = dict(zip(every, found["x"].toArray().astype(int).tolist()))
    return [
        r for r in every
        if LEAST_ROWS <= met[r] <= found["n"] - LEAST_ROWS
        and not (len(r) > 1 and any(met[(c,)] == met[r] for c in r))
    ]


def fit(rows: DataFrame, trees: int = 12, depth: int = 3, lasso: float = 0.001) -> RuleModel:
    """Fit on rows (doc_id, the statistics, and a ``label`` of 0 or 1).

    With no rows, or rows of one label only, every text gets the smoothed share of label 1.
    """
    spark = rows.sparkSession
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n"))
              .filter(F.col("label").isin(0.0, 1.0)).collect()}
    n0, n1 = counts.get(0.0, 0), counts.get(1.0, 0)
    if not (n0 and n1):
        share = (n1 + 1.0) / (n0 + n1 + 2.0)
        return RuleModel(math.log(share / (1 - share)), ())
    rows = rows.filter(F.col("label").isin(0.0, 1.0))
    parts = max(1, min(12, (n0 + n1) // 2000))
    # Dealt out and sorted by id, as the forest's random choices follow the rows' places.
    rows = rows.repartition(parts, "doc_id").sortWithinPartitions("doc_id")
    train = rows.select(
        "label", array_to_vector(F.array(*[F.col(s) for s in STATISTICS])).alias("x")
    )
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=11,
    ).fit(train)
    rules = supported(rows, tree_rules(forest))
    if not rules:
        return RuleModel(math.log((n1 + 1.0) / (n0 + 1.0)), ())
    marks = marked(rows, rules)
    weights = LogisticRegression(
        featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60,
        standardization=False,
    ).fit(marks)
    kept = [(float(w), r) for w, r in zip(weights.coefficients.toArray(), rules) if w != 0.0]
    return RuleModel(float(weights.intercept), tuple(kept))


def fitted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> RuleModel:
    """The model of the labelled rows of ``docs``: about ``fit_rows`` at most, none held out.

    Of the texts of a repeated id the one with the least statistics is learned from.
    """
    sample = label_sample(labels, "quality", FOLDS, HELD, fit_rows)
    # The bound of the sample bounds the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = materialize(
        rows.select("doc_id", "label", F.struct(*[c.alias(n) for n, c in statistics(F.col("text")).items()])
                    .alias("of_text")), "quality-sample")
    return fit(rows.groupBy("doc_id", "label").agg(F.min("of_text").alias("of_text"))
               .select("doc_id", "label", "of_text.*"))


def scored(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with ``quality_score``, from their ``text``."""
    names = docs.columns
    rows = docs.select(*names, *[c.alias(_OWN + n) for n, c in statistics(F.col("text")).items()])
    # A column that is no function of the row keeps later filters above the statistics, which
    # would otherwise be worked out again for every rule.
    rows = rows.withColumn("quality_row", F.monotonically_increasing_id())
    own = model.score({n: _OWN + n for n in STATISTICS})
    return rows.select(*names, "quality_row", own.alias("quality_score")).drop("quality_row")


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    The forest and the lasso see about ``fit_rows`` labelled rows at most, none of the
    held-out fold. Rules become one column expression over the statistics of a text, so
    scoring is a projection.

    Null or empty text: scored by statistics that are all zero. Null doc_id: scored, not held
    out. Repeated rows: one result each. Empty tables: no result rows, or, without labels, a
    score of 0.5. Other columns of either table are not read.
    """
    return scored(docs.select("doc_id", "text"), fitted(docs, labels, fit_rows)).select(
        "doc_id", in_fold(F.col("doc_id"), FOLDS, HELD).alias("held_out"),
        F.col("quality_score").alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
