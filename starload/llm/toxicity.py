"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.feature import (
    HashingTF, IDF, IDFModel, RegexTokenizer, UnivariateFeatureSelector, VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import in_fold, label_sample
from starload.session import materialize

FOLDS, HELD = 3, 1
THRESHOLD = 0.7
# Labelled rows a fit uses at most.
FIT_ROWS = 20_000
BUCKETS = 1 << 17


@dataclass(frozen=True)
class ToxicityModel:
    """Text to term counts, their weights, the buckets learned from, and the machine."""

    counts: PipelineModel
    weights: IDFModel
    chosen: VectorSlicer
    machine: FMClassificationModel

    def scored(self, texts: DataFrame) -> DataFrame:
        rows = self.chosen.transform(self.weights.transform(self.counts.transform(texts)))
        return self.machine.transform(rows).withColumn("score", vector_to_array("probability")[1])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("fm_text"))


def fitted(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, factors: int = 4,
    least_docs: int = 5, error: float = 0.01, iterations: int = 80,
) -> tuple[float, ToxicityModel | None]:
    """The smoothed share of label 1, and a model; without one if nothing can be learned.

    Numbers of texts with a term are counted over all of ``docs``. Terms may tell only as pairs:
    the machine learns from all buckets so frequent that two of them are expected together in
    ``least_docs`` texts of the sample, and of the rarer ones from those related to the label at
    a family-wise error of ``error``. Buckets in fewer than ``least_docs`` texts of the sample
    are left out: their weights would be chance.
    """
    texts = _texts(docs)
    sample = label_sample(labels, "toxic", FOLDS, HELD, fit_rows).filter(F.col("label").isin(0.0, 1.0))
    train = materialize(
        texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id")
        .agg(F.min("fm_text").alias("fm_text"), F.min("label").alias("label")), "toxic-sample",
    )
    seen = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = seen.get(0.0, 0), seen.get(1.0, 0)
    share = (n1 + 1.0) / (n0 + n1 + 2.0)
    if not n0 or not n1:
        return share, None
    counts = Pipeline(stages=[
        RegexTokenizer(inputCol="fm_text", outputCol="fm_terms", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="fm_terms", outputCol="fm_counts", numFeatures=BUCKETS, binary=True),
    ]).fit(train)
    weights = IDF(inputCol="fm_counts", outputCol="fm_weighted").fit(counts.transform(texts))
    parts = max(1, min(12, (n0 + n1) // 2000))
    examples = materialize(
        counts.transform(train).select("label", "fm_counts").repartition(parts), "toxic-features")
    known = IDF(inputCol="fm_counts", outputCol="fm_known").fit(examples).docFreq
    weighted = weights.transform(examples)
    linked = UnivariateFeatureSelector(
        featuresCol="fm_weighted", labelCol="label", outputCol="fm_linked", selectionMode="fwe",
    ).setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(error)
    wide = (least_docs / (n0 + n1)) ** 0.5 * weights.numDocs
    chosen = {i for i, n in enumerate(weights.docFreq) if n >= wide}
    chosen = sorted(i for i in chosen.union(linked.fit(weighted).selectedFeatures)
                    if known[i] >= least_docs)
    if not chosen:
        return share, None
    slicer = VectorSlicer(inputCol="fm_weighted", outputCol="fm_features", indices=chosen)
    machine = FMClassifier(
        featuresCol="fm_features", labelCol="label", factorSize=factors, initStd=0.05,
        maxIter=iterations, stepSize=0.1, regParam=1e-2, solver="adamW", seed=5,
    ).fit(materialize(slicer.transform(weighted).select("label", "fm_features"), "toxic-chosen"))
    return share, ToxicityModel(counts, weights, slicer, machine)


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Terms are runs of letters and digits in lower case, hashed into ``BUCKETS``; see ``fitted``
    for those that are learned from. The machine learns a weight for each of them and factors
    whose products weigh their pairs. The fit sees about ``fit_rows`` labelled rows at most, none
    of the held-out fold; scoring is a projection over all texts.

    Null or empty text: scored as a text without terms. Null doc_id: scored, not held out.
    Repeated rows: one result each. Empty tables: no rows; without labels of both kinds, or
    without a bucket to learn from, every score is the smoothed share of label 1. Other columns
    of either table are not read.
    """
    share, model = fitted(docs, labels, fit_rows, **options)
    texts = _texts(docs)
    scored = model.scored(texts) if model else texts.withColumn("score", F.lit(share))
    return scored.select(
        "doc_id", in_fold(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
