"""A corpus made ready for training: five stages over ``documents``, each written and reread."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import bounded
from starload.llm.jaccard import jaccard_join
from starload.llm.mixing import mix
from starload.llm.packing import pack_documents
from starload.llm.quality_model import THRESHOLD, fitted, scored
from starload.llm.substrings import remove_repeats
from starload.session import configure, materialize, scratch, session_area

# Target weight of each source; None: the square root of its number of rows.
WEIGHTS = None
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _prepared(spark: SparkSession) -> None:
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not reject, each by its own text.

    Null or empty texts are scored as such, and rows without an id like all others.
    """
    _prepared(spark)
    model = fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = scored(docs.select(*COLUMNS), model)
    return rows.filter(F.col("quality_score") >= THRESHOLD).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest id, one without an id last.

    Rows are told apart by id and text, so that texts of one id are judged each by itself.
    Rows without words are linked with nothing, and stay. Repeated rows of the one that stays
    are reduced to one.
    """
    _prepared(spark)
    rows = docs.select(*COLUMNS).withColumn("row_key", F.xxhash64("doc_id", "text"))
    links = materialize(jaccard_join(rows.select(F.col("row_key").alias("doc_id"), "text")), "links")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    ids = rows.select("row_key", "doc_id").distinct()
    linked = links.filter("n_shingles > 0").withColumnRenamed("doc_id", "row_key")
    first = linked.distinct().join(ids, "row_key").groupBy("component_id").agg(
        F.min(order)["row_key"].alias("row_key"))
    alone = links.filter("n_shingles = 0").select(F.col("doc_id").alias("row_key")).distinct()
    keys = materialize(first.select("row_key").unionByName(alone), "first-rows")
    # Few keys, by count, are broadcast, so that texts stay put.
    kept = rows.join(bounded(keys), "row_key", "left_semi")
    again = materialize(
        linked.groupBy("row_key").count().filter("count > 1").select("row_key"), "repeated-rows")
    if again.isEmpty():
        return kept.select(*COLUMNS)
    again = bounded(again)
    once = kept.join(again, "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.join(again, "row_key", "left_anti").unionByName(once).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words in repeated windows; others keep their texts as they are.

    A document that loses all its words stays, with an empty text.
    """
    _prepared(spark)
    cut = remove_repeats(docs, others=("text", "lang", "source", "n_chars"))
    text = F.when(F.col("dedup_removed") > 0, F.col("dedup_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("dedup_removed") > 0, F.length("dedup_text").cast("long")).otherwise(
        F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": n_chars}).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the mixed order of their sources."""
    _prepared(spark)
    return mix(docs, WEIGHTS).orderBy("mix_position").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences, along the mixed order.

    Files keep no order and the columns are fixed, so places in the mixture are worked out anew.
    """
    _prepared(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False,
                          mixed=lambda rows: mix(rows, WEIGHTS))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeats),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packing),
]

# Training a model, merging token pairs and following links are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # What a stage writes besides its result goes with the stage.
        path = f"{session_area(spark)}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
