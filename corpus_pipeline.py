"""Corpus pipeline: toxicity, quality, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes a
stage's result as Parquet to the shared folder and reads it back as the next
stage's documents.  All stages but the last return the columns of documents.

Stages know documents by doc_id and text together, so repeated rows and rows
without a doc_id are judged by their own text; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens.llm import decontamination, jaccard_join, packing, quality_knn, toxicity
from actionlens.llm.common import pin, rows_of_keys, table
from actionlens.llm.queries import END_ID, TOKENIZER


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of its own for every row, the same each time it is read, and the key's name (none of the input's)."""
    key = "row_key"
    while key.lower() in {c.lower() for c in docs.columns}:
        key += "_"
    return pin(docs.withColumn(key, F.monotonically_increasing_id()), "stage-rows"), key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts; it learns from the labelled documents of the corpus."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_knn.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_knn.accepted(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that of the smallest doc_id.

    Documents without words are in no group and stay.
    """
    rows, key = _keyed(docs)
    groups = jaccard_join.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), k=5, percent=80)
    named = rows.select(key, "doc_id").join(groups.select(F.col("doc_id").alias(key), "component_id", "n_shingles"), key)
    first = (named.where("n_shingles > 0").groupBy("component_id").agg(F.min_by(key, F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias(key)).select(key)
             .unionByName(named.where("n_shingles = 0").select(key)))
    return rows_of_keys(rows, key, first).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, TOKENIZER, 1024, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

ORACLE_SQL = None       # SQL states neither the classifiers nor the packing


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
