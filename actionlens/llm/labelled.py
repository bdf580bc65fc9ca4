"""Bounded samples of labelled documents for fitting, and the hold-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents


def remainder(mod: int) -> Column:
    """crc32 of the doc_id as text, modulo ``mod``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod


def sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int, per_class: int) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` labelled documents a class outside the held-out
    remainder: the first by a hash of doc_id.  A doc_id that is repeated counts each row; nulls are no labels;
    of labels of one doc_id that differ the larger holds."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (remainder(mod) != held_out)).groupBy("doc_id").agg(F.max("label").alias("label")))
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    return documents(docs).join(F.broadcast(picked), "doc_id")      # at most 2 x per_class rows
