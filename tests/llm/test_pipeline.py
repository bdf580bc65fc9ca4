"""The corpus pipeline: stages in order, each on what the one before kept, odd rows included."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from actionlens.llm import jaccard_join, packing, quality_knn, toxicity
from tests.conftest import SF_SMALL
from tests.llm.test_operators import ODD


def test_stages_are_applied_in_order(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    columns, kept = docs.columns, docs
    judged = {r.doc_id for r in toxicity.judged(docs, labels).where("predicted = 0").collect()}
    kept = cp.pin(cp.drop_toxic(spark, docs, SF_SMALL), "t")
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == judged
    good = {r.doc_id for r in quality_knn.judged(docs, labels).where("predicted = 1").collect()}
    kept = cp.pin(cp.keep_quality(spark, kept, SF_SMALL), "t")
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == judged & good
    groups = jaccard_join.near_duplicates(kept, 5, 80).collect()
    kept = cp.pin(cp.one_of_each_group(spark, kept, SF_SMALL), "t")
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {r.component_id for r in groups if r.n_shingles} | {r.doc_id for r in groups if not r.n_shingles}
    kept = cp.pin(cp.drop_contaminated(spark, kept, SF_SMALL), "t")
    assert kept.columns == columns
    packed = cp.pack(spark, kept, SF_SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}
    assert Counter(tuple(r) for r in cp.run(spark, SF_SMALL).drop("sequence_id", "offset").collect()) == Counter(tuple(r) for r in packed.drop("sequence_id", "offset").collect())


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_take_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("clash")).withColumn("row_key", F.lit("clash")).withColumn("bad_doc", F.lit(3)).withColumn("lang", F.lit(None).cast("string")).withColumn("row", F.lit(1))
    for _, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, SF_SMALL)
        assert got.columns == docs.columns and got.where("_row <> 'clash' OR row_key <> 'clash'").count() == 0
    one = Counter(r.doc_id for r in cp.one_of_each_group(spark, docs, SF_SMALL).collect())
    if rows:
        assert one[1] == 1 and one[4] == 0 and one[2] == one[3] == one[6] == 1 and one[None] == 1 and one[9] == 2
    assert cp.pack(spark, docs, SF_SMALL).count() == sum(len(packing.cut(r, 1024)) for r in _sizes(rows))


def _sizes(rows):
    from tests.llm.test_operators import _ids
    return [len(_ids(t)) for _, t in rows]


def test_the_join_stage_moves_no_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "other words than these are here"), (None, None)], "doc_id long, text string")
    kept = cp.one_of_each_group(spark, docs, SF_SMALL)
    assert "Exchange" not in kept._jdf.queryExecution().toString()
    assert Counter(tuple(r) for r in kept.collect()) == Counter([(1, "a b c d e f"), (2, "other words than these are here"), (None, None)])
