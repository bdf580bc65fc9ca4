"""Boosted trees from packed histograms: Spark ML's own trees, whatever the tasks, and after a lost executor."""

import glob
import math
import os
import re

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from actionlens.plans import boosting as bo
from actionlens.plans import model as ml

COLUMNS = [f"f{i}" for i in range(9)]


@pytest.fixture(scope="module")
def rows(spark):
    """Features of many values (so no two splits part a node alike), of few, mostly zero, and constant."""
    x = spark.range(4000, numPartitions=3).select(
        *[F.randn(k).alias(f"f{k}") for k in range(5)], F.floor(F.rand(5) * 3).cast("double").alias("f5"),
        F.when(F.rand(6) < 0.7, 0.0).otherwise(F.floor(F.rand(7) * 60)).alias("f6"), (F.rand(8) < 0.5).cast("double").alias("f7"), F.lit(1.0).alias("f8"))
    told = x.withColumn("label", (F.col("f0") + F.col("f5") * F.col("f1") + F.col("f6") / 20 + F.randn(9) > 1.5).cast("double"))
    return ml.pin(ml.assembler(COLUMNS).transform(ml.with_class_weight(told, 7.0)).select("features", "label", "weight"))


def trees(model):
    """The trees' lines, numbers to seven digits."""
    text = re.sub(r"uid=\S+", "", model.toDebugString)
    return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.7g}", text).replace("-0\n", "0\n")


def probabilities(model, rows):
    return np.array([r[0] for r in model.transform(rows).select(vector_to_array("probability")[1]).collect()])


@pytest.mark.parametrize("estimator", [
    lambda: ml.gbt(6), lambda: ml.gbt(5, weight_col="weight"), lambda: ml.gbt(4, depth=2).setFeatureSubsetStrategy("all"), lambda: ml.gbt(3, depth=5, seed=7).setMinInstancesPerNode(40).setMaxBins(8),
    lambda: ml.gbt(3, depth=1).setFeatureSubsetStrategy("3"), lambda: ml.gbt(3).setMinInfoGain(0.02)])
def test_the_trees_are_those_of_spark_ml(rows, estimator):
    assert bo.fits(estimator(), len(COLUMNS))
    mine, spark_ml = bo.fit(rows, estimator()), estimator().fit(rows)
    assert trees(mine).splitlines()[1:] == trees(spark_ml).splitlines()[1:]
    assert list(mine.treeWeights) == list(spark_ml.treeWeights) and mine.numFeatures == spark_ml.numFeatures == len(COLUMNS)
    assert probabilities(mine, rows) == pytest.approx(probabilities(spark_ml, rows), abs=1e-9)
    assert mine.featureImportances.toArray() == pytest.approx(spark_ml.featureImportances.toArray(), abs=1e-9)
    assert {p.name: v for p, v in mine.extractParamMap().items()} == {p.name: v for p, v in spark_ml.extractParamMap().items()}
    for a, b in zip(mine._java_obj.trees(), spark_ml._java_obj.trees()):
        assert (a.rootNode().impurity(), a.rootNode().impurityStats().count()) == pytest.approx((b.rootNode().impurity(), b.rootNode().impurityStats().count()), rel=1e-7)


def test_a_model_does_not_depend_on_tasks_or_chunks(rows, monkeypatch):
    told = [bo.fit(rows, ml.gbt(4, weight_col="weight"))]
    monkeypatch.setattr(bo, "PART_ROWS", 100)
    told.append(bo.fit(ml.pin(rows.orderBy(F.col("label"), F.rand(1)).repartition(40)), ml.gbt(4, weight_col="weight")))
    assert told[0].toDebugString.split("\n")[1:] == told[1].toDebugString.split("\n")[1:]


def test_what_is_lost_is_built_again(rows, monkeypatch):
    """State files that vanish, and a part that is not on its executor, change nothing in the model."""
    whole, run, passes = bo.fit(rows, ml.gbt(4, depth=3)), bo.Parts.run, []

    def losing(self, p):
        passes.append(p)
        for folder, _ in self.places if len(passes) % 2 else ():
            for name in glob.glob(f"{folder}/{('g', 'node', 'margin', '')[len(passes) % 4]}*-*"):
                os.remove(name)
        if len(passes) == 6:
            os.remove(f"{self.places[0][0]}/label")
        return run(self, p)

    monkeypatch.setattr(bo.Parts, "run", losing)
    again = bo.fit(rows, ml.gbt(4, depth=3))
    assert len(passes) == 4 * 3 + 1 and whole.toDebugString.split("\n")[1:] == again.toDebugString.split("\n")[1:]


def test_parts_are_cleared(rows, monkeypatch):
    places, close = [], bo.Parts.close
    monkeypatch.setattr(bo.Parts, "close", lambda self: (places.extend(self.places), close(self)))
    bo.fit(rows, ml.gbt(1))
    assert places and not any(os.path.exists(folder) for folder, _ in places)


def test_bundles_hold_every_feature_once():
    bins = [32] * 20 + [3] * 30 + [1] * 4 + [2] * 25 + [256]
    found = bo.bundles(bins)
    assert sorted(f for some in found for f in some) == [f for f, n in enumerate(bins) if n > 1]
    assert all(math.prod(bins[f] for f in some) <= bo.CODES for some in found) and len(found) < len(bins) / 4
    at = bo.layout([np.arange(n - 1) + 0.5 for n in bins])
    x = np.stack([np.arange(500) * (i + 1) % n for i, n in enumerate(bins)], axis=1).astype(float)
    codes = bo.packed(x, at)
    for f, n in enumerate(bins):
        if n > 1:
            assert ((codes[at.bundle[f]] // at.stride[f]) % n == x[:, f]).all()


def test_many_rows_are_fitted_from_histograms_and_few_by_spark_ml(spark, monkeypatch):
    train = spark.range(600).selectExpr("id DIV 30 AS user_id", "id % 30 AS sku_id", "id % 7 AS a", "id % 11 AS b", "CAST(id % 3 = 0 OR id % 7 = 2 AS INT) AS label")
    calls, fit = [], bo.fit
    monkeypatch.setattr(bo, "fit", lambda table, estimator: calls.append(1) or fit(table, estimator))
    few = ml.fit(train, ml.gbt(3))
    assert not calls
    monkeypatch.setattr(ml, "HISTOGRAM_ROWS", 600)
    many = ml.fit(train, ml.gbt(3))
    assert len(calls) == 1 and ml.scores(many, train).count() == 600
    ml.fit(train, ml.forest().setNumTrees(2))
    ml.fit(train, ml.gbt(2).setSubsamplingRate(0.5))
    assert len(calls) == 1
    a, b = ({(r.user_id, r.sku_id): r.score for r in ml.scores(m, train).collect()} for m in (few, many))
    assert a == pytest.approx(b, abs=1e-6)


def test_rows_that_cannot_be_fitted(spark):
    one = lambda rows: ml.pin(ml.assembler(["a"]).transform(spark.createDataFrame(rows, "a double, label double")).select("features", "label"))
    for rows in ([(1.0, 2.0), (2.0, 0.0)], [(1.0, None), (2.0, 1.0)], [(1.0, 0.0), (float("nan"), 1.0), (2.0, 1.0)]):
        with pytest.raises(Exception):
            ml.gbt(1).fit(one(rows))
        with pytest.raises(Exception):
            bo.fit(one(rows), ml.gbt(1))
    same = one([(1.0, 0.0), (1.0, 1.0), (1.0, 1.0)])                     # a constant feature: one leaf
    assert probabilities(bo.fit(same, ml.gbt(2)), same) == pytest.approx(probabilities(ml.gbt(2).fit(same), same))
    pure = one([(float(i), 1.0) for i in range(50)])                    # one label: nothing to part
    assert probabilities(bo.fit(pure, ml.gbt(2)), pure) == pytest.approx(probabilities(ml.gbt(2).fit(pure), pure))
