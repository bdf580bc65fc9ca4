"""Model stage: stored models, weighted fits, staged log-loss, submissions from stored scores."""

import math

import pytest
from pyspark.sql import functions as F

from actionlens.operators.selection import hash_split
from actionlens.plans import catalog_model as M
from actionlens.plans import model as ml
from actionlens.sources.readers import hadoop_path, is_finished
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def split_set(spark):
    return ml.pin(hash_split(M.labelled_set(spark, SF_SMALL, M.TRAIN)))


@pytest.fixture(scope="module")
def fitted(split_set):
    return ml.fit(split_set.where("is_test = 0"), ml.gbt(max_iter=5))


def test_scores_are_probabilities(split_set, fitted):
    assert split_set.where("label = 1").count() > 0
    told = ml.scores(fitted, split_set)
    assert told.count() == split_set.count() and told.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    forest = ml.fit(split_set.where("is_test = 0"), ml.forest().setNumTrees(5))
    assert ml.scores(forest, split_set).count() == split_set.count()


def test_staged_logloss_is_that_of_the_first_trees(split_set, fitted):
    """Round r against the margins of the first r trees, tree by tree and row by row."""
    got = sorted(ml.staged_logloss(fitted, split_set, digits=12).collect())
    assert [r["round"] for r in got] == [1, 2, 3, 4, 5]
    *before, gbt = fitted.stages
    rows = ml.PipelineModel(before).transform(split_set).select("label", "is_test", "features").collect()
    margin = [0.0] * len(rows)
    for r, (tree, weight) in enumerate(zip(gbt.trees, gbt.treeWeights)):
        margin = [m + weight * tree.predict(x.features) for m, x in zip(margin, rows)]
        for part, name in ((0, "train"), (1, "test")):
            loss = [math.log1p(math.exp(-2 * m if x.label == 1 else 2 * m)) for m, x in zip(margin, rows) if x.is_test == part]
            assert got[r][f"{name}_rows"] == len(loss) and got[r][f"{name}_logloss"] == pytest.approx(sum(loss) / len(loss), abs=1e-10)
    last = ml.split_logloss(fitted, split_set).head()
    assert (last.train_logloss, last.test_logloss) == pytest.approx((got[-1].train_logloss, got[-1].test_logloss), abs=2e-9)
    assert got[0].train_logloss > got[-1].train_logloss


def test_staged_logloss_without_a_part(split_set, fitted):
    got = ml.staged_logloss(fitted, split_set.where("is_test = 0")).collect()
    assert len(got) == 5 and all(r.test_rows == 0 and r.test_logloss is None for r in got)
    assert ml.staged_logloss(fitted, split_set.limit(0)).count() == 0


def test_weights_equal_repeated_rows(spark):
    rows = [(u, s, u % 4, (u * s) % 3, int((u + s) % 5 == 0 or (u % 4 == 3 and s % 2))) for u in range(30) for s in range(10)]
    train = spark.createDataFrame(rows, "user_id long, sku_id long, a int, b int, label int")
    estimator = lambda weight=None: ml.gbt(6, weight_col=weight).setMinInstancesPerNode(1).setFeatureSubsetStrategy("all")
    weighted = ml.fit(train, estimator("weight"), pos_weight=3)
    repeated = ml.fit(train.withColumn("n", F.explode(F.when(F.col("label") == 1, F.sequence(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1))))).drop("n"), estimator())
    plain = ml.fit(train, estimator())
    told = [{(r.user_id, r.sku_id): r.score for r in ml.scores(m, train).collect()} for m in (weighted, repeated, plain)]
    assert told[0] == pytest.approx(told[1], abs=1e-6)
    assert max(abs(told[0][k] - told[2][k]) for k in told[0]) > 0.05
    with pytest.raises(ValueError):
        ml.fit(train, estimator("weight"))
    with pytest.raises(ValueError):
        ml.fit(train, estimator(), pos_weight=3)


def test_stored_model_is_fitted_once_and_only_when_finished(spark, split_set, fitted, tmp_path):
    path, calls = f"{tmp_path}/model", []

    def fit():
        calls.append(1)
        return fitted

    a = ml.scores(ml.stored_model(spark, path, fit), split_set)
    b = ml.scores(ml.stored_model(spark, path, fit), split_set)
    assert len(calls) == 1 and a.exceptAll(b).count() == 0 and a.exceptAll(ml.scores(fitted, split_set)).count() == 0
    mark, fs = hadoop_path(spark, f"{path}/_SUCCESS")
    fs.delete(mark, False)                                    # as a driver that was lost while writing leaves it
    assert not is_finished(spark, path)
    ml.stored_model(spark, path, fit)
    assert len(calls) == 2 and is_finished(spark, path)


def test_data_version_sees_new_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(5).coalesce(1).write.parquet(path)
    one = ml.data_version(spark, [path])
    assert one == ml.data_version(spark, [path])
    spark.range(5).coalesce(1).write.mode("append").parquet(path)
    assert ml.data_version(spark, [path]) != one


def test_back_test_periods_do_not_meet():
    fit, test = M.BACK_FIT, M.BACK_TEST
    assert test.start < test.end < test.label_end <= fit.start < fit.end < fit.label_end
    assert M.MODELS["gbt_back"][0]().getMaxIter() == 283 and M.MODELS["gbt_weighted"][1] == 217


def test_submission_orders(spark):
    scored = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.2), (1, 3, 0.01), (2, 1, 0.9), (3, 9, 0.4), (4, 1, 0.02)], "user_id long, sku_id long, score double")
    buyers = spark.createDataFrame([(2,)], "user_id long")
    first = M.sel.submission(scored, buyers=buyers, threshold=0.03, order="asc")
    assert {tuple(r) for r in first.collect()} == {(1, 2, 0.2), (3, 9, 0.4)}
    assert [tuple(r) for r in sorted(M._positions(M.sel.submission(scored, order="desc")).collect())] == [(1, 2, 1, 0.9), (2, 1, 1, 0.5), (3, 3, 9, 0.4), (4, 4, 1, 0.02)]


def test_backtest_truth_reads_its_whole_period(spark, tmp_path):
    """Pairs seen on any of the 21 days before 01-15, the last of them and days before the first of January too, and bought by 01-20."""
    seen = [(1, 10, "2023-12-28", "view"), (2, 10, "2024-01-05", "view"), (3, 11, "2024-01-14", "click"), (4, 11, "2023-12-01", "view"), (5, 10, "2024-01-12", "view"), (6, 10, "2024-01-09", "view")]
    bought = [(1, 10, "2024-01-16"), (2, 10, "2024-01-19"), (3, 11, "2024-01-15"), (4, 11, "2024-01-16"), (5, 10, "2024-01-20"), (6, 10, "2024-01-12")]
    rows = [(i, day, user, kind, f'{{"k": {sku}}}') for i, (user, sku, day, kind) in enumerate([*seen, *[(*b, "purchase") for b in bought]], 1)]
    tables = {
        "events": spark.createDataFrame(rows, "event_id long, day string, user_id long, event_type string, props string").selectExpr("event_id", "CAST(day AS TIMESTAMP_NTZ) + INTERVAL 12 HOURS AS ts", "user_id", "event_type", "props"),
        "part": spark.createDataFrame([(10, "PROMO", "Brand#1", 3), (11, "SMALL", "Brand#2", 4)], "p_partkey long, p_type string, p_brand string, p_size int"),
        "customer": spark.createDataFrame([(1, "BUILDING", 1)], "c_custkey long, c_mktsegment string, c_nationkey int"),
        "orders": spark.createDataFrame([(1, "1996-01-01")], "o_custkey long, day string").selectExpr("o_custkey", "CAST(day AS TIMESTAMP_NTZ) AS o_orderdate"),
        "lineitem": spark.createDataFrame([(10, "N", "1996-01-01")], "l_partkey long, l_returnflag string, day string").selectExpr("l_partkey", "l_returnflag", "CAST(day AS TIMESTAMP_NTZ) AS l_shipdate"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    assert {tuple(r) for r in M.q_backtest_truth(spark, str(tmp_path)).collect()} == {(1, 10), (2, 10), (3, 11)}


def test_a_fit_reads_tasks_of_bounded_size(spark, monkeypatch):
    """One written partition is dealt over all cores, no task gets many more rows than asked for, and only what a fit reads is pinned."""
    cores, pinned = spark.sparkContext.defaultParallelism, []
    rows = spark.range(4000 * cores).selectExpr("id DIV 50 AS user_id", "id % 50 AS sku_id", "id % 7 AS a", "CAST(id % 3 = 0 AS INT) AS label", "'x' AS cate").coalesce(1)
    monkeypatch.setattr(ml, "TASK_ROWS", 1000)
    monkeypatch.setattr(ml, "dealt", lambda df, deal=ml.dealt: deal(df, ml.TASK_ROWS))
    monkeypatch.setattr(ml, "pin", lambda df, pin=ml.pin: pinned.append(pin(df)) or pinned[-1])
    ml.fit(rows, ml.forest().setNumTrees(2))
    sizes = pinned[0].rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == 4 * cores and sum(sizes) == 4000 * cores and max(sizes) < 1300
    assert pinned[0].columns == ["features", "label"]
    user = spark.createDataFrame([(None, 1, 0.5), (None, 1, 0.5), (2, None, 0.1)], "user_id long, sku_id long, a double")
    assert sorted(ml.dealt(user).collect(), key=str) == sorted(user.collect(), key=str) and ml.dealt(user.limit(0)).count() == 0
