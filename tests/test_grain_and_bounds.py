"""Hand-made frames for grains, bounds and NULL keys that the derived log alone would not pin down."""

import datetime as dt

import pytest

from actionlens import session
from actionlens.operators import breadth as br, curves as cv, windows as win
from actionlens.plans import features as ft

DDL = "user_id bigint, sku_id bigint, time timestamp_ntz, model_id int, type int, cate string, brand string"
USERS = "user_id bigint, age int, sex int, user_lv_cd int, user_reg_tm int, user_lv_reg double"
PRODUCTS = "sku_id bigint, a1 int, a2 int, a3 int, cate string, brand string"
COMMENTS = "dt date, sku_id bigint, comment_num int, has_bad int, bad_rate double"


def _t(day, hour=12):
    return dt.datetime(2024, 1, day, hour)


def test_label_belongs_to_user_and_product(spark):
    rows = [(1, 10, _t(20), None, 1, "A", "b1"), (1, 10, _t(20), None, 1, "A", "b2"), (1, 10, _t(26), None, 4, "A", "b2"), (2, 10, _t(20), None, 1, "A", "b1")]
    out = ft.train_set(spark.createDataFrame(rows, DDL), spark.createDataFrame([], USERS), spark.createDataFrame([], PRODUCTS),
                       spark.createDataFrame([], COMMENTS), "2024-01-25", "2024-01-25", "2024-01-30", "2024-01-25")
    assert {(r.user_id, r.brand): r.label for r in out.collect()} == {(1, "b1"): 1, (1, "b2"): 1, (2, "b1"): 0}


def test_breadth_counts_products_not_pair_rows(spark):
    rows = [(1, 10, _t(20), None, 1, "A", "b1"), (1, 10, _t(20), None, 1, "A", "b2"), (1, 11, _t(20), None, 1, None, None)]
    pairs = br.pair_totals(spark.createDataFrame(rows, DDL))
    got = {r.cate: (r.diff_cate_total, r.diff_cate) for r in br.group_breadth(pairs, "cate").collect()}
    assert got == {"A": (1, 2), None: (1, 2)}


def test_curve_reads_purchases_older_than_the_look_back(spark):
    rows = [(1, 10, _t(24), None, 1, "A", "b"), (1, 10, _t(2), None, 4, "A", "b")]
    table = cv.curve_table(spark.createDataFrame(rows, DDL), None, "2024-01-25", 3, "2024-01-01", "2024-01-05")
    got = {(r.n_days, r.type): (r.pairs, r.hits) for r in cv.cumulative_from_table(table, 3).collect()}
    assert got[(3, 1)] == (1, 1) and got[(3, 2)] == (0, 0)


def test_curves_of_any_length(spark):
    rows = [(1, 10, _t(24), None, 1, "A", "b"), (2, 10, dt.datetime(2023, 11, 1), None, 1, "A", "b")]
    table = cv.curve_table(spark.createDataFrame(rows, DDL), None, "2024-01-25", 90, "2024-01-25", "2024-01-30")
    got = {(r.n_days, r.type): r.pairs for r in cv.cumulative_from_table(table, 90).collect()}
    assert (got[(84, 1)], got[(85, 1)], got[(90, 1)]) == (1, 2, 2)
    day = {r.n_days for r in cv.daily_from_table(table, 90).collect() if r.pairs}
    assert day == {1, 85}


def test_window_block_keeps_pairs_without_brand(spark):
    rows = [(1, 10, _t(20), 3, 1, "A", "b1"), (1, 10, _t(20), None, 1, "A", None), (2, 11, _t(21), None, 4, None, "b1"), (2, 12, _t(21), None, 1, "B", "b2")]
    actions = spark.createDataFrame(rows, DDL)
    out = ft.window_block(actions, spark.createDataFrame([(1, 2, 1, 3, 5, 1.5)], USERS), spark.createDataFrame([(10, 1, 1, 1, "A", "b1")], PRODUCTS), "2024-01-25", 7)
    got = {(r.user_id, r.sku_id, r.cate, r.brand): r for r in out.collect()}
    assert len(got) == 4
    assert got[(1, 10, "A", "b1")].a1_1 == 1 and got[(1, 10, "A", None)].a1_1 == 0       # products join on sku, category and brand
    assert got[(1, 10, "A", None)].brand_action_1 == 1 and got[(2, 11, None, "b1")].brand_action_4 == 1
    assert got[(1, 10, "A", "b1")].cate_model_clicks == 1 and got[(1, 10, "A", "b1")].sex_action_1 == 2


def test_null_safe_rescan(spark):
    rows = [(1, 10, _t(24), None, 1, "A", None)]
    r = win.pair_window_counts_rescan(spark.createDataFrame(rows, DDL), "2024-01-25", [1, 3]).first()
    assert (r.w1_action_1, r.w3_action_1) == (1, 1)


def test_checkpoint_folder_must_be_named_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_memoised_stage_needs_a_finished_write(spark, tmp_path):
    from actionlens.sources.readers import memoised
    path = f"{tmp_path}/stage"
    (tmp_path / "stage").mkdir()
    (tmp_path / "stage" / "part-0.parquet").write_text("broken")
    assert memoised(spark, spark.range(3), path).count() == 3
    assert memoised(spark, spark.range(5), path).count() == 3
