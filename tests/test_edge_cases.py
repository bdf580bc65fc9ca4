"""Hand-made frames for the edge cases of FIXTURES.md §3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from actionlens.functions.expr import AGE_BUCKET_RANK, age_rank, safe_ratio
from actionlens.operators import dims, metrics, windows as win
from actionlens.operators.ranking import rank_within, top1_per_key

ACTIONS_DDL = "user_id bigint, sku_id bigint, time timestamp_ntz, model_id int, type int, cate string, brand string"


def _actions(spark, rows):
    return spark.createDataFrame(rows, ACTIONS_DDL)


def test_safe_ratio_cases(spark):
    df = spark.createDataFrame([(6, 3), (0, 0), (5, 0), (None, 4), (2, None)], "n bigint, d bigint")
    got = [r.r for r in df.select(safe_ratio("n", "d").alias("r")).collect()]
    assert got == [2.0, 0.0, 1.0, 0.0, 0.0]


def test_window_bounds_half_open(spark):
    end = "2024-01-25"
    t = dt.datetime
    rows = [
        (1, 10, t(2024, 1, 22, 0, 0, 0), None, 1, "A", "b"),     # exactly at the 3-day window start
        (1, 10, t(2024, 1, 25, 0, 0, 0), None, 1, "A", "b"),     # exactly at end: excluded
        (1, 10, t(2024, 1, 24, 23, 59, 59), None, 4, "A", "b"),  # last second before end
        (1, 10, t(2024, 1, 21, 23, 59, 59), None, 1, "A", "b"),  # before the 3-day window
    ]
    out = win.pair_window_counts(_actions(spark, rows), end, [1, 3, 4]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.w1_action_1, r.w1_action_4) == (0, 1)
    assert (r.w3_action_1, r.w3_action_4) == (1, 1)
    assert r.w4_action_1 == 2


def test_one_pass_equals_rescan(spark):
    from actionlens.sources import fixtures as fx
    from tests.conftest import SF_MID
    a = fx.actions(spark, SF_MID)
    windows = [1, 2, 3, 5, 7]
    one = win.pair_window_counts(a, "2024-01-25", windows)
    many = win.pair_window_counts_rescan(a, "2024-01-25", windows)
    assert one.exceptAll(many.select(*one.columns)).count() == 0
    assert many.select(*one.columns).exceptAll(one).count() == 0


def test_decay_weight_uses_whole_days(spark):
    t = dt.datetime
    rows = [(1, 1, t(2024, 1, 24, 0, 0, 0), None, 2, "A", "b"),   # 1 whole day before end
            (1, 1, t(2024, 1, 24, 12, 0, 0), None, 2, "A", "b")]  # 12 hours: 0 whole days
    r = win.decayed_counts(_actions(spark, rows), "2024-01-25", 3).collect()[0]
    assert r.decay_action_2 == pytest.approx(1.0 + 2.718281828459045 ** -1)


def test_user_dimension_nulls(spark):
    users = spark.createDataFrame([
        (1, "15岁以下", 1, 2, dt.date(2010, 1, 1)),
        (2, "15岁以下", 0, 1, None),                 # imputed from its group
        (3, None, 1, 1, dt.date(2012, 1, 1)),        # null age
        (4, "unknown", 1, 1, dt.date(2013, 1, 1)),   # unmapped age -> null group too
        (5, "56岁以上", 1, 1, None),                  # group whose reg days are all null
        (6, "15岁以下", 1, 1, dt.date(2000, 1, 1)),  # before base date -> missing -> imputed
    ], "user_id bigint, age string, sex int, user_lv_cd int, user_reg_tm date")
    out = {r.user_id: r for r in dims.user_dimension(users, "2004-01-01", AGE_BUCKET_RANK).collect()}
    d1 = (dt.date(2010, 1, 1) - dt.date(2004, 1, 1)).days
    assert out[1].age == 1 and out[1].user_reg_tm == d1
    assert out[2].user_reg_tm == d1 and out[6].user_reg_tm == d1
    assert out[3].age is None and out[4].age is None
    null_mean = int(((dt.date(2012, 1, 1) - dt.date(2004, 1, 1)).days + (dt.date(2013, 1, 1) - dt.date(2004, 1, 1)).days) / 2)
    assert out[3].user_reg_tm == (dt.date(2012, 1, 1) - dt.date(2004, 1, 1)).days
    assert out[5].user_reg_tm is None and out[5].user_lv_reg is None
    assert null_mean > 0
    assert out[1].user_lv_reg == pytest.approx(d1 / 2)


def test_age_rank_fixed_buckets(spark):
    df = spark.createDataFrame([(k,) for k in AGE_BUCKET_RANK] + [("x",)], "age string")
    got = [r.a for r in df.select(age_rank("age").alias("a")).collect()]
    assert got == list(AGE_BUCKET_RANK.values()) + [None]


def test_ties_go_to_smaller_sku(spark):
    df = spark.createDataFrame([(1, 20, 0.5), (1, 10, 0.5), (1, 30, 0.1), (2, 5, 0.2)],
                               "user_id bigint, sku_id bigint, score double")
    top = {r.user_id: r.sku_id for r in top1_per_key(df, "user_id", "score").collect()}
    low = {r.user_id: r.sku_id for r in top1_per_key(df, "user_id", "score", order="asc").collect()}
    assert top == {1: 10, 2: 5}
    assert low == {1: 30, 2: 5}


def test_rank_within_matches_row_number_with_hot_key(spark):
    from pyspark.sql import Window
    # user 1 holds about a third of all rows
    base = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 97 + 2).cast("bigint").alias("user_id"),
        F.col("id").alias("sku_id"), (F.col("id") * 7919 % 13).alias("n"))
    ranked = rank_within(base, ["user_id"], [F.col("n").desc(), F.col("sku_id")], "r", num_partitions=16)
    ref = base.withColumn("r", (F.row_number().over(
        Window.partitionBy("user_id").orderBy(F.col("n").desc(), "sku_id")) - 1).cast("int"))
    assert ranked.count() == 3000
    assert ranked.select(*ref.columns).exceptAll(ref).count() == 0
    glob = rank_within(base, [], [F.col("n"), F.col("sku_id")], "g")
    assert sorted(r.g for r in glob.collect()) == list(range(3000))


def test_asof_snapshot_boundaries(spark):
    c = spark.createDataFrame([
        (dt.date(2024, 1, 1), 7, 1, 0, 0.0),
        (dt.date(2024, 1, 8), 7, 3, 1, 0.5),   # latest strictly before end
        (dt.date(2024, 1, 15), 7, 4, 1, 1.0),  # exactly on end: excluded
    ], "dt date, sku_id bigint, comment_num int, has_bad int, bad_rate double")
    r = dims.asof_snapshot(c, "2024-01-15").collect()
    assert len(r) == 1 and r[0].dt == dt.date(2024, 1, 8) and r[0].comment_num == 3
    rng = dims.snapshot_range(c, "2024-01-15").collect()
    assert [x.dt for x in rng] == [dt.date(2024, 1, 8)]
    f = dims.comment_features(c, "2024-01-15").collect()[0]
    assert (f.comment_num_3, f.comment_num_4) == (1, 0)


def test_metrics_duplicates_and_zero_hits(spark):
    pred = spark.createDataFrame([(1, 10), (1, 10), (2, 20)], "user_id bigint, sku_id bigint")
    truth = spark.createDataFrame([(1, 10), (1, 11), (3, 30)], "user_id bigint, sku_id bigint")
    r = metrics.score_rows(pred, truth).collect()[0]
    # user join: each of the two (1,10) predictions meets both true rows of user 1
    assert (r.pred_rows, r.truth_rows, r.user_hits, r.pair_hits) == (3, 3, 4, 2)
    s = metrics.score_sets(pred, truth).collect()[0]
    assert (s.pred_users, s.truth_users, s.user_hits, s.pair_hits) == (2, 2, 1, 2)
    none = spark.createDataFrame([(9, 9)], "user_id bigint, sku_id bigint")
    z = metrics.score_rows(none, truth).collect()[0]
    assert (z.f11, z.f12, z.score) == (0.0, 0.0, 0.0)


def test_gbk_csv_with_chinese_age(spark, tmp_path):
    from actionlens.sources.readers import USERS_SCHEMA, read_csv
    p = tmp_path / "users.csv"
    p.write_bytes("user_id,age,sex,user_lv_cd,user_reg_tm\n1,15岁以下,1,2,2010-01-01\n"
                  "2,26-35岁,0,5,2012-05-06\n3,-1,,1,bad-date\n".encode("gbk"))
    df = read_csv(spark, str(p), USERS_SCHEMA, encoding="GBK")
    rows = {r.user_id: r for r in df.select("*", age_rank("age").alias("rank")).collect()}
    assert rows[1].rank == 1 and rows[2].rank == 7 and rows[3].rank == 5
    assert rows[3].sex is None and rows[3].user_reg_tm is None


def test_ratio_variant_keeps_infinity(spark):
    from actionlens.operators.rollups import rollup
    t = dt.datetime
    rows = [(1, 10, t(2024, 1, 24), None, 4, "A", "b"), (1, 10, t(2024, 1, 24), None, 2, "A", "b"),
            (2, 11, t(2024, 1, 24), None, 4, "B", "b")]
    df = _actions(spark, rows)
    g2 = {r.cate: r for r in rollup(df, "cate", ratio_types=(2, 5), x_over_zero=float("inf")).collect()}
    assert g2["A"].cate_ratio_2 == 1.0 and g2["A"].cate_ratio_5 == float("inf")
    assert "cate_ratio_1" not in g2["A"].asDict()
    g1 = {r.cate: r for r in rollup(df, "cate").collect()}
    assert g1["B"].cate_ratio_2 == 1.0 and g1["B"].cate_ratio_1 == 1.0


def test_day_partitioned_log_prunes(spark, tmp_path):
    from actionlens.sources import fixtures as fx
    from actionlens.sources.readers import read_log, write_log_by_day
    from tests.conftest import SF_SMALL
    a = fx.actions(spark, SF_SMALL)
    out = str(tmp_path / "log")
    write_log_by_day(a, out)
    got = read_log(spark, out, "2024-01-10", "2024-01-20")
    want = win.time_range(a, "2024-01-10", "2024-01-20")
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-20" in plan


def test_csv_period_files_union_and_memoised_stage(spark, tmp_path):
    from actionlens.sources import fixtures as fx
    from actionlens.sources.readers import ACTIONS_SCHEMA, memoised, read_csv, union_periods, write_csv
    from tests.conftest import SF_SMALL
    a = fx.actions(spark, SF_SMALL)
    periods = [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]
    paths = []
    for i, (s, e) in enumerate(periods):
        p = str(tmp_path / f"actions_{i}")
        write_csv(win.time_range(a, s, e).select(*ACTIONS_SCHEMA.fieldNames()), p)
        paths.append(p)
    back = read_csv(spark, paths, ACTIONS_SCHEMA)
    assert back.count() == a.count()
    assert back.exceptAll(a.select(*ACTIONS_SCHEMA.fieldNames())).count() == 0
    per_file = union_periods([read_csv(spark, p, ACTIONS_SCHEMA) for p in paths])
    assert per_file.count() == a.count()
    stage = str(tmp_path / "stage_end=2024-01-25_days=7")
    first = memoised(spark, win.pair_window_counts(a, "2024-01-25", [7]), stage)
    again = memoised(spark, win.pair_window_counts(a, "2024-01-25", [1]), stage)   # same path: not rewritten
    assert first.columns == again.columns and first.count() == again.count()
