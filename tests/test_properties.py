"""Metamorphic properties of the curves and joins on the driver tables."""

from pyspark.sql import functions as F

from actionlens import params as P
from actionlens.operators import curves as cv, selection as sel, windows as win
from actionlens.sources import fixtures as fx
from tests.conftest import SF_MID


def test_cumulative_counts_monotone_and_daily_consistent(spark):
    a = fx.actions(spark, SF_MID)
    pos = cv.positives(a, fx.products(spark, SF_MID), P.LABEL_START, P.LABEL_END)
    cum = {(r.type, r.n_days): r for r in cv.conversion_cumulative(a, pos, P.FEATURE_END, P.CURVE_DAYS).collect()}
    for t in P.NON_PURCHASE_TYPES:
        seq = [cum[(t, n)].pairs for n in range(1, P.CURVE_DAYS + 1)]
        assert seq == sorted(seq)
    assert all(cum[(5, n)].pairs == 0 and cum[(5, n)].rate == 0.0 for n in range(1, 21))
    assert any(cum[(t, 20)].hits > 0 for t in P.NON_PURCHASE_TYPES)
    rows = {r.n_days: r for r in cv.conversion_rows(a, pos, P.FEATURE_END, P.CURVE_DAYS).collect()}
    assert sum(rows[n].day_rows for n in rows) == rows[P.CURVE_DAYS].window_rows
    # window N of the cumulative curve is exactly the distinct pairs of that window
    direct = win.lookback(a, P.FEATURE_END, 7).where("type = 1").select("user_id", "sku_id").distinct().count()
    assert cum[(1, 7)].pairs == direct


def test_target_curve_not_empty(spark):
    a = fx.actions(spark, SF_MID)
    pos = cv.positives(a, fx.products(spark, SF_MID), P.LABEL_START, P.LABEL_END, P.TARGET_CATE)
    assert pos.count() > 0
    cum = cv.conversion_cumulative(a, pos, P.FEATURE_END, P.CURVE_DAYS)
    assert cum.where("n_days = 20").agg(F.sum("hits")).first()[0] > 0


def test_anti_and_semi_partition_the_input(spark):
    a = fx.actions(spark, SF_MID)
    cand = win.lookback(a, P.FEATURE_END, 7).select("user_id", "sku_id").distinct()
    buyers = sel.past_buyers(a, P.FEATURE_END, P.TARGET_CATE, P.HISTORY_START)
    kept = sel.drop_past_buyers(cand, buyers)
    dropped = cand.join(buyers, "user_id", "left_semi")
    assert kept.count() + dropped.count() == cand.count()
    assert kept.unionByName(dropped).exceptAll(cand).count() == 0


def test_one_scan_curves_equal_join_form(spark):
    a = fx.actions(spark, SF_MID)
    prods = fx.products(spark, SF_MID)
    for cate in (None, P.TARGET_CATE):
        pos = cv.positives(a, prods, P.LABEL_START, P.LABEL_END, cate)
        table = cv.curve_table(a, prods, P.FEATURE_END, P.CURVE_DAYS, P.LABEL_START, P.LABEL_END, cate)
        pairs = [(cv.conversion_cumulative(a, pos, P.FEATURE_END, P.CURVE_DAYS),
                  cv.cumulative_from_table(table, P.CURVE_DAYS)),
                 (cv.conversion_daily(a, pos, P.FEATURE_END, P.CURVE_DAYS),
                  cv.daily_from_table(table, P.CURVE_DAYS)),
                 (cv.conversion_rows(a, pos, P.FEATURE_END, P.CURVE_DAYS),
                  cv.rows_from_table(table, P.CURVE_DAYS))]
        for joined, one_scan in pairs:
            assert joined.exceptAll(one_scan.select(*joined.columns)).count() == 0
            assert one_scan.select(*joined.columns).exceptAll(joined).count() == 0


def test_window_block_set_matches_single_blocks(spark):
    from actionlens.plans import catalog as C, features as ft
    from tests.conftest import SF_SMALL
    a = fx.actions(spark, SF_SMALL)
    ud, prods = C._user_dim(spark, SF_SMALL), fx.products(spark, SF_SMALL)
    merged = ft.window_block_set(a, ud, prods, P.FEATURE_END, (1, 3))
    keys = ["user_id", "sku_id", "cate", "brand"]
    three = ft.window_block(a, ud, prods, P.FEATURE_END, 3)
    got3 = merged.select(*keys, *[F.col(f"w3_{c}").alias(c) for c in three.columns if c not in keys])
    assert got3.exceptAll(three.select(*got3.columns)).count() == 0
    assert merged.count() == three.count()
    one = ft.window_block(a, ud, prods, P.FEATURE_END, 1)
    got1 = merged.where("w1_sku_total > 0").select(
        *keys, *[F.col(f"w1_{c}").alias(c) for c in one.columns if c not in keys])
    assert got1.exceptAll(one.select(*got1.columns)).count() == 0
    assert got1.count() == one.count()
