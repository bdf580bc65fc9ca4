"""Physical-plan properties the scale design relies on."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _final_plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    txt = df._jdf.queryExecution().executedPlan().toString()
    return txt.split("== Initial Plan ==")[0]


def _event_scans(plan):
    return len(re.findall(r"FileScan parquet \[[^\]]*\bts#", plan))


@pytest.mark.parametrize("name", ["feature_set", "train_set", "candidate_set",
                                  "conversion_cumulative", "conversion_daily", "conversion_rows"])
def test_one_log_scan(spark, name):
    assert _event_scans(_final_plan(spark, name)) == 1


def test_feature_grains_reuse_the_day_shuffle(spark):
    assert "ReusedExchange" in _final_plan(spark, "feature_set")


def test_time_bounds_and_columns_reach_the_scan(spark):
    df = entry.queries()["pair_window_counts"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-04T00:00)" in plan and "LessThan(ts,2024-01-25T00:00)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan.split("events.parquet")[1]).group(1)
    assert "value" not in schema        # (event_id decides the recorded brand and category)
    plan = entry.queries()["user_window_ratios"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan.split("events.parquet")[1]).group(1)
    assert "value" not in schema and "event_id" not in schema and "part.parquet" not in plan


def test_blocks_do_not_shuffle_pairs_on_category_or_attribute(spark):
    """Broadcasts by size off: only the checked side tables are broadcast, and no pair is dealt by category or brand alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _final_plan(spark, "window_block")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    # (Age and sex rollups meet the user table, not the pairs.)  The side tables' own aggregates are combined before they are dealt.
    lines = plan.split("\n")
    dealt = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\((coalesce\()?(cate|brand)#", line) and "user_id" not in line]
    assert dealt and all(any("HashAggregate" in x for x in lines[i + 1:i + 3]) for i in dealt), [lines[i:i + 3] for i in dealt]


def test_argmax_per_user_is_an_aggregate_not_a_window(spark):
    plan = _final_plan(spark, "top1_per_user")
    assert "Window" not in plan and "HashAggregate" in plan


def test_category_filter_stands_before_the_joins_of_a_block(spark):
    """The pairs are cut where the pinned table is read, and the features still come from all actions."""
    from actionlens import params as P
    from actionlens.plans import catalog as C
    from actionlens.plans import features as ft
    args = (*C._block_args(spark, SF_SMALL), 3)
    cut = ft.window_block(*args, cate=P.TARGET_CATE)
    lines = cut._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [i for i, line in enumerate(lines) if "Filter" in line and f"= {P.TARGET_CATE})" in line]
    assert at and all("LogicalRDD" in lines[i + 1] for i in at)
    whole = ft.window_block(*args).where(f"cate = '{P.TARGET_CATE}'")
    assert cut.count() > 0 and cut.exceptAll(whole.select(*cut.columns)).count() == 0 and whole.select(*cut.columns).exceptAll(cut).count() == 0


def test_blocks_of_all_windows_are_ranked_and_joined_once(spark, monkeypatch):
    """One global sort and one set of side tables serve seven windows, and each window's block is the one built alone."""
    from actionlens.plans import catalog as C
    from actionlens.plans import features as ft
    ranked = []
    monkeypatch.setattr(ft.br, "rank_within", lambda *a, rank=ft.br.rank_within, **k: ranked.append(a[1]) or rank(*a, **k))
    args = C._block_args(spark, SF_SMALL)
    whole = ft.window_block_set(*args)
    assert [g for g in ranked if "user_id" in g] == [["days", "user_id"]]
    for n in (2, 7):
        alone = ft.window_block(*args, n)
        columns = ["user_id", "sku_id", "cate", "brand", *[c for c in alone.columns if c not in ("user_id", "sku_id", "cate", "brand")]]
        of_set = whole.where(f"w{n}_sku_total > 0").select(*columns[:4], *[f"w{n}_{c}" for c in columns[4:]])
        assert alone.count() == of_set.count() > 0 and alone.select(*columns).exceptAll(of_set).count() == 0
