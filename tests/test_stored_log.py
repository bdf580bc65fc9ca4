"""Stored logs: checked CSV, days written anew, windows from day partials, several periods, as-of for several cut-offs, quartiles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from actionlens import params as P
from actionlens.operators import dims
from actionlens.operators import periods as pe
from actionlens.operators import profile as pf
from actionlens.operators import windows as win
from actionlens.plans import catalog_store as C
from actionlens.sources import fixtures as fx
from actionlens.sources import readers as rd
from actionlens.streaming import rolling
from tests.conftest import SF_SMALL

LOG = "user_id long, sku_id long, time timestamp_ntz, model_id int, type int, cate string, brand string"


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


# ---- CSV -----------------------------------------------------------------------------------------------------


def test_gbk_in_a_session_without_the_setting(spark, tmp_path):
    """A plain session reads and writes GBK, and its settings stay as they were."""
    plain = spark.newSession()
    plain.conf.set(rd.CHARSETS, "false")
    users = plain.createDataFrame([(1, "26-35岁", 1, 3, dt.date(2016, 1, 2)), (2, None, None, 1, None)], "user_id long, age string, sex int, user_lv_cd int, user_reg_tm date")
    path = f"{tmp_path}/gbk"
    rd.write_csv(users, path, encoding="GBK")
    assert plain.conf.get(rd.CHARSETS) == "false"
    assert "岁".encode("gbk") in b"".join(p.read_bytes() for p in (tmp_path / "gbk").glob("part-*"))
    got = rd.read_csv(plain, path, rd.USERS_SCHEMA, encoding="GBK")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, users.collect()))
    assert plain.conf.get(rd.CHARSETS) == "false"
    checked = rd.read_checked(plain, path, rd.USERS_SCHEMA, encoding="GBK")
    assert checked.where(F.size("reasons") > 0).count() == 0 and checked.where("age = '26-35岁'").count() == 1


def test_checked_lines(spark, tmp_path):
    lines = ["user_id,age,sex,user_lv_cd,user_reg_tm", "1,a,0,1,2016-01-02", "2,,,,", "x3,a,0,1,2016-01-02", "4,a,0", "5,a,0,1,2016-01-02,more", "6,a,1.0,2e0,2016-02-30", '7,"a,b", 1 ,99999999999,2016-01-02', "", "9,a,1.5,-3,01/02/2016"]
    (tmp_path / "u.csv").write_text("\n".join(lines) + "\n")
    checked = rd.read_checked(spark, f"{tmp_path}/u.csv", rd.USERS_SCHEMA)
    got = {r.user_id: r for r in checked.collect()}
    day = dt.date(2016, 1, 2)
    assert tuple(got[1])[:5] == (1, "a", 0, 1, day) and got[1].reasons == [] and got[2].reasons == [] and got[2].sex is None
    assert got[None].reasons == ["user_id: not a bigint"] and got[4].reasons == [rd.BAD_LINE] and got[4].raw_line == "4,a,0" and got[5].reasons == [rd.BAD_LINE]
    assert (got[6].sex, got[6].user_lv_cd, got[6].reasons) == (1, 2, ["user_reg_tm: not a date"])
    assert (got[7].age, got[7].sex, got[7].user_lv_cd, got[7].reasons) == ("a,b", 1, None, ["user_lv_cd: not a int"])
    assert got[9].user_lv_cd == -3 and got[9].reasons == ["sex: not a int", "user_reg_tm: not a date"]
    good = rd.quarantine(checked, f"{tmp_path}/bad")
    assert {r.user_id for r in good.collect()} == {1, 2} and spark.read.parquet(f"{tmp_path}/bad").count() == 6
    assert {r.reason: r.n_rows for r in rd.reason_counts(checked).collect()} == {
        "good": 2, "user_id: not a bigint": 1, rd.BAD_LINE: 2, "user_reg_tm: not a date": 2, "user_lv_cd: not a int": 1, "sex: not a int": 1}


# ---- the log by day ------------------------------------------------------------------------------------------


def test_late_days_replace_only_themselves(spark, tmp_path):
    rows = [(u, u, dt.datetime(2024, 1, d, 8), None, 1, "c", "b") for d in (1, 2, 3) for u in range(20)] + [(99, 1, None, None, 1, None, None)]
    path = f"{tmp_path}/log"
    rd.write_log_by_day(spark.createDataFrame(rows, LOG), path)
    before = {p: p.stat().st_mtime_ns for d in (1, 3) for p in (tmp_path / "log" / f"day=2024-01-0{d}").glob("*.parquet")}
    late = [(u, 7, dt.datetime(2024, 1, 2, 20), None, 4, "c", "b") for u in range(5)]
    for _ in range(2):                                        # a replay changes nothing
        rd.replace_days(spark.createDataFrame(late, LOG), path)
    assert {r.day.day: r["count"] for r in spark.read.parquet(path).where("day IS NOT NULL").groupBy("day").count().collect()} == {1: 20, 2: 5, 3: 20}
    assert all(p.stat().st_mtime_ns == t for p, t in before.items()) and rd.read_log(spark, path).count() == 46
    part = rd.read_log(spark, path, "2024-01-02", "2024-01-03")
    assert part.count() == 5
    plan = part._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "day" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0] and "GreaterThanOrEqual(time" in scan


def test_windows_rolled_day_by_day(spark, tmp_path):
    """After every day the stored table equals the counts straight off the log, which only storing the days reads."""
    log = fx.actions(spark, SF_SMALL)
    windows, path = (1, 3, 7), f"{tmp_path}/roll"
    rolling.store_days(log, path, "2024-01-01", "2024-01-18")
    rolling.store_days(log, path, "2024-01-05", "2024-01-08")                  # stored again: the same
    rolling.start_windows(spark, path, "2024-01-12", windows)
    for day in range(12, 18):
        end = f"2024-01-{day:02d}"
        assert same(rolling.read_windows(spark, path, end, windows), win.pair_window_counts(log, end, windows)), end
        rolling.advance(spark, path, end, windows)
        if day == 14:
            rolling.advance(spark, path, end, windows)                         # replayed
    plan = rolling._signed_days(spark, path, {"2024-01-12": {1: 1}}, windows)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "day#" in plan.split("PartitionFilters:")[1].split("]")[0]
    with pytest.raises(ValueError):
        rolling.advance(spark, path, "2024-02-01", windows)


def test_a_pair_leaves_the_rolled_table(spark, tmp_path):
    rows = [(1, 1, dt.datetime(2024, 1, 1, 9), None, 1, None, None), (1, 1, dt.datetime(2024, 1, 1, 9), None, 1, None, None), (2, 2, dt.datetime(2024, 1, 3, 9), None, None, "c", None)]
    log, path = spark.createDataFrame(rows, LOG), f"{tmp_path}/roll"
    rolling.store_days(log, path, "2024-01-01", "2024-01-06")
    rolling.start_windows(spark, path, "2024-01-02", (1, 2))
    told = {}
    for day in range(2, 7):
        end = f"2024-01-{day:02d}"
        told[day] = sorted((r.user_id, r.w1_action_1, r.w2_action_1) for r in rolling.read_windows(spark, path, end, (1, 2)).collect())
        rolling.advance(spark, path, end, (1, 2))
    assert told == {2: [(1, 2, 2)], 3: [(1, 0, 2)], 4: [(2, 0, 0)], 5: [(2, 0, 0)], 6: []}


# ---- several periods -----------------------------------------------------------------------------------------


def test_periods_equal_single_sets(spark):
    log = fx.actions(spark, SF_SMALL)
    periods = [pe.PeriodSet("a", "2024-01-01", "2024-01-15", "2024-01-20"), pe.PeriodSet("b", "2024-01-12", "2024-01-30")]
    got = pe.period_sets(log, periods, (1, 5, 10))
    for p in periods:
        single = win.pair_window_counts(log.where(F.col("time") >= F.lit(p.start).cast("timestamp_ntz")), p.end, (1, 5, 10))
        assert same(single, got.where(F.col("period") == p.name).drop("period", "label"))
    assert got.where("period = 'b' AND label IS NOT NULL").count() == 0 and got.where("period = 'a' AND label IS NULL").count() == 0


def test_periods_read_the_log_once_and_do_not_meet(spark):
    plan = pe.period_sets(fx.actions(spark, SF_SMALL), C.PERIODS)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and plan.count("Scan ExistingRDD") == 2              # pairs and labels from the pinned day table
    train, _, one, two = C.PERIODS
    assert not pe.overlapping(train, one) and not pe.overlapping(train, two) and not pe.overlapping(one, two)
    assert pe.overlapping(train, C.PERIODS[1])


# ---- as-of, quartiles ----------------------------------------------------------------------------------------


def test_asof_cutoffs_equal_one_asof_each(spark):
    comments = fx.comments(spark, SF_SMALL)
    ends = ["1995-06-15", "1993-02-01", "1998-11-30", "1995-06-15", "1992-01-01"]
    got = dims.asof_cutoffs(comments, ends)
    for end in set(ends):
        assert same(dims.asof_snapshot(comments, end), got.where(F.col("cutoff") == F.lit(end).cast("date")).drop("cutoff"))


@pytest.mark.parametrize("values", [[], [5.0], [1.0, 2.0], [3.0, None, 1.0], [7.0] * 50, list(map(float, range(101))), [1.0] * 4000 + [2.0] * 3 + [3.0] * 4000 + [float(i) for i in range(5000)]])
def test_quartiles_are_exact(spark, values):
    import numpy as np
    df = spark.createDataFrame([(v, None) for v in values], "x double, empty double")
    by = {r["column"]: r for r in pf.describe(df, ["x", "empty"]).collect()}
    known = [v for v in values if v is not None]
    assert by["x"]["count"] == len(known) and by["empty"]["count"] == 0 and by["empty"].q50 is None
    want = np.percentile(known, [25, 50, 75]).tolist() if known else [None] * 3
    assert [by["x"].q25, by["x"].q50, by["x"].q75] == pytest.approx(want)


def test_few_values_do_not_gather_in_a_task(spark):
    """Three values over eight partitions: counted where they are read, a row a value and task is shuffled."""
    df = spark.range(0, 90_000, 1, 8).select((F.col("id") % 3).alias("x"))
    before = {r["column"]: r for r in pf.describe(df, ["x"], exact=False).collect()}["x"]
    exact = pf.describe(df, ["x"]).head()
    assert (exact.q25, exact.q50, exact.q75) == (0.0, 1.0, 2.0) and exact["count"] == before["count"] == 90_000
    counts = spark.createDataFrame([(0, None, 10**10), (0, 1.0, 3 * 10**9), (0, 2.0, 1)], "k int, x double, n long")
    assert pf.values_at(counts, {0: {10**10, 13 * 10**9}}) == {(0, 10**10): 1.0, (0, 13 * 10**9): 2.0}        # ranks beyond INT
