"""Registered queries over stored logs: checked CSV, day-partitioned log, windows from day partials, several periods at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from actionlens import params as P
from actionlens.operators import dims
from actionlens.operators import periods as pe
from actionlens.operators import rollups as ru
from actionlens.operators import windows as win
from actionlens.plans import sqlgen as S
from actionlens.plans.catalog import ACTION_COLS, BLOCK_ROWS_SQL, END, _block_rows, _pair_window_sql, _scratch, register
from actionlens.sources import fixtures as fx
from actionlens.sources import readers as rd
from actionlens.streaming import rolling

# ---- CSV lines with faults (S1-S3, P16) ----------------------------------------------------------------------

# Lines in which a fault is planted: short, long, bad date, bad number, number with a fraction.
CHECKED = """SELECT *, user_id % 13 = 6 AS is_short, user_id % 13 = 8 AS is_long,
    user_id % 13 <> 6 AND user_id % 7 = 1 AS bad_date, user_id % 11 = 3 AND sex IS NOT NULL AS bad_sex, user_id % 17 = 5 AS bad_level FROM users"""


def _faulty_users(spark, sf_dir):
    """The users written as CSV lines, some of them faulty, and read back checked."""
    path = _scratch(spark, "faulty")
    u, text = fx.users(spark, sf_dir), lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    sex = F.when((F.col("user_id") % 11 == 3) & F.col("sex").isNotNull(), F.concat(F.lit("x"), text("sex"))) \
        .when((F.col("user_id") % 11 == 4) & F.col("sex").isNotNull(), F.concat(F.lit(" "), text("sex"), F.lit(".0 "))).otherwise(text("sex"))
    level = F.when(F.col("user_id") % 17 == 5, F.concat(text("user_lv_cd"), F.lit(".5"))).otherwise(text("user_lv_cd"))
    day = F.when(F.col("user_id") % 7 == 1, F.lit("2016-13-45")).otherwise(text("user_reg_tm"))
    line = F.concat_ws(",", F.col("user_id").cast("string"), text("age"), sex, level)
    line = F.when(F.col("user_id") % 13 == 6, line).when(F.col("user_id") % 13 == 8, F.concat_ws(",", line, day, F.lit("more"))).otherwise(F.concat_ws(",", line, day))
    u.select(line.alias("value")).write.option("lineSep", "\n").text(path)
    return rd.read_checked(spark, path, rd.USERS_SCHEMA, header=False)


@register("csv_reason_counts", S.with_views(["users"], [("c", CHECKED)], """
    SELECT reason, count(*) AS n_rows FROM (
        SELECT unnest([CASE WHEN is_short OR is_long THEN 'number of fields' END, CASE WHEN bad_sex THEN 'sex: not a int' END, CASE WHEN bad_level THEN 'user_lv_cd: not a int' END,
                       CASE WHEN bad_date THEN 'user_reg_tm: not a date' END, CASE WHEN NOT (is_short OR is_long OR bad_date OR bad_sex OR bad_level) THEN 'good' END]) AS reason FROM c)
    WHERE reason IS NOT NULL GROUP BY reason"""))
def q_csv_reason_counts(spark, sf_dir):
    """How many lines each fault was found in."""
    return rd.reason_counts(_faulty_users(spark, sf_dir))


@register("csv_good_rows", S.with_views(["users"], [("c", CHECKED)], """
    SELECT user_id, age, sex, user_lv_cd, user_reg_tm FROM c WHERE NOT (is_short OR is_long OR bad_date OR bad_sex OR bad_level)"""))
def q_csv_good_rows(spark, sf_dir):
    """The lines without a fault, typed; the others are in the side sink."""
    return rd.quarantine(_faulty_users(spark, sf_dir), _scratch(spark, "quarantine"))


@register("csv_quarantined", S.with_views(["users"], [("c", CHECKED)], """
    SELECT user_id, CAST(CASE WHEN bad_sex THEN NULL ELSE sex END AS INTEGER) AS sex, CASE WHEN is_short OR bad_date THEN NULL ELSE user_reg_tm END AS user_reg_tm,
           CAST(is_short OR is_long AS INTEGER) + CAST(bad_date AS INTEGER) + CAST(bad_sex AS INTEGER) + CAST(bad_level AS INTEGER) AS n_faults
    FROM c WHERE is_short OR is_long OR bad_date OR bad_sex OR bad_level"""))
def q_csv_quarantined(spark, sf_dir):
    """What the side sink holds: what could be read of the faulty lines, and how many faults each has."""
    path = _scratch(spark, "quarantine")
    rd.quarantine(_faulty_users(spark, sf_dir), path)
    return spark.read.parquet(path).select("user_id", "sex", "user_reg_tm", F.size("reasons").alias("n_faults"))


@register("coerced_numbers", S.with_views(["users"], [], """
    SELECT user_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_lv_cd END AS user_lv_cd, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id / 4.0::DOUBLE END AS share FROM users"""))
def q_coerced_numbers(spark, sf_dir):
    """A whole frame of text brought to numbers (P16): what is none becomes NULL."""
    u = fx.users(spark, sf_dir)
    text = u.select(F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(".0")).alias("user_id"),
                    F.when(F.col("user_id") % 5 == 0, F.lit("n/a")).otherwise(F.concat(F.col("user_lv_cd").cast("string"), F.lit("e0"))).alias("user_lv_cd"),
                    F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise((F.col("user_id") / 4.0).cast("string")).alias("share"))
    return rd.coerced(text, rd.T._parse_datatype_string("user_id long, user_lv_cd int, share double"))


# ---- the log by day (S5, S6) ---------------------------------------------------------------------------------

LATE_DAY, RANGE_START, RANGE_END = "2024-01-12", "2024-01-08", "2024-01-18"


@register("log_by_day", S.with_views(["actions"], [], f"SELECT {ACTION_COLS} FROM actions WHERE time >= {S.ts(RANGE_START)} AND time < {S.ts(RANGE_END)}"))
def q_log_by_day(spark, sf_dir):
    """The log stored by day without what came late, its late day written anew, and a range of days read back."""
    path, t = _scratch(spark, "log"), F.col("time")
    actions = fx.actions(spark, sf_dir)
    on_late_day = (F.to_date(t) == F.lit(LATE_DAY).cast("date"))
    rd.write_log_by_day(actions.where(t.isNull() | ~on_late_day | (F.hour(t) < 12)), path)
    rd.replace_days(actions.where(on_late_day), path)
    return rd.read_log(spark, path, RANGE_START, RANGE_END).select(*[c.strip() for c in ACTION_COLS.split(",")])


@register("union_of_month_files", S.with_views(["actions"], [], f"SELECT {ACTION_COLS} FROM actions WHERE time IS NOT NULL"))
def q_union_of_month_files(spark, sf_dir):
    """Periods kept as folders of their own (one a third of the month), put together by column name."""
    path, t = _scratch(spark, "months"), F.col("time")
    actions, bounds = fx.actions(spark, sf_dir), ["0001-01-01", "2024-01-11", "2024-01-21", "9999-01-01"]
    for a, b in zip(bounds, bounds[1:]):
        rd.write_log_by_day(win.time_range(actions, a, b), f"{path}/{a}")
    return rd.union_periods([rd.read_log(spark, f"{path}/{a}") for a in bounds[:-1]]).where(t.isNotNull()).select(*[c.strip() for c in ACTION_COLS.split(",")])


# ---- windows from day partials (A2, A5) ----------------------------------------------------------------------

ROLL_DAYS = 4


@register("rolled_window_counts", _pair_window_sql(P.PAIR_WINDOWS))
def q_rolled_window_counts(spark, sf_dir):
    """The pair windows of END, brought there day by day from those of four days before; the log is read once, to store the days."""
    path = _scratch(spark, "rolled")
    rolling.store_days(fx.actions(spark, sf_dir), path, win.shift_date(END, -ROLL_DAYS - max(P.PAIR_WINDOWS)), END)
    end = win.shift_date(END, -ROLL_DAYS)
    rolling.start_windows(spark, path, end)
    while end < END:
        rolling.advance(spark, path, end)
        end = win.shift_date(end, 1)
    return rolling.read_windows(spark, path, END)


# ---- several periods from one read (E3) ----------------------------------------------------------------------

PERIODS = (pe.PeriodSet("train", "2024-01-11", "2024-01-25", "2024-01-30"), pe.PeriodSet("candidates", "2024-01-04", "2024-01-30"),
           pe.PeriodSet("back 1", "2024-01-01", "2024-01-04", "2024-01-06"), pe.PeriodSet("back 2", "2024-01-06", "2024-01-09", "2024-01-11"))


def _period_sql(p: pe.PeriodSet) -> str:
    first = max(p.start, win.shift_date(p.end, -max(P.PAIR_WINDOWS)))
    cols = ", ".join(f"count(*) FILTER (WHERE type = {k} AND off <= {n}) AS w{n}_action_{k}" for n in P.PAIR_WINDOWS for k in P.TYPES)
    label = "NULL::INTEGER" if p.label_end is None else f"""CAST((user_id, sku_id) IN (SELECT (user_id, sku_id) FROM actions
        WHERE type = 4 AND time >= {S.ts(p.end)} AND time < {S.ts(p.label_end)}) AS INTEGER)"""
    return f"""SELECT '{p.name}' AS period, w.*, {label} AS label FROM (SELECT user_id, sku_id, cate, brand, {cols} FROM (
        SELECT *, {S.off_expr(p.end)} AS off FROM actions WHERE time >= {S.ts(first)} AND time < {S.ts(p.end)}) GROUP BY user_id, sku_id, cate, brand) w"""


@register("period_sets", S.with_views(["actions"], [], " UNION ALL ".join(_period_sql(p) for p in PERIODS)))
def q_period_sets(spark, sf_dir):
    """Training, candidate and two back-test sets from one read of the log."""
    return pe.period_sets(fx.actions(spark, sf_dir), PERIODS)


# ---- review snapshots as of several cut-offs (J8) ------------------------------------------------------------

CUTOFFS = ("1993-02-01", "1995-06-15", "1997-01-01", "1998-11-30", P.COMMENT_CUTOFF)


@register("asof_cutoffs", S.with_views(["comments"], [], " UNION ALL ".join(f"""
    SELECT {S.dt(c)} AS cutoff, * FROM (SELECT sku_id, dt, comment_num, has_bad, bad_rate FROM comments WHERE dt < {S.dt(c)}
    QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY dt DESC) = 1)""" for c in CUTOFFS)))
def q_asof_cutoffs(spark, sf_dir):
    return dims.asof_cutoffs(fx.comments(spark, sf_dir), CUTOFFS)


# ---- second generation's ratios: two behaviours, purchases without the behaviour stay infinite ---------------

SECOND_TYPES = (2, 5)


def _second_sql(key, prefix):
    cnt = ", ".join(S.type_count_cols(P.TYPES, lambda k: f"{prefix}_action_{k}"))
    ratio = ", ".join(f"CASE WHEN {prefix}_action_{k} = 0 THEN (CASE WHEN {prefix}_action_4 = 0 THEN 0.0 ELSE 'inf'::DOUBLE END) "
                      f"ELSE CAST({prefix}_action_4 AS DOUBLE) / {prefix}_action_{k} END AS {prefix}_ratio_{k}" for k in SECOND_TYPES)
    return S.with_views(["actions"], [("r", BLOCK_ROWS_SQL), ("g", f"SELECT {key}, {cnt} FROM r GROUP BY {key}")], f"SELECT *, {ratio} FROM g")


for _key, _prefix in (("cate", "cate"), ("brand", "brand"), ("user_id", "user"), ("sku_id", "sku")):
    register(f"second_ratios_{_prefix}", _second_sql(_key, _prefix))(
        lambda spark, sf_dir, _k=_key, _p=_prefix: ru.rollup(_block_rows(spark, sf_dir), _k, _p, ratio_types=SECOND_TYPES, x_over_zero=float("inf")))
