"""Registered queries: Spark callables and their DuckDB oracle statements.

Each query takes ``(spark, sf_dir)`` and reads the whole driver tables through
the fixture views; the oracle spells the same result in DuckDB SQL over the
same parquet files (column names match one to one).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens import params as P
from actionlens.functions import expr as X
from actionlens.operators import breadth as br
from actionlens.operators import curves as cv
from actionlens.operators import dims
from actionlens.operators import metrics as mt
from actionlens.operators import profile as pf
from actionlens.operators import rollups as ru
from actionlens.operators import selection as sel
from actionlens.operators import windows as win
from actionlens.operators.ranking import first_in_order, top1_per_key, top_k
from actionlens.plans import features as ft
from actionlens.plans import sqlgen as S
from actionlens.sources import fixtures as fx
from actionlens.sources import readers as rd
from actionlens.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


END = P.FEATURE_END
ACTION_COLS = "user_id, sku_id, time, model_id, type, cate, brand"

# --------------------------------------------------------------------------
# Scans and extracts
# --------------------------------------------------------------------------

EXTRACT_START, EXTRACT_END = "2024-01-05", "2024-01-25"


@register("time_range_extract", S.with_views(["actions"], [], f"""
    SELECT {ACTION_COLS} FROM actions
    WHERE time >= {S.ts(EXTRACT_START)} AND time < {S.ts(EXTRACT_END)}"""))
def q_time_range_extract(spark, sf_dir):
    return win.time_range(fx.actions(spark, sf_dir), EXTRACT_START, EXTRACT_END)


# Three period files of the log (the fixture log spans one month, so the
# "months" are ten-day periods), unioned back into one table with its period.
# The first is open to the past and the last to the future, so no action is left out.
PERIOD_STARTS = (("p2", "2024-01-11"), ("p3", "2024-01-21"))


@register("monthly_union", S.with_views(["actions"], [], f"""
    SELECT {ACTION_COLS}, 'p1' AS period FROM actions WHERE time < {S.ts("2024-01-11")} OR time IS NULL
    UNION ALL SELECT {ACTION_COLS}, 'p2' FROM actions WHERE time >= {S.ts("2024-01-11")} AND time < {S.ts("2024-01-21")}
    UNION ALL SELECT {ACTION_COLS}, 'p3' FROM actions WHERE time >= {S.ts("2024-01-21")}"""))
def q_monthly_union(spark, sf_dir):
    """One scan: the union of the period files, each row with its period."""
    period = F.lit("p1")
    for name, start in PERIOD_STARTS:
        period = F.when(F.col("time") >= X.ts_lit(start), F.lit(name)).otherwise(period)
    return fx.actions(spark, sf_dir).withColumn("period", period)


# --------------------------------------------------------------------------
# Multi-window behaviour counts
# --------------------------------------------------------------------------

def _pair_window_sql(windows, end=END) -> str:
    cols = S.window_count_cols(windows, P.TYPES, lambda n, k: f"w{n}_action_{k}")
    d = (f"SELECT user_id, sku_id, cate, brand, type, {S.off_expr(end)} AS off FROM actions "
         f"WHERE {S.lookback_where(end, max(windows))}")
    return S.with_views(["actions"], [("d", d)], f"""
        SELECT user_id, sku_id, cate, brand, {', '.join(cols)}
        FROM d GROUP BY user_id, sku_id, cate, brand""")


@register("pair_window_counts", _pair_window_sql(P.PAIR_WINDOWS))
def q_pair_window_counts(spark, sf_dir):
    return win.pair_window_counts(fx.actions(spark, sf_dir), END, P.PAIR_WINDOWS)


@register("pair_window_counts_rescan", _pair_window_sql(P.PAIR_WINDOWS))
def q_pair_window_counts_rescan(spark, sf_dir):
    return win.pair_window_counts_rescan(fx.actions(spark, sf_dir), END, P.PAIR_WINDOWS)


@register("pair_window_counts_short", _pair_window_sql(P.SHORT_WINDOWS))
def q_pair_window_counts_short(spark, sf_dir):
    return win.pair_window_counts(fx.actions(spark, sf_dir), END, P.SHORT_WINDOWS)


def _acc_ratio_sql(key: str, prefix: str, windows=P.ACC_WINDOWS, end=END) -> str:
    cols = S.window_count_cols(windows, P.TYPES, lambda n, k: f"{prefix}_w{n}_action_{k}")
    d = (f"SELECT {key}, type, {S.off_expr(end)} AS off FROM actions "
         f"WHERE {S.lookback_where(end, max(windows))}")
    outs = []
    for n in windows:
        p = f"{prefix}_w{n}_action"
        outs.append(f"{p}_4")
        outs += [f"{S.safe_ratio(f'{p}_4', f'{p}_{k}')} AS {p}_ratio_{k}"
                 for k in P.NON_PURCHASE_TYPES]
    return S.with_views(["actions"], [("d", d), ("g", f"SELECT {key}, {', '.join(cols)} FROM d GROUP BY {key}")],
                        f"SELECT {key}, {', '.join(outs)} FROM g")


@register("user_window_ratios", _acc_ratio_sql("user_id", "user"))
def q_user_window_ratios(spark, sf_dir):
    return win.accumulated_ratios(fx.log(spark, sf_dir), "user_id", END, P.ACC_WINDOWS, "user")


@register("sku_window_ratios", _acc_ratio_sql("sku_id", "sku"))
def q_sku_window_ratios(spark, sf_dir):
    return win.accumulated_ratios(fx.log(spark, sf_dir), "sku_id", END, P.ACC_WINDOWS, "sku")


DECAY_DAYS = 21


@register("decayed_counts", S.with_views(["actions"], [("d", f"""
    SELECT user_id, sku_id, cate, brand, type,
           exp(-CAST(date_sub('day', time, {S.ts(END)}) AS DOUBLE)) AS wt
    FROM actions WHERE {S.lookback_where(END, DECAY_DAYS)}""")], f"""
    SELECT user_id, sku_id, cate, brand,
           {', '.join(f'round(sum(CASE WHEN type = {k} THEN wt ELSE 0.0 END), 6) AS decay_action_{k}' for k in P.TYPES)}
    FROM d GROUP BY user_id, sku_id, cate, brand"""))
def q_decayed_counts(spark, sf_dir):
    out = win.decayed_counts(fx.actions(spark, sf_dir), END, DECAY_DAYS)
    return out.select(*win.PAIR_KEYS, *[F.round(f"decay_action_{k}", 6).alias(f"decay_action_{k}")
                                        for k in P.TYPES])


# --------------------------------------------------------------------------
# Labels, buyers, semi / anti joins, selection
# --------------------------------------------------------------------------


CAND_DAYS = 7
SCORE_DAYS = 21
# Three user ids that the query ``user_dimension`` removes (P10); no other query does.
BLOCKED_USERS = (3, 5, 8)


@register("purchase_labels", S.with_views(["actions"], [], f"""
    SELECT DISTINCT user_id, sku_id, 1 AS label FROM actions
    WHERE type = 4 AND time >= {S.ts(P.LABEL_START)} AND time < {S.ts(P.LABEL_END)}"""))
def q_purchase_labels(spark, sf_dir):
    return sel.purchase_labels(fx.log(spark, sf_dir), P.LABEL_START, P.LABEL_END)


BUYERS_SQL = (f"SELECT DISTINCT user_id FROM actions WHERE type = 4 AND cate = '{P.TARGET_CATE}' "
              f"AND time >= {S.ts(P.HISTORY_START)} AND time < {S.ts(END)}")
CAND_SQL = f"SELECT DISTINCT user_id, sku_id FROM actions WHERE {S.lookback_where(END, CAND_DAYS)}"


def _buyers(spark, sf_dir):
    return sel.past_buyers(fx.actions(spark, sf_dir), END, P.TARGET_CATE, P.HISTORY_START)


def _candidates(spark, sf_dir):
    return win.lookback(fx.log(spark, sf_dir), END, CAND_DAYS).select("user_id", "sku_id").distinct()


@register("past_buyers", S.with_views(["actions"], [], BUYERS_SQL))
def q_past_buyers(spark, sf_dir):
    return _buyers(spark, sf_dir)


@register("drop_past_buyers", S.with_views(["actions"], [("b", BUYERS_SQL), ("c", CAND_SQL)], """
    SELECT c.user_id, c.sku_id FROM c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = c.user_id)"""))
def q_drop_past_buyers(spark, sf_dir):
    return sel.drop_past_buyers(_candidates(spark, sf_dir), _buyers(spark, sf_dir))


@register("product_subset_semi", S.with_views(["actions", "target_products"], [("c", CAND_SQL)], """
    SELECT c.user_id, c.sku_id FROM c WHERE EXISTS (SELECT 1 FROM target_products p WHERE p.sku_id = c.sku_id)"""))
def q_product_subset_semi(spark, sf_dir):
    return sel.in_product_subset(_candidates(spark, sf_dir), fx.target_products(spark, sf_dir))


def _case_map(col: str, mapping) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in mapping.items()) + " END"


USER_DIM_SQL_CTES = [
    ("u", f"""SELECT user_id, CAST({_case_map('age', X.SEGMENT_AGE_CODES)} AS INTEGER) AS age, sex, user_lv_cd,
                     CASE WHEN date_diff('day', {S.dt(P.REG_BASE_DATE)}, user_reg_tm) >= 0
                          THEN date_diff('day', {S.dt(P.REG_BASE_DATE)}, user_reg_tm) END AS reg_days
              FROM users"""),
    ("m", "SELECT age, avg(reg_days) AS reg_mean FROM u GROUP BY age"),
    ("ud", """SELECT u.user_id, u.age, u.sex, u.user_lv_cd,
                     CAST(trunc(coalesce(CAST(u.reg_days AS DOUBLE), m.reg_mean)) AS INTEGER) AS user_reg_tm
              FROM u LEFT JOIN m ON u.age IS NOT DISTINCT FROM m.age"""),
]
BLOCKED_DIM_SQL_CTES = [("u", USER_DIM_SQL_CTES[0][1] + f" WHERE user_id NOT IN ({', '.join(map(str, BLOCKED_USERS))})"), *USER_DIM_SQL_CTES[1:]]
USER_DIM_COLS = "user_id, age, sex, user_lv_cd, user_reg_tm, CAST(user_reg_tm AS DOUBLE) / CAST(user_lv_cd AS DOUBLE) AS user_lv_reg"


def _user_dim(spark, sf_dir, block=None):
    return dims.user_dimension(fx.users(spark, sf_dir), P.REG_BASE_DATE, X.SEGMENT_AGE_CODES, block)


@register("user_dimension", S.with_views(["users"], BLOCKED_DIM_SQL_CTES, f"SELECT {USER_DIM_COLS} FROM ud"))
def q_user_dimension(spark, sf_dir):
    return _user_dim(spark, sf_dir, spark.createDataFrame([(u,) for u in BLOCKED_USERS], "user_id bigint"))


@register("age_years", S.with_views(["users"], [], f"""
    SELECT user_id, CAST({_case_map('age', X.SEGMENT_AGE_YEARS)} AS INTEGER) AS age_years FROM users"""))
def q_age_years(spark, sf_dir):
    return fx.users(spark, sf_dir).select("user_id", X.age_years("age", X.SEGMENT_AGE_YEARS).alias("age_years"))


def _onehot_sql(col, values, prefix):
    return [f"CAST(CASE WHEN {col} = {v} THEN 1 ELSE 0 END AS INTEGER) AS {prefix}_{str(v).replace('-', 'm')}"
            for v in values]


PRODUCT_ONEHOT_COLS = ", ".join(["sku_id", "cate", "brand"] + _onehot_sql("a1", dims.A1_VALUES, "a1")
                                + _onehot_sql("a2", dims.A2_VALUES, "a2") + _onehot_sql("a3", dims.A3_VALUES, "a3"))


@register("product_onehot", S.with_views(["products"], [], f"SELECT {PRODUCT_ONEHOT_COLS} FROM products"))
def q_product_onehot(spark, sf_dir):
    return dims.product_onehot(fx.products(spark, sf_dir))


@register("product_clean", S.with_views(["products"], [], """
    SELECT sku_id, CAST(CASE WHEN a1 = -1 THEN 0 ELSE a1 END AS INTEGER) AS a1,
           CAST(CASE WHEN a2 = -1 THEN 0 ELSE a2 END AS INTEGER) AS a2,
           CAST(CASE WHEN a3 = -1 THEN 0 ELSE a3 END AS INTEGER) AS a3, cate, brand
    FROM products"""))
def q_product_clean(spark, sf_dir):
    return dims.product_clean(fx.products(spark, sf_dir))


ASOF_SQL = f"""SELECT sku_id, dt, comment_num, has_bad, bad_rate FROM comments
    WHERE dt < {S.dt(P.COMMENT_CUTOFF)}
    QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY dt DESC) = 1"""


@register("asof_comments", S.with_views(["comments"], [], ASOF_SQL))
def q_asof_comments(spark, sf_dir):
    return dims.asof_snapshot(fx.comments(spark, sf_dir), P.COMMENT_CUTOFF)


@register("snapshot_range_comments", S.with_views(["comments"], [], f"""
    SELECT * FROM comments WHERE dt < {S.dt(P.COMMENT_CUTOFF)}
      AND dt >= (SELECT max(dt) FROM comments WHERE dt < {S.dt(P.COMMENT_CUTOFF)})"""))
def q_snapshot_range_comments(spark, sf_dir):
    return dims.snapshot_range(fx.comments(spark, sf_dir), P.COMMENT_CUTOFF)


COMMENT_FEAT_COLS = ", ".join(["sku_id", "has_bad", "bad_rate"]
                              + _onehot_sql("comment_num", dims.COMMENT_LEVELS, "comment_num"))


@register("comment_onehot", S.with_views(["comments"], [("a", ASOF_SQL)], f"SELECT {COMMENT_FEAT_COLS} FROM a"))
def q_comment_onehot(spark, sf_dir):
    return dims.comment_features(fx.comments(spark, sf_dir), P.COMMENT_CUTOFF)


SCORE_SQL = f"""SELECT user_id, sku_id,
        round(1.0 - exp(-sum(exp(-CAST(date_sub('day', time, {S.ts(END)}) AS DOUBLE)))), 6) AS score
    FROM actions WHERE {S.lookback_where(END, SCORE_DAYS)} GROUP BY user_id, sku_id"""


def _scores(spark, sf_dir):
    return win.intent_score(fx.log(spark, sf_dir), END, SCORE_DAYS)


@register("top1_per_user", S.with_views(["actions"], [("s", SCORE_SQL)], """
    SELECT user_id, sku_id, score FROM s
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, sku_id ASC) = 1"""))
def q_top1_per_user(spark, sf_dir):
    return top1_per_key(_scores(spark, sf_dir), "user_id", "score", order="desc")


@register("low1_per_user", S.with_views(["actions"], [("s", SCORE_SQL)], """
    SELECT user_id, sku_id, score FROM s
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score ASC, sku_id ASC) = 1"""))
def q_low1_per_user(spark, sf_dir):
    return top1_per_key(_scores(spark, sf_dir), "user_id", "score", order="asc")


SUBMISSION_SQL = f"""SELECT user_id, sku_id, score FROM (
        SELECT user_id, sku_id, score FROM s
        WHERE score >= {P.SCORE_THRESHOLD}
          AND sku_id IN (SELECT sku_id FROM target_products)
          AND user_id NOT IN (SELECT user_id FROM b)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, sku_id ASC) = 1)
    ORDER BY score DESC, user_id ASC LIMIT {P.SUBMISSION_K}"""


def _activity(spark, sf_dir):
    """Scores, past buyers and truth from one pinned (user, sku) aggregate:
    each consumer prunes different columns, so without pinning each would
    rescan the log."""
    from actionlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    act = sel.pair_activity(fx.actions(spark, sf_dir), END, SCORE_DAYS, P.HISTORY_START,
                            P.LABEL_START, P.LABEL_END, P.TARGET_CATE)
    return act.checkpoint(eager=True)


def _submission(spark, sf_dir, activity=None):
    act = activity if activity is not None else _activity(spark, sf_dir)
    return sel.submission(sel.scores_of(act), fx.target_products(spark, sf_dir), sel.buyers_of(act),
                          threshold=P.SCORE_THRESHOLD, k=P.SUBMISSION_K)


@register("submission_topk", S.with_views(["actions", "target_products"], [("s", SCORE_SQL), ("b", BUYERS_SQL)],
                                          SUBMISSION_SQL))
def q_submission_topk(spark, sf_dir):
    return _submission(spark, sf_dir)


PAIRS_SQL = f"SELECT DISTINCT user_id, sku_id FROM actions WHERE {S.lookback_where(END, max(P.PAIR_WINDOWS))}"


@register("hash_split", S.with_views(["actions"], [("pr", PAIRS_SQL)], """
    SELECT user_id, sku_id,
           CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(sku_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS INTEGER) AS bucket,
           CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(sku_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 AS INTEGER) AS is_test
    FROM pr"""))
def q_hash_split(spark, sf_dir):
    pairs = win.lookback(fx.log(spark, sf_dir), END, max(P.PAIR_WINDOWS)).select("user_id", "sku_id").distinct()
    return sel.hash_split(pairs)


# --------------------------------------------------------------------------
# Rollups, breadth, ranks
# --------------------------------------------------------------------------


BLOCK_DAYS = 7
BLOCK_ROWS_SQL = f"SELECT * FROM actions WHERE {S.lookback_where(END, BLOCK_DAYS)}"


def _block_rows(spark, sf_dir):
    return win.lookback(fx.actions(spark, sf_dir), END, BLOCK_DAYS)


def _ratio_sel(prefix):
    return ", ".join(f"{S.safe_ratio(f'{prefix}_action_4', f'{prefix}_action_{k}')} AS {prefix}_ratio_{k}"
                     for k in P.NON_PURCHASE_TYPES)


def _rollup_sql(key, prefix):
    cnt = ", ".join(S.type_count_cols(P.TYPES, lambda k: f"{prefix}_action_{k}"))
    return S.with_views(["actions"], [("r", BLOCK_ROWS_SQL), ("g", f"SELECT {key}, {cnt} FROM r GROUP BY {key}")],
                        f"SELECT *, {_ratio_sel(prefix)} FROM g")


def _attr_rollup_sql(attr):
    cnt = ", ".join(S.type_count_cols(P.TYPES, lambda k: f"a_{k}"))
    sums = ", ".join(f"CAST(sum(a_{k}) AS BIGINT) AS {attr}_action_{k}" for k in P.TYPES)
    return S.with_views(["actions", "users"], [("r", BLOCK_ROWS_SQL), *USER_DIM_SQL_CTES,
                        ("pu", f"SELECT user_id, {cnt} FROM r GROUP BY user_id"),
                        ("g", f"SELECT ud.{attr}, {sums} FROM pu JOIN ud ON ud.user_id = pu.user_id "
                              f"WHERE ud.{attr} IS NOT NULL GROUP BY ud.{attr}")],
                        f"SELECT *, {_ratio_sel(attr)} FROM g")


for _key, _prefix in (("cate", "cate"), ("brand", "brand"), ("user_id", "user"), ("sku_id", "sku")):
    register(f"rollup_{_prefix}", _rollup_sql(_key, _prefix))(
        lambda spark, sf_dir, _k=_key, _p=_prefix: ru.rollup(_block_rows(spark, sf_dir), _k, _p))

for _attr, _name in (("age", "age"), ("sex", "sex"), ("user_lv_cd", "level")):
    register(f"rollup_{_name}", _attr_rollup_sql(_attr))(
        lambda spark, sf_dir, _a=_attr: ru.rollup_by_user_attr(_block_rows(spark, sf_dir), _user_dim(spark, sf_dir), _a))


def _grouping_sets_sql():
    cnt = ", ".join(S.type_count_cols(P.TYPES, lambda k: f"a_{k}"))
    sums = ", ".join(f"CAST(sum(a_{k}) AS BIGINT) AS action_{k}" for k in P.TYPES)
    parts = [f"SELECT '{d}' AS dim, CAST({d} AS VARCHAR) AS key, {sums} FROM w GROUP BY {d}"
             for d in ru.GROUPING_DIMS]
    return S.with_views(["actions", "users"], [("r", BLOCK_ROWS_SQL), *USER_DIM_SQL_CTES,
                        ("pr", f"SELECT user_id, sku_id, cate, brand, {cnt} FROM r GROUP BY user_id, sku_id, cate, brand"),
                        ("w", "SELECT pr.*, ud.age, ud.sex, ud.user_lv_cd FROM pr LEFT JOIN ud ON ud.user_id = pr.user_id")],
                        " UNION ALL ".join(parts))


@register("rollup_grouping_sets", _grouping_sets_sql())
def q_rollup_grouping_sets(spark, sf_dir):
    return ru.rollup_long(_block_rows(spark, sf_dir), _user_dim(spark, sf_dir))


@register("model_click_count", S.with_views(["actions"], [("r", BLOCK_ROWS_SQL)], """
    SELECT user_id, sku_id, cate, brand, CAST(sum(CASE WHEN model_id > 0 THEN 1 ELSE 0 END) AS BIGINT) AS model_clicks
    FROM r GROUP BY user_id, sku_id, cate, brand"""))
def q_model_click_count(spark, sf_dir):
    return ru.model_clicks(_block_rows(spark, sf_dir))


for _attr in ("age", "sex"):
    register(f"purchases_by_{_attr}", S.with_views(["actions", "users"], [("r", BLOCK_ROWS_SQL), *USER_DIM_SQL_CTES], f"""
        SELECT ud.{_attr}, CAST(count(*) AS BIGINT) AS purchases FROM r JOIN ud ON ud.user_id = r.user_id
        WHERE r.type = 4 AND ud.{_attr} IS NOT NULL GROUP BY ud.{_attr}"""))(
        lambda spark, sf_dir, _a=_attr: ru.purchases_by_user_attr(_block_rows(spark, sf_dir), _user_dim(spark, sf_dir), _a))


PAIR_TOTALS_SQL = "SELECT user_id, sku_id, cate, brand, count(*) AS sku_total FROM r GROUP BY user_id, sku_id, cate, brand"
BREADTH_CTES = [("r", BLOCK_ROWS_SQL), ("pt", PAIR_TOTALS_SQL),
                ("ub", "SELECT user_id, CAST(sum(sku_total) AS BIGINT) AS action_total, count(*) AS diff_sku FROM pt GROUP BY user_id")]


def _pairs(spark, sf_dir):
    return br.pair_totals(_block_rows(spark, sf_dir))


@register("user_breadth", S.with_views(["actions"], BREADTH_CTES, "SELECT * FROM ub"))
def q_user_breadth(spark, sf_dir):
    return br.user_breadth(_pairs(spark, sf_dir))


def _group_breadth_sql(attr):
    extra_cte, extra_col, extra_join = [], "", ""
    if attr == "brand":
        extra_cte = [("uc", "SELECT user_id, count(*) AS diff_cate FROM (SELECT DISTINCT user_id, cate FROM pt) GROUP BY user_id")]
        extra_col = ", CAST(uc.diff_cate AS DOUBLE) / CAST(u.diff_brand AS DOUBLE) AS cate_brand_ratio"
        extra_join = " JOIN uc ON uc.user_id = p.user_id"
    return S.with_views(["actions"], BREADTH_CTES + extra_cte + [
        ("per", f"SELECT user_id, {attr}, count(DISTINCT sku_id) AS diff_{attr}_total FROM pt GROUP BY user_id, {attr}"),
        ("u", f"SELECT user_id, count(*) AS diff_{attr} FROM per GROUP BY user_id")], f"""
        SELECT p.user_id, p.{attr}, p.diff_{attr}_total, u.diff_{attr},
               CAST(p.diff_{attr}_total AS DOUBLE) / CAST(u.diff_{attr} AS DOUBLE) AS diff_{attr}_ratio,
               CAST(ub.diff_sku AS DOUBLE) / CAST(u.diff_{attr} AS DOUBLE) AS sku_{attr}_ratio{extra_col}
        FROM per p JOIN u ON u.user_id = p.user_id JOIN ub ON ub.user_id = p.user_id{extra_join}""")


for _attr in ("cate", "brand"):
    register(f"{_attr}_breadth", _group_breadth_sql(_attr))(
        lambda spark, sf_dir, _a=_attr: br.group_breadth(_pairs(spark, sf_dir), _a))


@register("sku_rank_in_user", S.with_views(["actions"], BREADTH_CTES, """
    SELECT pt.user_id, pt.sku_id, pt.cate, pt.brand, pt.sku_total,
           CAST(row_number() OVER (PARTITION BY pt.user_id ORDER BY pt.sku_total DESC, pt.sku_id, pt.cate NULLS FIRST, pt.brand NULLS FIRST) - 1 AS INTEGER) AS sku_total_rank,
           CAST(CASE WHEN row_number() OVER (PARTITION BY pt.user_id ORDER BY pt.sku_total DESC, pt.sku_id, pt.cate NULLS FIRST, pt.brand NULLS FIRST) = 1 THEN 1 ELSE 0 END AS INTEGER) AS sku_action_max,
           CAST(pt.sku_total AS DOUBLE) / CAST(ub.action_total AS DOUBLE) AS sku_action_ratio
    FROM pt JOIN ub ON ub.user_id = pt.user_id"""))
def q_sku_rank_in_user(spark, sf_dir):
    return br.sku_rank_in_user(_pairs(spark, sf_dir))


HIST_ROWS_SQL = f"SELECT * FROM actions WHERE time < {S.ts(END)}"


def _history(spark, sf_dir):
    return fx.actions(spark, sf_dir).where(F.col("time") < X.ts_lit(END))


@register("brand_popularity_rank", S.with_views(["actions"], [("r", HIST_ROWS_SQL)], """
    SELECT brand, purchases, CAST(row_number() OVER (ORDER BY purchases, brand NULLS FIRST) - 1 AS INTEGER) AS brand_rank
    FROM (SELECT brand, count(*) FILTER (WHERE type = 4) AS purchases FROM r GROUP BY brand)"""))
def q_brand_popularity_rank(spark, sf_dir):
    return br.brand_popularity_rank(_history(spark, sf_dir))


@register("model_popularity_rank", S.with_views(["actions"], [("r", HIST_ROWS_SQL)], """
    SELECT model_id, n, CAST(row_number() OVER (ORDER BY n, model_id) - 1 AS INTEGER) AS model_rank
    FROM (SELECT coalesce(model_id, 0) AS model_id, count(*) AS n FROM r GROUP BY 1)"""))
def q_model_popularity_rank(spark, sf_dir):
    return br.model_popularity_rank(_history(spark, sf_dir))


# --------------------------------------------------------------------------
# Conversion curves
# --------------------------------------------------------------------------



def _pos_sql(cate):
    extra = f" AND cate = '{cate}'" if cate else ""
    return (f"SELECT DISTINCT user_id, sku_id FROM actions WHERE type = 4{extra} "
            f"AND time >= {S.ts(P.LABEL_START)} AND time < {S.ts(P.LABEL_END)} "
            f"AND sku_id IN (SELECT sku_id FROM target_products)")


CURVE_TYPES = ", ".join(f"({t})" for t in P.NON_PURCHASE_TYPES)
CURVE_GRID = (f"SELECT CAST(n AS INTEGER) AS n_days, CAST(t AS INTEGER) AS type "
              f"FROM range(1, {P.CURVE_DAYS + 1}) g(n), (VALUES {CURVE_TYPES}) v(t)")
CURVE_ROWS = (f"SELECT user_id, sku_id, type, {S.off_expr(END)} AS off FROM actions "
              f"WHERE {S.lookback_where(END, P.CURVE_DAYS)}")


def _cum_sql(cate):
    return S.with_views(["actions", "target_products"], [
        ("pos", _pos_sql(cate)), ("r", CURVE_ROWS), ("grid", CURVE_GRID),
        ("pm", f"SELECT user_id, sku_id, type, min(off) AS m FROM r WHERE type IN ({', '.join(map(str, P.NON_PURCHASE_TYPES))}) GROUP BY 1, 2, 3"),
        ("c", """SELECT g.n_days, g.type, count(pm.user_id) AS pairs, count(pos.user_id) AS hits
                 FROM grid g LEFT JOIN pm ON pm.type = g.type AND pm.m <= g.n_days
                 LEFT JOIN pos ON pos.user_id = pm.user_id AND pos.sku_id = pm.sku_id
                 GROUP BY g.n_days, g.type""")],
        f"SELECT n_days, type, pairs, hits, {S.safe_ratio('hits', 'pairs')} AS rate FROM c")


def _daily_sql(cate):
    return S.with_views(["actions", "target_products"], [
        ("pos", _pos_sql(cate)), ("r", CURVE_ROWS), ("grid", CURVE_GRID),
        ("pd", "SELECT DISTINCT user_id, sku_id, type, off FROM r"),
        ("c", """SELECT g.n_days, g.type, count(pd.user_id) AS pairs, count(pos.user_id) AS hits
                 FROM grid g LEFT JOIN pd ON pd.type = g.type AND pd.off = g.n_days
                 LEFT JOIN pos ON pos.user_id = pd.user_id AND pos.sku_id = pd.sku_id
                 GROUP BY g.n_days, g.type""")],
        f"SELECT n_days, type, pairs, hits, {S.safe_ratio('hits', 'pairs')} AS rate FROM c")


def _curve_table(spark, sf_dir, cate):
    actions = fx.log(spark, sf_dir) if cate is None else fx.actions(spark, sf_dir)
    return cv.curve_table(actions, fx.target_products(spark, sf_dir), END, P.CURVE_DAYS,
                          P.LABEL_START, P.LABEL_END, cate)


for _suffix, _cate in (("", None), ("_target", P.TARGET_CATE)):
    register(f"conversion_cumulative{_suffix}", _cum_sql(_cate))(
        lambda spark, sf_dir, _c=_cate: cv.cumulative_from_table(_curve_table(spark, sf_dir, _c), P.CURVE_DAYS))
    register(f"conversion_daily{_suffix}", _daily_sql(_cate))(
        lambda spark, sf_dir, _c=_cate: cv.daily_from_table(_curve_table(spark, sf_dir, _c), P.CURVE_DAYS))


@register("conversion_rows", S.with_views(["actions", "target_products"], [
    ("pos", _pos_sql(None)), ("r", CURVE_ROWS),
    ("d", """SELECT CAST(r.off AS INTEGER) AS n_days, count(*) AS day_rows, count(pos.user_id) AS day_hit_rows
             FROM r LEFT JOIN pos ON pos.user_id = r.user_id AND pos.sku_id = r.sku_id GROUP BY 1"""),
    ("g", f"SELECT CAST(n AS INTEGER) AS n_days FROM range(1, {P.CURVE_DAYS + 1}) t(n)")], """
    SELECT g.n_days,
           CAST(sum(coalesce(d.day_rows, 0)) OVER (ORDER BY g.n_days) AS BIGINT) AS window_rows,
           CAST(sum(coalesce(d.day_hit_rows, 0)) OVER (ORDER BY g.n_days) AS BIGINT) AS window_hit_rows,
           CAST(coalesce(d.day_rows, 0) AS BIGINT) AS day_rows,
           CAST(coalesce(d.day_hit_rows, 0) AS BIGINT) AS day_hit_rows
    FROM g LEFT JOIN d ON d.n_days = g.n_days"""))
def q_conversion_rows(spark, sf_dir):
    return cv.rows_from_table(_curve_table(spark, sf_dir, None), P.CURVE_DAYS)


# --------------------------------------------------------------------------
# Profiles, feature tables, metrics
# --------------------------------------------------------------------------


DESCRIBE_COLS = ("comment_num", "bad_rate")


@register("describe_value", S.with_views(["comments"], [], " UNION ALL ".join(f"""
    SELECT '{c}' AS col_name, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
           round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
           round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS max
    FROM (SELECT CAST({c} AS DOUBLE) AS x FROM comments)""" for c in DESCRIBE_COLS)))
def q_describe_value(spark, sf_dir):
    return pf.describe(fx.comments(spark, sf_dir), DESCRIBE_COLS).withColumnRenamed("column", "col_name")


def _feature_set_ctes(end=END, pair_windows=P.PAIR_WINDOWS, acc_windows=P.ACC_WINDOWS):
    longest = max(max(pair_windows), max(acc_windows))
    d = (f"SELECT user_id, sku_id, cate, brand, type, {S.off_expr(end)} AS off FROM actions "
         f"WHERE {S.lookback_where(end, longest)}")
    pcols = S.window_count_cols(pair_windows, P.TYPES, lambda n, k: f"w{n}_action_{k}")
    ctes = [("d", d), ("pair", f"SELECT user_id, sku_id, cate, brand, {', '.join(pcols)} FROM d "
                               f"WHERE off <= {max(pair_windows)} GROUP BY user_id, sku_id, cate, brand")]
    fill = []
    for key, prefix in (("user_id", "user"), ("sku_id", "sku")):
        cols = S.window_count_cols(acc_windows, P.TYPES, lambda n, k, p=prefix: f"{p}_w{n}_action_{k}")
        outs = []
        for n in acc_windows:
            p = f"{prefix}_w{n}_action"
            outs.append(f"{p}_4")
            outs += [f"{S.safe_ratio(f'{p}_4', f'{p}_{k}')} AS {p}_ratio_{k}" for k in P.NON_PURCHASE_TYPES]
        ctes.append((f"{prefix}_g", f"SELECT {key}, {', '.join(cols)} FROM d GROUP BY {key}"))
        ctes.append((f"{prefix}_f", f"SELECT {key}, {', '.join(outs)} FROM {prefix}_g"))
        for n in acc_windows:
            p = f"{prefix}_w{n}_action"
            fill.append((f"{prefix}_f", f"{p}_4", "0"))
            fill += [(f"{prefix}_f", f"{p}_ratio_{k}", "0.0") for k in P.NON_PURCHASE_TYPES]
    sel_cols = ", ".join(f"coalesce({t}.{c}, {z}) AS {c}" for t, c, z in fill)
    ctes.append(("fs", f"""SELECT pair.*, {sel_cols} FROM pair
                           LEFT JOIN user_f ON user_f.user_id = pair.user_id
                           LEFT JOIN sku_f ON sku_f.sku_id = pair.sku_id"""))
    return ctes


@register("feature_set", S.with_views(["actions"], _feature_set_ctes(), "SELECT * FROM fs"))
def q_feature_set(spark, sf_dir):
    return ft.feature_set(fx.actions(spark, sf_dir), END)


def _dimension_ctes():
    return [*USER_DIM_SQL_CTES,
            ("ud2", f"SELECT {USER_DIM_COLS} FROM ud"),
            ("po", f"SELECT {PRODUCT_ONEHOT_COLS} FROM products"),
            ("ca", ASOF_SQL),
            ("cf", f"SELECT {COMMENT_FEAT_COLS} FROM ca")]


def _dimension_select():
    ucols = [("age", "0"), ("sex", "0"), ("user_lv_cd", "0"), ("user_reg_tm", "0"), ("user_lv_reg", "0.0")]
    pcols = [(c.split(" AS ")[-1], "0") for c in PRODUCT_ONEHOT_COLS.split(", ")[3:]]
    ccols = [("has_bad", "0"), ("bad_rate", "0.0")] + [(f"comment_num_{k}", "0") for k in dims.COMMENT_LEVELS]
    parts = ([f"coalesce(ud2.{c}, {z}) AS {c}" for c, z in ucols]
             + [f"coalesce(po.{c}, {z}) AS {c}" for c, z in pcols]
             + [f"coalesce(cf.{c}, {z}) AS {c}" for c, z in ccols])
    joins = """LEFT JOIN ud2 ON ud2.user_id = fs.user_id
               LEFT JOIN po ON po.sku_id = fs.sku_id
               LEFT JOIN cf ON cf.sku_id = fs.sku_id"""
    return ", ".join(parts), joins


def _train_sql():
    cols, joins = _dimension_select()
    lab = (f"SELECT DISTINCT user_id, sku_id, 1 AS label FROM actions WHERE type = 4 "
           f"AND time >= {S.ts(P.LABEL_START)} AND time < {S.ts(P.LABEL_END)}")
    return S.with_views(["actions", "users", "products", "comments"],
                        _feature_set_ctes() + _dimension_ctes() + [("lab", lab)], f"""
        SELECT fs.*, {cols}, coalesce(lab.label, 0) AS label FROM fs {joins}
        LEFT JOIN lab ON lab.user_id = fs.user_id AND lab.sku_id = fs.sku_id""")


def _candidate_sql():
    cols, joins = _dimension_select()
    return S.with_views(["actions", "users", "products", "comments"],
                        _feature_set_ctes() + _dimension_ctes(), f"""
        SELECT fs.*, {cols} FROM fs {joins} WHERE fs.cate = '{P.TARGET_CATE}'""")


def _dims(spark, sf_dir):
    return _user_dim(spark, sf_dir), fx.products(spark, sf_dir), fx.comments(spark, sf_dir)


def _train(spark, sf_dir, end=END, label_start=P.LABEL_START, label_end=P.LABEL_END):
    return ft.train_set(fx.actions(spark, sf_dir), *_dims(spark, sf_dir), end, label_start, label_end,
                        P.COMMENT_CUTOFF)


@register("train_set", _train_sql())
def q_train_set(spark, sf_dir):
    return _train(spark, sf_dir)


@register("candidate_set", _candidate_sql())
def q_candidate_set(spark, sf_dir):
    return ft.candidate_set(fx.actions(spark, sf_dir), *_dims(spark, sf_dir), END, P.COMMENT_CUTOFF)


TRUTH_SQL = (f"SELECT DISTINCT user_id, sku_id FROM actions WHERE type = 4 "
             f"AND time >= {S.ts(P.LABEL_START)} AND time < {S.ts(P.LABEL_END)}")
METRIC_CTES = [("s", SCORE_SQL), ("b", BUYERS_SQL), ("pred", SUBMISSION_SQL), ("truth", TRUTH_SQL)]


def _metric_sql(counts: str, prec: str) -> str:
    return S.with_views(["actions", "target_products"], METRIC_CTES + [("c", counts), ("pr", prec), ("f", """
        SELECT *, CASE WHEN 5.0 * user_recall + 1.0 * user_precision = 0 THEN 0.0
                       ELSE 6.0 * user_recall * user_precision / (5.0 * user_recall + 1.0 * user_precision) END AS f11,
                  CASE WHEN 2.0 * pair_recall + 3.0 * pair_precision = 0 THEN 0.0
                       ELSE 5.0 * pair_recall * pair_precision / (2.0 * pair_recall + 3.0 * pair_precision) END AS f12
        FROM pr""")], """
        SELECT * EXCLUDE (user_precision, user_recall, pair_precision, pair_recall, f11, f12),
               round(user_precision, 9) AS user_precision, round(user_recall, 9) AS user_recall,
               round(pair_precision, 9) AS pair_precision, round(pair_recall, 9) AS pair_recall,
               round(f11, 9) AS f11, round(f12, 9) AS f12, round(0.4 * f11 + 0.6 * f12, 9) AS score
        FROM f""")


def _div_sql(a, b):
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


@register("score_metrics", _metric_sql("""
    SELECT (SELECT count(*) FROM pred) AS pred_rows, (SELECT count(*) FROM truth) AS truth_rows,
           (SELECT count(*) FROM pred JOIN truth ON truth.user_id = pred.user_id) AS user_hits,
           (SELECT count(*) FROM pred JOIN truth ON truth.user_id = pred.user_id AND truth.sku_id = pred.sku_id) AS pair_hits""",
    f"""SELECT *, {_div_sql('user_hits', 'pred_rows')} AS user_precision, {_div_sql('user_hits', 'truth_rows')} AS user_recall,
               {_div_sql('pair_hits', 'pred_rows')} AS pair_precision, {_div_sql('pair_hits', 'truth_rows')} AS pair_recall
        FROM c"""))
def q_score_metrics(spark, sf_dir):
    act = _activity(spark, sf_dir)
    return mt.score_rows(_submission(spark, sf_dir, act), sel.truth_of(act))


@register("report_metrics", _metric_sql("""
    SELECT (SELECT count(DISTINCT user_id) FROM pred) AS pred_users, (SELECT count(DISTINCT user_id) FROM truth) AS truth_users,
           (SELECT count(*) FROM (SELECT DISTINCT user_id FROM pred) p WHERE user_id IN (SELECT user_id FROM truth)) AS user_hits,
           (SELECT count(*) FROM pred) AS pred_rows, (SELECT count(*) FROM truth) AS truth_rows,
           (SELECT count(*) FROM pred WHERE (user_id, sku_id) IN (SELECT (user_id, sku_id) FROM truth)) AS pair_hits""",
    f"""SELECT *, {_div_sql('user_hits', 'pred_users')} AS user_precision, {_div_sql('user_hits', 'truth_users')} AS user_recall,
               {_div_sql('pair_hits', 'pred_rows')} AS pair_precision, {_div_sql('pair_hits', 'truth_rows')} AS pair_recall
        FROM c"""))
def q_report_metrics(spark, sf_dir):
    act = _activity(spark, sf_dir)
    return mt.score_sets(_submission(spark, sf_dir, act), sel.truth_of(act))


# --------------------------------------------------------------------------
# Sources and sinks (written to the shared folder and read back), previews
# --------------------------------------------------------------------------


def _scratch(spark, name):
    import uuid
    from actionlens.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_actions", S.with_views(["actions"], [], f"SELECT {ACTION_COLS} FROM actions"))
def q_csv_actions(spark, sf_dir):
    """The log written as one CSV folder a period (append sink), read back as one multi-file scan."""
    path = _scratch(spark, "csv")
    a = fx.actions(spark, sf_dir)
    t = F.col("time")
    rd.write_csv(a.where((t < X.ts_lit("2024-01-16")) | t.isNull()), path)
    rd.write_csv(a.where(t >= X.ts_lit("2024-01-16")), path, mode="append")
    return rd.read_csv(spark, path, rd.ACTIONS_SCHEMA)


@register("csv_users_gbk", S.with_views(["users"], [], "SELECT user_id, age || '岁' AS age, sex, user_lv_cd, user_reg_tm FROM users"))
def q_csv_users_gbk(spark, sf_dir):
    path = _scratch(spark, "gbk")
    users = fx.users(spark, sf_dir).withColumn("age", F.concat("age", F.lit("岁")))
    rd.write_csv(users.select(*rd.USERS_SCHEMA.fieldNames()), path, encoding="GBK")
    return rd.read_csv(spark, path, rd.USERS_SCHEMA, encoding="GBK")


@register("csv_pruned_columns", S.with_views(["actions"], [], "SELECT user_id, sku_id, type FROM actions"))
def q_csv_pruned_columns(spark, sf_dir):
    path = _scratch(spark, "pruned")
    rd.write_columns(fx.actions(spark, sf_dir), ["user_id", "sku_id", "type"], path, header=True)
    return rd.read_csv(spark, path, rd.T.StructType([f for f in rd.ACTIONS_SCHEMA if f.name in ("user_id", "sku_id", "type")]))


@register("split_sink", S.with_views(["actions"], [("lab", f"SELECT DISTINCT user_id, sku_id, 1 AS label FROM actions WHERE type = 4 "
                                                         f"AND time >= {S.ts(P.LABEL_START)} AND time < {S.ts(P.LABEL_END)}"),
                                                  ("s", SCORE_SQL)], """
    SELECT s.user_id, s.sku_id, s.score, coalesce(lab.label, 0) AS label FROM s LEFT JOIN lab ON lab.user_id = s.user_id AND lab.sku_id = s.sku_id"""))
def q_split_sink(spark, sf_dir):
    """Ids, features and labels written apart, read back and put together by row."""
    path = _scratch(spark, "split")
    labels = sel.purchase_labels(fx.log(spark, sf_dir), P.LABEL_START, P.LABEL_END)
    rd.write_split(_scores(spark, sf_dir).join(labels, ["user_id", "sku_id"], "left").na.fill(0, ["label"]), path, ["user_id", "sku_id"], "label")
    part = lambda name: spark.read.parquet(f"{path}/{name}")
    return part("ids").join(part("features"), "row").join(part("labels"), "row").drop("row")


@register("memoised_stage", S.with_views(["actions"], [("s", SCORE_SQL)], "SELECT * FROM s"))
def q_memoised_stage(spark, sf_dir):
    path = _scratch(spark, "stage")
    rd.memoised(spark, _scores(spark, sf_dir), path)
    return rd.memoised(spark, _scores(spark, sf_dir).limit(0), path)      # finished: the stored stage is read


@register("preview_actions", S.with_views(["actions"], [], f"""
    SELECT {ACTION_COLS} FROM actions ORDER BY user_id, time, sku_id, type, cate NULLS FIRST, brand NULLS FIRST LIMIT 20"""))
def q_preview_actions(spark, sf_dir):
    """The first 20 rows of the sorted log (S4, O5: a preview is the feature)."""
    return rd.first_rows(fx.actions(spark, sf_dir), 20, ["user_id", "time", "sku_id", "type", "cate", "brand"])


@register("sorted_scores", S.with_views(["actions"], [("s", SCORE_SQL)], "SELECT * FROM s"))
def q_sorted_scores(spark, sf_dir):
    """Global sort sink: scores written in descending order (range partitions) and read back."""
    path = _scratch(spark, "sorted")
    _scores(spark, sf_dir).orderBy(F.desc("score"), "user_id", "sku_id").write.parquet(path)
    return spark.read.parquet(path)


@register("date_text", S.with_views(["users"], [], f"""
    SELECT user_id, try_cast(txt AS DATE) AS day FROM (
        SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'unknown' ELSE CAST(user_reg_tm AS VARCHAR) END AS txt FROM users)"""))
def q_date_text(spark, sf_dir):
    """Dates from text; bad text becomes NULL (D1, P16)."""
    txt = F.when(F.col("user_id") % 7 == 0, F.lit("unknown")).otherwise(F.col("user_reg_tm").cast("string"))
    return fx.users(spark, sf_dir).select("user_id", F.try_to_date(txt, "yyyy-MM-dd").alias("day"))


# --------------------------------------------------------------------------
# Small operators
# --------------------------------------------------------------------------


@register("first_declared_order", S.with_views(["actions"], [], """
    SELECT user_id, sku_id, time, type FROM actions
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY time, sku_id, type) = 1"""))
def q_first_declared_order(spark, sf_dir):
    """W9: each user's first row in a declared order."""
    return first_in_order(fx.log(spark, sf_dir), "user_id", ["time", "sku_id", "type"])


TOP10_SQL = "SELECT * FROM s ORDER BY score DESC, user_id, sku_id LIMIT 10"


@register("top10_scores", S.with_views(["actions"], [("s", SCORE_SQL)], TOP10_SQL))
def q_top10_scores(spark, sf_dir):
    return top_k(_scores(spark, sf_dir), 10, "score", ("user_id", "sku_id"))


for _key in ("cate", "brand"):
    register(f"model_clicks_{_key}", S.with_views(["actions"], [("r", BLOCK_ROWS_SQL)], f"""
        SELECT {_key}, count(*) FILTER (WHERE model_id > 0) AS model_clicks FROM r GROUP BY {_key}"""))(
        lambda spark, sf_dir, _k=_key: ru.model_clicks(_block_rows(spark, sf_dir), [_k]))


@register("rollup_age_all", _attr_rollup_sql("age").replace("WHERE ud.age IS NOT NULL ", ""))
def q_rollup_age_all(spark, sf_dir):
    """The age rollup with the group of unknown age."""
    return ru.rollup_by_user_attr(_block_rows(spark, sf_dir), _user_dim(spark, sf_dir), "age", keep_null=True)


@register("past_buyers_ever", S.with_views(["actions"], [], "SELECT DISTINCT user_id FROM actions WHERE type = 4 AND time < " + S.ts(END)))
def q_past_buyers_ever(spark, sf_dir):
    return sel.past_buyers(fx.log(spark, sf_dir), END, None)


@register("product_onehot_observed", S.with_views(["products"], [], "SELECT sku_id, cate, brand, " + ", ".join(
    f"CAST(coalesce(a{i} = {v}, false) AS INTEGER) AS a{i}_{str(v).replace('-', 'm')}" for i, vs in ((1, (-1, 0, 1, 2)), (2, (0, 1, 2)), (3, (0, 1))) for v in vs) + " FROM products"))
def q_product_onehot_observed(spark, sf_dir):
    """C4: the one-hot domain is what the data holds."""
    products = fx.products(spark, sf_dir)
    return dims.product_onehot(products, *[dims.observed_values(products, c) for c in ("a1", "a2", "a3")])


def _describe_sql(view, cols):
    return S.with_views([view], [], " UNION ALL ".join(f"""
    SELECT '{c}' AS col_name, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
           round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
           round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS max
    FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {view})""" for c in cols))


for _view, _cols in (("actions", ("user_id", "sku_id", "type")), ("users", ("sex", "user_lv_cd")), ("products", ("a1", "a2", "a3"))):
    register(f"describe_{_view}", _describe_sql(_view, _cols))(
        lambda spark, sf_dir, _v=_view, _c=_cols: pf.describe(getattr(fx, _v)(spark, sf_dir), _c).withColumnRenamed("column", "col_name"))


# --------------------------------------------------------------------------
# Single-window feature block (breadth + rank + product + rollups)
# --------------------------------------------------------------------------

def _block_ctes(n: int) -> list[tuple[str, str]]:
    """CTEs of one window's block; the last is ``blk{n}`` with the block's columns."""
    t = lambda name: f"{name}{n}"
    same = lambda x, y, *keys: " AND ".join(f"{x}.{k} IS NOT DISTINCT FROM {y}.{k}" for k in keys)
    cnt = lambda p: ", ".join(S.type_count_cols(P.TYPES, lambda k: f"{p}action_{k}"))
    clicks = "count(*) FILTER (WHERE model_id > 0)"
    ctes = [(t("r"), f"SELECT * FROM actions WHERE {S.lookback_where(END, n)}"),
            (t("c"), f"SELECT user_id, sku_id, cate, brand, {cnt('')}, count(*) AS sku_total, {clicks} AS model_clicks FROM {t('r')} GROUP BY ALL"),
            (t("rk"), f"""SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY sku_total DESC, sku_id, cate NULLS FIRST, brand NULLS FIRST) - 1 AS INTEGER) AS sku_total_rank
                          FROM {t('c')}"""),
            (t("ub"), f"SELECT user_id, CAST(sum(sku_total) AS BIGINT) AS action_total, count(*) AS diff_sku FROM {t('c')} GROUP BY user_id")]
    for key, p in (("user_id", "user"), ("sku_id", "sku")):
        ctes += [(t(f"{p}_g"), f"SELECT {key}, {cnt(p + '_')} FROM {t('r')} GROUP BY {key}"), (t(f"{p}_r"), f"SELECT *, {_ratio_sel(p)} FROM {t(f'{p}_g')}")]
    for key in ("cate", "brand"):
        ctes += [(t(f"{key}_g"), f"SELECT {key}, {cnt(key + '_')}, {clicks} AS {key}_model_clicks FROM {t('r')} GROUP BY {key}"),
                 (t(f"{key}_r"), f"SELECT *, {_ratio_sel(key)} FROM {t(f'{key}_g')}"),
                 (t(f"{key}_b"), f"""SELECT p.*, u.diff_{key}, CAST(p.diff_{key}_total AS DOUBLE) / u.diff_{key} AS diff_{key}_ratio
                     FROM (SELECT user_id, {key}, count(DISTINCT sku_id) AS diff_{key}_total FROM {t('c')} GROUP BY ALL) p
                     JOIN (SELECT user_id, count(*) AS diff_{key} FROM (SELECT DISTINCT user_id, {key} FROM {t('c')}) GROUP BY user_id) u ON u.user_id = p.user_id""")]
    for attr in ("age", "sex"):
        sums = ", ".join(f"CAST(sum(g.user_action_{k}) AS BIGINT) AS {attr}_action_{k}" for k in P.TYPES)
        ctes += [(t(f"{attr}_g"), f"SELECT ud2.{attr}, {sums} FROM {t('user_g')} g JOIN ud2 ON ud2.user_id = g.user_id WHERE ud2.{attr} IS NOT NULL GROUP BY ud2.{attr}"),
                 (t(f"{attr}_r"), f"SELECT *, {_ratio_sel(attr)} FROM {t(f'{attr}_g')}")]
    roll = [f"{t(f'{p}_r')}.{c}" for p in ("cate", "brand", "user", "sku") for c in
            [f"{p}_action_{k}" for k in P.TYPES] + [f"{p}_ratio_{k}" for k in P.NON_PURCHASE_TYPES] + ([f"{p}_model_clicks"] if p in ("cate", "brand") else [])]
    roll += [f"coalesce({t(f'{a}_r')}.{c}, 0) AS {c}" for a in ("age", "sex") for c in
             [f"{a}_action_{k}" for k in P.TYPES] + [f"{a}_ratio_{k}" for k in P.NON_PURCHASE_TYPES]]
    onehot = [c.split(" AS ")[-1] for c in PRODUCT_ONEHOT_COLS.split(", ")[3:]]
    user = [f"coalesce(ud2.{c}, 0) AS {c}" for c in ("age", "sex", "user_lv_cd", "user_reg_tm", "user_lv_reg")]
    ctes.append((f"blk{n}", f"""
        SELECT k.*, CAST(CASE WHEN k.sku_total_rank = 0 THEN 1 ELSE 0 END AS INTEGER) AS sku_action_max, ub.action_total, ub.diff_sku,
               CAST(k.sku_total AS DOUBLE) / CAST(ub.action_total AS DOUBLE) AS sku_action_ratio,
               cb.diff_cate_total, cb.diff_cate, cb.diff_cate_ratio, CAST(ub.diff_sku AS DOUBLE) / cb.diff_cate AS sku_cate_ratio,
               bb.diff_brand_total, bb.diff_brand, bb.diff_brand_ratio, CAST(ub.diff_sku AS DOUBLE) / bb.diff_brand AS sku_brand_ratio,
               CAST(cb.diff_cate AS DOUBLE) / bb.diff_brand AS cate_brand_ratio, coalesce(brank.brand_rank, 0) AS brand_rank,
               {', '.join(f'coalesce(po.{c}, 0) AS {c}' for c in onehot)}, {', '.join(user)}, {', '.join(roll)}
        FROM {t('rk')} k JOIN {t('ub')} ub ON ub.user_id = k.user_id
        JOIN {t('cate_b')} cb ON {same('cb', 'k', 'user_id', 'cate')} JOIN {t('brand_b')} bb ON {same('bb', 'k', 'user_id', 'brand')}
        LEFT JOIN brank ON {same('brank', 'k', 'brand')}
        LEFT JOIN po ON po.sku_id = k.sku_id AND po.cate = k.cate AND po.brand = k.brand
        LEFT JOIN ud2 ON ud2.user_id = k.user_id
        JOIN {t('cate_r')} ON {same(t('cate_r'), 'k', 'cate')} JOIN {t('brand_r')} ON {same(t('brand_r'), 'k', 'brand')}
        JOIN {t('user_r')} ON {t('user_r')}.user_id = k.user_id JOIN {t('sku_r')} ON {t('sku_r')}.sku_id = k.sku_id
        LEFT JOIN {t('age_r')} ON {t('age_r')}.age = ud2.age LEFT JOIN {t('sex_r')} ON {t('sex_r')}.sex = ud2.sex"""))
    return ctes


BLOCK_COMMON = [*USER_DIM_SQL_CTES, ("ud2", f"SELECT {USER_DIM_COLS} FROM ud"), ("po", f"SELECT {PRODUCT_ONEHOT_COLS} FROM products"),
                ("brank", f"""SELECT brand, CAST(row_number() OVER (ORDER BY purchases, brand NULLS FIRST) - 1 AS INTEGER) AS brand_rank
                    FROM (SELECT brand, count(*) FILTER (WHERE type = 4) AS purchases FROM actions WHERE time < {S.ts(END)} GROUP BY brand)""")]


@register("window_block", S.with_views(["actions", "users", "products"], BLOCK_COMMON + _block_ctes(BLOCK_DAYS), f"SELECT * FROM blk{BLOCK_DAYS}"))
def q_window_block(spark, sf_dir):
    return ft.window_block(fx.actions(spark, sf_dir), _user_dim(spark, sf_dir), fx.products(spark, sf_dir),
                           END, BLOCK_DAYS)


def _block_columns() -> list[str]:
    """Columns of a block besides its keys."""
    ratio = lambda p: [f"{p}_action_{k}" for k in P.TYPES] + [f"{p}_ratio_{k}" for k in P.NON_PURCHASE_TYPES]
    onehot = [c.split(" AS ")[-1] for c in PRODUCT_ONEHOT_COLS.split(", ")[3:]]
    return ([f"action_{k}" for k in P.TYPES] + ["sku_total", "model_clicks", "sku_total_rank", "sku_action_max", "action_total", "diff_sku", "sku_action_ratio"]
            + [c for a in ("cate", "brand") for c in (f"diff_{a}_total", f"diff_{a}", f"diff_{a}_ratio", f"sku_{a}_ratio", f"{a}_model_clicks")]
            + ["cate_brand_ratio", "brand_rank", *onehot, "age", "sex", "user_lv_cd", "user_reg_tm", "user_lv_reg"]
            + [c for p in ("cate", "brand", "user", "sku", "age", "sex") for c in ratio(p)])


def _block_set_sql(tail: str = "", extra: str = "", ctes=()) -> str:
    longest = max(P.SHORT_WINDOWS)
    cols = [f"coalesce(blk{n}.{c}, 0) AS w{n}_{c}" for n in P.SHORT_WINDOWS for c in _block_columns()]
    joins = " ".join(f"LEFT JOIN blk{n} ON " + " AND ".join(f"blk{n}.{k} IS NOT DISTINCT FROM blk{longest}.{k}" for k in win.PAIR_KEYS)
                     for n in P.SHORT_WINDOWS if n != longest)
    keys = ", ".join(f"blk{longest}.{k}" for k in win.PAIR_KEYS)
    return S.with_views(["actions", "users", "products"], BLOCK_COMMON + [c for n in P.SHORT_WINDOWS for c in _block_ctes(n)] + list(ctes),
                        f"SELECT {keys}, {', '.join(cols)}{extra} FROM blk{longest} {joins} {tail}")


def _block_args(spark, sf_dir):
    return fx.actions(spark, sf_dir), _user_dim(spark, sf_dir), fx.products(spark, sf_dir), END


@register("window_block_set", _block_set_sql())
def q_window_block_set(spark, sf_dir):
    return ft.window_block_set(*_block_args(spark, sf_dir))


@register("block_train_set", _block_set_sql(
    f"LEFT JOIN lab ON lab.user_id = blk{max(P.SHORT_WINDOWS)}.user_id AND lab.sku_id = blk{max(P.SHORT_WINDOWS)}.sku_id", ", coalesce(lab.label, 0) AS label",
    [("lab", f"SELECT DISTINCT user_id, sku_id, 1 AS label FROM actions WHERE type = 4 AND time >= {S.ts(P.LABEL_START)} AND time < {S.ts(P.LABEL_END)}")]))
def q_block_train_set(spark, sf_dir):
    return ft.block_train_set(*_block_args(spark, sf_dir), P.LABEL_START, P.LABEL_END)


@register("block_candidate_set", _block_set_sql(f"WHERE blk{max(P.SHORT_WINDOWS)}.cate = '{P.TARGET_CATE}'"))
def q_block_candidate_set(spark, sf_dir):
    return ft.block_candidate_set(*_block_args(spark, sf_dir))


# --------------------------------------------------------------------------
# Incremental ingestion (Structured Streaming, file source)
# --------------------------------------------------------------------------



def _events_to_actions(spark, sf_dir):
    def conv(batch):
        return fx.actions_from_events(batch, spark.read.parquet(f"{sf_dir}/part.parquet"))
    return conv


@register("streaming_day_counts", S.with_views(["actions"], [], f"""
    SELECT user_id, sku_id, cate, brand, CAST(time AS DATE) AS day,
           {', '.join(f'count(*) FILTER (WHERE type = {k}) AS n_{k}' for k in P.TYPES)}
    FROM actions GROUP BY user_id, sku_id, cate, brand, CAST(time AS DATE)"""))
def q_streaming_day_counts(spark, sf_dir):
    import uuid
    from actionlens.session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # The driver folder holds one file per table; a glob selects the events
    # file(s), as a landing folder of log files would.
    src = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/event[s]*.parquet")
    q = ingest.ingest_day_counts(spark, src, _events_to_actions(spark, sf_dir), f"{base}/sink", f"{base}/ckpt")
    q.awaitTermination()
    return ingest.read_day_counts(spark, f"{base}/sink").drop("batch")
