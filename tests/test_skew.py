"""A third of the log on one user: results still equal a brute-force DuckDB run."""

import duckdb
from pyspark.sql import functions as F

from actionlens import params as P
from actionlens.operators import breadth as br, windows as win
from actionlens.plans import features as ft
from actionlens.sources import fixtures as fx
from tests.conftest import SF_MID


def _skewed(spark, tmp_path):
    a = fx.actions(spark, SF_MID)
    hot = (F.abs(F.hash("time", "sku_id")) % 3 == 0)
    df = a.withColumn("user_id", F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("user_id")))
    path = str(tmp_path / "skewed")
    df.write.parquet(path)
    return spark.read.parquet(path), path


def test_rank_and_features_under_a_hot_user(spark, tmp_path):
    df, path = _skewed(spark, tmp_path)
    share = df.where("user_id = 1").count() / df.count()
    assert share > 0.3
    con = duckdb.connect()
    con.execute(f"CREATE VIEW actions AS SELECT * FROM read_parquet('{path}/*.parquet')")

    end = P.FEATURE_END
    rows = win.lookback(df, end, 7)
    ranked = br.sku_rank_in_user(br.pair_totals(rows)).select("user_id", "sku_id", "cate", "brand",
                                                               "sku_total", "sku_total_rank")
    want = con.execute(f"""
        SELECT user_id, sku_id, cate, brand, count(*) AS sku_total,
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, sku_id, cate NULLS FIRST, brand NULLS FIRST) - 1 AS r
        FROM actions WHERE time >= TIMESTAMP '2024-01-18' AND time < TIMESTAMP '{end}'
        GROUP BY user_id, sku_id, cate, brand""").fetchall()
    got = {(r.user_id, r.sku_id, r.cate, r.brand): (r.sku_total, r.sku_total_rank) for r in ranked.collect()}
    assert got == {(u, s, c, b): (n, r) for u, s, c, b, n, r in want}

    fs = ft.feature_set(df, end, (1, 7), (3, 30))
    hot_user = fs.where("user_id = 1").agg(F.sum("w7_action_1"), F.max("user_w30_action_4")).first()
    want_hot = con.execute(f"""
        SELECT (SELECT count(*) FROM actions WHERE user_id = 1 AND type = 1
                  AND time >= TIMESTAMP '2024-01-18' AND time < TIMESTAMP '{end}'),
               (SELECT count(*) FROM actions WHERE user_id = 1 AND type = 4
                  AND time >= TIMESTAMP '2023-12-26' AND time < TIMESTAMP '{end}')""").fetchone()
    assert (hot_user[0], hot_user[1]) == want_hot
