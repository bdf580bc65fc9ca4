"""Submission scoring: precision / recall on users and on (user, sku) pairs.

Both metrics need only counts per user and per pair, so predictions and truth
are tagged, unioned and aggregated (two-phase, skew-safe) instead of joined
row by row: a pair predicted p times and true t times contributes p*t
matches to a row-count join, and a user contributes P_u * T_u.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tagged_counts(pred: DataFrame, truth: DataFrame) -> DataFrame:
    tagged = (pred.select("user_id", "sku_id", F.lit(1).alias("p"), F.lit(0).alias("t"))
              .unionByName(truth.select("user_id", "sku_id", F.lit(0).alias("p"), F.lit(1).alias("t"))))
    return tagged.groupBy("user_id", "sku_id").agg(F.sum("p").alias("np"), F.sum("t").alias("nt"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _f(p: Column, r: Column, a: float, b: float, c: float) -> Column:
    """a*P*R / (b*R + c*P), 0 when the denominator is 0."""
    den = F.lit(b) * r + F.lit(c) * p
    return F.when(den == 0, F.lit(0.0)).otherwise(F.lit(a) * r * p / den)


# F11 = 6PR / (5R + P) on users, F12 = 5PR / (2R + 3P) on
# pairs, score = 0.4 F11 + 0.6 F12.
F11_WEIGHTS = (6.0, 5.0, 1.0)
F12_WEIGHTS = (5.0, 2.0, 3.0)
SCORE_WEIGHTS = (0.4, 0.6)


def _scores(df: DataFrame, digits: int) -> DataFrame:
    f11 = _f(F.col("user_precision"), F.col("user_recall"), *F11_WEIGHTS)
    f12 = _f(F.col("pair_precision"), F.col("pair_recall"), *F12_WEIGHTS)
    out = df.withColumn("f11", f11).withColumn("f12", f12) \
            .withColumn("score", F.lit(SCORE_WEIGHTS[0]) * F.col("f11") + F.lit(SCORE_WEIGHTS[1]) * F.col("f12"))
    dbl = ["user_precision", "user_recall", "pair_precision", "pair_recall", "f11", "f12", "score"]
    return out.select(*[F.round(c, digits).alias(c) if c in dbl else F.col(c) for c in out.columns])


def score_rows(pred: DataFrame, truth: DataFrame, digits: int = 9) -> DataFrame:
    """Row-count form: matches are join rows (duplicates multiply)."""
    pairs = _tagged_counts(pred, truth)
    users = pairs.groupBy("user_id").agg(F.sum("np").alias("pu"), F.sum("nt").alias("tu"),
                                         F.sum(F.col("np") * F.col("nt")).alias("pair_hits"))
    tot = users.agg(F.sum("pu").cast("bigint").alias("pred_rows"),
                    F.sum("tu").cast("bigint").alias("truth_rows"),
                    F.sum(F.col("pu") * F.col("tu")).cast("bigint").alias("user_hits"),
                    F.sum("pair_hits").cast("bigint").alias("pair_hits"))
    tot = tot.select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in tot.columns])
    return _scores(tot.select(
        "*",
        _div(F.col("user_hits"), F.col("pred_rows")).alias("user_precision"),
        _div(F.col("user_hits"), F.col("truth_rows")).alias("user_recall"),
        _div(F.col("pair_hits"), F.col("pred_rows")).alias("pair_precision"),
        _div(F.col("pair_hits"), F.col("truth_rows")).alias("pair_recall")), digits)


def score_sets(pred: DataFrame, truth: DataFrame, digits: int = 9) -> DataFrame:
    """Set form: users as distinct sets; every predicted row is tested for
    membership in the true pairs, recall over all true rows."""
    pairs = _tagged_counts(pred, truth)
    users = pairs.groupBy("user_id").agg(F.sum("np").alias("pu"), F.sum("nt").alias("tu"),
                                         F.sum(F.when(F.col("nt") > 0, F.col("np")).otherwise(0)).alias("ph"))
    tot = users.agg(
        F.count_if(F.col("pu") > 0).alias("pred_users"),
        F.count_if(F.col("tu") > 0).alias("truth_users"),
        F.count_if((F.col("pu") > 0) & (F.col("tu") > 0)).alias("user_hits"),
        F.sum("pu").cast("bigint").alias("pred_rows"),
        F.sum("tu").cast("bigint").alias("truth_rows"),
        F.sum("ph").cast("bigint").alias("pair_hits"))
    tot = tot.select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in tot.columns])
    return _scores(tot.select(
        "*",
        _div(F.col("user_hits"), F.col("pred_users")).alias("user_precision"),
        _div(F.col("user_hits"), F.col("truth_users")).alias("user_recall"),
        _div(F.col("pair_hits"), F.col("pred_rows")).alias("pair_precision"),
        _div(F.col("pair_hits"), F.col("truth_rows")).alias("pair_recall")), digits)
