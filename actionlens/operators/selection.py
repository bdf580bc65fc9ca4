"""Labels, past buyers, semi/anti joins and the submission builder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.functions.expr import decay_weight, pair_key, ts_lit
from actionlens.operators.ranking import top1_per_key, top_k
from actionlens.operators.windows import shift_date, time_range
from actionlens.params import PURCHASE


def purchase_labels(actions: DataFrame, start: str, end: str, cate: str | None = None) -> DataFrame:
    """Distinct (user_id, sku_id) purchased in ``[start, end)`` with label = 1."""
    rows = time_range(actions, start, end).where(F.col("type") == PURCHASE)
    if cate is not None:
        rows = rows.where(F.col("cate") == cate)
    return rows.select("user_id", "sku_id").distinct().withColumn("label", F.lit(1))


def past_buyers(actions: DataFrame, end: str, cate: str | None, start: str | None = None) -> DataFrame:
    """Distinct users who bought (in ``cate``) before ``end`` (and from ``start``)."""
    cond = (F.col("type") == PURCHASE) & (F.col("time") < ts_lit(end))
    if start is not None:
        cond &= F.col("time") >= ts_lit(start)
    if cate is not None:
        cond &= F.col("cate") == cate
    return actions.where(cond).select("user_id").distinct()


def drop_past_buyers(candidates: DataFrame, buyers: DataFrame) -> DataFrame:
    """Candidates whose user has not bought before (NOT EXISTS)."""
    return candidates.join(buyers.select("user_id"), "user_id", "left_anti")


def in_product_subset(candidates: DataFrame, products: DataFrame) -> DataFrame:
    """Candidates whose sku is in the product subset (EXISTS; immune to
    duplicate product rows, unlike an inner join)."""
    return candidates.join(products.select("sku_id"), "sku_id", "left_semi")


def submission(scored: DataFrame, products: DataFrame | None = None,
               buyers: DataFrame | None = None, threshold: float | None = None,
               k: int | None = None, order: str = "desc", score: str = "score") -> DataFrame:
    """Threshold -> product subset -> drop past buyers -> one sku per user -> top k."""
    c = scored
    if threshold is not None:
        c = c.where(F.col(score) >= threshold)
    if products is not None:
        c = in_product_subset(c, products)
    if buyers is not None:
        c = drop_past_buyers(c, buyers)
    one = top1_per_key(c, "user_id", score, order=order)
    return top_k(one, k, score) if k is not None else one


def hash_split(df: DataFrame, test_percent: int = 20, key_cols: Sequence[str] = ("user_id", "sku_id")) -> DataFrame:
    """Deterministic hold-out split: md5 of the pair key, first 32 bits mod 100.

    Unlike ``randomSplit`` it does not depend on partitioning, so a
    recomputed task (or another engine) picks the same rows.
    """
    key = pair_key(*key_cols)
    bucket = (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100).cast("int")
    return df.withColumn("bucket", bucket).withColumn("is_test", (F.col("bucket") < test_percent).cast("int"))


def pair_activity(actions: DataFrame, end: str, score_days: int, history_start: str,
                  label_start: str, label_end: str, buy_cate: str | None) -> DataFrame:
    """One aggregate per (user, sku) that feeds a whole submission round:

    * ``score`` — 1 - exp(-sum of decay weights) over ``[end - score_days, end)``
      (NULL when the pair has no action there), rounded to 6 places;
    * ``past_buy`` — bought (in ``buy_cate``) in ``[history_start, end)``;
    * ``bought`` — bought in the label window ``[label_start, label_end)``.

    The log is read once over the union of the three periods.
    """
    lo = min(history_start, shift_date(end, -score_days), label_start)
    hi = max(end, label_end)
    s0, e, h0 = ts_lit(shift_date(end, -score_days)), ts_lit(end), ts_lit(history_start)
    t = F.col("time")
    in_score = (t >= s0) & (t < e)
    buy = F.col("type") == PURCHASE
    past = buy & (t >= h0) & (t < e)
    if buy_cate is not None:
        past = past & (F.col("cate") == buy_cate)
    label = buy & (t >= ts_lit(label_start)) & (t < ts_lit(label_end))
    rows = time_range(actions, lo, hi).withColumn("wt", F.when(in_score, decay_weight("time", end)))
    agg = rows.groupBy("user_id", "sku_id").agg(
        F.sum("wt").alias("_wt"),
        F.max(F.when(past, 1).otherwise(0)).alias("past_buy"),
        F.max(F.when(label, 1).otherwise(0)).alias("bought"))
    return agg.select("user_id", "sku_id",
                      F.when(F.col("_wt").isNotNull(), F.round(F.lit(1.0) - F.exp(-F.col("_wt")), 6))
                      .alias("score"), "past_buy", "bought")


def scores_of(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("score").isNotNull()).select("user_id", "sku_id", "score")


def buyers_of(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("past_buy") == 1).select("user_id").distinct()


def truth_of(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("bought") == 1).select("user_id", "sku_id")
