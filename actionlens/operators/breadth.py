"""Per-user breadth and rank features (distinct skus, categories, brands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.operators.ranking import rank_within
from actionlens.operators.windows import PAIR_KEYS
from actionlens.params import PURCHASE


def pair_totals(rows: DataFrame) -> DataFrame:
    """user_id, sku_id, cate, brand, sku_total (actions on the pair)."""
    return rows.groupBy(*PAIR_KEYS).agg(F.count(F.lit(1)).alias("sku_total"))


def user_breadth(pairs: DataFrame, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """user_id, action_total (actions), diff_sku (distinct products)."""
    return pairs.groupBy(*by).agg(F.sum("sku_total").cast("bigint").alias("action_total"),
                                        F.count(F.lit(1)).alias("diff_sku"))


def _ratio(a, b):
    return (F.col(a).cast("double") / F.col(b).cast("double"))


def group_breadth(pairs: DataFrame, attr: str, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """Per (user, attr): distinct skus; per user: distinct attr values; ratios.

    attr is ``cate`` or ``brand``; a product seen under several values of the
    other attribute counts once, and NULL is a value like any other.  Columns:
    diff_{attr}_total, diff_{attr}, diff_{attr}_ratio, sku_{attr}_ratio (and
    cate_brand_ratio for brand).  All are aggregates + user-keyed joins (no
    per-user window).  ``by`` names the user and what else tells tables apart that are held in one.
    """
    by = list(by)
    per = pairs.select(*by, "sku_id", attr).distinct().groupBy(*by, attr).agg(F.count(F.lit(1)).alias(f"diff_{attr}_total"))
    per_user = per.groupBy(*by).agg(F.count(F.lit(1)).alias(f"diff_{attr}"))
    out = (per.join(per_user, by).join(user_breadth(pairs, by).select(*by, "diff_sku"), by)
           .withColumn(f"diff_{attr}_ratio", _ratio(f"diff_{attr}_total", f"diff_{attr}"))
           .withColumn(f"sku_{attr}_ratio", _ratio("diff_sku", f"diff_{attr}")))
    if attr == "brand":
        cates = pairs.select(*by, "cate").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("diff_cate"))
        out = out.join(cates, by).withColumn("cate_brand_ratio", _ratio("diff_cate", "diff_brand")) \
                 .drop("diff_cate")
    return out.drop("diff_sku")


def sku_rank_in_user(pairs: DataFrame) -> DataFrame:
    """Rank of each product inside its user by action count (0 = most acted on).

    Ties go to the smaller sku id.  Also the top flag and the product's share
    of the user's actions.
    """
    # Totals are joined before ranking, so the pinned (checkpointed) table
    # carries them and nothing downstream goes back to the log.
    totals = user_breadth(pairs).select("user_id", "action_total")
    ranked = rank_within(pairs.join(totals, "user_id"), ["user_id"],
                         [F.col("sku_total").desc(), F.col("sku_id"), F.col("cate"), F.col("brand")],
                         name="sku_total_rank")
    return (ranked
            .withColumn("sku_action_max", F.when(F.col("sku_total_rank") == 0, 1).otherwise(0).cast("int"))
            .withColumn("sku_action_ratio", _ratio("sku_total", "action_total"))
            .drop("action_total"))


def brand_popularity_rank(rows: DataFrame) -> DataFrame:
    """Brands ranked by purchases ascending (0-based; ties by brand)."""
    agg = rows.groupBy("brand").agg(F.count_if(F.col("type") == PURCHASE).alias("purchases"))
    return rank_within(agg, [], [F.col("purchases"), F.col("brand")], name="brand_rank")


def model_popularity_rank(rows: DataFrame) -> DataFrame:
    """Model ids (missing -> 0) ranked by row count ascending (0-based)."""
    agg = (rows.select(F.coalesce(F.col("model_id"), F.lit(0)).alias("model_id"))
           .groupBy("model_id").agg(F.count(F.lit(1)).alias("n")))
    return rank_within(agg, [], [F.col("n"), F.col("model_id")], name="model_rank")
