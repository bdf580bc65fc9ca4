"""Behaviour rollups per category, brand, user, sku and user attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.functions.expr import flag_positive, safe_ratio_sql
from actionlens.operators.windows import PAIR_KEYS, type_counts
from actionlens.params import NON_PURCHASE_TYPES, PURCHASE, TYPES


def with_ratios(df: DataFrame, prefix: str, ratio_types: Sequence[int] = NON_PURCHASE_TYPES,
                x_over_zero: float = 1.0) -> DataFrame:
    """Add ``{prefix}_ratio_{k}`` = purchases / behaviour k for each k."""
    return df.selectExpr("*", *[f"{safe_ratio_sql(f'{prefix}_action_{PURCHASE}', f'{prefix}_action_{k}', x_over_zero)}"
                                f" AS {prefix}_ratio_{k}" for k in ratio_types])


def rollup(rows: DataFrame, key: str, prefix: str | None = None,
           ratio_types: Sequence[int] = NON_PURCHASE_TYPES, x_over_zero: float = 1.0) -> DataFrame:
    """Counts of each behaviour per ``key`` plus purchase ratios.

    A two-phase aggregate straight off the (already window-filtered) rows.
    The second generation's form is ``ratio_types=(2, 5)`` with
    ``x_over_zero=float("inf")``.
    """
    prefix = prefix or key.replace("_id", "")
    return with_ratios(type_counts(rows, [key], TYPES, prefix=f"{prefix}_action"), prefix,
                       ratio_types, x_over_zero)


def rollup_from_counts(counts: DataFrame, key: str, prefix: str | None = None,
                       src: str = "action") -> DataFrame:
    """Rollup of an already aggregated table with ``{src}_1..6`` count columns
    (sums of sums: the finer grain is reused, the log is not read again)."""
    prefix = prefix or key.replace("_id", "")
    agg = counts.groupBy(key).agg(*[F.expr(f"CAST(sum({src}_{k}) AS BIGINT) AS {prefix}_action_{k}")
                                    for k in TYPES])
    return with_ratios(agg, prefix)


def rollup_by_user_attr(rows: DataFrame, users: DataFrame, attr: str, prefix: str | None = None,
                        keep_null: bool = False) -> DataFrame:
    """Rollup over a user attribute (age, sex, level).

    Rows are first reduced to one count row per user, so the join with the
    user dimension is user-sized, not log-sized.  NULL attribute groups are
    dropped unless ``keep_null``.
    """
    prefix = prefix or attr
    per_user = type_counts(rows, ["user_id"], TYPES, prefix="a")
    j = per_user.join(users.select("user_id", attr), "user_id", "inner")
    if not keep_null:
        j = j.where(F.col(attr).isNotNull())
    agg = j.groupBy(attr).agg(*[F.sum(f"a_{k}").cast("bigint").alias(f"{prefix}_action_{k}") for k in TYPES])
    return with_ratios(agg, prefix)


GROUPING_DIMS = ("cate", "brand", "user_id", "sku_id", "age", "sex", "user_lv_cd")


def rollup_long(rows: DataFrame, users: DataFrame, dims: Sequence[str] = GROUPING_DIMS) -> DataFrame:
    """All single-dimension rollups as one long table (GROUPING SETS).

    Output: dim, key (as text), action_1..6.  Rows are reduced to the pair
    grain first; user attributes join at that grain.
    """
    pairs = type_counts(rows, PAIR_KEYS, TYPES, prefix="a")
    wide = pairs.join(users.select("user_id", "age", "sex", "user_lv_cd"), "user_id", "left")
    dims = list(dims)
    g = wide.groupingSets([[d] for d in dims], *dims).agg(
        F.grouping_id().alias("_gid"),
        *[F.sum(f"a_{k}").cast("bigint").alias(f"action_{k}") for k in TYPES])
    n = len(dims)
    name = key = None
    for i, d in enumerate(dims):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))   # bit set for every other dimension
        cond = F.col("_gid") == gid
        name = F.when(cond, F.lit(d)) if name is None else name.when(cond, F.lit(d))
        key = F.when(cond, F.col(d).cast("string")) if key is None else key.when(cond, F.col(d).cast("string"))
    return g.select(name.alias("dim"), key.alias("key"), *[f"action_{k}" for k in TYPES])


def model_clicks(rows: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """Count of rows that carry a model id (model_id > 0) per key."""
    return rows.groupBy(*keys).agg(F.sum(flag_positive("model_id")).cast("bigint").alias("model_clicks"))


def purchases_by_user_attr(rows: DataFrame, users: DataFrame, attr: str) -> DataFrame:
    """Purchases per user attribute value (NULL attribute dropped)."""
    per_user = rows.where(F.col("type") == PURCHASE).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return (per_user.join(users.select("user_id", attr), "user_id")
            .where(F.col(attr).isNotNull())
            .groupBy(attr).agg(F.sum("n").cast("bigint").alias("purchases")))
