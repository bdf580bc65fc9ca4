"""User, product and review-snapshot dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.functions.expr import AGE_BUCKET_RANK, age_rank, date_lit, days_since, one_hot

A1_VALUES, A2_VALUES, A3_VALUES = (-1, 0, 1, 2), (0, 1, 2), (0, 1)
COMMENT_LEVELS = (0, 1, 2, 3, 4)


def user_dimension(users: DataFrame, base_date: str, age_map: Mapping[str, int] = AGE_BUCKET_RANK,
                   blocklist: DataFrame | None = None) -> DataFrame:
    """user_id, age (rank), sex, user_lv_cd, user_reg_tm (days), user_lv_reg.

    Registration days before ``base_date`` are treated as missing and filled
    with the truncated mean of the user's age group; ``user_lv_reg`` is the
    filled day count per user level.  ``blocklist`` (user_id rows) is removed.
    """
    u = users
    if blocklist is not None:
        u = u.join(blocklist.select("user_id"), "user_id", "left_anti")
    days = days_since("user_reg_tm", base_date)
    u = u.select("user_id", age_rank("age", age_map).alias("age"), "sex", "user_lv_cd",
                 F.when(days >= 0, days).alias("reg_days"))
    # One row per age rank: the group key is the image of a fixed mapping
    # (at most len(age_map) + 1 rows), so broadcasting it is size-bounded.
    means = u.groupBy(F.col("age").alias("_age")).agg(F.avg("reg_days").alias("reg_mean"))
    j = u.join(F.broadcast(means), F.col("age").eqNullSafe(F.col("_age")), "left").drop("_age")
    reg = F.coalesce(F.col("reg_days").cast("double"), F.col("reg_mean")).cast("int")
    return j.select("user_id", "age", "sex", "user_lv_cd", reg.alias("user_reg_tm")).withColumn(
        "user_lv_reg", F.try_divide(F.col("user_reg_tm").cast("double"), F.col("user_lv_cd").cast("double")))


def product_onehot(products: DataFrame, a1=A1_VALUES, a2=A2_VALUES, a3=A3_VALUES) -> DataFrame:
    """sku_id, cate, brand and 0/1 columns for each declared attribute value."""
    return products.select("sku_id", "cate", "brand",
                           *one_hot("a1", a1, "a1"), *one_hot("a2", a2, "a2"), *one_hot("a3", a3, "a3"))


def observed_values(df: DataFrame, col: str, at_most: int = 1000) -> list[int]:
    """The distinct non-null values of an attribute, sorted; an attribute of more than ``at_most``
    values is no one-hot domain and raises an error."""
    got = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(at_most + 1).collect()]
    if len(got) > at_most:
        raise ValueError(f"{col} has more than {at_most} values")
    return sorted(got)


def product_clean(products: DataFrame, cols: Sequence[str] = ("a1", "a2", "a3")) -> DataFrame:
    """Unknown attribute (-1) becomes 0."""
    return products.select(*[F.when(F.col(c) == -1, F.lit(0)).otherwise(F.col(c)).cast("int").alias(c)
                             if c in cols else F.col(c) for c in products.columns])


def asof_snapshot(comments: DataFrame, end: str, key: str = "sku_id", time_col: str = "dt") -> DataFrame:
    """Per key, the latest snapshot dated strictly before ``end``.

    ``max(struct(dt, ...))`` is an ordinary aggregate, combined map-side, so
    a key with many snapshots never gathers in one task.
    """
    rest = [c for c in comments.columns if c not in (key, time_col)]
    best = F.max(F.struct(F.col(time_col).alias(time_col), *[F.col(c).alias(c) for c in rest]))
    return (comments.where(F.col(time_col) < date_lit(end))
            .groupBy(key).agg(best.alias("_s"))
            .select(key, *[F.col(f"_s.{c}").alias(c) for c in [time_col, *rest]]))


def asof_cutoffs(comments: DataFrame, ends: Sequence[str], key: str = "sku_id", time_col: str = "dt") -> DataFrame:
    """``asof_snapshot`` for a list of cut-offs from one read: (cutoff, key, time_col, ...).

    A snapshot is the latest of its key up to the key's next one, so it serves the cut-offs between the
    two.  Each (key, stretch between two neighbouring cut-offs) keeps its latest snapshot (an aggregate,
    combined in every task); a merge over the at most ``len(ends)`` stretches of a key then carries the
    last snapshot on to the cut-offs of stretches without one.
    """
    cutoffs = sorted(set(ends))
    rest = [c for c in comments.columns if c not in (key, time_col)]
    # Stretch 0 ends before the first cut-off, stretch 1 before the second, ...
    stretch = F.lit(len(cutoffs)) - sum((F.col(time_col) < date_lit(e)).cast("int") for e in cutoffs)
    best = F.max(F.struct(F.col(time_col).alias(time_col), *[F.col(c).alias(c) for c in rest]))
    latest = comments.where(F.col(time_col) < date_lit(cutoffs[-1])).withColumn("_stretch", stretch).groupBy(key, "_stretch").agg(best.alias("_s"))
    of_key = latest.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_stretch", "_s"))).alias("_m"))     # at most len(ends) entries
    carried = F.explode(F.array(*[F.struct(date_lit(e).alias("cutoff"), F.coalesce(*[F.try_element_at("_m", F.lit(j)) for j in range(i, -1, -1)]).alias("_s")) for i, e in enumerate(cutoffs)]))
    return of_key.select(key, carried.alias("_c")).where("_c._s IS NOT NULL").select("_c.cutoff", key, *[F.col(f"_c._s.{c}").alias(c) for c in [time_col, *rest]])


def snapshot_range(comments: DataFrame, end: str, time_col: str = "dt") -> DataFrame:
    """All rows dated in ``[d, end)`` where d is the latest snapshot date before ``end``.

    d is a scalar subquery (one aggregate job), not a join.
    """
    before = comments.where(F.col(time_col) < date_lit(end))
    latest = before.select(F.max(time_col)).scalar()
    return before.where(F.col(time_col) >= latest)


def comment_features(comments: DataFrame, end: str) -> DataFrame:
    """As-of review snapshot per sku with ``comment_num`` one-hot over 0..4."""
    snap = asof_snapshot(comments, end)
    keep = [c for c in snap.columns if c not in ("dt", "comment_num")]
    return snap.select(*keep, *one_hot("comment_num", COMMENT_LEVELS, "comment_num"))
