"""Feature tables composed from the operators.

``feature_set``  pair counts for every pair window + per-user and per-sku
                 purchase ratios for every accumulation window, all from ONE
                 day-level aggregate of the log.
``train_set``    feature_set + user / product / review dimensions + labels.
``candidate_set`` the same without labels, restricted to the target category.
``window_block`` the single-window block of the later generation: pair
                 counts, breadth/rank features, product one-hots and rollups.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens import params as P
from actionlens.operators import breadth as br
from actionlens.operators import dims
from actionlens.operators import rollups as ru
from actionlens.operators import selection as sel
from actionlens.operators import windows as win
from actionlens.session import ensure_checkpoint_dir


def _day_table(actions: DataFrame, end: str, days: int, until: str | None = None) -> DataFrame:
    # The grains read one day-level aggregate.  Stating the join keys'
    # non-null filter up front keeps the branches identical, so the planner
    # reuses the one shuffle (ReusedExchange) instead of rescanning the log.
    keyed = actions.where(F.col("user_id").isNotNull() & F.col("sku_id").isNotNull())
    return win.day_counts(keyed, win.PAIR_KEYS, end, days, until=until)


def _grains(actions: DataFrame, end: str, pair_windows, acc_windows, label_window=None,
            pair_cate: str | None = None):
    """(pair, user, sku) tables from one day-level aggregate.

    With ``label_window = (start, end)`` the day table also covers the label
    days and the pair table gets ``label`` (any purchase on those days) from
    the same aggregate: no second scan and no join on the pair key.
    """
    longest_pair = max(pair_windows)
    until = label_window[1] if label_window and label_window[1] > end else None
    longest = max(longest_pair, max(acc_windows))
    if label_window:
        longest = max(longest, (date.fromisoformat(end) - date.fromisoformat(label_window[0])).days)
    daily = _day_table(actions, end, longest, until)
    extra, label = [], None
    if label_window:
        # The label belongs to (user, sku): a purchase under any category or brand.
        lo = (date.fromisoformat(end) - date.fromisoformat(label_window[1])).days + 1
        hi = (date.fromisoformat(end) - date.fromisoformat(label_window[0])).days
        # Naming every count keeps this branch's day aggregate the same as the others', so its
        # shuffle is reused and the log is read once.
        any_count = " + ".join(f"n_{k}" for k in P.TYPES)
        label = daily.groupBy("user_id", "sku_id").agg(
            F.expr(f"CAST(max(CASE WHEN off BETWEEN {lo} AND {hi} AND n_{P.PURCHASE} > 0 AND {any_count} >= 0 THEN 1 ELSE 0 END) AS INT) AS label")) \
            .where("label = 1")
    # Pair rows are the pairs active in the longest pair window (and, for a
    # candidate set, in one category).  Both tests are on aggregates, so they
    # are not pushed below the shared day-level aggregate: the three grains
    # keep one plan and read the log once.
    keep = F.col("_first_off") <= longest_pair
    if pair_cate is not None:
        extra.append(F.max(F.when(F.col("cate") == F.lit(pair_cate), 1).otherwise(0)).alias("_in_cate"))
        keep = keep & (F.col("_in_cate") == 1)
    pair = (win.window_sums(daily, win.PAIR_KEYS, pair_windows, P.TYPES, lambda n, k: f"w{n}_action_{k}",
                            first_off=True, extra=extra)
            .where(keep).drop("_first_off", "_in_cate"))
    if label is not None:
        pair = pair.join(label, ["user_id", "sku_id"], "left")      # nulls become 0 with the other features
    user = win.accumulated_ratios(actions, "user_id", end, acc_windows, "user", daily=daily)
    sku = win.accumulated_ratios(actions, "sku_id", end, acc_windows, "sku", daily=daily)
    return pair, user, sku


def feature_set(actions: DataFrame, end: str, pair_windows: Sequence[int] = P.PAIR_WINDOWS,
                acc_windows: Sequence[int] = P.ACC_WINDOWS) -> DataFrame:
    pair, user, sku = _grains(actions, end, pair_windows, acc_windows)
    fill = [c for c in user.columns + sku.columns if c not in ("user_id", "sku_id")]
    return pair.join(user, "user_id", "left").join(sku, "sku_id", "left").na.fill(0, fill)


def _user_side(user: DataFrame, user_dim: DataFrame) -> DataFrame:
    return user.join(user_dim, "user_id", "left")


def _sku_side(sku: DataFrame, products: DataFrame, comments: DataFrame, comment_end: str) -> DataFrame:
    prod = dims.product_onehot(products).drop("cate", "brand")
    com = dims.comment_features(comments, comment_end)
    return sku.join(prod, "sku_id", "left").join(com, "sku_id", "left")


def train_set(actions: DataFrame, user_dim: DataFrame, products: DataFrame, comments: DataFrame,
              end: str, label_start: str, label_end: str, comment_end: str,
              pair_windows: Sequence[int] = P.PAIR_WINDOWS,
              acc_windows: Sequence[int] = P.ACC_WINDOWS) -> DataFrame:
    """Feature set + user / product / review dimensions + label.

    Dimensions are joined to the narrow per-user and per-sku tables first,
    so the wide pair table is shuffled at most twice (by user, by sku) —
    and not at all when AQE finds those sides small enough to broadcast.
    """
    pair, user, sku = _grains(actions, end, pair_windows, acc_windows, (label_start, label_end))
    return (pair.join(_user_side(user, user_dim), "user_id", "left")
            .join(_sku_side(sku, products, comments, comment_end), "sku_id", "left")
            .na.fill(0))


def candidate_set(actions: DataFrame, user_dim: DataFrame, products: DataFrame, comments: DataFrame,
                  end: str, comment_end: str, cate: str | None = P.TARGET_CATE,
                  pair_windows: Sequence[int] = P.PAIR_WINDOWS,
                  acc_windows: Sequence[int] = P.ACC_WINDOWS) -> DataFrame:
    pair, user, sku = _grains(actions, end, pair_windows, acc_windows, pair_cate=cate)
    return (pair.join(_user_side(user, user_dim), "user_id", "left")
            .join(_sku_side(sku, products, comments, comment_end), "sku_id", "left")
            .na.fill(0))


BROADCAST_ROWS = 100_000        # a side table of at most so many rows is broadcast


def _small(df: DataFrame, columns: Sequence[str], windows: int = 1) -> dict[str, bool]:
    """Whether a table by each column and window has at most ``BROADCAST_ROWS`` rows (counted within 5 %); one job for all."""
    got = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).head()
    return {c: got[c] * windows <= BROADCAST_ROWS * 0.8 for c in columns}


def _attribute_rollup(per_user: DataFrame, attr: str) -> DataFrame:
    """Rollup of the per-user counts of each window by a user attribute (bounded values; users without it are left out)."""
    agg = per_user.where(F.col(attr).isNotNull()).groupBy("days", attr).agg(
        *[F.expr(f"CAST(sum(user_action_{k}) AS BIGINT) AS {attr}_action_{k}") for k in P.TYPES])
    return ru.with_ratios(agg, attr)


def _window_counts(daily: DataFrame, windows: Sequence[int]) -> DataFrame:
    """keys, days, action_1 .. action_6, sku_total, model_clicks: a row for every window that a pair is seen in, from one aggregate."""
    names = {f"action_{k}": f"n_{k}" for k in P.TYPES} | {"sku_total": "n_all", "model_clicks": "n_model"}
    sums = daily.where(F.col("off").between(1, max(windows))).groupBy(*win.PAIR_KEYS).agg(
        *[F.expr(f"CAST(sum(CASE WHEN off <= {n} THEN {count} ELSE 0 END) AS BIGINT) AS _{n}_{name}") for n in windows for name, count in names.items()])
    each = F.array(*[F.struct(F.lit(n).alias("days"), *[F.col(f"_{n}_{name}").alias(name) for name in names]) for n in windows])
    return sums.select(*win.PAIR_KEYS, F.inline(each)).where("sku_total > 0")


def _blocks(actions: DataFrame, user_dim: DataFrame, products: DataFrame, end: str, windows: Sequence[int],
            daily: DataFrame | None = None, brand_rank: DataFrame | None = None, cate: str | None = None) -> DataFrame:
    """The blocks of all windows in one table, told apart by ``days``: ranked once, each side table and join once for all.

    Eager: the ranked pair table is pinned in the shared checkpoint folder, and everything else is
    derived from it lazily.  The pair table meets one user table, one product table, two breadth tables
    and the category and brand tables, which are broadcast where the number of their keys, counted
    once, allows it.
    """
    ensure_checkpoint_dir(actions.sparkSession)
    if brand_rank is None:
        brand_rank = brand_rank_before(actions, end)
    if daily is None:
        daily = win.day_counts(actions, win.PAIR_KEYS, end, max(windows), with_total=True)
    ranked = br.rank_within(_window_counts(daily, windows), ["days", "user_id"], [F.col("sku_total").desc(), F.col("sku_id"), F.col("cate"), F.col("brand")],
                            name="sku_total_rank").checkpoint(eager=True)
    small = _small(ranked, ["cate", "brand"], len(windows)) | _small(user_dim, ["age", "sex"], len(windows))
    side = lambda df, key: F.broadcast(df) if small[key] else df
    total = lambda p: [F.expr(f"CAST(sum(action_{k}) AS BIGINT) AS {p}_action_{k}") for k in P.TYPES]
    clicks = lambda p: F.expr(f"CAST(sum(model_clicks) AS BIGINT) AS {p}_model_clicks")

    per_user = ru.with_ratios(ranked.groupBy("days", "user_id").agg(
        *total("user"), F.expr("CAST(sum(sku_total) AS BIGINT) AS action_total"), F.count(F.lit(1)).alias("diff_sku")), "user")
    per_user = per_user.join(user_dim, "user_id", "left")
    user = per_user
    for attr in ("age", "sex"):
        user = user.join(side(_attribute_rollup(per_user, attr), attr), ["days", attr], "left")
    sku = ru.with_ratios(ranked.groupBy("days", "sku_id").agg(*total("sku")), "sku")
    of_cate = side(ru.with_ratios(ranked.groupBy("days", "cate").agg(*total("cate"), clicks("cate")), "cate"), "cate")
    brand = ru.with_ratios(ranked.groupBy("days", "brand").agg(*total("brand"), clicks("brand")), "brand")
    brand = side(win.join_null_safe(brand, brand_rank.select("brand", "brand_rank"), ["brand"]), "brand")
    pairs = ranked.select("days", *win.PAIR_KEYS, "sku_total")
    product = dims.product_onehot(products).checkpoint(eager=True)      # a category filter that the planner infers for it stands where it is read, too

    out = ranked if cate is None else ranked.where(F.col("cate") == F.lit(cate))
    out = out.withColumn("sku_action_max", F.when(F.col("sku_total_rank") == 0, 1).otherwise(0).cast("int"))
    out = out.join(user, ["days", "user_id"], "left").withColumn("sku_action_ratio", F.col("sku_total").cast("double") / F.col("action_total").cast("double"))
    for attr in ("cate", "brand"):
        out = win.join_null_safe(out, br.group_breadth(pairs, attr, ["days", "user_id"]), ["days", "user_id", attr])
    out = out.join(sku, ["days", "sku_id"], "left").join(product, ["sku_id", "cate", "brand"], "left")
    out = win.join_null_safe(win.join_null_safe(out, of_cate, ["days", "cate"]), brand, ["days", "brand"])
    return out.na.fill(0)


def window_block(actions: DataFrame, user_dim: DataFrame, products: DataFrame, end: str,
                 days: int, daily: DataFrame | None = None, brand_rank: DataFrame | None = None, cate: str | None = None) -> DataFrame:
    """Pair features of one look-back window: behaviour counts, breadth, rank, product attributes,
    user columns, model clicks and rollups by category, brand, user, product, age and sex.

    With ``cate`` only that category's pairs are returned (features still come from all actions); the
    filter stands before the joins.
    """
    return _blocks(actions, user_dim, products, end, [days], daily, brand_rank, cate).drop("days")


def brand_rank_before(actions: DataFrame, end: str) -> DataFrame:
    """brand, brand_rank over all actions before ``end``."""
    return br.brand_popularity_rank(actions.where(F.col("time") < F.lit(end).cast("timestamp_ntz"))).drop("purchases")


def _block_days(actions: DataFrame, end: str, windows: Sequence[int], until: str | None = None) -> DataFrame:
    """The pinned day table that all windows (and the labels up to ``until``) are read from."""
    ensure_checkpoint_dir(actions.sparkSession)
    return win.day_counts(actions, win.PAIR_KEYS, end, max(windows), until=until, with_total=True).checkpoint(eager=True)


def window_block_set(actions: DataFrame, user_dim: DataFrame, products: DataFrame, end: str,
                     windows: Sequence[int] = P.SHORT_WINDOWS, cate: str | None = None, daily: DataFrame | None = None) -> DataFrame:
    """The later generation's merged set: one block per window, columns prefixed ``w{N}_``, left-joined
    onto the longest window's pairs (pairs absent from a shorter window get zeros).

    Eager: one pinned day table and one brand rank serve every window, and the blocks of all windows are
    built at once and kept in the shared checkpoint folder by window, so each is read alone; with
    ``cate`` the pairs are cut to that category before they meet a side table or are written.
    """
    spark = actions.sparkSession
    daily = daily if daily is not None else _block_days(actions, end, windows)
    rank = brand_rank_before(actions, end).checkpoint(eager=True)
    user_dim = user_dim.checkpoint(eager=True)
    keys, path = list(win.PAIR_KEYS), f"{ensure_checkpoint_dir(spark).rstrip('/')}/blocks-{uuid.uuid4().hex}"
    built = _blocks(actions, user_dim, products, end, sorted(windows), daily, rank, cate)
    built.write.partitionBy("days").parquet(path)
    blocks = spark.read.schema(built.schema).parquet(path)
    out = None
    for n in sorted(windows, reverse=True):
        b = blocks.where(F.col("days") == n)
        b = b.select(*keys, *[F.col(c).alias(f"w{n}_{c}") for c in built.columns if c not in (*keys, "days")])
        out = b if out is None else win.join_null_safe(out, b, keys)
    return out.na.fill(0)


def block_train_set(actions: DataFrame, user_dim: DataFrame, products: DataFrame, end: str, label_start: str, label_end: str,
                    windows: Sequence[int] = P.SHORT_WINDOWS) -> DataFrame:
    """The merged set with ``label``: whether the user bought the product in the label window, read from the same day table."""
    if label_start < end:
        raise ValueError("labels are read from the days after the features")
    daily = _block_days(actions, end, windows, until=label_end)
    first = (date.fromisoformat(label_start) - date.fromisoformat(end)).days
    labels = daily.where((F.col("off") <= -first) & (F.col(f"n_{P.PURCHASE}") > 0)).select("user_id", "sku_id").distinct().withColumn("label", F.lit(1))
    return window_block_set(actions, user_dim, products, end, windows, daily=daily).join(labels, ["user_id", "sku_id"], "left").na.fill(0, ["label"])


def block_candidate_set(actions: DataFrame, user_dim: DataFrame, products: DataFrame, end: str, cate: str = P.TARGET_CATE,
                        windows: Sequence[int] = P.SHORT_WINDOWS) -> DataFrame:
    """The merged set of the target category's pairs."""
    return window_block_set(actions, user_dim, products, end, windows, cate=cate)
