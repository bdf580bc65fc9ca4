"""Behaviour counts over look-back windows (one scan for every window).

The pipeline counts each behaviour type per key for many look-back windows
``[end - N days, end)``.  Rescanning the log per window costs one pass per
window; here the log is scanned once, reduced to per-day counts, and every
window is a conditional sum over the day offset:

    off = datediff(end, to_date(time))      -- 1 for the last day before end
    count in window N = sum(n_k) where off <= N

The day-level table is the only wide-input step; it is a two-phase hash
aggregate (partial per map task, so a hot user or sku is pre-combined before
the shuffle) and every grain (pair, user, sku) is derived from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.functions.expr import day_offset, decay_weight, safe_ratio_sql, ts_lit
from actionlens.params import NON_PURCHASE_TYPES, PURCHASE, TYPES

PAIR_KEYS = ("user_id", "sku_id", "cate", "brand")


def shift_date(d: str, days: int) -> str:
    return (date.fromisoformat(d) + timedelta(days=days)).isoformat()


def time_range(actions: DataFrame, start: str, end: str, col: str = "time") -> DataFrame:
    """Rows with ``start <= time < end`` (dates at midnight; half-open)."""
    return actions.where((F.col(col) >= ts_lit(start)) & (F.col(col) < ts_lit(end)))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL (a missing category or brand is a group of its own)."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def lookback(actions: DataFrame, end: str, days: int) -> DataFrame:
    return time_range(actions, shift_date(end, -days), end)


def type_counts(actions: DataFrame, keys: Sequence[str], types: Sequence[int] = TYPES,
                prefix: str = "action") -> DataFrame:
    """Counts of each behaviour type per key (one-hot + sum)."""
    aggs = [F.expr(f"CAST(sum(CASE WHEN type = {k} THEN 1 ELSE 0 END) AS BIGINT) AS {prefix}_{k}")
            for k in types]
    return actions.groupBy(*keys).agg(*aggs)


def day_counts(actions: DataFrame, keys: Sequence[str], end: str, max_days: int,
               types: Sequence[int] = TYPES, until: str | None = None,
               with_total: bool = False) -> DataFrame:
    """keys + off + n_1..n_6: behaviour counts per key and day before ``end``.

    ``until`` extends the scanned range past ``end`` (those days get
    ``off <= 0``), so a later period can be read from the same aggregate.
    """
    rows = time_range(actions, shift_date(end, -max_days), until or end) \
        .withColumn("off", day_offset("time", end))
    # sum(CASE ...) rather than count_if: Spark 4.1 rewrites count_if with
    # uniquely named common sub-expressions, which defeats exchange reuse
    # when several grains read this aggregate.
    aggs = [F.expr(f"CAST(sum(CASE WHEN type = {k} THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}") for k in types]
    if with_total:
        aggs += [F.count(F.lit(1)).alias("n_all"), F.expr("CAST(sum(CASE WHEN model_id > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_model")]
    return rows.groupBy(*keys, "off").agg(*aggs)


def window_sums(daily: DataFrame, keys: Sequence[str], windows: Sequence[int],
                types: Sequence[int], name, first_off: bool = False, extra: Sequence = ()) -> DataFrame:
    """Window counts per key from a ``day_counts`` table (plus ``extra`` aggregates)."""
    # ``off >= 1``: a day table may also hold days at or after ``end`` (the
    # label period, see plans.features.train_set); windows never count them.
    aggs = [F.expr(f"CAST(sum(CASE WHEN off BETWEEN 1 AND {n} THEN n_{k} ELSE 0 END) AS BIGINT) AS {name(n, k)}")
            for n in windows for k in types]
    if first_off:
        aggs.append(F.expr("min(CASE WHEN off >= 1 THEN off END) AS _first_off"))
    return daily.groupBy(*keys).agg(*aggs, *extra)


def pair_window_counts(actions: DataFrame, end: str, windows: Sequence[int],
                       keys: Sequence[str] = PAIR_KEYS, types: Sequence[int] = TYPES,
                       daily: DataFrame | None = None, first_off: bool = False) -> DataFrame:
    """One row per key seen in the longest window; ``w{N}_action_{k}`` counts.

    ``first_off`` adds ``_first_off`` (earliest day offset of the key), for
    callers that pass a ``daily`` table spanning more days than ``windows``.
    """
    if daily is None:
        # Standalone: one aggregate straight off the log (one shuffle); the
        # day-level table only pays off when several grains share it.
        rows = lookback(actions, end, max(windows)).withColumn("off", day_offset("time", end))
        aggs = [F.expr(f"CAST(sum(CASE WHEN type = {k} AND off <= {n} THEN 1 ELSE 0 END) AS BIGINT)"
                       f" AS w{n}_action_{k}") for n in windows for k in types]
        return rows.groupBy(*keys).agg(*aggs)
    return window_sums(daily, keys, windows, types, lambda n, k: f"w{n}_action_{k}", first_off)


def pair_window_counts_rescan(actions: DataFrame, end: str, windows: Sequence[int],
                              keys: Sequence[str] = PAIR_KEYS,
                              types: Sequence[int] = TYPES) -> DataFrame:
    """The per-window form (one scan and one aggregate per window, then joins).

    Kept as the metamorphic reference for the one-pass form and for the
    bench; the one-pass form is what the feature sets use.
    """
    longest = max(windows)
    out = None
    for n in sorted(windows, reverse=True):
        w = type_counts(lookback(actions, end, n), keys, types, prefix=f"w{n}_action")
        out = w if out is None else join_null_safe(out, w, keys)
    fill = {f"w{n}_action_{k}": 0 for n in windows for k in types if n != longest}
    return out.na.fill(fill)


def ratio_columns(prefix: str, types: Sequence[int] = NON_PURCHASE_TYPES) -> list[str]:
    """purchases / behaviour k for each k (safe ratio), as SQL expressions."""
    return [f"{safe_ratio_sql(f'{prefix}_{PURCHASE}', f'{prefix}_{k}')} AS {prefix}_ratio_{k}"
            for k in types]


def accumulated_ratios(actions: DataFrame, key: str, end: str, windows: Sequence[int],
                       prefix: str, daily: DataFrame | None = None) -> DataFrame:
    """Per-``key`` purchases and purchase ratios for each window.

    Columns: ``{prefix}_w{N}_action_4`` and ``{prefix}_w{N}_action_ratio_{k}``
    for k in 1,2,3,5,6.  A key present only in longer windows has zeros in
    the shorter ones (0/0 -> 0), which is what the left join plus
    ``fillna(0)`` of the per-window form produces.
    """
    if daily is None:
        # Two levels on purpose: (key, day) rows are far fewer than log rows,
        # so 6 conditions per log row plus a small second shuffle beat one
        # aggregate with windows x 6 conditions per log row.  (The pair grain,
        # whose (pair, day) rows are close to log rows, uses one aggregate.)
        daily = day_counts(actions, [key], end, max(windows))
    sums = window_sums(daily, [key], windows, TYPES, lambda n, k: f"{prefix}_w{n}_action_{k}")
    cols = [key]
    for n in windows:
        p = f"{prefix}_w{n}_action"
        cols.append(f"{p}_{PURCHASE}")
        cols.extend(ratio_columns(p))
    return sums.selectExpr(*cols)


def decayed_counts(actions: DataFrame, end: str, days: int,
                   keys: Sequence[str] = PAIR_KEYS, types: Sequence[int] = TYPES) -> DataFrame:
    """Time-decayed behaviour sums: weight exp(-whole days before ``end``)."""
    rows = lookback(actions, end, days).withColumn("wt", decay_weight("time", end))
    aggs = [F.expr(f"sum(CASE WHEN type = {k} THEN wt ELSE 0.0 END) AS decay_action_{k}") for k in types]
    return rows.groupBy(*keys).agg(*aggs)


def intent_score(actions: DataFrame, end: str, days: int,
                 keys: Sequence[str] = ("user_id", "sku_id")) -> DataFrame:
    """A model-free purchase-intent score per key in [0, 1).

    score = 1 - exp(-sum of decay weights of the key's actions), rounded to
    6 places so ties and thresholds do not depend on summation order.
    """
    rows = lookback(actions, end, days).withColumn("wt", decay_weight("time", end))
    return rows.groupBy(*keys).agg(
        F.round(F.lit(1.0) - F.exp(-F.sum("wt")), 6).alias("score"))
