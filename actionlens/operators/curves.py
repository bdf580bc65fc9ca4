"""Conversion curves: how many pairs seen in the last N days later convert.

Positives are the (user, sku) pairs purchased in a label window (optionally
in one category) whose sku is in the product subset.  For each behaviour
type and N in 1..days:

* cumulative: distinct pairs with that behaviour in ``[end - N, end)``, and
  how many are positives.  A pair is in window N iff its earliest day offset
  is <= N, so one aggregate of ``min(off)`` per pair and a running sum over
  the offsets give every N at once (no per-N rescans).
* daily: the same for the single day N before ``end``.
* rows: raw row counts per window / day, and rows whose pair converts.

The (N, type) grid is filled so empty days and never-seen behaviours appear
with zero counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datetime import date

from actionlens.functions.expr import day_offset, safe_ratio, ts_lit
from actionlens.operators.selection import in_product_subset, purchase_labels
from actionlens.operators.windows import lookback, shift_date
from actionlens.params import NON_PURCHASE_TYPES, PURCHASE

MASK_DAYS = 62          # days a BIGINT mask holds


def positives(actions: DataFrame, products: DataFrame | None, start: str, end: str,
              cate: str | None = None) -> DataFrame:
    pos = purchase_labels(actions, start, end, cate).select("user_id", "sku_id")
    return in_product_subset(pos, products) if products is not None else pos


def _grid(spark, days: int, types: Sequence[int] | None) -> DataFrame:
    # (days x types) rows: bounded by the parameters, never by the data.
    g = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(days))).alias("n_days"))
    if types is not None:
        g = g.select("n_days", F.explode(F.array(*[F.lit(t) for t in types])).alias("type"))
    return g


def _flag_hits(df: DataFrame, pos: DataFrame) -> DataFrame:
    return df.join(pos.withColumn("_hit", F.lit(1)), ["user_id", "sku_id"], "left") \
             .withColumn("_hit", F.coalesce("_hit", F.lit(0)))


def _finish(counts: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Both sides hold at most days x types rows (keys are bounded by the
    # parameters), so the build side is broadcast.
    out = grid.join(F.broadcast(counts), list(keys), "left")
    return out.select(*[F.col(k).cast("int").alias(k) for k in keys],
                      F.coalesce("pairs", F.lit(0)).cast("bigint").alias("pairs"),
                      F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits")) \
              .withColumn("rate", safe_ratio("hits", "pairs"))


def conversion_cumulative(actions: DataFrame, pos: DataFrame, end: str, days: int,
                          types: Sequence[int] = NON_PURCHASE_TYPES) -> DataFrame:
    rows = lookback(actions, end, days).where(F.col("type").isin(*types)) \
        .withColumn("off", day_offset("time", end))
    first = rows.groupBy("user_id", "sku_id", "type").agg(F.min("off").alias("first_off"))
    hist = _flag_hits(first, pos).groupBy("type", F.col("first_off").alias("n_days")).agg(
        F.count(F.lit(1)).alias("p"), F.sum("_hit").alias("h"))
    filled = _grid(actions.sparkSession, days, types).join(F.broadcast(hist), ["n_days", "type"], "left")
    # Running sum per type over at most ``days`` rows.
    run = Window.partitionBy("type").orderBy("n_days").rowsBetween(Window.unboundedPreceding, 0)
    counts = filled.select("n_days", "type",
                           F.sum(F.coalesce("p", F.lit(0))).over(run).alias("pairs"),
                           F.sum(F.coalesce("h", F.lit(0))).over(run).alias("hits"))
    return _finish(counts, _grid(actions.sparkSession, days, types), ["n_days", "type"])


def conversion_daily(actions: DataFrame, pos: DataFrame, end: str, days: int,
                     types: Sequence[int] = NON_PURCHASE_TYPES) -> DataFrame:
    rows = lookback(actions, end, days).where(F.col("type").isin(*types)) \
        .withColumn("n_days", day_offset("time", end))
    daily = rows.select("user_id", "sku_id", "type", "n_days").distinct()
    counts = _flag_hits(daily, pos).groupBy("n_days", "type").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("_hit").alias("hits"))
    return _finish(counts, _grid(actions.sparkSession, days, types), ["n_days", "type"])


def conversion_rows(actions: DataFrame, pos: DataFrame, end: str, days: int) -> DataFrame:
    """n_days, window_rows, window_hit_rows, day_rows, day_hit_rows."""
    rows = lookback(actions, end, days).withColumn("n_days", day_offset("time", end))
    per_pair_day = rows.groupBy("user_id", "sku_id", "n_days").agg(F.count(F.lit(1)).alias("n"))
    per_day = (_flag_hits(per_pair_day, pos)
               .groupBy("n_days").agg(F.sum("n").alias("d"), F.sum(F.col("n") * F.col("_hit")).alias("dh")))
    filled = _grid(actions.sparkSession, days, None).join(F.broadcast(per_day), "n_days", "left") \
        .na.fill(0, ["d", "dh"])
    run = Window.orderBy("n_days").rowsBetween(Window.unboundedPreceding, 0)   # <= days rows
    return filled.select(F.col("n_days").cast("int").alias("n_days"),
                         F.sum("d").over(run).cast("bigint").alias("window_rows"),
                         F.sum("dh").over(run).cast("bigint").alias("window_hit_rows"),
                         F.col("d").cast("bigint").alias("day_rows"),
                         F.col("dh").cast("bigint").alias("day_hit_rows"))


# ---------------------------------------------------------------------------
# One-scan form: every curve from one (user, sku) aggregate.
# ---------------------------------------------------------------------------

def curve_table(actions: DataFrame, products: DataFrame | None, end: str, days: int,
                label_start: str, label_end: str, cate: str | None = None,
                types: Sequence[int] = NON_PURCHASE_TYPES) -> DataFrame:
    """One row per (user, sku) seen in ``[end - days, max(end, label_end))``:

    * ``m_{t}_{f}`` BIGINT masks of the days f+1 .. f+``MASK_DAYS``: bit d-f-1 is set when the
                  pair has behaviour t on day ``off = d`` (1 <= d <= days),
    * ``r_{d}``   rows of the pair on day d (all behaviours),
    * ``hit``     1 when the pair bought (in ``cate``) during the label window
                  and its sku is in the product subset.

    The log is scanned once (the label days are read by the same scan) and
    reduced by one two-phase aggregate; the product test is a sku-keyed join.
    """
    lo = (date.fromisoformat(end) - date.fromisoformat(label_end)).days + 1
    hi = (date.fromisoformat(end) - date.fromisoformat(label_start)).days
    lower, upper = min(label_start, shift_date(end, -days)), max(end, label_end)
    rows = (actions.where((F.col("time") >= ts_lit(lower)) & (F.col("time") < ts_lit(upper)))
            .withColumn("off", day_offset("time", end)))
    aggs = [F.expr(f"bit_or(CASE WHEN type = {t} AND off BETWEEN {first + 1} AND {min(first + MASK_DAYS, days)} "
                   f"THEN shiftleft(CAST(1 AS BIGINT), off - {first + 1}) ELSE CAST(0 AS BIGINT) END) AS m_{t}_{first}")
            for t in types for first in range(0, days, MASK_DAYS)]
    aggs += [F.expr(f"CAST(sum(CASE WHEN off = {d} THEN 1 ELSE 0 END) AS BIGINT) AS r_{d}") for d in range(1, days + 1)]
    bought = (F.col("type") == PURCHASE) & F.col("off").between(lo, hi)
    if cate is not None:
        bought = bought & (F.col("cate") == F.lit(cate))
    aggs.append(F.max(F.when(bought, 1).otherwise(0)).alias("bought"))
    pairs = rows.groupBy("user_id", "sku_id").agg(*aggs)
    if products is not None:
        skus = products.select("sku_id").distinct().withColumn("_in", F.lit(1))
        pairs = pairs.join(skus, "sku_id", "left")
        in_subset = F.col("_in") == 1
    else:
        pairs = pairs.withColumn("_in", F.lit(1))
        in_subset = F.lit(True)
    return pairs.withColumn("hit", F.when((F.col("bought") == 1) & in_subset, 1).otherwise(0)) \
                .drop("_in", "bought")


def _mask_starts(table: DataFrame) -> list[int]:
    """First days (0-based) of the masks that the table has for each behaviour."""
    return sorted({int(c.rsplit("_", 1)[1]) for c in table.columns if c.startswith("m_")})


def _first_days(table: DataFrame, types: Sequence[int]) -> DataFrame:
    """type, hit, n_days: the earliest day of each pair and behaviour."""
    def earliest(t: int) -> Column:
        masks = [(first, F.col(f"m_{t}_{first}")) for first in _mask_starts(table)]
        return F.coalesce(*[F.when(m != 0, first + F.bit_count(m.bitwiseXOR(m - 1))) for first, m in masks])

    each = F.explode(F.array(*[F.struct(F.lit(t).alias("type"), earliest(t).alias("n_days")) for t in types]))
    return table.select("hit", each.alias("x")).select("x.type", "hit", "x.n_days").where("n_days IS NOT NULL")


def cumulative_from_table(table: DataFrame, days: int, types: Sequence[int] = NON_PURCHASE_TYPES) -> DataFrame:
    # A pair is in window N iff its earliest day <= N; earliest day = 1 +
    # index of the lowest set bit = bit_count(m XOR (m - 1)).
    first = _first_days(table, types)
    hist = first.groupBy("type", "n_days").agg(F.count(F.lit(1)).alias("p"), F.sum("hit").alias("h"))
    filled = _grid(table.sparkSession, days, types).join(F.broadcast(hist), ["n_days", "type"], "left")
    run = Window.partitionBy("type").orderBy("n_days").rowsBetween(Window.unboundedPreceding, 0)
    counts = filled.select("n_days", "type",
                           F.sum(F.coalesce("p", F.lit(0))).over(run).alias("pairs"),
                           F.sum(F.coalesce("h", F.lit(0))).over(run).alias("hits"))
    return _finish(counts, _grid(table.sparkSession, days, types), ["n_days", "type"])


def daily_from_table(table: DataFrame, days: int, types: Sequence[int] = NON_PURCHASE_TYPES) -> DataFrame:
    masks = F.explode(F.array(*[F.struct(F.lit(t).alias("type"), F.lit(first).alias("first"), F.lit(min(MASK_DAYS, days - first)).alias("n"), F.col(f"m_{t}_{first}").alias("m"))
                                for t in types for first in _mask_starts(table)]))
    active = table.select("hit", masks.alias("x")).select("hit", "x.*").where("m <> 0")
    on_days = active.select("type", "hit", "first", "m", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("d")) \
        .where("(shiftright(m, d - 1) & 1) = 1").select("type", "hit", (F.col("first") + F.col("d")).alias("n_days"))
    counts = on_days.groupBy("n_days", "type").agg(F.count(F.lit(1)).alias("pairs"), F.sum("hit").alias("hits"))
    return _finish(counts, _grid(table.sparkSession, days, types), ["n_days", "type"])


def rows_from_table(table: DataFrame, days: int) -> DataFrame:
    sums = table.agg(*[F.sum(f"r_{d}").alias(f"d_{d}") for d in range(1, days + 1)],
                     *[F.sum(F.col(f"r_{d}") * F.col("hit")).alias(f"h_{d}") for d in range(1, days + 1)])
    per_day = sums.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("n_days"), F.coalesce(F.col(f"d_{d}"), F.lit(0)).alias("d"),
                 F.coalesce(F.col(f"h_{d}"), F.lit(0)).alias("dh")) for d in range(1, days + 1)])).alias("x")) \
        .select("x.*")
    run = Window.orderBy("n_days").rowsBetween(Window.unboundedPreceding, 0)   # <= days rows
    return per_day.select(F.col("n_days").cast("int").alias("n_days"),
                          F.sum("d").over(run).cast("bigint").alias("window_rows"),
                          F.sum("dh").over(run).cast("bigint").alias("window_hit_rows"),
                          F.col("d").cast("bigint").alias("day_rows"),
                          F.col("dh").cast("bigint").alias("day_hit_rows"))
