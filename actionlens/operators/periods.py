"""Window counts and labels of several periods from one read of the log."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.functions.expr import date_lit
from actionlens.operators.windows import PAIR_KEYS, shift_date, time_range
from actionlens.params import PAIR_WINDOWS, PURCHASE, TYPES
from actionlens.session import ensure_checkpoint_dir


class PeriodSet(NamedTuple):
    """Features from the days [start, end), labels from the days [end, label_end) (none: a candidate set)."""
    name: str
    start: str
    end: str
    label_end: str | None = None


def overlapping(a: PeriodSet, b: PeriodSet) -> bool:
    """Whether the two read a day in common."""
    return a.start < (b.label_end or b.end) and b.start < (a.label_end or a.end)


def period_sets(actions: DataFrame, periods: Sequence[PeriodSet], windows: Sequence[int] = PAIR_WINDOWS, types: Sequence[int] = TYPES) -> DataFrame:
    """period, user_id, sku_id, cate, brand, ``w{N}_action_{k}``, label: the pair sets of all periods.

    The log is read once over the days of all periods and reduced to a pinned day table (eager); a row of it goes to
    the periods its day lies in (a list of at most ``len(periods)`` structs, found by comparison with
    the parameters, so no join).  A pair's row needs an action within the longest window and after
    the period's start; the label belongs to (user, sku) and is NULL in a period without label days.
    """
    longest = max(windows)
    first = {p.name: max(p.start, shift_date(p.end, -longest)) for p in periods}
    last = {p.name: p.label_end or p.end for p in periods}
    counts = [F.expr(f"CAST(sum(CASE WHEN type = {k} THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}") for k in types]
    rows = time_range(actions, min(first.values()), max(last.values())).withColumn("day", F.to_date("time"))
    ensure_checkpoint_dir(actions.sparkSession)
    daily = rows.groupBy(*PAIR_KEYS, "day").agg(*counts).checkpoint(eager=True)      # read by pairs and labels
    mine = F.array_compact(F.array(*[F.when((F.col("day") >= date_lit(first[p.name])) & (F.col("day") < date_lit(last[p.name])),
                                            F.struct(F.lit(p.name).alias("period"), F.datediff(date_lit(p.end), F.col("day")).alias("off"))) for p in periods]))
    rows = daily.withColumn("p", F.explode(mine)).select("p.period", "p.off", *daily.columns)
    sums = [F.expr(f"CAST(sum(CASE WHEN off BETWEEN 1 AND {n} THEN n_{k} ELSE 0 END) AS BIGINT) AS w{n}_action_{k}") for n in windows for k in types]
    pairs = rows.groupBy("period", *PAIR_KEYS).agg(F.max(F.when(F.col("off") >= 1, 1)).alias("_seen"), *sums).where("_seen = 1").drop("_seen")
    bought = rows.groupBy("period", "user_id", "sku_id").agg(F.expr(f"max(CASE WHEN off <= 0 AND n_{PURCHASE} > 0 THEN 1 ELSE 0 END) AS bought")).where("bought = 1")
    labelled = [p.name for p in periods if p.label_end]
    label = F.when(F.col("period").isin(labelled), F.coalesce("bought", F.lit(0)))
    return pairs.join(bought, ["period", "user_id", "sku_id"], "left").withColumn("label", label).drop("bought")
