"""Descriptive statistics (count, mean, std, min, quartiles, max)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actionlens.session import ensure_checkpoint_dir

STATS = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


QUARTILES = (0.25, 0.5, 0.75)
# Distances, in shares of the rows, at which the sketch is asked for the values around a quartile.
MARGINS = (0.0002, 0.002, 0.05)
ACCURACY = 10_000               # of the sketch: a rank is off by at most one row in so many


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True, accuracy: int = ACCURACY,
             digits: int = 6) -> DataFrame:
    """One row per column: count, mean, std (sample), min, q25, q50, q75, max.

    All columns come from one read of ``df`` and one aggregate.  ``exact=False`` gives quartiles of
    the mergeable ``percentile_approx`` sketch (rank error at most 1 / ``accuracy``).  ``exact``
    quartiles (linear interpolation) take a second pass over the pinned columns: the sketch gives
    values a little below and above each quartile, and only rows between them are counted by value
    (see ``quartiles``; eager).
    """
    narrow = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    if exact:
        ensure_checkpoint_dir(df.sparkSession)
        narrow = narrow.checkpoint(eager=True)
    asked = [p for q in QUARTILES for m in (MARGINS if exact else ()) for p in (max(q - m, 0.0), min(q + m, 1.0))] if exact else list(QUARTILES)
    aggs = []
    for i in range(len(cols)):
        x = F.col(f"x{i}")
        aggs += [F.count(x).alias(f"count{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
                 F.percentile_approx(x, asked, accuracy if not exact else ACCURACY).alias(f"sketch{i}")]
    one = narrow.agg(*aggs)
    if exact:
        one = one.checkpoint(eager=True)                # one row
        found = quartiles(narrow, len(cols), one.head())
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"count{i}").alias("count"),
                     *[F.round(F.col(f"{name}{i}"), digits).alias(name) for name in ("mean", "std", "min")],
                     *[F.round(F.lit(found[i][k]).cast("double") if exact else F.get(f"sketch{i}", F.lit(k)), digits).alias(f"q{int(100 * q)}") for k, q in enumerate(QUARTILES)],
                     F.round(F.col(f"max{i}"), digits).alias("max")) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def _bracket(one, i: int, k: int) -> tuple[float, float]:
    """Values of column ``i`` that surely enclose quartile ``k``, from the sketch's nearest margin that is wide enough."""
    n = one[f"count{i}"]
    for j, margin in enumerate(MARGINS):
        if margin >= 1.0 / ACCURACY + 2.0 / n:
            at = 2 * (k * len(MARGINS) + j)
            return one[f"sketch{i}"][at], one[f"sketch{i}"][at + 1]
    return one[f"min{i}"], one[f"max{i}"]


def quartiles(narrow: DataFrame, n_cols: int, one) -> list[list[float | None]]:
    """Exact quartiles of the columns x0, x1, ... of a pinned table, given the row of their aggregates.

    One pass counts, for each column and quartile, the rows below its bracket (under a NULL value) and
    the rows of every value inside.  Equal values are added up in every task before the shuffle, so a
    value that a third of the rows hold is a few rows; ranks are BIGINT.
    """
    brackets = {3 * i + k: _bracket(one, i, k) for i in range(n_cols) if one[f"count{i}"] for k in range(3)}
    if not brackets:
        return [[None] * 3] * n_cols
    each = [F.when(F.col(f"x{b // 3}") <= F.lit(hi), F.struct(F.lit(b).alias("k"), F.when(F.col(f"x{b // 3}") >= F.lit(lo), F.col(f"x{b // 3}")).alias("x"))) for b, (lo, hi) in brackets.items()]
    counts = narrow.select(F.explode(F.array(*each)).alias("r")).where("r IS NOT NULL").groupBy("r.k", "r.x").agg(F.count("*").alias("n"))
    ranks = {}
    for b in brackets:
        at = (one[f"count{b // 3}"] - 1) * QUARTILES[b % 3]
        ranks[b] = (math.floor(at), math.ceil(at), at - math.floor(at))
    value = values_at(counts, {b: {lo, hi} for b, (lo, hi, _) in ranks.items()})
    out: list[list[float | None]] = [[None] * 3 for _ in range(n_cols)]
    for b, (lo, hi, share) in ranks.items():
        out[b // 3][b % 3] = value[b, lo] + (value[b, hi] - value[b, lo]) * share
    return out


def values_at(counts: DataFrame, wanted: dict[int, set[int]]) -> dict[tuple[int, int], float]:
    """The values at 0-based ranks of the sorted series ``k``, from (k, x, n) with the number of times each value occurs.

    The counts are range-partitioned; the sums of the partitions (a row a series and partition) say in
    which one a rank lies, and only there a running sum is formed.
    """
    placed = counts.repartitionByRange("k", "x").sortWithinPartitions("k", "x").withColumn("part", F.spark_partition_id()).checkpoint(eager=True)
    sums: dict[int, list[tuple[int, int]]] = {}
    for r in sorted(placed.groupBy("k", "part").agg(F.sum("n").alias("n")).collect()):
        sums.setdefault(r["k"], []).append((r["part"], r["n"]))
    need = []
    for k, ranks in wanted.items():
        before = 0
        for part, n in sums[k]:
            need += [(k, part, r, r - before) for r in ranks if before <= r < before + n]
            before += n
    where = placed.sparkSession.createDataFrame(need, "k int, part int, rank long, at long")
    upto = Window.partitionBy("k", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)     # one partition's values
    run = placed.join(F.broadcast(where.select("k", "part").distinct()), ["k", "part"], "left_semi").withColumn("upto", F.sum("n").over(upto))
    hit = run.join(F.broadcast(where), ["k", "part"]).where("at < upto AND at >= upto - n")           # a row a wanted rank
    return {(r["k"], r["rank"]): r["x"] for r in hit.select("k", "rank", "x").collect()}
