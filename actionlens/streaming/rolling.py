"""Window counts kept up to date from stored day partials.

A day is reduced once to partial counts per pair (``store_days``).  The window table of the next day
then needs no log: it is the last one plus the newest day, less, for every window, the day that falls
out of it.  Day partials are folders of one table, replaced by dynamic partition overwrite, and every
window table has a folder of its own that counts only when finished, so a day that is stored or
advanced again (a replayed batch, a lost driver) gives the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens.functions.expr import date_lit
from actionlens.operators.windows import PAIR_KEYS, shift_date, time_range
from actionlens.params import PAIR_WINDOWS, TYPES
from actionlens.sources.readers import is_finished

COUNTS = tuple(f"n_{k}" for k in TYPES) + ("n_all",)


def store_days(actions: DataFrame, path: str, start: str, end: str) -> None:
    """Partial counts per pair of every day of [start, end) that has actions; days stored before are written anew."""
    rows = time_range(actions, start, end).withColumn("day", F.to_date("time"))
    aggs = [F.expr(f"CAST(sum(CASE WHEN type = {k} THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}") for k in TYPES]
    (rows.groupBy(*PAIR_KEYS, "day").agg(*aggs, F.count(F.lit(1)).alias("n_all"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/days"))


def _columns(windows: Sequence[int]) -> list[str]:
    # The longest window also keeps its number of rows: a pair leaves the table when none is left.
    return [f"w{n}_{c}" for n in windows for c in COUNTS if c != "n_all" or n == max(windows)]


def _signed_days(spark: SparkSession, path: str, signs: dict[str, dict[int, int]], windows: Sequence[int]) -> DataFrame:
    """The stored days of ``signs`` (no others are read) under the windows each enters (1) or leaves (-1)."""
    days = spark.read.parquet(f"{path}/days").where(F.col("day").isin([date_lit(d) for d in signs]))

    def counted(column: str):
        n, count = int(column.split("_")[0][1:]), "n_" + column.split("_n_")[1]
        of = lambda sign: F.col("day").isin([date_lit(d) for d, s in signs.items() if s.get(n) == sign])
        return F.when(of(1), F.col(count)).when(of(-1), -F.col(count)).otherwise(F.lit(0)).alias(column)

    return days.select(*PAIR_KEYS, *[counted(c) for c in _columns(windows)])


def _state(path: str, end: str, windows: Sequence[int]) -> str:
    return f"{path}/windows-{'-'.join(map(str, windows))}/{end}"


def _write_table(parts: DataFrame, windows: Sequence[int], path: str) -> None:
    summed = parts.groupBy(*PAIR_KEYS).agg(*[F.sum(c).cast("bigint").alias(c) for c in _columns(windows)])
    summed.where(f"w{max(windows)}_n_all > 0").write.mode("overwrite").parquet(path)


def start_windows(spark: SparkSession, path: str, end: str, windows: Sequence[int] = PAIR_WINDOWS) -> None:
    """The window table of ``end`` from the stored days before it."""
    signs = {shift_date(end, -back): {n: 1 for n in windows if back <= n} for back in range(1, max(windows) + 1)}
    _write_table(_signed_days(spark, path, signs, windows), windows, _state(path, end, windows))


def advance(spark: SparkSession, path: str, end: str, windows: Sequence[int] = PAIR_WINDOWS) -> None:
    """The window table of the day after ``end``: that of ``end``, plus the day ``end``, less the days that leave."""
    state = _state(path, end, windows)
    if not is_finished(spark, state):
        raise ValueError(f"the window table of {end} is not there")
    signs: dict[str, dict[int, int]] = {end: {n: 1 for n in windows}}
    for n in windows:
        signs.setdefault(shift_date(end, -n), {})[n] = -1
    _write_table(spark.read.parquet(state).unionByName(_signed_days(spark, path, signs, windows)), windows, _state(path, shift_date(end, 1), windows))


def read_windows(spark: SparkSession, path: str, end: str, windows: Sequence[int] = PAIR_WINDOWS) -> DataFrame:
    """user_id, sku_id, cate, brand and ``w{N}_action_{k}`` of the stored table of ``end``."""
    table = spark.read.parquet(_state(path, end, windows))
    return table.select(*PAIR_KEYS, *[F.col(f"w{n}_n_{k}").alias(f"w{n}_action_{k}") for n in windows for k in TYPES])
