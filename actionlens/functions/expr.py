"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d: str) -> Column:
    return F.lit(d).cast("date")


def ts_lit(d: str) -> Column:
    """Midnight of a 'YYYY-MM-DD' date as a TIMESTAMP_NTZ literal.

    The action log carries zone-less timestamps, so the bounds are zone-less
    too; the literal is folded and pushed into the Parquet scan.
    """
    return F.lit(d).cast("timestamp_ntz")


def safe_ratio(num, den, x_over_zero: float = 1.0) -> Column:
    """Purchase ratio with the pipeline's repair rules.

    missing operand -> 0, 0/0 -> 0, x/0 -> ``x_over_zero`` (1: the infinite
    ratio capped at 1, as the first generation does; ``float("inf")`` keeps
    it infinite, as the second does), otherwise true division.  Never raises
    under ANSI mode.
    """
    n, d = _c(num), _c(den)
    return (
        F.when(n.isNull() | d.isNull(), F.lit(0.0))
        .when(d == 0, F.when(n == 0, F.lit(0.0)).otherwise(F.lit(float(x_over_zero))))
        .otherwise(F.try_divide(n.cast("double"), d.cast("double")))
    )


def safe_ratio_sql(num: str, den: str, x_over_zero: float = 1.0) -> str:
    """``safe_ratio`` as a SQL expression string (for wide ``selectExpr`` lists:
    one JVM parse per column instead of a Py4J call per operator)."""
    xz = "CAST('Infinity' AS DOUBLE)" if x_over_zero == float("inf") else repr(float(x_over_zero))
    return (f"CASE WHEN {num} IS NULL OR {den} IS NULL THEN 0.0 "
            f"WHEN {den} = 0 THEN CASE WHEN {num} = 0 THEN 0.0 ELSE {xz} END "
            f"ELSE try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE)) END")


def day_offset(ts, end: str) -> Column:
    """Calendar days between the day of ``ts`` and ``end`` (1 = the day before)."""
    return F.datediff(date_lit(end), F.to_date(_c(ts)))


def elapsed_whole_days(ts: str, end: str) -> Column:
    """Whole days elapsed from column ``ts`` to midnight of ``end`` (rounded down)."""
    return F.expr(f"timestampdiff(DAY, `{ts}`, TIMESTAMP_NTZ '{end} 00:00:00')")


def decay_weight(ts, end: str) -> Column:
    """exp(-whole days elapsed): 1 for the last 24 hours before ``end``."""
    return F.exp(-elapsed_whole_days(ts, end).cast("double"))


def days_since(d, base: str) -> Column:
    return F.datediff(_c(d), date_lit(base))


# The action log's age buckets ranked by purchasing power, as
# the pipeline ranks them (unknown text -> NULL).
AGE_BUCKET_RANK = {
    "15岁以下": 1,
    "56岁以上": 2,
    "46-55岁": 3,
    "16-25岁": 4,
    "-1": 5,
    "36-45岁": 6,
    "26-35岁": 7,
}

# Representative years of each age bucket used for profiling.
AGE_BUCKET_YEARS = {
    "-1": 0,
    "15岁以下": 15,
    "16-25岁": 20,
    "26-35岁": 30,
    "36-45岁": 40,
    "46-55岁": 50,
    "56岁以上": 55,
}

# The driver fixture stands market segments in for age buckets (codes 1..5).
SEGMENT_AGE_CODES = {
    "AUTOMOBILE": 1,
    "BUILDING": 2,
    "FURNITURE": 3,
    "HOUSEHOLD": 4,
    "MACHINERY": 5,
}
SEGMENT_AGE_YEARS = {
    "AUTOMOBILE": 15,
    "BUILDING": 20,
    "FURNITURE": 30,
    "HOUSEHOLD": 40,
    "MACHINERY": 50,
}


def _map_when(col: Column, mapping: Mapping[str, int]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None
                else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(None).cast("int"))


def age_rank(c, mapping: Mapping[str, int] = AGE_BUCKET_RANK) -> Column:
    return _map_when(_c(c), mapping).cast("int")


def age_years(c, mapping: Mapping[str, int] = AGE_BUCKET_YEARS) -> Column:
    return _map_when(_c(c), mapping).cast("int")


def one_hot(c, values: Iterable, prefix: str) -> list[Column]:
    """One 0/1 INT column per value of a declared domain (``prefix_value``)."""
    col = _c(c)
    out = []
    for v in values:
        name = f"{prefix}_{v}".replace("-", "m")
        out.append(F.when(col == F.lit(v), 1).otherwise(0).cast("int").alias(name))
    return out


def flag_positive(c) -> Column:
    return F.when(_c(c) > 0, 1).otherwise(0).cast("int")


def pair_key(user="user_id", sku="sku_id") -> Column:
    return F.concat_ws("-", _c(user).cast("string"), _c(sku).cast("string"))
