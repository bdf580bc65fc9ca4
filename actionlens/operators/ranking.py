"""Ranks and arg-max per key that stay balanced when one key is huge.

``Window.partitionBy(key)`` puts a whole key group into one task; a user
holding a third of all rows would then be sorted by one core.  The forms
below avoid that:

* ``top1_per_key`` is a plain aggregate (``max``/``min`` of a struct whose
  first fields are the sort key), so it is combined map-side before the
  shuffle and the hot key costs one partial row per task.
* ``rank_within`` computes the 0-based position of each row inside its group
  from a *global* range-partitioned sort: a hot group spans many range
  partitions; each row's rank is the number of group rows in earlier
  partitions (a running sum over at most ``num_partitions`` rows per group)
  plus its position inside its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionlens.session import ensure_checkpoint_dir


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rank_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                name: str = "rank", num_partitions: int | None = None, kind: str = "int") -> DataFrame:
    """Add ``name`` = 0-based row position inside each group under ``order_cols``.

    ``order_cols`` must make the order total (include a unique tie-break),
    otherwise positions of tied rows are arbitrary.  With no ``group_cols``
    the rank is global.  Group keys must be non-null.  ``kind`` is the rank's
    type: ``bigint`` where a group may hold more than 2**31 rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = list(group_cols) or []
    if not groups:
        df = df.withColumn("_grp", F.lit(0))
        groups = ["_grp"]
    order = [_col(c) for c in order_cols]
    keys = [F.col(g) for g in groups] + order
    indexed = (df.repartitionByRange(n, *keys)
               .sortWithinPartitions(*keys)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    # The ids above depend on physical placement: pin them once in the shared
    # checkpoint folder so every later read (and any recomputed task) agrees.
    indexed = indexed.checkpoint(eager=True)
    per_part = indexed.groupBy(*groups, "_pid").agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = (indexed.join(offsets.select(*groups, "_pid", "_first", "_off"), [*groups, "_pid"])
           .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast(kind))
           .drop("_pid", "_mid", "_first", "_off"))
    return out.drop("_grp") if "_grp" in out.columns else out


def top1_per_key(df: DataFrame, key: Sequence[str] | str, score: str, item: str = "sku_id",
                 order: str = "desc", extra: Sequence[str] = ()) -> DataFrame:
    """One row per key: the item with the highest (``desc``) or lowest (``asc``)
    score; ties go to the smallest item id.  ``extra`` columns ride along.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if order == "desc":
        best = F.max(F.struct(F.col(score).alias("s"), (-F.col(item)).alias("t"),
                              *[F.col(c).alias(c) for c in [item, *extra]]))
    elif order == "asc":
        best = F.min(F.struct(F.col(score).alias("s"), F.col(item).alias("t"),
                              *[F.col(c).alias(c) for c in [item, *extra]]))
    else:
        raise ValueError(f"order must be 'asc' or 'desc', not {order!r}")
    return (df.groupBy(*keys).agg(best.alias("_b"))
            .select(*keys, F.col(f"_b.{item}").alias(item), F.col("_b.s").alias(score),
                    *[F.col(f"_b.{c}").alias(c) for c in extra]))


def first_in_order(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Each key's first row under the declared column order (ascending, NULLs first); an aggregate
    of structs, so a key with many rows is reduced before the shuffle.  Keeps key and order columns."""
    best = F.min(F.struct(*[F.col(c).alias(c) for c in order]))
    return df.groupBy(key).agg(best.alias("_b")).select(key, *[F.col(f"_b.{c}").alias(c) for c in order])


def top_k(df: DataFrame, k: int, score: str, tie: Sequence[str] = ("user_id",)) -> DataFrame:
    """The k rows of highest score (ties by ``tie`` ascending).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k and only those k-per-task rows reach the final merge.
    """
    return df.orderBy(F.col(score).desc(), *[F.col(t).asc() for t in tie]).limit(k)
