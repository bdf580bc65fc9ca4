"""Streaming ingestion equals the batch day counts; split and sinks."""

from pyspark.sql import functions as F

from actionlens.operators import windows as win
from actionlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_streaming_day_counts_equal_batch(spark):
    import __spark_entry__ as entry
    got = entry.queries()["streaming_day_counts"](spark, SF_SMALL)
    a = fx.actions(spark, SF_SMALL)
    want = a.groupBy(*win.PAIR_KEYS, F.to_date("time").alias("day")).agg(
        *[F.expr(f"CAST(sum(CASE WHEN type = {k} THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}") for k in range(1, 7)])
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*want.columns)).count() == 0


def test_hash_split_is_stable(spark):
    from actionlens.operators.selection import hash_split
    df = spark.range(0, 2000).select(F.col("id").alias("user_id"), (F.col("id") * 7).alias("sku_id"))
    a = hash_split(df).where("is_test = 1").count()
    b = hash_split(df.repartition(7)).where("is_test = 1").count()
    assert a == b and 300 < a < 500


def test_first_rows_and_column_sink(spark, tmp_path):
    from actionlens.sources.readers import first_rows, write_columns
    a = fx.actions(spark, SF_SMALL)
    head = first_rows(a, 100, ["time", "user_id", "sku_id", "type"]).collect()
    assert len(head) == 100 and head == sorted(head, key=lambda r: (r.time, r.user_id, r.sku_id, r.type))
    out = str(tmp_path / "pruned")
    write_columns(a, ["user_id", "sku_id", "type", "cate", "brand"], out)
    write_columns(a, ["user_id", "sku_id", "type", "cate", "brand"], out)   # append twice
    assert spark.read.csv(out).count() == 2 * a.count()
