"""Logical tables of the behaviour log over the driver's parquet tables.

The analysis needs four tables: ``actions`` (user, sku, time, behaviour
type, category, brand), ``users``, ``products`` (the target product subset)
and dated ``comments`` snapshots.  The driver ships a TPC-H-like star schema,
so each table is a declarative view over it (see FIXTURES.md §2).  All views
are lazy: filters and projections placed on top reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event name -> behaviour code (5, "follow", never occurs in the fixture).
EVENT_TYPE_CODES = {"view": 1, "signup": 2, "error": 3, "purchase": 4, "click": 6}


# The log records the category and brand at the time of the action, and both may
# change or be missing: some events of a product carry another brand or category
# than its part row, or none.
OTHER_CATE, OTHER_BRAND = "ECONOMY", "Brand#99"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, sku_id, time, model_id, type, cate, brand — one row per event.

    The sku comes from the event's JSON key; it is joined to ``part`` for
    category and brand; an action whose product has no part row keeps a NULL
    category and brand.  The join is a plain equi-join: AQE broadcasts the
    part side at run time only when its shuffle output is small, and falls
    back to a sort-merge join otherwise.
    """
    return actions_from_events(_read(spark, sf_dir, "events"), _read(spark, sf_dir, "part"))


def actions_from_events(e: DataFrame, part: DataFrame) -> DataFrame:
    """The ``actions`` mapping for any events frame (batch or micro-batch)."""
    p = part.select("p_partkey", "p_type", "p_brand")
    code = None
    for name, v in EVENT_TYPE_CODES.items():
        code = F.when(F.col("event_type") == name, F.lit(v)) if code is None \
            else code.when(F.col("event_type") == name, F.lit(v))
    ev = e.select(
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("sku_id"),
        F.col("ts").alias("time"),
        F.when((F.col("event_type") == "click") & (F.col("event_id") % 3 > 0),
               (F.col("event_id") % 20).cast("int")).alias("model_id"),
        code.cast("int").alias("type"),
        F.col("event_id").alias("_event"),
    )
    event = F.col("_event")
    cate = F.when(event % 19 == 0, F.lit(None)).when(event % 13 == 0, F.lit(OTHER_CATE)).otherwise(F.col("p_type"))
    brand = F.when(event % 17 == 0, F.lit(None)).when(event % 11 == 0, F.lit(OTHER_BRAND)).otherwise(F.col("p_brand"))
    return (ev.join(p, ev.sku_id == p.p_partkey, "left")
            .select("user_id", "sku_id", "time", "model_id", "type", cate.alias("cate"), brand.alias("brand")))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions without category and brand: user_id, sku_id, time, type (no join with ``part``)."""
    code = F.create_map(*[x for k, v in EVENT_TYPE_CODES.items() for x in (F.lit(k), F.lit(v))])
    return _read(spark, sf_dir, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("sku_id"), F.col("ts").alias("time"),
        F.try_element_at(code, F.col("event_type")).cast("int").alias("type"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, age (text bucket), sex, user_lv_cd, user_reg_tm (DATE)."""
    c = _read(spark, sf_dir, "customer")
    first = (_read(spark, sf_dir, "orders")
             .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order")))
    return (c.join(first, c.c_custkey == first.o_custkey, "left")
            .select(
                F.col("c_custkey").alias("user_id"),
                F.col("c_mktsegment").alias("age"),
                F.when(F.col("c_nationkey") % 5 == 0, F.lit(None).cast("int"))
                 .otherwise(F.col("c_nationkey") % 3).cast("int").alias("sex"),
                (F.lit(1) + F.col("c_custkey") % 5).cast("int").alias("user_lv_cd"),
                F.to_date("first_order").alias("user_reg_tm"),
            ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products: sku_id, a1, a2, a3, cate, brand."""
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku_id"),
        (F.col("p_size") % 4 - 1).cast("int").alias("a1"),
        (F.col("p_partkey") % 3).cast("int").alias("a2"),
        (F.col("p_partkey") % 2).cast("int").alias("a3"),
        F.col("p_type").alias("cate"),
        F.col("p_brand").alias("brand"),
    )


def target_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target product subset (the feature of the semi-join and the submission)."""
    chosen = _read(spark, sf_dir, "part").where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("sku_id"))
    return products(spark, sf_dir).join(chosen, "sku_id", "left_semi")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly review snapshots: dt, sku_id, comment_num (0..4), has_bad, bad_rate."""
    li = _read(spark, sf_dir, "lineitem")
    bad = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return (li.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("dt"),
                       F.col("l_partkey").alias("sku_id"))
            .agg(F.least(F.count(F.lit(1)), F.lit(4)).cast("int").alias("comment_num"),
                 F.max(bad).cast("int").alias("has_bad"),
                 F.avg(bad.cast("double")).alias("bad_rate")))


# DuckDB forms of the same views, used by the SQL oracle and the tests.
DUCKDB_VIEWS = {
    "actions": """
        SELECT e.user_id AS user_id,
               CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS sku_id,
               e.ts AS time,
               CASE WHEN e.event_type = 'click' AND e.event_id % 3 > 0
                    THEN CAST(e.event_id % 20 AS INTEGER) END AS model_id,
               CAST(CASE e.event_type WHEN 'view' THEN 1 WHEN 'signup' THEN 2
                    WHEN 'error' THEN 3 WHEN 'purchase' THEN 4 WHEN 'click' THEN 6 END
                    AS INTEGER) AS type,
               CASE WHEN e.event_id % 19 = 0 THEN NULL WHEN e.event_id % 13 = 0 THEN 'ECONOMY' ELSE p.p_type END AS cate,
               CASE WHEN e.event_id % 17 = 0 THEN NULL WHEN e.event_id % 11 = 0 THEN 'Brand#99' ELSE p.p_brand END AS brand
        FROM events e
        LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)""",
    "users": """
        SELECT c.c_custkey AS user_id,
               c.c_mktsegment AS age,
               CAST(CASE WHEN c.c_nationkey % 5 = 0 THEN NULL ELSE c.c_nationkey % 3 END
                    AS INTEGER) AS sex,
               CAST(1 + c.c_custkey % 5 AS INTEGER) AS user_lv_cd,
               CAST(f.first_order AS DATE) AS user_reg_tm
        FROM customer c
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order
                   FROM orders GROUP BY o_custkey) f ON f.o_custkey = c.c_custkey""",
    "products": """
        SELECT p_partkey AS sku_id,
               CAST(p_size % 4 - 1 AS INTEGER) AS a1,
               CAST(p_partkey % 3 AS INTEGER) AS a2,
               CAST(p_partkey % 2 AS INTEGER) AS a3,
               p_type AS cate,
               p_brand AS brand
        FROM part""",
    "target_products": """
        SELECT p_partkey AS sku_id FROM part WHERE p_size <= 25""",
    "comments": """
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS dt,
               l_partkey AS sku_id,
               CAST(least(count(*), 4) AS INTEGER) AS comment_num,
               CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS has_bad,
               avg(CASE WHEN l_returnflag = 'R' THEN 1::DOUBLE ELSE 0::DOUBLE END) AS bad_rate
        FROM lineitem
        GROUP BY 1, 2""",
}

