"""Reproducible shuffle into shards by a Feistel permutation with cycle walking.

Documents are numbered 0..n-1 in (doc_id, checksum, size) order; a keyed
permutation of these numbers gives each its place in the shuffle, and place
``q`` lies in shard ``q % shards`` at slot ``q // shards``.  Shard counts are at
most one apart, slots are gapless, and ``place`` computes shard and slot of any
row number, without a table.

The permutation is an alternating Feistel network on the grid a x b with
a = ceil(sqrt(n)), b = ceil(n / a): at most sqrt(n) grid cells lie beyond n.
Numbers that land there are walked on (permuted again) until they land below n;
the longest walk is found beforehand by walking those few cells.

Only SQL functions are used.  Null text has size 8 and checksum 0; null doc_ids
come first; rows equal in every ordering column may swap places among
themselves without changing the result; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens.llm.common import documents, numbered

PRIME = 2147483647      # products of two numbers below it fit a 64-bit integer
ROUNDS = 8


def _keys(seed: int) -> list[tuple[int, int, int]]:
    r = random.Random(seed)
    return [(r.randrange(PRIME), r.randrange(1, PRIME), r.randrange(PRIME)) for _ in range(ROUNDS)]


def _grid(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(n) + (math.isqrt(n) ** 2 < n))
    return a, -(-n // a)


def permuted(q: int, n: int, seed: int) -> int:
    """One pass of the network on a grid number (plain Python, for readers and tests)."""
    a, b = _grid(n)
    left, right = divmod(q, b)
    for i, (k, m, c) in enumerate(_keys(seed)):
        t = ((left if i % 2 else right) + k) % PRIME
        f = (t * t % PRIME * t % PRIME * m % PRIME + c) % PRIME
        left, right = (left, (right + f) % b) if i % 2 else ((left + f) % a, right)
    return left * b + right


def place(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """(shard, slot) of a row number."""
    q = permuted(row, n, seed)
    while q >= n:
        q = permuted(q, n, seed)
    return q % shards, q // shards


def _permuted(q: Column, n: int, seed: int) -> Column:
    a, b = _grid(n)
    keys = F.array(*[F.struct(F.lit(i % 2).alias("odd"), F.lit(k).cast("long").alias("k"), F.lit(m).cast("long").alias("m"), F.lit(c).cast("long").alias("c"))
                     for i, (k, m, c) in enumerate(_keys(seed))])
    side = lambda left, right: F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))

    def step(acc: Column, key: Column) -> Column:
        left, right, odd = acc["left"], acc["right"], key["odd"] == 1
        shifted = F.transform(F.array((F.when(odd, left).otherwise(right) + key["k"]) % PRIME),
                              lambda t: (t * t % PRIME * t % PRIME * key["m"] % PRIME + key["c"]) % PRIME)[0]
        return side(F.when(odd, left).otherwise((left + shifted) % a), F.when(odd, (right + shifted) % b).otherwise(right))

    return F.aggregate(keys, side((q - q % b) / b, q % b), step, lambda acc: acc["left"] * b + acc["right"])


def _longest_walk(spark: SparkSession, n: int, seed: int) -> int:
    a, b = _grid(n)
    out, walks = spark.range(n, a * b).toDF("q"), 0
    while out.limit(1).count():
        out, walks = out.select(_permuted(F.col("q"), n, seed).alias("q")).where(F.col("q") >= n), walks + 1
    return walks


def shards_of(docs: DataFrame, shards: int = 24, seed: int = 20240131) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    narrow = documents(docs).select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows, n = numbered(narrow, ["doc_id", "text_crc32", "size"], "shard-rows")
    q = F.col("row")
    if n:
        walks = _longest_walk(docs.sparkSession, n, seed)
        q = _permuted(q, n, seed)
        if walks:
            q = F.aggregate(F.sequence(F.lit(1), F.lit(walks)), q, lambda at, _: F.when(at < n, at).otherwise(_permuted(at, n, seed)))
    return (rows.withColumn("_q", q)
            .select("doc_id", "size", "text_crc32", (F.col("_q") % shards).cast("int").alias("shard"), F.expr(f"_q div {shards}").alias("slot")))
