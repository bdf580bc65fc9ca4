"""Registered queries of the subpackage (and their DuckDB SQL where SQL can state them)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens.llm import (conversation_repair, decontamination, jaccard_join, license_scan, line_crf, line_dedup, packing, periodic_runs, quality_knn, sharding, token_frames,
                            toxicity, url_filter)
from actionlens.llm.common import documents, shared_folder, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-frames")
    token_frames.write(table(spark, sf_dir, "documents"), folder, TOKENIZER, END_ID)
    return token_frames.read(spark, folder)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90)


OP2_SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE w[i:i + 2] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM tokens WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingles),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM numbered a JOIN numbered b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)
), both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
degree AS (SELECT u, count(*) AS n FROM both_ways GROUP BY u),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, v FROM reach JOIN both_ways ON u = r
)
SELECT d.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(reach.r)::BIGINT AS component_id, coalesce(any_value(g.n), 0)::BIGINT AS n_links
FROM documents d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN degree g ON g.u = d.doc_id GROUP BY d.doc_id
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Fixed rules of the query: host, path prefix, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, 1024, END_ID)


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards_of(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("line_labels")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op10_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def damaged_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the faults that op11 plants, by the checksum of conv_id and turn."""
    known = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    mark = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    coded = known.withColumn("code", F.crc32(mark) % 20).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return coded.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                                                        F.col("text").cast("string").alias("text"))
    report = conversation_repair.Repair(damaged_turns(rows)).report().withColumnRenamed("conv_id", "r_conv")
    met = rows.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("r_conv")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduplicated(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH lines AS (
  SELECT doc_id, n, unnest(range(len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, row_number() OVER () AS n, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), often AS (
  SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40) GROUP BY key HAVING count(*) >= 5
), marked AS (
  SELECT k.*, keeper IS NOT NULL AND k.doc_id IS DISTINCT FROM keeper AS dropped FROM keyed k LEFT JOIN often o ON o.key = k.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY n, doc_id
"""


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, also inside a lambda."""
    return F.transform(F.array(value), use)[0]


def looped_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the periodic ends that op13 plants, by the checksum of doc_id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def looped(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " "))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return documents(docs).select("doc_id", F.when(h % 10 == 0, _bound(words, looped)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(looped_documents(table(spark, sf_dir, "documents")), min_length=12, min_periods=2)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    digest = F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
    best = found.select("doc_id", "runs", "collapsed", digest.alias("runs_sha256"), longest.alias("best"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_token_frames": op1_token_frames,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_toxicity": op3_toxicity,
    "op4_url_filter": op4_url_filter,
    "op5_decontamination": op5_decontamination,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_feistel_shards": op7_feistel_shards,
    "op8_line_crf": op8_line_crf,
    "op9_license_scan": op9_license_scan,
    "op10_quality_knn": op10_quality_knn,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE: dict[str, str] = {
    "op2_jaccard_join": OP2_SQL,
    "op12_line_dedup": OP12_SQL,
}
