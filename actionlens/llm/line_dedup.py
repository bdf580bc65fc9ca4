"""Line de-duplication across documents (DataFrame functions only).

Every line's key (the line without white space at both ends, A-Z lower-cased) is known by a
128-bit hash.  The hashes are range-partitioned together with doc_id, so a line that a third of
all documents hold is dealt over many tasks, and sorted by document and position inside a
partition; a stream over the sorted rows marks a key's first occurrence in each document.  The
marked rows give the documents a key is found in (combined in each task before the shuffle) and
the one that keeps it.  The result is one keep bitmap per document that loses a line, as runs of
kept lines; texts are not shuffled for it.  ``deduplicated`` applies the bitmaps to the texts.

Defined results: a null text is one empty line.  A document is a doc_id: rows of the same doc_id
count once and keep or lose a line alike; rows without doc_id are one document, smaller than all
others.  A key that the keeping document holds several times stays there each time.  Keys of fewer
than ``min_chars`` code points (empty lines too) are never dropped.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionlens.llm.common import documents, pin

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased; ``lower`` does it for lines of ASCII alone."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, also where ``use`` has it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, text_hash, n_lines, pos, first): the long lines, ``first`` for a key's first one in its document."""
    rows = documents(docs).select("doc_id", _text_hash(F.col("text")).alias("text_hash"), split_lines(F.col("text")).alias("lines"))
    rows = rows.select("doc_id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = rows.select("doc_id", "text_hash", "n_lines", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    hashed = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second hash"), "key").alias("h2"), "doc_id", "text_hash", "n_lines", "pos")
    in_order = Window.partitionBy(*KEY, "doc_id").orderBy("pos")       # the range partitioning serves it: no further shuffle
    return hashed.repartitionByRange(*KEY, "doc_id").withColumn("first", F.row_number().over(in_order) == 1)


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per (doc_id, text_hash) that loses a line: n_lines, n_dropped and ``keep_runs``, the keep
    bitmap as runs (first line, number of lines) of kept lines."""
    lines = pin(occurrences(docs, min_chars), "line-keys")
    often = lines.where("first").groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")).where(F.col("n_docs") >= min_docs)
    often = pin(often, "repeated-lines")            # so both sides of the join are dealt anew, and the rows of a hot line can be split
    dropped = lines.join(often, KEY).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    places = dropped.groupBy("doc_id", "text_hash", "n_lines").agg(F.sort_array(F.collect_set("pos")).alias("gone"))    # at most a text's lines
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda p: p + 1))
    ends = F.concat(F.col("gone"), F.array("n_lines"))
    runs = F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), (b - a).alias("n"))), lambda r: r["n"] > 0)
    return places.select("doc_id", "text_hash", F.col("n_lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), runs.alias("keep_runs"))


def deduplicated(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every row of ``docs`` with the lines its bitmap keeps."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(F.col("doc_id").alias("b_doc"), F.col("text_hash").alias("b_hash"), "n_dropped", "keep_runs")
    rows = documents(docs).withColumn("text_hash", _text_hash(F.col("text")))
    met = rows.join(bitmaps, F.col("doc_id").eqNullSafe(F.col("b_doc")) & (F.col("text_hash") == F.col("b_hash")), "left")
    runs = F.col("keep_runs")
    kept = _let(split_lines(F.col("text")), lambda lines: F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(lines, r["first"] + 1, r["n"]))), "\n"))
    return met.select("doc_id", F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                      F.when(runs.isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("text"))
