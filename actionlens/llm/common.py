"""Spark helpers shared by the operators: tables, shared scratch folder, pinned tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens.session import ensure_checkpoint_dir


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder (URI) under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def pin(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: lineage is cut, a lost
    executor costs nothing, and consumers that prune columns read only those.  The write's shuffle files
    go with it (Spark keeps them until the driver's next garbage collection): nothing reads them again."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, what)
    kept = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)        # mostly text: smaller than with the default by a good part
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if kept is None else spark.conf.set(SHUFFLE_CLEANUP, kept)
    pinned = spark.read.schema(df.schema).parquet(path)
    pinned._pin_path = path
    return pinned


def unpin(*pinned: DataFrame) -> None:
    """Deletes pinned tables that nothing reads any more (their successors are written)."""
    for df in pinned:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._pin_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def rows_of_keys(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of a pinned table whose ``key`` (given by ``monotonically_increasing_id``) is in ``wanted``.

    The rows stay where they are: the wanted keys are written by part of the table (a key's upper bits),
    and a task reads those of the parts that it meets.  A join would shuffle whole texts.
    """
    folder, at = shared_folder(rows.sparkSession, "wanted-keys"), rows.columns.index(key)
    keys = wanted.select(F.col(key).alias("key"), F.shiftright(key, 33).alias("part"))
    keys.repartition("part").write.partitionBy("part").parquet(folder)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, held = None, None
        for batch in batches:
            of_row = batch.column(at).to_numpy()
            part, keep = of_row >> 33, np.zeros(len(of_row), bool)
            for one in np.unique(part).tolist():
                if one != read:
                    read, held = one, _keys_of_part(folder, one)
                keep[part == one] = np.isin(of_row[part == one], held)
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(kept, rows.schema)


def _keys_of_part(folder: str, part: int) -> np.ndarray:
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    files = fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/part={part}", allow_not_found=True))
    found = [pyarrow.parquet.ParquetFile(fs.open_input_file(f.path)).read(["key"]).column(0).to_numpy() for f in files if f.base_name.endswith(".parquet")]
    return np.concatenate([np.zeros(0, np.int64), *found])


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) and nothing else, whatever further columns the input has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def numbered(df: DataFrame, order: list[str], what: str) -> tuple[DataFrame, int]:
    """``df`` with ``row`` = 0, 1, ... in the given order, and the number of rows.

    A range partitioning sorts the rows over many tasks; a row's number is its place in its
    partition plus the rows of the partitions before.  Only one count a partition is summed up,
    so neither a hot key nor the whole table meets in one task.
    """
    placed = pin(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), what)
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect()     # a row a partition
    first, total = {}, 0
    for r in sorted(counts):
        first[r["_part"]], total = total, total + r["_n"]
    if not total:
        return placed.withColumn("row", F.lit(0).cast("long")).drop("_at"), 0
    offsets = placed.sparkSession.createDataFrame(list(first.items()), "_part long, _first long")
    out = placed.withColumn("_part", part.cast("long")).join(F.broadcast(offsets), "_part")  # a row a partition
    return out.withColumn("row", F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_first"), total
