"""File sources and sinks: CSV (with legacy encodings), Parquet, memoised stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACTIONS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("model_id", T.IntegerType()),
    T.StructField("type", T.IntegerType()),
    T.StructField("cate", T.StringType()),
    T.StructField("brand", T.StringType()),
])

USERS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age", T.StringType()),
    T.StructField("sex", T.IntegerType()),
    T.StructField("user_lv_cd", T.IntegerType()),
    T.StructField("user_reg_tm", T.DateType()),
])

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("sku_id", T.LongType()),
    T.StructField("a1", T.IntegerType()),
    T.StructField("a2", T.IntegerType()),
    T.StructField("a3", T.IntegerType()),
    T.StructField("cate", T.StringType()),
    T.StructField("brand", T.StringType()),
])

COMMENTS_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("comment_num", T.IntegerType()),
    T.StructField("has_bad", T.IntegerType()),
    T.StructField("bad_rate", T.DoubleType()),
])


MODERN_ENCODINGS = ("UTF-8", "UTF8", "ISO-8859-1", "US-ASCII")
CHARSETS = "spark.sql.legacy.javaCharsets"


def reading_session(spark: SparkSession, encoding: str) -> SparkSession:
    """The session that reads ``encoding``: for a legacy one such as GBK, which Spark 4 decodes only under a
    setting, one of its own that has it (and the caller's other settings); the caller's stays as it is."""
    if encoding.upper() in MODERN_ENCODINGS or spark.conf.get(CHARSETS, "false").lower() == "true":
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(CHARSETS, "true")
    return own


@contextmanager
def writing_session(spark: SparkSession, encoding: str) -> Iterator[None]:
    """While a write in a legacy encoding runs, the session has the setting it needs."""
    if encoding.upper() in MODERN_ENCODINGS:
        yield
        return
    before = spark.conf.get(CHARSETS, None)
    spark.conf.set(CHARSETS, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CHARSETS)
        else:
            spark.conf.set(CHARSETS, before)


def _csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, encoding: str, header: bool = True, **options) -> DataFrame:
    return (reading_session(spark, encoding).read.schema(schema).options(header=header, encoding=encoding, mode="PERMISSIVE", **options)
            .csv(list(paths) if not isinstance(paths, str) else paths))


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
             encoding: str = "UTF-8", date_format: str = "yyyy-MM-dd",
             ts_format: str = "yyyy-MM-dd HH:mm:ss[.SSSSSS]") -> DataFrame:
    """Headered CSV with a declared schema (no inference pass), in any encoding and any session.

    Bad numbers and dates become NULL (PERMISSIVE mode); ``read_checked`` tells them apart.
    """
    return _csv(spark, paths, schema, encoding, dateFormat=date_format, timestampNTZFormat=ts_format)


BAD_LINE = "number of fields"


def coerced(df: DataFrame, schema: T.StructType, reasons: str | None = None) -> DataFrame:
    """Every column of ``schema`` brought to its declared type; text that is none becomes NULL.

    Numbers may carry white space, a sign, a fraction of zeros for whole numbers, and an exponent.
    ``reasons`` names an array column that lists what failed: ``<column>: not a <type>``.  Columns
    outside the schema stay as they are.
    """
    typed, failed = {}, []
    for field in schema:
        raw = F.trim(F.col(field.name).cast("string"))
        kind = field.dataType.simpleString()
        if isinstance(field.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            number = raw.try_cast("decimal(38,9)")
            value = F.when(number == F.floor(number), number).try_cast(kind)
        else:
            value = raw.try_cast(kind)
        if isinstance(field.dataType, T.StringType):
            value = F.col(field.name).cast("string")
        typed[field.name] = value.alias(field.name)
        failed.append(F.when((raw != "") & value.isNull(), F.lit(f"{field.name}: not a {kind}")))
    rest = [F.col(c) for c in df.columns if c not in typed]
    extra = [F.array_compact(F.array(*failed)).alias(reasons)] if reasons else []
    return df.select(*typed.values(), *rest, *extra)


def read_checked(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """The columns of ``schema``, ``raw_line`` and ``reasons`` of every line of CSV files.

    ``reasons`` is empty for a good line; otherwise it lists each field that is not of its declared
    type, or that the line has too few or too many fields (its fields then count as read, the missing
    ones as NULL).  An empty field is NULL and no fault.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField("raw_line", T.StringType())])
    lines = _csv(spark, paths, text, encoding, header, columnNameOfCorruptRecord="raw_line")
    whole = F.when(F.col("raw_line").isNotNull(), F.array(F.lit(BAD_LINE))).otherwise(F.array().cast("array<string>"))
    return coerced(lines, schema, "faults").select(*schema.fieldNames(), "raw_line", F.concat(whole, "faults").alias("reasons"))


def quarantine(checked: DataFrame, path: str) -> DataFrame:
    """Good rows of a ``read_checked`` table; the others are written to ``path`` with their reasons."""
    columns = [c for c in checked.columns if c not in ("raw_line", "reasons")]
    checked.where(F.size("reasons") > 0).select(*columns, "raw_line", "reasons").write.mode("overwrite").parquet(path)
    return checked.where(F.size("reasons") == 0).select(*columns)


def reason_counts(checked: DataFrame) -> DataFrame:
    """reason, n_rows: how many lines each fault was found in ('good': without any)."""
    each = F.when(F.size("reasons") > 0, F.array_distinct("reasons")).otherwise(F.array(F.lit("good")))
    return checked.select(F.explode(each).alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def union_periods(frames: Sequence[DataFrame]) -> DataFrame:
    """Union per-period extracts by column name (a multi-file scan does the same)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


# Fixed value: log timestamps are text 'YYYY-MM-DD HH:MM:SS'; fractions of a
# second are kept when present, so a written log reads back unchanged.
TS_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    with writing_session(df.sparkSession, encoding):
        (df.write.mode(mode).option("header", True).option("encoding", encoding)
         .option("timestampNTZFormat", TS_WRITE_FORMAT).option("dateFormat", "yyyy-MM-dd").csv(path))


def hadoop_path(spark: SparkSession, path: str):
    """(path, file system) of the cluster's Hadoop client, for marks that readers hide."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has ended: its ``_SUCCESS`` mark is there."""
    mark, fs = hadoop_path(spark, f"{path}/_SUCCESS")
    return fs.exists(mark)


def memoised(spark: SparkSession, df: DataFrame | Callable[[], DataFrame], path: str) -> DataFrame:
    """Stage output kept as Parquet: written once, then read.

    ``path`` must carry every parameter of the stage (dates, windows) so two
    stages never share a file.  Only a finished write (``_SUCCESS``) counts;
    what a failed one left is written over.  The write is a normal
    distributed job; the read gives a lineage-free DataFrame that survives
    executor loss.  A stage given as a function is only planned when it has
    to be written.
    """
    if not is_finished(spark, path):
        (df() if callable(df) else df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_split(df: DataFrame, path: str, ids: Sequence[str], label: str, mode: str = "overwrite") -> None:
    """Split sink: identifiers, features and labels of the same rows in three folders, tied by ``row``."""
    from actionlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.withColumn("row", F.monotonically_increasing_id()).checkpoint()       # one numbering for all three
    rows.select("row", *ids).write.mode(mode).parquet(f"{path}/ids")
    rows.drop(*ids, label).write.mode(mode).parquet(f"{path}/features")
    rows.select("row", label).write.mode(mode).parquet(f"{path}/labels")


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """A deterministic preview: the first ``n`` rows under ``order``
    (``orderBy().limit()`` plans as a per-task top-n, merged once)."""
    return df.orderBy(*order).limit(n)


def write_columns(df: DataFrame, cols: Sequence[str], path: str, mode: str = "append",
                  fmt: str = "csv", header: bool = False) -> None:
    """Column-pruned sink: only ``cols`` are read and written."""
    w = df.select(*cols).write.mode(mode)
    if fmt == "csv":
        w.option("header", header).option("timestampNTZFormat", TS_WRITE_FORMAT).csv(path)
    else:
        w.format(fmt).save(path)


def _by_day(actions: DataFrame, num_partitions: int | None) -> DataFrame:
    n = num_partitions or int(actions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return actions.withColumn("day", F.to_date("time")).repartitionByRange(n, "day", "user_id", "sku_id")


def write_log_by_day(actions: DataFrame, path: str, mode: str = "overwrite",
                     num_partitions: int | None = None) -> None:
    """Store the action log as Parquet partitioned by day.

    Rows are range-partitioned on (day, user_id, sku_id) first: a hot day is
    split across many tasks (no single writer per day) and files come out
    clustered by user, which keeps per-file min/max statistics selective.
    """
    _by_day(actions, num_partitions).write.mode(mode).partitionBy("day").parquet(path)


def replace_days(actions: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Write the days that ``actions`` holds anew (late files); the log's other days stay untouched.

    Dynamic partition overwrite: only folders of days that occur are replaced, when all tasks are done.
    ``actions`` must not read the log it replaces.
    """
    _by_day(actions, num_partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_log(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Read a day-partitioned log; ``[start, end)`` prunes day folders and is
    also pushed to the Parquet reader as a time filter."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where((F.col("day") >= F.lit(start).cast("date"))
                      & (F.col("time") >= F.lit(start).cast("timestamp_ntz")))
    if end is not None:
        df = df.where((F.col("day") < F.lit(end).cast("date"))
                      & (F.col("time") < F.lit(end).cast("timestamp_ntz")))
    return df.drop("day")
