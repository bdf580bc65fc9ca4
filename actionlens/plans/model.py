"""Model stage: feature assembly, hash split, boosted trees / forest, stored models, scoring, staged log-loss.

A fitted model is a stage kept in the shared folder (``stored_model``): it is written once as a Spark ML
pipeline, feature columns included, and read by whatever scores with it, in this session or another.  The
training table is dealt over tasks of bounded size and pinned in the shared checkpoint folder, as feature
vectors, before fitting, because fitting iterates over it.  Boosted trees over many rows are grown by
``boosting`` (the same trees from packed histograms), over fewer by Spark ML itself.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actionlens.plans import boosting
from actionlens.session import ensure_checkpoint_dir
from actionlens.sources.readers import hadoop_path, is_finished

ID_COLS = ("user_id", "sku_id")
NON_FEATURES = {"user_id", "sku_id", "label", "cate", "brand", "bucket", "is_test", "weight"}
TASK_ROWS = 100_000             # rows that one task of a fit reads
HISTOGRAM_ROWS = 250_000        # boosted trees over so many rows or more are grown from packed histograms
POSITIVE_WEIGHT = 217.0         # fixed value: weight of a purchase in the later generation's fit


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    numeric = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, numeric) and f.name not in NON_FEATURES | set(exclude)]


def assembler(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """The rows dealt by pair over tasks of about ``rows`` rows, in whole rounds of the cluster's cores.

    How a table was written says nothing about how long a pass over it takes: few large files leave cores
    idle, one file more than there are cores makes every pass twice as long, and a fit makes hundreds.
    """
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    n = cores * max(1, math.ceil(df.count() / (rows * cores)))
    keys = [c for c in (*ID_COLS, "cate", "brand") if c in df.columns]
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def gbt(max_iter: int = 200, depth: int = 4, step: float = 0.05, weight_col: str | None = None,
        seed: int = 0) -> GBTClassifier:
    g = GBTClassifier(featuresCol="features", labelCol="label", maxDepth=depth, maxIter=max_iter,
                      stepSize=step, minInstancesPerNode=5, subsamplingRate=1.0,
                      featureSubsetStrategy="0.8", seed=seed, checkpointInterval=10)
    if weight_col:
        g.setWeightCol(weight_col)
    return g


def forest(seed: int = 0, weight_col: str | None = None) -> RandomForestRegressor:
    f = RandomForestRegressor(featuresCol="features", labelCol="label", seed=seed)
    return f.setWeightCol(weight_col) if weight_col else f


def with_class_weight(df: DataFrame, pos_weight: float) -> DataFrame:
    """Per-row weight: ``pos_weight`` for positives, 1 otherwise."""
    return df.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))


def fit(train: DataFrame, estimator, pos_weight: float | None = None, cols: Sequence[str] | None = None) -> PipelineModel:
    """Assembler and estimator fitted to ``train``; with ``pos_weight`` every positive row weighs so much."""
    if (pos_weight is not None) != estimator.isSet(estimator.weightCol):
        raise ValueError("pos_weight and the estimator's weight column go together")
    data = dealt(train).withColumn("label", F.col("label").cast("double"))
    if pos_weight is not None:
        data = with_class_weight(data, pos_weight)
    features = assembler(cols or feature_columns(train))
    table = pin(features.transform(data).select("features", "label", *(["weight"] if pos_weight is not None else [])))
    if boosting.fits(estimator, len(features.getInputCols())) and table.count() >= HISTOGRAM_ROWS:
        return PipelineModel([features, boosting.fit(table, estimator)])
    return PipelineModel([features, estimator.fit(table)])


# ---- stored models -----------------------------------------------------------------------------------------


def data_version(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the names, sizes and times of the files under ``paths``: another one as soon as a file is
    added or written anew.  The files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path", "length", "modificationTime")
    return str(files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).head())


def stage_path(folder: str, name: str, **parameters) -> str:
    """Folder of a stage: its name and a digest of every parameter it depends on."""
    return f"{folder.rstrip('/')}/{name}-{hashlib.sha256(json.dumps(parameters, sort_keys=True, default=str).encode()).hexdigest()[:24]}"


def parameters_of(estimator) -> dict[str, str]:
    return {"estimator": type(estimator).__name__} | {p.name: str(v) for p, v in estimator.extractParamMap().items()}


def stored_model(spark: SparkSession, path: str, fitted: Callable[[], PipelineModel]) -> PipelineModel:
    """The model kept under ``path``; fitted and written first where no finished one is there.

    The mark of a finished write comes last, so what a lost driver left half-written is written over.
    """
    if not is_finished(spark, path):
        fitted().write().overwrite().save(path)
        mark, fs = hadoop_path(spark, f"{path}/_SUCCESS")
        fs.create(mark, True).close()
    return PipelineModel.load(path)


# ---- scoring -----------------------------------------------------------------------------------------------


def scores(model: PipelineModel, candidates: DataFrame, digits: int = 9) -> DataFrame:
    """user_id, sku_id, score: the probability of a purchase, or the forest's prediction."""
    told = model.transform(candidates)
    score = vector_to_array("probability")[1] if isinstance(model.stages[-1], GBTClassificationModel) else F.col("prediction")
    return told.select(*ID_COLS, F.round(score, digits).alias("score"))


def split_logloss(model: PipelineModel, data: DataFrame) -> DataFrame:
    """Log-loss of the model on both parts of a split table (label, is_test), in one row."""
    told = pin(model.transform(data.withColumn("label", F.col("label").cast("double"))).select("label", "is_test", "prediction", "probability"))
    ev = MulticlassClassificationEvaluator(labelCol="label", probabilityCol="probability", metricName="logLoss")
    tr, te = (ev.evaluate(told.where(F.col("is_test") == part)) for part in (0, 1))
    counts = told.groupBy().agg(F.count_if(F.col("is_test") == 0).alias("train_rows"), F.count_if(F.col("is_test") == 1).alias("test_rows"))
    return counts.select("train_rows", "test_rows", F.lit(round(tr, 9)).alias("train_logloss"), F.lit(round(te, 9)).alias("test_logloss"))


def leaf_margins(model: GBTClassificationModel) -> np.ndarray:
    """What each leaf of each tree (one row a tree, leaves from left to right) adds to the margin."""
    trees = re.split(r"^\s*Tree \d+ \(weight .*\):$", model.toDebugString, flags=re.M)[1:]
    leaves = [[float(x) for x in re.findall(r"Predict: (\S+)", t)] for t in trees]
    table = np.zeros((len(trees), max(map(len, leaves))))
    for row, values, weight in zip(table, leaves, model.treeWeights):
        row[:len(values)] = np.array(values) * weight
    return table


def _round_sums(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    rounds = len(table)
    sums: dict[int, list] = {}
    for batch in batches:
        label, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        leaf = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(label), rounds)
        margin = np.cumsum(table[np.arange(rounds), leaf], axis=1)                      # running margin over the trees
        loss = np.logaddexp(0.0, -2.0 * np.where(label == 1, 1.0, -1.0)[:, None] * margin)
        for p in np.unique(part).tolist():
            old = sums.setdefault(p, [0, np.zeros(rounds)])
            old[0] += int((part == p).sum())
            old[1] += loss[part == p].sum(axis=0)
    for p, (n, total) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([p] * rounds, pa.int32()), pa.array(range(1, rounds + 1), pa.int32()), pa.array([n] * rounds, pa.int64()), pa.array(total)],
                                         names=["is_test", "round", "n", "loss"])


def staged_logloss(model: PipelineModel, data: DataFrame, digits: int = 9) -> DataFrame:
    """round, train_rows, test_rows, train_logloss, test_logloss: the log-loss of the ensemble's first 1, 2, ...
    trees on both parts of a split table (label, is_test), from one pass over its rows.

    Every row's leaf in every tree gives its running margin over the rounds; a task sums the losses of its
    rows, and one row a round, part and task is shuffled.  A part without rows has NULL.
    """
    *before, trees = model.stages
    table = leaf_margins(trees)
    rows = PipelineModel(before).transform(data)
    told = trees.transform(rows, {trees.leafCol: "leaf"}).select(F.col("label").cast("double").alias("label"), F.col("is_test").cast("int").alias("is_test"), vector_to_array("leaf").alias("leaf"))
    sums = told.mapInArrow(lambda batches: _round_sums(batches, table), "is_test int, round int, n long, loss double")
    part = lambda p, c: F.sum(F.when(F.col("is_test") == p, F.col(c)))
    by_round = sums.groupBy("round").agg(*[part(p, c).alias(f"{c}{p}") for p in (0, 1) for c in ("n", "loss")])
    return by_round.select("round", *[F.coalesce(f"n{p}", F.lit(0).cast("long")).alias(f"{name}_rows") for p, name in ((0, "train"), (1, "test"))],
                           *[F.round(F.col(f"loss{p}") / F.col(f"n{p}"), digits).alias(f"{name}_logloss") for p, name in ((0, "train"), (1, "test"))])
