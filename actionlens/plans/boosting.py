"""Boosted trees over many rows: the trees of Spark ML's ``GBTClassifier``, from histograms of packed codes.

Spark ML's pass visits every feature of a row by itself, some microseconds a row and level.  Here the
features' bins are found once and packed, several features to a code of at most ``CODES`` values
(``bundles``), so a pass counts codes, a few dozen a row, and a feature's histogram is a sum over them.
Of two sibling nodes only the one with fewer rows is counted; the other is their parent's less it.

Everything that makes the model is Spark ML's: the sample and the thresholds of the bins, the feature subset
of every node (its own random numbers), gains, the rule of a leaf, losses and step, and the model is a
``GBTClassificationModel``.  Sums differ in one way: a row's gradient is rounded to a fixed fraction
(2^-k, as fine as 53 bits allow for the sum of all rows), so sums are exact and do not depend on the order
of rows or tasks.  Two splits that part a node's rows alike therefore gain exactly the same, and the first
feature of the subset is taken, where in Spark ML the last bit of sums in changing order decides.

A task keeps its rows' codes and margins in files of its executor's local folder and the driver holds the
trees; what is lost with an executor is built again from the pinned table and the trees.
"""

from __future__ import annotations

import contextlib
import math
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CODES = 4096                    # values of a code, at most
PART_ROWS = 2_000_000           # rows whose state one task holds, at most
CHUNK = 1 << 18                 # rows whose codes lie together in a file
BLOCK = 1 << 16                 # rows counted at once
EPSILON = 2.0 ** -52            # Spark's Utils.EPSILON


# ---- bins and bundles ----------------------------------------------------------------------------------------


def thresholds(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Spark ML's thresholds of one feature: values and weights of the sampled rows, the weight expected of the
    whole sample (zeros are what is missing from it), and how many thresholds there may be."""
    seen = values != 0.0
    distinct, at = np.unique(values[seen], return_inverse=True)
    if not len(distinct):
        return np.empty(0)
    count = np.bincount(at, weights[seen])
    if expected - count.sum() > EPSILON * seen.sum() * 100:
        i = int(np.searchsorted(distinct, 0.0))
        distinct, count = np.insert(distinct, i, 0.0), np.insert(count, i, expected - count.sum())
    middle = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride, found, current = expected / (most + 1), [], count[0]
    target = stride
    for i in range(1, len(distinct)):
        previous, current = current, current + count[i]
        if abs(previous - target) < abs(current - target):
            found.append(middle[i - 1])
            target += stride
    return np.array(found)


def bundles(bins: Sequence[int], most: int = CODES) -> list[list[int]]:
    """Features that share a code: the product of their bins is at most ``most``; features of one bin are in none."""
    room: list[int] = []
    found: list[list[int]] = []
    for f in sorted((f for f, n in enumerate(bins) if n > 1), key=lambda f: -bins[f]):
        for i, left in enumerate(room):
            if left >= bins[f]:
                found[i].append(f)
                room[i] = left // bins[f]
                break
        else:
            found.append([f])
            room.append(max(most, bins[f]) // bins[f])
    return found


class Layout(NamedTuple):
    """Where every feature lies in the codes."""
    cuts: list[np.ndarray]              # thresholds a feature
    members: list[list[int]]            # features a bundle
    bundle: np.ndarray                  # bundle of a feature, -1 without a threshold
    stride: np.ndarray                  # a feature's bin is (code // stride) % bins
    bins: np.ndarray
    first: np.ndarray                   # a feature's first place among all bins

    @property
    def sizes(self) -> list[int]:
        return [int(np.prod(self.bins[m])) for m in self.members]


def layout(cuts: list[np.ndarray]) -> Layout:
    bins = np.array([len(c) + 1 for c in cuts], dtype=np.int64)
    members = bundles(bins.tolist())
    bundle, stride = np.full(len(cuts), -1, dtype=np.int64), np.ones(len(cuts), dtype=np.int64)
    for i, some in enumerate(members):
        bundle[some] = i
        stride[some] = np.concatenate([[1], np.cumprod(bins[some])[:-1]])
    return Layout(cuts, members, bundle, stride, bins, np.concatenate([[0], np.cumsum(bins)]))


def packed(x: np.ndarray, at: Layout) -> np.ndarray:
    """One row of codes a bundle.  A value at a threshold lies below it; what is not a number lies above all."""
    codes = np.zeros((len(at.members), len(x)), dtype=np.uint16)
    for i, some in enumerate(at.members):
        for f in some:
            codes[i] += (np.searchsorted(at.cuts[f], x[:, f], side="left") * at.stride[f]).astype(np.uint16)
    return codes


# ---- what tasks do -------------------------------------------------------------------------------------------


class Splits(NamedTuple):
    """A tree (or its levels so far) over nodes numbered from the root, 0, with children 2i + 1 and 2i + 2.
    ``bundle`` is -1 where a node is not split; ``value`` is what a leaf adds to the margin."""
    bundle: np.ndarray
    stride: np.ndarray
    bins: np.ndarray
    cut: np.ndarray                     # the last bin of the left child
    value: np.ndarray

    @classmethod
    def empty(cls, *shape: int) -> Splits:
        return cls(np.full(shape, -1, np.int32), np.ones(shape, np.int32), np.ones(shape, np.int32), np.zeros(shape, np.int32), np.zeros(shape))

    def of(self, k: int) -> Splits:
        return Splits(*[a[k] for a in self])


class Pass(NamedTuple):
    """One pass: the finished trees, the tree that grows, its level, and the nodes whose histograms are asked for."""
    trees: Splits                       # a row a tree
    growing: Splits | None              # None: only the sums of the last tree's leaves
    level: int
    counted: list[int]
    scale: float
    depth: int

    @property
    def nodes(self) -> int:
        return 2 ** (self.depth + 1) - 1


class Part:
    """The rows of a task: codes in chunks, labels, weights, and the state that the last pass left."""

    def __init__(self, folder: str, sizes: list[int]):
        self.folder, self.sizes = folder, sizes
        self.label = np.fromfile(f"{folder}/label")
        self.weight = np.fromfile(f"{folder}/weight") if os.path.exists(f"{folder}/weight") else None
        self.n = len(self.label)

    def chunks(self) -> Iterator[tuple[slice, np.ndarray]]:
        for a in range(0, self.n, CHUNK):
            n = min(CHUNK, self.n - a)
            yield slice(a, a + n), np.memmap(f"{self.folder}/codes", np.uint16, "r", 2 * a * len(self.sizes), (len(self.sizes), n))

    def kept(self, name: str, kind=np.float64) -> np.ndarray | None:
        with contextlib.suppress(FileNotFoundError):
            return np.fromfile(f"{self.folder}/{name}", dtype=kind)
        return None

    def keep(self, name: str, values: np.ndarray, instead: str | None = None) -> None:
        part = f"{self.folder}/{name}.{uuid.uuid4().hex}"
        values.tofile(part)
        os.replace(part, f"{self.folder}/{name}")
        if instead is not None:
            with contextlib.suppress(FileNotFoundError):
                os.remove(f"{self.folder}/{instead}")

    def descend(self, node: np.ndarray, tree: Splits, first: int, last: int) -> None:
        """Rows at the nodes ``first`` to ``last`` go to their children where the node is split."""
        split = [i for i in range(first, last) if tree.bundle[i] >= 0]
        for rows, codes in self.chunks() if split else ():
            at = node[rows]
            for i in split:
                right = (codes[tree.bundle[i]] // np.uint16(tree.stride[i])) % np.uint16(tree.bins[i]) > np.uint16(tree.cut[i])
                at += (at == i) * (np.uint16(i + 1) + right)

    def gradient(self, margin: np.ndarray | None, scale: float) -> np.ndarray:
        """The rows' weighted targets in whole steps of 1 / scale: the label in the first round, then Spark ML's pseudo-residuals."""
        g = self.label.copy() if margin is None else 4.0 * self.label / (1.0 + np.exp(2.0 * self.label * margin))
        return np.rint((g if self.weight is None else g * self.weight) * scale)

    def squares(self, node: np.ndarray, g: np.ndarray, p: Pass) -> np.ndarray:
        return np.bincount(node, (g * g if self.weight is None else g * g / self.weight) / p.scale ** 2, minlength=p.nodes)

    def reached(self, tree: int, splits: Splits, level: int) -> np.ndarray:
        """The rows' nodes after the splits of the levels before ``level``, from the last level that is kept."""
        for k in range(level, 0, -1):
            node = self.kept(f"node-{tree}-{k}", np.uint16)
            if node is not None:
                break
        else:
            k, node = 0, np.zeros(self.n, np.uint16)
        self.descend(node, splits, 2 ** k - 1, 2 ** level - 1)
        return node

    def state(self, p: Pass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients, nodes, and the sums of squared gradients by node (of the last tree's nodes at level 0)."""
        m = len(p.trees.value)
        if p.level:
            g = self.kept(f"g-{m}")
            if g is None:
                g = self.gradient(self.margin(p, m), p.scale)
                self.keep(f"g-{m}", g)
            node = self.reached(m, p.growing, p.level)
            self.keep(f"node-{m}-{p.level}", node, f"node-{m}-{p.level - 1}")
            return g, node, self.squares(node, g, p)
        squares, margin = np.zeros(p.nodes), None
        if m:
            last, before = p.trees.of(m - 1), self.kept(f"margin-{m - 1}") if m > 1 else np.zeros(self.n)
            before = self.margin(p, m - 1) if before is None else before
            g, node = self.kept(f"g-{m - 1}"), self.reached(m - 1, last, p.depth)
            g = self.gradient(before if m > 1 else None, p.scale) if g is None else g
            squares = self.squares(node, g, p)
            if p.growing is None:
                return g, node, squares
            margin = before + last.value[node]
            self.keep(f"margin-{m}", margin, f"margin-{m - 1}")
        g = self.gradient(margin, p.scale)
        self.keep(f"g-{m}", g, f"g-{m - 1}")
        for k in range(1, p.depth):
            with contextlib.suppress(FileNotFoundError):
                os.remove(f"{self.folder}/node-{m - 1}-{k}")
        return g, np.zeros(self.n, np.uint16), squares

    def margin(self, p: Pass, trees: int) -> np.ndarray | None:
        """The rows' margins under the first trees, from the beginning (None: before the first tree)."""
        if not trees:
            return None
        margin = np.zeros(self.n)
        for k in range(trees):
            node = np.zeros(self.n, np.uint16)
            self.descend(node, p.trees.of(k), 0, 2 ** p.depth - 1)
            margin += p.trees.value[k][node]
        self.keep(f"margin-{trees}", margin)
        return margin

    def sums(self, node: np.ndarray, g: np.ndarray, counted: list[int], at: Layout) -> np.ndarray:
        """Rows, weights and gradients (3, nodes, all bins) of the counted nodes."""
        slots = len(counted)
        slot = np.full(int(node.max(initial=0)) + 2, -1, dtype=np.int64)
        slot[[i for i in counted if i < len(slot)]] = [k for k, i in enumerate(counted) if i < len(slot)]
        tables, held = [np.zeros((3, slots * size)) for size in self.sizes], np.empty(BLOCK, np.int64)
        for rows, codes in self.chunks():
            of = slot[node[rows]]
            chosen = np.flatnonzero(of >= 0)
            for a in range(0, len(chosen), BLOCK):
                some = chosen[a:a + BLOCK]
                whole = len(some) == some[-1] - some[0] + 1
                some = slice(some[0], some[-1] + 1) if whole else some
                base, target = of[some], g[rows][some]
                place = held[:len(base)]
                more = None if self.weight is None else self.weight[rows][some] - 1.0
                heavy = None if more is None else np.flatnonzero(more)
                bases = {size: base * size for size in set(self.sizes)} if slots > 1 else {}
                for i, size in enumerate(self.sizes):
                    np.copyto(place, codes[i][some]) if slots == 1 else np.add(bases[size], codes[i][some], out=place)
                    table, n = tables[i], slots * size
                    table[0] += np.bincount(place, minlength=n)
                    table[2] += np.bincount(place, target, minlength=n)
                    if heavy is not None and len(heavy):
                        table[1] += np.bincount(place[heavy], more[heavy], minlength=n)
        found = np.zeros((3, slots, int(at.first[-1])))
        for i, some in enumerate(at.members):
            table = tables[i].reshape(3, slots, *at.bins[some][::-1])           # the first feature changes fastest
            for k, f in enumerate(some):
                other = tuple(2 + len(some) - 1 - j for j in range(len(some)) if j != k)
                found[:, :, at.first[f]:at.first[f + 1]] = table.sum(axis=other)
        found[1] += found[0]                                                    # beyond one a row
        return found


def local_folder() -> str:
    """A new folder beside this executor's shuffle files, which go with it."""
    top = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.mkdtemp(prefix="boosting-", dir=top if os.path.isdir(top) else None)


def build(batches: Iterator[pa.RecordBatch], at: Layout, weighted: bool) -> Iterator[pa.RecordBatch]:
    """Writes the part of a task (features, label and weight) to its executor and tells where."""
    folder, held, rows = local_folder(), [], 0
    with open(f"{folder}/codes", "wb") as codes, open(f"{folder}/label", "wb") as label, open(f"{folder}/weight" if weighted else os.devnull, "wb") as weight:
        def put(last: bool) -> None:
            nonlocal held
            while held and (last or sum(c.shape[1] for c in held) >= CHUNK):
                together = np.concatenate(held, axis=1)
                np.ascontiguousarray(together[:, :CHUNK]).tofile(codes)
                held = [together[:, CHUNK:]] if together.shape[1] > CHUNK else []

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, len(at.cuts))
            if not np.isfinite(x).all():
                raise ValueError("a feature is not a finite number")
            held.append(packed(x, at))
            (batch.column(1).to_numpy(zero_copy_only=False) * 2.0 - 1.0).tofile(label)
            batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64).tofile(weight)
            rows += n
            put(False)
        put(True)
    yield pa.RecordBatch.from_arrays([pa.array([folder]), pa.array([rows], pa.int64())], names=["folder", "n"])


def _run(folder: str, n: int, p: Pass, at: Layout) -> tuple[int, np.ndarray, np.ndarray | None]:
    """Whether a part is not on this executor, or the sums over it."""
    if not n:
        return 0, np.zeros(p.nodes), None
    if not os.path.exists(f"{folder}/label"):
        return 1, np.zeros(p.nodes), None
    part = Part(folder, at.sizes)
    g, node, squares = part.state(p)
    return 0, squares, None if p.growing is None else part.sums(node, g, p.counted, at)


def _each(i: int, rows: Iterator, places: list[tuple[str, int]], p: Pass, at: Layout) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    yield _run(*places[i], p, at)
    for _ in rows:                      # read last: the row that brings the task to its part arrives while it counts
        pass


def _add(a, b):
    return a[0] + b[0], a[1] + b[1], b[2] if a[2] is None else a[2] if b[2] is None else a[2] + b[2]


def _clear(parts: Iterator[tuple[str, int]]) -> Iterator[int]:
    for folder, _ in parts:
        shutil.rmtree(folder, ignore_errors=True)
    yield 0


class Parts:
    """The rows of a fit, spread over the executors."""

    def __init__(self, table: DataFrame, at: Layout, rows: int, weight: str | None):
        self.at = at._replace(cuts=[])
        cores = max(1, table.sparkSession.sparkContext.defaultParallelism)
        columns = [vector_to_array("features").alias("x"), F.col("label").cast("double"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")]
        self.told = table.select(*columns).coalesce(cores * max(1, math.ceil(rows / (cores * PART_ROWS)))).mapInArrow(lambda b: build(b, at, weight is not None), "folder string, n long")
        self.keep()

    def keep(self) -> None:
        # Kept where they were built, so passes go there; if an executor is lost, Spark builds its parts anew elsewhere.
        self.rdd = self.told.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        self.places = self.rdd.collect()            # a row a partition

    def run(self, p: Pass) -> tuple[np.ndarray, np.ndarray | None]:
        at = self.at
        for attempt in range(4):
            places = self.places
            told = self.rdd.mapPartitionsWithIndex(lambda i, rows: _each(i, rows, places, p, at))
            if told.getNumPartitions() > 32:
                lost, squares, found = told.treeReduce(_add)
            else:
                lost, squares, found = 0, 0.0, None
                for one in told.collect():
                    lost, squares, found = _add((lost, squares, found), one)
            if not lost:
                return squares, found
            if attempt < 3:
                self.close()
                self.keep()
        raise RuntimeError(f"{lost} parts of a fit were not on the executor that was to read them")

    def close(self) -> None:
        self.rdd.mapPartitions(_clear).count()
        self.rdd.unpersist()


# ---- growing trees -------------------------------------------------------------------------------------------


class Node:
    """Sums of a node's rows and, once found, its split."""

    def __init__(self, n: float, w: float, s: float):
        self.n, self.w, self.s, self.squares = n, w, s, 0.0
        self.feature, self.bin, self.gain = -1, -1, 0.0

    @property
    def prediction(self) -> float:
        return self.s / self.w

    @property
    def impurity(self) -> float:
        return (self.squares - self.s * self.s / self.w) / self.w


def best_splits(sums: np.ndarray, at: Layout, least: int, gain: float) -> tuple[np.ndarray, ...]:
    """Every feature's best bin to cut after and its gain (minus infinity where no cut is allowed), and the left child's sums."""
    width = int(at.bins.max())
    places = at.first[:-1, None] + np.minimum(np.arange(width), at.bins[:, None] - 1)
    real = np.arange(width) < at.bins[:, None]
    n, w, s = np.cumsum(np.where(real, sums[:, places], 0.0), axis=2)       # left sums after each bin
    total = np.stack([a[:, -1:] for a in (n, w, s)])
    with np.errstate(divide="ignore", invalid="ignore"):
        value = (s * s / w + (total[2] - s) ** 2 / (total[1] - w) - total[2] ** 2 / total[1]) / total[1]
    cut = np.arange(width) < at.bins[:, None] - 1
    allowed = cut & (n >= least) & (total[0] - n >= least) & (value >= gain)
    value = np.where(allowed, value, -np.inf)
    best = value.argmax(axis=1)
    rows = np.arange(len(best))
    return best, value[rows, best], n[rows, best], w[rows, best], s[rows, best]


class Subsets:
    """The feature subsets of a tree's nodes, by Spark ML's random numbers."""

    def __init__(self, spark, seed: int, features: int, chosen: int):
        self.jvm, self.features, self.chosen = spark._jvm, features, chosen
        self.random = self.jvm.java.util.Random(seed)
        self.range = getattr(getattr(self.jvm.scala.collection.immutable, "Range$"), "MODULE$")

    def next(self) -> list[int]:
        if self.chosen == self.features:
            return list(range(self.features))
        told = self.jvm.org.apache.spark.util.random.SamplingUtils.reservoirSampleAndCount(
            self.range.apply(0, self.features).iterator(), self.chosen, self.random.nextLong(), self.jvm.scala.reflect.ClassTag.Int())
        return [int(x) for x in self.jvm.java.util.Arrays.toString(told._1())[1:-1].split(", ")]


def chosen_features(strategy: str, features: int) -> int | None:
    """How many features a node of a single tree may choose from; None for strategies left to Spark ML."""
    if strategy.lower() in ("all", "auto"):
        return features
    with contextlib.suppress(ValueError):
        return min(features, int(strategy)) if int(strategy) > 0 else None
    with contextlib.suppress(ValueError):
        return math.ceil(float(strategy) * features) if 0 < float(strategy) <= 1 else None
    return None


def fits(estimator, features: int) -> bool:
    """Whether ``fit`` states the estimator's parameters: plain boosting with the logistic loss over continuous features."""
    if not isinstance(estimator, GBTClassifier):
        return False
    e = estimator
    level = 2 ** max(0, e.getMaxDepth() - 1) * features * e.getMaxBins() * 4 * 8            # a level's sums are one group in Spark ML
    return (e.getSubsamplingRate() == 1.0 and not e.isSet(e.validationIndicatorCol) and e.getLossType() == "logistic" and e.getMinWeightFractionPerNode() == 0.0
            and 1 <= e.getMaxDepth() <= 10 and 2 <= e.getMaxBins() <= 256 and level <= e.getMaxMemoryInMB() << 20 and chosen_features(e.getFeatureSubsetStrategy(), features) is not None)


def found_cuts(table: DataFrame, estimator: GBTClassifier, rows: int, weights: float, weight: str | None) -> list[np.ndarray]:
    """Thresholds of all features from the rows that Spark ML samples for them."""
    spark, bins = table.sparkSession, min(estimator.getMaxBins(), rows)
    need = max(bins * bins, 10_000)
    fraction = need / rows if need < rows else 1.0
    seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(estimator.getSeed()).nextInt()
    sampled = DataFrame(spark._jsparkSession.createDataFrame(table._jdf.toJavaRDD().sample(False, fraction, seed), table._jdf.schema()), spark)
    told = sampled.select(vector_to_array("features").alias("x"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")).toArrow().combine_chunks()
    n = told.num_rows
    x = told.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    w = told.column("w").to_numpy()
    return [thresholds(x[:, f], w, fraction * weights, bins - 1) for f in range(x.shape[1])]


def fit(table: DataFrame, estimator: GBTClassifier) -> GBTClassificationModel:
    """``estimator`` fitted to a pinned table of ``features``, ``label`` (0 or 1) and its weight column."""
    spark, depth = table.sparkSession, estimator.getMaxDepth()
    weight = estimator.getWeightCol() if estimator.isSet(estimator.weightCol) else None
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows, weights, right = table.agg(F.count(F.lit(1)), F.sum(w), F.every(F.coalesce(F.col("label").isin(0.0, 1.0) & (w > 0), F.lit(False)))).head()
    if not rows or not right:
        return estimator.fit(table)                                     # Spark ML says what is wrong with them
    cuts = found_cuts(table, estimator, rows, weights, weight)
    at = layout(cuts)
    if not at.members:
        return estimator.fit(table)                                     # nothing to choose from
    scale = 2.0 ** (50 - math.ceil(math.log2(weights + 1)))             # |gradient| <= 4: all sums are below 2^53
    chosen = chosen_features(estimator.getFeatureSubsetStrategy(), len(cuts))
    done = Splits.empty(0, 2 ** (depth + 1) - 1)
    grown: list[dict[int, Node]] = []
    steps: list[float] = []
    parts = Parts(table, at, rows, weight)
    try:
        for m in range(estimator.getMaxIter()):
            steps.append(estimator.getStepSize() if m else 1.0)
            nodes, squares = _grow(parts, done, depth, scale, estimator, Subsets(spark, estimator.getSeed() + m, len(cuts), chosen), at)
            _told(grown, squares)
            tree = Splits.empty(1, 2 ** (depth + 1) - 1)
            for i, x in nodes.items():
                _split(tree.of(0), i, x, at)
                tree.value[0, i] = steps[-1] * x.prediction
            done = Splits(*[np.concatenate(a) for a in zip(done, tree)])
            grown.append(nodes)
        _told(grown, parts.run(Pass(done, None, 0, [], scale, depth))[0])
    finally:
        parts.close()
    return _model(spark, estimator, grown, steps, cuts)


def _told(grown: list[dict[int, Node]], squares: np.ndarray) -> None:
    """Squares of the last tree's nodes, from those of its leaves, which the first pass of the next round finds."""
    for i, x in sorted(grown[-1].items(), reverse=True) if grown else ():
        x.squares = float(squares[i]) if x.feature < 0 else grown[-1][2 * i + 1].squares + grown[-1][2 * i + 2].squares


def _split(tree: Splits, i: int, x: Node, at: Layout) -> None:
    if x.feature >= 0:
        tree.bundle[i], tree.stride[i], tree.bins[i], tree.cut[i] = at.bundle[x.feature], at.stride[x.feature], at.bins[x.feature], x.bin


def _grow(parts: Parts, done: Splits, depth: int, scale: float, estimator: GBTClassifier, subsets: Subsets, at: Layout) -> tuple[dict[int, Node], np.ndarray]:
    """The nodes of the next tree, level by level, and the squares of the tree before it."""
    growing, nodes, before, stack = Splits.empty(2 ** (depth + 1) - 1), {}, None, [0]
    whole: dict[int, np.ndarray] = {}                                   # sums of the last level's nodes
    for level in range(depth):
        if not stack:
            break
        ask = [0] if level == 0 else sorted({min((2 * i + 1, 2 * i + 2), key=lambda k: nodes[k].n) for i in {(k - 1) // 2 for k in stack}})
        squares, sums = parts.run(Pass(done, growing, level, ask, scale, depth))
        sums = sums.copy()
        sums[2] /= scale
        here = {k: sums[:, j] for j, k in enumerate(ask)}
        if level == 0:
            before, f = squares, at.members[0][0]
            nodes[0] = Node(*here[0][:, at.first[f]:at.first[f + 1]].sum(axis=1))
        else:
            for k in [k for k in stack if k not in here]:
                here[k] = whole[(k - 1) // 2] - here[k + 1 if k % 2 else k - 1]
            for k in {c for i in {(k - 1) // 2 for k in stack} for c in (2 * i + 1, 2 * i + 2)}:
                nodes[k].squares = float(squares[k])
            stack = [k for k in stack if abs(nodes[k].impurity) >= EPSILON]
        following = []
        for k in stack:                                                 # in the order in which Spark ML draws
            x, subset = nodes[k], subsets.next()
            bins, gains, n, w, s = best_splits(here[k], at, estimator.getMinInstancesPerNode(), estimator.getMinInfoGain())
            order = np.array([f for f in subset if at.bundle[f] >= 0], dtype=np.int64)
            f = int(order[gains[order].argmax()]) if len(order) else -1
            if f < 0 or not gains[f] > 0:
                continue
            x.feature, x.bin, x.gain = f, int(bins[f]), float(gains[f])
            nodes[2 * k + 1] = Node(n[f], w[f], s[f])
            nodes[2 * k + 2] = Node(x.n - n[f], x.w - w[f], x.s - s[f])
            _split(growing, k, x, at)
            following = [2 * k + 2, 2 * k + 1, *following]              # a stack: the right child is on top
        stack, whole = (following if level + 1 < depth else []), here
    return nodes, before


# ---- the model -----------------------------------------------------------------------------------------------


def _model(spark, estimator: GBTClassifier, grown: list[dict[int, Node]], steps: list[float], cuts: list[np.ndarray]) -> GBTClassificationModel:
    """The grown trees as Spark ML's own model."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    tree = jvm.org.apache.spark.ml.tree
    inner, leaf, at_most, regression = tree.InternalNode, tree.LeafNode, tree.ContinuousSplit, jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    variance, parsed, uid = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.org.apache.spark.mllib.linalg.Vectors.parse, jvm.org.apache.spark.ml.util.Identifiable.randomUID
    doubles = lambda values: parsed(str([float(v) for v in values])).toArray()

    def node(nodes: dict[int, Node], i: int):
        x = nodes[i]
        children = [node(nodes, 2 * i + 1), node(nodes, 2 * i + 2)] if x.feature >= 0 else []
        stats = variance(doubles([x.w, x.s, x.squares]), int(x.n))
        if children and not (children[0][1] == children[1][1] is not None):      # leaves that say the same are one
            return inner(float(x.prediction), float(x.impurity), x.gain, children[0][0], children[1][0], at_most(x.feature, float(cuts[x.feature][x.bin])), stats), None
        return leaf(float(x.prediction), float(x.impurity), stats), x.prediction

    estimator._transfer_params_to_java()
    made = gateway.new_array(regression, len(grown))
    with ThreadPoolExecutor(4) as pool:
        for i, root in enumerate(pool.map(lambda nodes: regression(uid("dtr"), node(nodes, 0)[0], len(cuts)), grown)):
            made[i] = root
    java = estimator._java_obj
    model = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), made, doubles(steps), len(cuts), 2)
    return estimator._copyValues(GBTClassificationModel(java.copyValues(model.setParent(java), jvm.org.apache.spark.ml.param.ParamMap())))
