"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

Terms of a document are triples of character classes (letter, capital, digit,
each mark, space, line end), which tell shouting, symbol noise, tables and lists
from prose in any language, and counts of repetition (a word after itself,
windows of three words, lines) and of size.  A term weighs the square root of
its share times its inverse document frequency, counted over all documents.  A
truncated singular value decomposition of the labelled sample's term matrix
gives the latent axes; vectors are scaled to unit length.

Every document is compared with all labelled vectors (exact cosines, in blocks
of documents), and its ``NEIGHBOURS`` nearest vote with their similarity, each
label weighing in total as among all labelled documents.  The labelled vectors are
broadcast: at most ``2 * per_class`` vectors of ``AXES`` numbers.

The fit uses text alone.  A null or empty text, or one whose vector is zero,
gets score 0; equal texts get equal scores; of equally similar neighbours those
of smaller doc_id vote; a text of any length is used whole; with no labelled
document every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents
from actionlens.llm.labelled import remainder, sample
from actionlens.llm.textops import distinct_per_row, segments, shingle_hash, slices, span_hash, words

AXES = 48
NEIGHBOURS = 25
PER_CLASS = 2000
THRESHOLD = 0.5
DIGITS = 9              # to which vectors and similarities are rounded
BLOCK = 512

_CLASS = np.full(256, 14, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[0x20], _CLASS[9:14] = 0, 1, 2, 3, 4
for _i, _c in enumerate(".,!#$%&*|"):
    _CLASS[ord(_c)] = 5 + _i
_CLASS[0x80:0xA0], _CLASS[0xA0:0xC0], _CLASS[0xC0:] = 1, 0, -1      # later bytes of Latin capitals and small letters; lead bytes carry nothing
CLASSES = 15
SHAPES = CLASSES ** 3
EXTRA = 24              # repetition and size terms
TERMS = SHAPES + EXTRA


def term_counts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the documents of one slice."""
    rows = len(off) - 1
    cls = _CLASS[buf]
    row = np.repeat(np.arange(rows), np.diff(off))
    keep = cls >= 0
    cls, row = cls[keep], row[keep]
    n = max(0, len(cls) - 2)
    same = row[:n] == row[2:2 + n]
    shape = ((cls[:n] * CLASSES + cls[1:1 + n]) * CLASSES + cls[2:2 + n])[same]
    count = np.bincount(row[:n][same] * SHAPES + shape, minlength=rows * SHAPES).reshape(rows, SHAPES)

    start, end, of = words(buf, off)
    word = span_hash(buf, start, end)
    n_words = np.bincount(of, minlength=rows)
    again = np.bincount(of[1:][(word[1:] == word[:-1]) & (of[1:] == of[:-1])], minlength=rows) if len(of) else n_words
    h, r = shingle_hash(word, of, 3)
    windows = np.bincount(r, minlength=rows) - np.bincount(distinct_per_row(h, r)[1], minlength=rows)
    ls, le, lr = segments(buf == 0x0A, off)
    lines = np.bincount(lr, minlength=rows)
    line_again = lines - np.bincount(distinct_per_row(span_hash(buf, ls, le), lr)[1], minlength=rows)
    chars = np.bincount(row, minlength=rows)
    extra = np.zeros((rows, EXTRA), np.int64)
    extra[:, 0] = again * 8                                        # as heavy as the letters of the words
    extra[:, 1] = windows * 4
    extra[:, 2] = line_again * 16
    size = np.minimum(np.log2(n_words + 1).astype(np.int64), EXTRA - 5)
    extra[np.arange(rows), 4 + size] = np.maximum(1, chars // 16)
    extra[n_words == 0] = 0
    full = np.concatenate([count, extra], 1)
    at, term = np.nonzero(full)
    return at, term, full[at, term]


def vectors(row: np.ndarray, term: np.ndarray, count: np.ndarray, rows: int, idf: np.ndarray) -> np.ndarray:
    """(rows, TERMS) weighted terms."""
    total = np.bincount(row, count, rows)
    x = np.zeros((rows, TERMS), np.float32)
    x[row, term] = np.sqrt(count / np.maximum(total[row], 1)) * idf[term]
    return x


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x ** 2).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-9)


def axes_of(x: np.ndarray, seed: int = 7) -> np.ndarray:
    """(TERMS, AXES) leading right singular vectors, by subspace iteration."""
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(AXES + 8, *x.shape))).astype(np.float32)
    for _ in range(8):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T)[:, :AXES].astype(np.float32)


class Model:
    def __init__(self, idf: np.ndarray, axes: np.ndarray, known: np.ndarray, label: np.ndarray, good: float = 0.5) -> None:
        """``good``: share of label 1 among all labelled documents, which the sample need not have."""
        self.idf, self.axes, self.known, self.label = idf.astype(np.float32), axes.astype(np.float64), np.round(known.astype(np.float64), DIGITS), label
        share = label.mean() if len(label) else 0.5
        self.weight = np.where(label == 1, good / max(share, 1e-9), (1 - good) / max(1 - share, 1e-9))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.label):
            return np.full(len(x), 0.5)
        # Rounded, so that equal texts score alike wherever they stand in a block; of equally near
        # neighbours the first ones (smaller doc_id) vote.
        x = np.round(unit(x.astype(np.float64) @ self.axes), DIGITS)
        near = np.round(x @ self.known.T, DIGITS)
        k = min(NEIGHBOURS, len(self.label))
        order = np.arange(len(self.label)) * (0.1 ** (DIGITS + 1) / max(len(self.label), 1)) - near
        top = np.sort(np.argpartition(order, k - 1, axis=1)[:, :k], axis=1) if k < len(self.label) else np.tile(np.arange(k), (len(x), 1))
        vote = np.maximum(np.take_along_axis(near, top, 1), 0) ** 4 * self.weight[top]
        total = vote.sum(1)
        return np.where(total > 0, (vote * self.label[top]).sum(1) / np.maximum(total, 1e-30), 0.0)


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each term, and documents, over the whole table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, buf, off in slices(batch.column("text")):
                df[:TERMS] += np.bincount(term_counts(buf, off)[1], minlength=TERMS)
        df[TERMS] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "n"])

    got = documents(docs).mapInArrow(rows, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()     # a row a term
    df = np.zeros(TERMS + 1, np.int64)
    for r in got:
        df[r["term"]] = r["n"]
    return df[:TERMS], int(df[TERMS])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, mod: int = 3, held_out: int = 1) -> Model:
    df, n = document_frequency(docs)
    idf = np.log((n + 1) / (df + 1)) + 0.1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in slices(batch.column("text")):
                row, term, count = term_counts(buf, off)
                cut = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("label").slice(a, b - a),
                     pa.array([term[i:j].astype("<i4").tobytes() for i, j in zip(cut, cut[1:])], pa.binary()),
                     pa.array([count[i:j].astype("<i4").tobytes() for i, j in zip(cut, cut[1:])], pa.binary())], names=["doc_id", "label", "term", "count"])

    known = sample(docs, labels, "quality", mod, held_out, per_class).select("doc_id", "label", "text")
    got = known.mapInArrow(rows, "doc_id long, label int, term binary, count binary").toPandas().sort_values(["doc_id", "term", "count"], kind="stable")
    if not len(got):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    term = [np.frombuffer(b, "<i4") for b in got["term"]]
    row = np.repeat(np.arange(len(got)), [len(t) for t in term])
    x = vectors(row, np.concatenate(term), np.concatenate([np.frombuffer(b, "<i4") for b in got["count"]]), len(got), idf)
    axes = axes_of(x)
    good = labels.where(F.col("quality").isin(0, 1) & (remainder(mod) != held_out)).agg(F.avg("quality")).first()[0]
    return Model(idf, axes, unit(x @ axes), got["label"].to_numpy(np.int64), good)


def score_texts(text: pa.Array, model: Model) -> Iterator[tuple[int, int, np.ndarray]]:
    for a, b, buf, off in slices(text):
        row, term, count = term_counts(buf, off)
        cut = np.searchsorted(row, np.arange(b - a + 1))
        out = np.zeros(b - a)
        for lo in range(0, b - a, BLOCK):
            hi = min(lo + BLOCK, b - a)
            part = slice(cut[lo], cut[hi])
            out[lo:hi] = model.score(vectors(row[part] - lo, term[part], count[part], hi - lo, model.idf))
        yield a, b, np.clip(out, 0, 1)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, score in score_texts(batch.column("text"), model):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(score)], names=["doc_id", "score"])

    return documents(docs).mapInArrow(rows, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least the threshold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
            for a, b, score in score_texts(text, model):
                yield batch.slice(a, b - a).filter(pa.array(score >= THRESHOLD))

    return docs.mapInArrow(rows, docs.schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    out = scores(docs, train(docs, labels))
    return out.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
