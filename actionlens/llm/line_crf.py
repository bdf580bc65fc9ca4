"""Quality rules by line labelling: a linear-chain conditional random field.

Each line with a word is one step of a chain with two labels, content or
boilerplate.  Scores are linear in the line's features (size, letters, capitals,
digits, marks, symbols, repetition inside the line, repetition of an earlier
line, sentence end) plus a score for each pair of neighbouring labels; Viterbi
decoding gives the best labels of the whole document.  A document is retained
if it passes the base rules and at least ``CONTENT_SHARE`` of its words stand in
content lines.

The field is fitted by maximum likelihood (exact forward-backward gradients) on
a bounded sample of labelled documents: lines of good documents are content,
but for lines equal to an earlier line of the same document; lines of bad
documents are boilerplate.  Documents weigh by their label's share of all
labelled documents, good ones ``KEEP`` times.  A sample document is cut into chains of at most
``FIT_LINES`` lines; where the sample has more than ``per_chains`` chains a label, the first by a hash
are fitted on, whatever the length of their document (all documents are decoded whole).

Null and empty texts have no words and fail the base rules; repeated rows are
judged each; a text of any length is decoded whole; with no labelled document
every line is content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents
from actionlens.llm.labelled import sample
from actionlens.llm.textops import segments, shingle_hash, slices, span_hash, words

PER_CLASS = 1500
FIT_LINES = 256
PER_CHAINS = 6000
CONTENT_SHARE = 0.5
KEEP = 4                # losing a good document costs so many times keeping a bad one
FEATURES = 14

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True


class Lines:
    """Words and lines of the documents of one slice, with base measures and line features."""

    def __init__(self, buf: np.ndarray, off: np.ndarray) -> None:
        rows = len(off) - 1
        start, end, row = words(buf, off)
        word = span_hash(buf, start, end)
        count = lambda flag: np.diff(np.r_[0, np.cumsum(flag)][off])
        self.n_words = np.bincount(row, minlength=rows)
        self.word_chars = count(((buf & 0xC0) != 0x80) & ~_SPACE[buf])
        self.n_symbols = count(_SYMBOL[buf])
        self.n_repeat = _repeated(word, row, rows)

        ls, le, lr = segments(buf == 0x0A, off)
        first = np.searchsorted(start, ls)
        n = np.searchsorted(start, le) - first
        some = n > 0
        ls, le, lr, first, n = ls[some], le[some], lr[some], first[some], n[some]
        h = span_hash(buf, ls, le)
        order = np.lexsort((np.arange(len(h)), h, lr))
        again = np.zeros(len(h), bool)
        again[order[1:]] = (h[order][1:] == h[order][:-1]) & (lr[order][1:] == lr[order][:-1])
        self.row, self.words, self.again, self.rows = lr, n, again, rows
        self.n_dup_lines = np.bincount(lr, again, rows).astype(np.int64)

        per = lambda flag: (lambda c: c[le] - c[ls])(np.r_[0, np.cumsum(flag)])
        chars = np.maximum(per(((buf & 0xC0) != 0x80) & ~_SPACE[buf]), 1)
        line_of = np.repeat(np.arange(len(n)), n)
        own = word[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(line_of))] if len(n) else word[:0]
        o = np.lexsort((own, line_of))
        same = np.bincount(line_of[o][1:][(own[o][1:] == own[o][:-1]) & (line_of[o][1:] == line_of[o][:-1])], minlength=len(n)) if len(o) else n
        next_ = np.bincount(line_of[1:][(own[1:] == own[:-1]) & (line_of[1:] == line_of[:-1])], minlength=len(n)) if len(o) else n
        caps, marks = per(_CAPITAL[buf]) / chars, per(_MARK[buf])
        symbols = per(_SYMBOL[buf]) / chars
        if len(n):
            last = buf[end[first + n - 1] - 1]
            opens = buf[start[first]]
        else:
            last = opens = buf[:0]
        self.x = np.stack([
            np.ones(len(n)), again, np.log1p(n) / 3, n < 4, symbols * 4, symbols > 0.1, caps * 2, caps > 0.5, per(_DIGIT[buf]) / chars * 2,
            marks / np.maximum(n, 1), same / np.maximum(n, 1), next_ / np.maximum(n, 1) * 2, np.isin(last, [0x2E, 0x21, 0x3F]), (opens >= 97) & (opens < 123),
        ], 1).astype(float).reshape(len(n), FEATURES)


def _repeated(word: np.ndarray, row: np.ndarray, rows: int, k: int = 8) -> np.ndarray:
    """Words inside a k-word window that its document has twice or more."""
    n = len(word)
    if n < k:
        return np.zeros(rows, np.int64)
    inside = np.flatnonzero(row[:n - k + 1] == row[k - 1:])
    sizes = np.bincount(row, minlength=rows)
    h, r = shingle_hash(word, row, k)
    keep = sizes[r] >= k                        # documents of fewer words have no window
    h, r = h[keep], r[keep]
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    same = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    many = np.r_[False, same] | np.r_[same, False]
    at = inside[order[many]]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + k, -1)
    return np.bincount(row, np.cumsum(cover)[:n] > 0, rows).astype(np.int64)


class Field:
    """Weights: (FEATURES, 2) line scores and (2, 2) scores of neighbouring labels; label 1 is content."""

    def __init__(self, line: np.ndarray, pair: np.ndarray) -> None:
        self.line, self.pair = line, pair

    def viterbi(self, x: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Best label of every line; the documents of a slice step together."""
        score = x @ self.line
        grid, size = _steps(row)
        best = score.copy()
        back = np.zeros((len(row), 2), np.int8)
        for t in range(1, size.max(initial=0)):
            m = int((size > t).sum())
            at = grid[:m] + t
            through = best[at - 1][:, :, None] + self.pair[None]
            back[at] = through.argmax(1)
            best[at] += through.max(1)
        label = np.zeros(len(row), np.int64)
        end = grid + size - 1
        label[end] = best[end].argmax(1)
        for t in range(size.max(initial=0) - 1, 0, -1):
            m = int((size > t).sum())
            at = grid[:m] + t
            label[at - 1] = back[at, label[at]]
        return label


def _steps(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of each document that has lines, longest first."""
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(row)])
    order = np.argsort(-size, kind="stable")
    return first[order], size[order]


def _gradient(x: np.ndarray, y: np.ndarray, row: np.ndarray, weight: np.ndarray, line: np.ndarray, pair: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted negative log-likelihood and its gradients, by forward-backward over all chains at once."""
    score = x @ line
    grid, size = _steps(row)
    w = weight[row[grid]] if len(grid) else np.zeros(0)
    lse = lambda a, axis: (lambda m: m.squeeze(axis) + np.log(np.exp(a - m).sum(axis)))(a.max(axis, keepdims=True))
    fwd, bwd = score.copy(), np.zeros_like(score)
    for t in range(1, size.max(initial=0)):
        at = grid[:int((size > t).sum())] + t
        fwd[at] += lse(fwd[at - 1][:, :, None] + pair[None], 1)
    for t in range(size.max(initial=0) - 1, 0, -1):
        at = grid[:int((size > t).sum())] + t
        bwd[at - 1] = lse(pair[None] + (score[at] + bwd[at])[:, None, :], 2)
    total = lse(fwd[grid + size - 1], 1)
    z, lw = np.zeros(len(row)), np.zeros(len(row))
    doc = np.repeat(np.arange(len(grid)), size)
    lines = np.repeat(grid, size) + np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    z[lines], lw[lines] = total[doc], w[doc]
    p = np.exp(fwd + bwd - z[:, None])
    one = np.eye(2)[y]
    at = np.flatnonzero(np.r_[False, row[1:] == row[:-1]])
    pp = np.exp(fwd[at - 1][:, :, None] + pair[None] + (score[at] + bwd[at])[:, None, :] - z[at][:, None, None])
    gold = (one * score).sum(1)
    gold[at] += pair[y[at - 1], y[at]]
    loss = float((w * total).sum() - (lw * gold).sum())
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1], y[at]), lw[at])
    return loss, x.T @ (lw[:, None] * (p - one)), (lw[at][:, None, None] * pp).sum(0) - seen


def fit(x: np.ndarray, y: np.ndarray, row: np.ndarray, weight: np.ndarray, steps: int = 150) -> Field:
    """Adam on the penalised likelihood; ``weight`` per document."""
    line, pair = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    if not len(y):
        line[0, 1] = 1.0
        return Field(line, pair)
    params, m, v = [line, pair], [0.0, 0.0], [0.0, 0.0]
    n = weight.sum()
    for t in range(1, steps + 1):
        _, g_line, g_pair = _gradient(x, y, row, weight, *params)
        for i, g in enumerate((g_line, g_pair)):
            g = g / n + 1e-3 * params[i]
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
            params[i] = params[i] - 0.2 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
    return Field(*params)


def chains(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, per_chains: int = PER_CHAINS) -> DataFrame:
    """(doc_id, label, chain, x) of at most ``per_chains`` chains a label of a bounded sample of labelled documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in slices(batch.column("text")):
                s = Lines(buf, off)
                cut = np.searchsorted(s.row, np.arange(b - a + 1))
                parts = [(a + i, n, lo, min(lo + FIT_LINES, cut[i + 1])) for i in range(b - a) for n, lo in enumerate(range(cut[i], cut[i + 1], FIT_LINES))]
                of = pa.array([p[0] for p in parts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(of), batch.column("label").take(of), pa.array([p[1] for p in parts], pa.int32()),
                     pa.array([s.x[lo:hi].astype("<f4").tobytes() for _, _, lo, hi in parts], pa.binary())], names=["doc_id", "label", "chain", "x"])

    known = sample(docs, labels, "quality", 1, 1, per_class).select("doc_id", "label", "text")
    cut_up = known.mapInArrow(rows, "doc_id long, label int, chain int, x binary")
    order = [F.xxhash64("doc_id", "chain"), "doc_id", "chain", "x"]
    return cut_up.where("label = 0").orderBy(*order).limit(per_chains).unionByName(cut_up.where("label = 1").orderBy(*order).limit(per_chains))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, per_chains: int = PER_CHAINS) -> Field:
    """Fit on the chains of a bounded sample of labelled documents."""
    got = chains(docs, labels, per_class, per_chains).toPandas().sort_values(["doc_id", "chain", "x"], kind="stable")
    x = [np.frombuffer(b, "<f4").reshape(-1, FEATURES).astype(float) for b in got["x"]]
    if not x:
        return fit(np.zeros((0, FEATURES)), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    label = got["label"].to_numpy(np.int64)
    row = np.repeat(np.arange(len(x)), [len(p) for p in x])
    flat = np.concatenate(x)
    y = np.where(flat[:, 1] > 0, 0, label[row])
    share = labels.where(F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    good = label[~got.duplicated(["doc_id"]).to_numpy() | (got["chain"] == 0).to_numpy()].mean()     # by document
    weight = np.where(label == 1, KEEP * share / max(good, 1e-9), (1 - share) / max(1 - good, 1e-9)) if 0 < good < 1 else np.ones(len(label))
    return fit(flat, y, row, weight)


def decoded(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, the base measures, content_words and the labels (one a line with a word, 1 for content)."""
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words", "line_labels"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in slices(batch.column("text")):
                s = Lines(buf, off)
                label = field.viterbi(s.x, s.row)
                content = np.bincount(s.row, s.words * label, b - a).astype(np.int64)
                cut = np.searchsorted(s.row, np.arange(b - a + 1))
                text = (label + 48).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *(pa.array(c.astype(np.int64)) for c in (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat, content)),
                     pa.array([text[i:j].tobytes().decode() for i, j in zip(cut, cut[1:])], pa.string())], names=names)

    return documents(docs).mapInArrow(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_words long, line_labels string")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Measures and verdict of every row, with its content words and line labels."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = ~F.col("base_failed") & (F.col("content_words") >= CONTENT_SHARE * F.col("n_words"))
    return decoded(docs, train(docs, labels)).withColumn("base_failed", failed).withColumn("kept", kept)
