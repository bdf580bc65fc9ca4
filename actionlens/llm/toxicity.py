"""Toxicity by a subsequence string kernel support vector machine.

The kernel compares two words by their common letter subsequences of length
three, each weighted ``DECAY ** span``, so letters may be inserted or skipped at
a price.  ``LANDMARKS`` words give the Nystroem feature map (kernel values to
the landmarks, whitened by the landmarks' own kernel matrix), and a linear SVM
separates the words that make a sentence toxic from the others.  A sentence
scores as its worst word, and a document by its two worst words and their
number, mapped to 0..1 by a logistic fit.

Labels are per document, so the words are found by a multiple-instance
fit: words seen far more often in toxic than in clean sentences start as
positive, with the most telling words of toxic documents that hold none of those
(words around a stem that toxic documents share more often than clean ones).
After each fit the worst words of the toxic documents join them, for a document
that still scores below 0 its most telling ones, while every word of clean
documents stays negative.

A landmark expansion is linear in the kernel's features, so scoring a word is a
sum over its letter triples of one learned weight each, divided by the word's
own norm; no landmark is visited.  ASCII punctuation is dropped and words of
single letters in a row are joined before words are split, so ``i.d.i.o.t`` and
``i d i o t`` are words too.

The fit uses a bounded sample (``per_class`` documents of each label, first by
hash) and text alone; of the sample's words it takes at most ``MOST_POSITIVE``
and, a round, three times ``MOST_NEGATIVE`` (the frequent, some by hash, the
worst scored).  A margin below ``FLOOR`` counts as ``FLOOR``.  Null and empty texts have no words and get the lowest
score; equal texts get equal scores; a text of any length is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents
from actionlens.llm.labelled import remainder, sample
from actionlens.llm.textops import lowered, slices, span_hash, words

SPAN = 8                # widest span of a letter triple
DECAY = 0.7
LETTERS = 24            # letters of a word compared; a longer word is compared by overlapping parts of this size
LANDMARKS = 128
PER_CLASS = 1200
PART = 20_000           # words scored at once
THRESHOLD = 0.3
FLOOR = -0.9            # margins below it tell no more
MOST_POSITIVE = 4000    # words of each side that a fit takes
MOST_NEGATIVE = 1500
STEMS = (4, 5, 6, 7, 8)     # bytes of the stems that telling words share
TELLING = 4             # times as often in toxic documents as in clean ones

_CODE = np.full(256, -1, np.int64)                  # letters and digits; of a multi-byte letter its later bytes
_CODE[97:123] = np.arange(26)
_CODE[48:58] = np.arange(26, 36)
_CODE[0x80:0xC0] = np.arange(36, 100)
ALPHABET = 100
_DROP = np.zeros(256, bool)
_DROP[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def normal(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes without punctuation, single letters in a row joined; new offsets."""
    buf = lowered(buf)
    for drop in (_DROP[buf], None):
        if drop is None:
            start, end, row = words(buf, off)
            if not len(start):
                break
            letters = np.add.reduceat(((buf & 0xC0) != 0x80).astype(np.int64), start) if len(start) else start
            single = (end - start <= 4) & (letters - np.add.reduceat((buf <= 0x20).astype(np.int64), start) == 1)
            pair = np.flatnonzero(single[:-1] & single[1:] & (row[1:] == row[:-1]) & (start[1:] == end[:-1] + 1))
            triple = np.isin(pair, pair + 1) | np.isin(pair, pair - 1)          # runs of three and more
            drop = np.zeros(len(buf), bool)
            drop[end[pair[triple]]] = True
        keep = ~drop
        off = np.r_[0, np.cumsum(keep)][off]
        buf = buf[keep]
    return buf, off


def codes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, LETTERS) letter codes, padded with -1, and the word of each part; parts overlap by SPAN - 1."""
    step = LETTERS - SPAN + 1
    parts = np.maximum(1, -(-(end - start - SPAN + 1) // step))
    of = np.repeat(np.arange(len(start)), parts)
    at = start[of] + (np.arange(len(of)) - (np.cumsum(parts) - parts)[of]) * step
    grid = at[:, None] + np.arange(LETTERS)
    inside = grid < end[of][:, None]
    out = np.where(inside, _CODE[buf[np.where(inside, grid, 0)]], -1) if len(of) else np.zeros((0, LETTERS), np.int64)
    lead = (out < 0) & inside                           # lead bytes carry nothing: close the gap
    if lead.any():
        order = np.argsort(np.where(out < 0, LETTERS, 0), axis=1, kind="stable")
        out = np.take_along_axis(out, order, 1)
    return out, of


_TRIPLES = [(i, j, k) for i in range(SPAN) for j in range(i + 1, SPAN) for k in range(j + 1, SPAN) if i == 0]


def triples(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(part, feature, weight) of all letter triples, by shape; every triple of a part comes once."""
    length = (code >= 0).sum(1)
    order = np.argsort(-length, kind="stable")
    code, most = code[order], int(length.max(initial=0))
    longer = np.searchsorted(-length[order], -np.arange(LETTERS + 1), "right")          # parts with at least n letters
    for first in range(most - 2):
        for _, j, k in _TRIPLES:
            if first + k < most:
                m = int(longer[first + k + 1])
                yield order[:m], (code[:m, first] * ALPHABET + code[:m, first + j]) * ALPHABET + code[:m, first + k], DECAY ** (k + 1)


def features(words_: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature, value) of the kernel's explicit feature map, scaled to unit norm."""
    blob = [w.encode() for w in words_]
    end = np.cumsum([len(b) for b in blob]).astype(np.int64)
    start = np.r_[0, end[:-1]].astype(np.int64)
    code, of = codes(np.frombuffer(b"".join(blob), np.uint8), start, end)
    keys, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    for part, f, weight in triples(code):
        keys.append(of[part] * ALPHABET ** 3 + f)
        values.append(np.full(len(part), weight))
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(at, np.concatenate(values), len(key))
    word = key // ALPHABET ** 3
    norm = np.sqrt(np.bincount(word, value ** 2, len(blob)))
    return word, key % ALPHABET ** 3, value / np.maximum(norm[word], 1e-12)


class Model:
    """Weights of letter triples, the bias, and the logistic map of a document's worst words."""

    def __init__(self, beta: np.ndarray, bias: float, logistic: np.ndarray) -> None:
        at = np.flatnonzero(beta)
        self.at, self.value, self.bias, self.logistic = at, beta[at].astype(np.float32), bias, logistic

    def table(self) -> np.ndarray:
        beta = np.zeros(ALPHABET ** 3, np.float32)
        beta[self.at] = self.value
        return beta


def margins(buf: np.ndarray, start: np.ndarray, end: np.ndarray, beta: np.ndarray, bias: float) -> np.ndarray:
    """SVM margin of each word: exact where it exceeds ``FLOOR``, else some value up to ``FLOOR``."""
    code, of = codes(buf, start, end)
    total, least, most = np.zeros(len(code)), np.zeros(len(code)), np.zeros(len(code))
    for part, f, weight in triples(code):
        total[part] += weight * beta[f]
        least[part] += weight * weight                    # the squared norm if no triple came twice,
        most[part] += weight                              # the norm if all triples were one
    out = total / np.where(total > 0, np.sqrt(np.maximum(least, 1e-12)), np.maximum(most, 1e-12)) + bias      # an upper bound
    near = np.flatnonzero((out > FLOOR) & (least > 0))
    if len(near):
        keys, values = [], []
        for part, f, weight in triples(code[near]):
            keys.append(part * ALPHABET ** 3 + f)
            values.append(np.full(len(part), weight))
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        value = np.bincount(at, np.concatenate(values), len(key))
        norm = np.sqrt(np.bincount(key // ALPHABET ** 3, value ** 2, len(near)))
        out[near] = total[near] / norm + bias
    out[least == 0] = bias
    worst = np.full(len(start), -np.inf)
    np.maximum.at(worst, of, out)
    return worst


def summary(top1: np.ndarray, top2: np.ndarray, many: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Inputs of the logistic map."""
    clip = lambda x: np.clip(x, FLOOR, 1.5)
    return np.stack([clip(top1), clip(top2), np.log1p(many), np.log1p(many) - 0.25 * np.log1p(n / 50), np.ones(len(n))], 1)


def _worst(of: np.ndarray, margin: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per document: its two worst words' margins (of different places), words above 0, words."""
    n = np.bincount(of, minlength=rows)
    order = np.lexsort((-margin, of))
    first = np.cumsum(n) - n
    sorted_ = np.r_[margin[order], -1.5, -1.5]
    top1 = np.where(n > 0, sorted_[np.minimum(first, len(of))], -1.5)
    top2 = np.where(n > 1, sorted_[np.minimum(first + 1, len(of))], -1.5)
    return top1, top2, np.bincount(of, margin > 0, rows), n


def score_texts(text: pa.Array, model: Model) -> Iterator[tuple[int, int, np.ndarray]]:
    beta = model.table()
    for a, b, buf, off in slices(text):
        buf, off = normal(buf, off)
        start, end, row = words(buf, off)
        _, where, which = np.unique(span_hash(buf, start, end), return_index=True, return_inverse=True)
        margin = np.concatenate([np.zeros(0), *(margins(buf, start[where[lo:lo + PART]], end[where[lo:lo + PART]], beta, model.bias) for lo in range(0, len(where), PART))])
        x = summary(*_worst(row, margin[which] if len(which) else np.zeros(0), b - a))
        yield a, b, 1 / (1 + np.exp(-(x @ model.logistic)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """Linear SVM (squared hinge, L2) by Newton steps; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-3
    for _ in range(30):
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = ridge * w - 2 * cost * (x[on] * (weight * y * slack)[on, None]).sum(0)
        step = np.linalg.solve(np.diag(ridge) + 2 * cost * (x[on] * weight[on, None]).T @ x[on], grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1]), x.T @ (p - y) + 0.05 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(words_of: Iterable[list[str]], toxic: np.ndarray, rounds: int = 2) -> Model:
    """Fit on documents given as lists of normalised words."""
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in ws], np.int32) for ws in words_of]
    word, size = list(number), len(number)
    usable = np.array([len(w) > 2 for w in word], bool)
    good, pairs = np.zeros(size, np.int64), [np.zeros(0, np.int64)]
    value = _telling(ids, word, toxic)
    for d, t in zip(ids, toxic):
        if t:
            pairs.append(np.unique(np.r_[-1, d[:-1]].astype(np.int64) * size + d) if len(d) else pairs[0])
        else:
            good[np.unique(d)] += 1
    # A word counts once after each word, so copies of a text add nothing.
    bad = np.bincount(np.unique(np.concatenate(pairs)) % size, minlength=size) if size else good
    n_bad, n_good = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    share = n_bad / (n_bad + n_good)
    often = np.log(20 * (np.count_nonzero(bad) + 1)) / -np.log(share)      # chance puts hardly any word that often into toxic texts alone
    by_count = lambda at, n: at[np.lexsort((at, -n[at]))]

    def telling(left: list[np.ndarray]) -> np.ndarray:
        """The most telling words of each document, all that are as telling as its best one."""
        best = [d[(value[d] > 0) & (value[d] == value[d].max())] for d in (np.asarray(d)[usable[d] & (good[d] == 0)] for d in left) if len(d)]
        return np.unique(np.concatenate([np.zeros(0, np.int64), *best]))

    bags = [d for d, t in zip(ids, toxic) if t and len(d)]
    pos = by_count(np.flatnonzero(usable & (bad >= often) & (bad * n_good >= 20 * n_bad * (good + 1))), bad)
    pos = np.r_[pos, np.setdiff1d(telling([d for d in bags if not np.isin(d, pos).any()]), pos)].astype(np.int64)[:MOST_POSITIVE]
    if not len(pos):
        pos = by_count(np.flatnonzero(usable & (bad > 1) & (good == 0)), bad)[:20]
    if not len(pos):
        return Model(np.zeros(ALPHABET ** 3), -1.0, np.array([0, 0, 0, 0, np.log((n_bad + 0.5) / (n_good + 0.5))]))
    clean = np.flatnonzero(usable & (good > 0))
    some = clean[np.argsort([hash_of(word[i]) for i in clean], kind="stable")[:3 * MOST_NEGATIVE]] if len(clean) > 3 * MOST_NEGATIVE else clean
    neg = np.setdiff1d(np.union1d(by_count(clean, good)[:MOST_NEGATIVE], some), pos)
    for _ in range(rounds):
        vocab = [word[i] for i in (*pos, *neg)]
        beta, bias = _fit_words(vocab, len(pos))
        margin = np.array(_margin_list(word, beta, bias))
        ranked = np.where(usable, margin, -np.inf)
        worst = np.bincount([d[ranked[d].argmax()] for d in bags], minlength=size)
        more = np.r_[by_count(np.flatnonzero((worst > 1) & (margin > 0) & (good == 0)), worst), telling([d for d in bags if ranked[d].max() < 0])]
        hard = clean[np.argsort(-margin[clean], kind="stable")[:MOST_NEGATIVE]]
        pos = np.r_[pos, np.setdiff1d(more, pos)][:MOST_POSITIVE]
        neg = np.setdiff1d(np.union1d(neg, hard), pos)
    of = np.repeat(np.arange(len(ids)), [len(d) for d in ids])
    x = summary(*_worst(of, margin[np.concatenate(ids)] if len(ids) else margin, len(ids)))
    return Model(beta, bias, _logistic(x, toxic.astype(float)))


def _telling(ids: list[np.ndarray], word: list[str], toxic: np.ndarray) -> np.ndarray:
    """How telling each word is: of its stems (runs of ``STEMS`` bytes) the greatest surplus of toxic documents, 0 where
    none is in three toxic documents and ``TELLING`` times as common there as in clean ones."""
    value = np.zeros(len(word))
    blob = [w.encode() for w in word]
    buf = np.frombuffer(b"".join(blob), np.uint8)
    size = np.array([len(b) for b in blob], np.int64)
    first = np.cumsum(size) - size
    n_bad, n_good = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    doc = np.repeat(np.arange(len(ids)), [len(np.unique(d)) for d in ids])
    held = np.concatenate([np.zeros(0, np.int64), *(np.unique(d) for d in ids)]).astype(np.int64)
    at = np.argsort(held, kind="stable")                       # documents by word
    doc, many = doc[at], np.bincount(held, minlength=len(word))
    begin = np.cumsum(many) - many
    for n in STEMS:
        of = np.repeat(np.arange(len(word)), np.maximum(size - n + 1, 0))
        if not len(of):
            continue
        start = first[of] + np.arange(len(of)) - np.searchsorted(of, of)
        _, stem = np.unique(span_hash(buf, start, start + n), return_inverse=True)
        times = many[of]
        where = np.repeat(begin[of], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        seen = np.unique(np.repeat(stem, times) * len(ids) + doc[where])           # (stem, document)
        kind = toxic[seen % len(ids)] == 1
        bad = np.bincount(seen[kind] // len(ids), minlength=stem.max() + 1)
        good = np.bincount(seen[~kind] // len(ids), minlength=stem.max() + 1)
        surplus = np.where((bad > 2) & (bad * n_good >= TELLING * n_bad * (good + 1)), bad / n_bad - TELLING * good / n_good, 0)
        np.maximum.at(value, of, surplus[stem])
    return value


def _fit_words(vocab: list[str], positive: int) -> tuple[np.ndarray, float]:
    """Weights of the letter triples and the bias of the SVM on words, of which the first ``positive`` are toxic."""
    w_i, f_i, v_i = features(vocab)
    place = {w: i for i, w in enumerate(vocab)}
    ids = np.array([place[w] for w in _landmarks(vocab[:positive], vocab[positive:])])
    used = np.unique(f_i[np.isin(w_i, ids)])                     # other features meet no landmark
    col = np.minimum(np.searchsorted(used, f_i), len(used) - 1)
    keep = used[col] == f_i
    w_i, v_i, col = w_i[keep], v_i[keep], col[keep]
    cut = np.searchsorted(w_i, np.arange(len(vocab) + 1))

    def rows(lo: int, hi: int) -> np.ndarray:
        x = np.zeros((hi - lo, len(used)), np.float32)
        part = slice(cut[lo], cut[hi])
        x[w_i[part] - lo, col[part]] = v_i[part]
        return x

    dense = np.concatenate([rows(i, i + 1) for i in ids])
    gram = np.concatenate([rows(lo, min(lo + 512, len(vocab))) @ dense.T for lo in range(0, len(vocab), 512)]).astype(float)
    value, vector = np.linalg.eigh(gram[ids] + 1e-6 * np.eye(len(ids)))
    white = vector / np.sqrt(np.maximum(value, 1e-6))
    x = np.c_[gram @ white, np.ones(len(vocab))]
    y = np.r_[np.ones(positive), -np.ones(len(vocab) - positive)]
    weight = np.where(y > 0, 0.5 / positive, 0.5 / max(1, len(vocab) - positive)) * len(vocab)
    w = _svm(x, y, weight)
    beta = np.zeros(ALPHABET ** 3, np.float32)
    np.add.at(beta, used, (white @ w[:-1]) @ dense)
    return beta, float(w[-1])


def hash_of(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(b, np.array([0]), np.array([len(b)]))[0])


def _margin_list(words_: list[str], beta: np.ndarray, bias: float) -> list[float]:
    out: list[float] = []
    for lo in range(0, len(words_), PART):
        blob = [w.encode() for w in words_[lo:lo + PART]]
        end = np.cumsum([len(b) for b in blob]).astype(np.int64)
        out += margins(np.frombuffer(b"".join(blob), np.uint8), np.r_[0, end[:-1]].astype(np.int64), end, beta, bias).tolist()
    return out


def _landmarks(pos: list[str], neg: list[str]) -> list[str]:
    """Three quarters positive words (the most frequent half, then spread by hash), the rest negative."""
    n = LANDMARKS * 3 // 4
    chosen = list(dict.fromkeys(pos[:n // 2] + sorted(pos, key=hash_of)))[:n]
    return chosen + sorted(neg, key=hash_of)[:LANDMARKS - len(chosen)]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, mod: int = 4, held_out: int = 2) -> Model:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in slices(batch.column("text")):
                buf, off = normal(buf, off)
                texts = [buf[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(off, off[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("label").slice(a, b - a), pa.array(texts, pa.string())],
                                                 names=["doc_id", "label", "words"])

    got = sample(docs, labels, "toxic", mod, held_out, per_class).select("doc_id", "label", "text").mapInArrow(rows, "doc_id long, label int, words string").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    return fit((w.split() for w in got["words"]), got["label"].to_numpy(np.int64))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``' doc_id and text_hash with the document's score."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, score in score_texts(batch.column("text"), model):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(score)], names=["doc_id", "score"])

    return documents(docs).mapInArrow(rows, "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    out = scores(docs, train(docs, labels))
    return out.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
            for a, b, score in score_texts(text, model):
                yield batch.slice(a, b - a).filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(rows, docs.schema)
