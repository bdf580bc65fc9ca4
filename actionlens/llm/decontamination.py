"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a mask over consecutive words: positions marked 1 are hashed,
the others ignored, so a window whose ignored words were substituted still has
the same hash.  Every window of every test item and training document is hashed
under each of the fixed masks (lighter ones as well for items of up to 15 words, so
that every allowed substitution leaves a seed), and equal hashes are joined.  A training window
is emitted only if two fixed-size bitmaps of the test hashes have it (their size
does not depend on either table), so the join sees few rows besides hits.

Around each hit the document and the item are laid over each other on the hit's
diagonal.  A document is contaminated by an item that is there as a whole, with at
least 80 % of its words equal, or by a stretch of at least ``min_words`` words that
begins and ends with an equal word and has at least 80 % of them equal.  Of these
stretches the best is reported (a match counts 1, a substitution -4).

Words are split at white space, A-Z lower-cased, ASCII punctuation at their ends
cut off.  Null and empty texts have no words and no matches; repeated rows are
reported each; a null doc_id is reported as null; empty tables give an empty
result; a document of any length is compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents, pin
from actionlens.llm.textops import lowered, mix, slices, span_hash, words

# Fixed masks, weight 6: substitutions in any third, fourth or second word leave at least one of them intact.
MASKS = ("111111", "1110111", "11011011", "1100110011", "10101010101", "111000111", "1101000111")
# Lighter masks for items too short for those, by the item's number of words; without them some substitutions leave no seed.
LIGHT_MASKS = {n: ("1" * n,) for n in range(1, 5)} | {5: ("1111", "10111", "11011", "11101")} | {n: ("11111", "101111", "110111", "111011", "111101") for n in range(6, 16)}
ALL_MASKS = MASKS + tuple(dict.fromkeys(m for own in LIGHT_MASKS.values() for m in own))
FILTER_BITS = 1 << 24
MATCHES = "doc_id long, text_hash long, item_id long, start_word long, end_word long, item_start int, matched int, identity double"

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words, without punctuation at their ends; a word of punctuation alone is none."""
    buf = lowered(buf)
    start, end, row = words(buf, off)
    while len(start):
        cut = (start < end) & _PUNCT[buf[np.minimum(start, len(buf) - 1)]]
        if not cut.any():
            break
        start = start + cut
    while len(end):
        cut = (start < end) & _PUNCT[buf[end - 1]]
        if not cut.any():
            break
        end = end - cut
    some = start < end
    return span_hash(buf, start[some], end[some]), row[some]


def seeds(word: np.ndarray, row: np.ndarray, masks: tuple[str, ...] = MASKS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, first word of the window) for each mask."""
    for mask in masks:
        m = ALL_MASKS.index(mask)
        at = [i for i, c in enumerate(mask) if c == "1"]
        n = len(word) - len(mask) + 1
        if n > 0:
            h = np.zeros(n, np.uint64)
            for j, i in enumerate(at):
                h += word[i:i + n] * (mix(np.array([j + 1], np.uint64))[0] | np.uint64(1))
            inside = np.flatnonzero(row[:n] == row[len(mask) - 1:])
            yield mix(h[inside] + np.uint64(m + 1)), inside


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h % np.uint64(FILTER_BITS)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _items(tests: DataFrame) -> DataFrame:
    """item_id, words (8 bytes each), n, seeds."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in slices(batch.column("text")):
                word, row = word_hashes(buf, off)
                hits: list[list[dict]] = [[] for _ in range(b - a)]
                size = np.bincount(row, minlength=b - a)
                for mask, (h, at) in ((m, found) for m in ALL_MASKS for found in seeds(word, row, (m,))):
                    if mask not in MASKS:
                        own = np.isin(size[row[at]], [n for n, light in LIGHT_MASKS.items() if mask in light])
                        h, at = h[own], at[own]
                    first = np.searchsorted(row, row[at])
                    for x, p, f in zip(h.view(np.int64).tolist(), at.tolist(), first.tolist()):
                        hits[row[p]].append({"seed": x, "item_at": p - f})
                cut = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").slice(a, b - a), pa.array([word[cut[i]:cut[i + 1]].tobytes() for i in range(b - a)], pa.binary()),
                     pa.array(hits, pa.list_(pa.struct([("seed", pa.int64()), ("item_at", pa.int32())])))], names=["item_id", "item_words", "seeds"])

    own = tests.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(rows, "item_id long, item_words binary, seeds array<struct<seed: long, item_at: int>>")


def _hits(docs: DataFrame, low: bytes, high: bytes, masks: tuple[str, ...]) -> DataFrame:
    """Documents with a window that both bitmaps have: doc_id, text_hash, words, hits."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_map, b_map = (np.unpackbits(np.frombuffer(x, np.uint8)).view(bool) for x in (low, high))
        for batch in batches:
            for a, _, buf, off in slices(batch.column("text")):
                word, row = word_hashes(buf, off)
                found = []
                for h, at in seeds(word, row, masks):
                    lo, hi = _bits(h)
                    ok = a_map[lo]
                    ok[ok] = b_map[hi[ok]]
                    found.append((h[ok], at[ok]))
                if not found:
                    continue
                h, at = (np.concatenate(x) for x in zip(*found))
                if not len(h):
                    continue
                order = np.argsort(row[at], kind="stable")
                h, at = h[order], at[order]
                of = row[at]
                cut, mine = np.searchsorted(row, np.arange(len(off))), np.unique(of)
                ids, texts = batch.column("doc_id").slice(a), batch.column("text_hash").slice(a)
                begin = np.searchsorted(of, mine)
                end = np.r_[begin[1:], len(of)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(mine)), texts.take(pa.array(mine)), pa.array([word[cut[r]:cut[r + 1]].tobytes() for r in mine], pa.binary()),
                     pa.array([[{"seed": int(x), "doc_at": int(p)} for x, p in zip(h[i:j].view(np.int64), at[i:j] - cut[r])] for r, i, j in zip(mine, begin, end)],
                              pa.list_(pa.struct([("seed", pa.int64()), ("doc_at", pa.int64())])))], names=["doc_id", "text_hash", "doc_words", "hits"])

    own = documents(docs).withColumn("text_hash", F.xxhash64("text"))
    return own.mapInArrow(rows, "doc_id long, text_hash long, doc_words binary, hits array<struct<seed: long, doc_at: long>>")


def best_stretch(doc: np.ndarray, item: np.ndarray, diagonal: int, least: int = 1) -> tuple[int, int, int]:
    """(first, end, matches) in item words of the whole item, or of the best stretch of at least ``least`` words
    on a diagonal (doc position - item position); (x, x, 0) if there is none."""
    lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    same = doc[lo + diagonal:hi + diagonal] == item[lo:hi]
    if hi - lo == len(item) and 5 * same.sum() >= 4 * len(item):
        return 0, len(item), int(same.sum())               # the whole item, substitutions and all
    least = max(1, least)
    if len(same) < least:
        return lo, lo, 0
    matches = np.r_[0, np.cumsum(same)]
    score = 5 * matches - 4 * np.arange(len(same) + 1)     # words [i, j) count score[j] - score[i]; 80 % agree if that is not negative
    none = 5 * len(same) + 1
    begin = np.where(same, score[:-1], none)[:len(same) - least + 1]            # a stretch begins and ends with a match
    low = np.minimum.accumulate(begin)
    gain = np.where(same[least - 1:] & (low < none), score[least:] - low, -1)   # by its end
    j = int(np.argmax(gain))
    if gain[j] < 0:
        return lo, lo, 0
    first, end = int(np.flatnonzero(begin[:j + 1] == low[j])[-1]), j + least
    return lo + first, lo + end, int(matches[end] - matches[first])


def contaminated(docs: DataFrame, tests: DataFrame, min_words: int = 13) -> DataFrame:
    """A row for each (document, test item) with a verified overlap: ids, the document's words
    [start_word, end_word), where they begin in the item, how many agree and their share."""
    items = pin(_items(tests), "test-items")
    seed_rows = items.select("item_id", F.explode("seeds").alias("s")).select("item_id", "s.seed", "s.item_at")
    maps = []
    for shift in (0, 32):           # at most FILTER_BITS / 64 words each, whatever the tables
        bit = F.pmod(F.shiftrightunsigned("seed", shift).bitwiseAND(F.lit(FILTER_BITS - 1)), F.lit(FILTER_BITS))
        set_bits = np.zeros(FILTER_BITS, bool)
        got = seed_rows.select(bit.alias("bit")).distinct().groupBy(F.expr("bit div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("m"))
        for r in got.collect():
            for i in range(64):
                if r["m"] >> i & 1:
                    set_bits[r["w"] * 64 + i] = True
        maps.append(np.packbits(set_bits).tobytes())
    short = items.select((F.octet_length("item_words") / 8).cast("int").alias("n")).where(F.col("n").isin(*LIGHT_MASKS)).distinct().collect()     # lengths up to 15
    masks = MASKS + tuple(dict.fromkeys(m for r in sorted(short) for m in LIGHT_MASKS[r["n"]]))
    hits = pin(_hits(docs, *maps, masks).withColumn("row", F.monotonically_increasing_id()), "seed-hits")
    lined = (hits.select("row", F.explode("hits").alias("h")).select("row", "h.seed", "h.doc_at")
             .join(seed_rows, "seed").groupBy("row", "item_id").agg(F.collect_set(F.col("doc_at") - F.col("item_at")).alias("diagonals")))    # fewer than both have words

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples():
                doc, item = np.frombuffer(r.doc_words, np.uint64), np.frombuffer(r.item_words, np.uint64)
                places = ((*best_stretch(doc, item, d, min(min_words, len(item))), d) for d in map(int, r.diagonals))
                same, start, first, end, d = max((same, -(first + d), -first, end, d) for first, end, same, d in places)
                if same:
                    out.append((r.row, r.item_id, -start, end + d, -first, same, same / (end + first)))
            yield pd.DataFrame(out, columns=["row", "item_id", "start_word", "end_word", "item_start", "matched", "identity"])

    joined = lined.join(hits.select("row", "doc_words"), "row").join(items.select("item_id", "item_words"), "item_id")
    found = joined.mapInPandas(verify, "row long, item_id long, start_word long, end_word long, item_start int, matched int, identity double")
    order = F.struct("matched", -F.col("start_word"), -F.col("item_start"), "end_word")
    best = found.groupBy("row", "item_id").agg(F.max_by(F.struct("start_word", "end_word", "item_start", "matched", "identity"), order).alias("b"))      # items of one id are one
    return best.join(hits.select("row", "doc_id", "text_hash"), "row").select("doc_id", "text_hash", "item_id", "b.*")


def decontaminated(docs: DataFrame, tests: DataFrame, min_words: int = 13) -> DataFrame:
    """The rows of ``docs`` (all columns) that no test item contaminates; found by doc_id and text, so rows without a doc_id are told apart."""
    bad = pin(contaminated(docs, tests, min_words).select(F.col("doc_id").alias("bad_doc"), F.col("text_hash").alias("bad_text")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["bad_doc"]) & (F.xxhash64(docs["text"].cast("string")) == bad["bad_text"]), "left_anti")
