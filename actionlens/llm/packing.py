"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

A document longer than the capacity is cut into full pieces; its first piece
may be shorter.  Pieces are range-sorted by length (longest first) and
numbered, so the pieces of one length are one run of numbers.  Sequences with
the same gap are runs as well: a round works on runs, at most one a length,
whatever the number of documents.

A round sweeps the piece runs from the longest down.  Each run takes its
successor, the smallest gap that holds it, from the gaps as they were when the
round began; where several want the same gap, rank decides: longer pieces
first, then lower numbers.  A run larger than its gap run takes what there is
and sweeps on to the next gap.  Gaps are updated after the sweep, and the next
round begins.  When a round places nothing, new sequences are opened: one for
every piece over half the capacity, or, if none is left, half as many as the
total length left needs, for the longest pieces.

The sweeps run on the run table (bounded by the capacity, not by the data);
numbering the pieces, and giving each its sequence and offset from the rounds'
placements, are Spark jobs over all pieces.

Null text is a document of one id (the end id); repeated rows and doc_ids are
packed each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents, numbered, pin
from actionlens.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n ids."""
    if n <= capacity:
        return [n]
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids_crc32 (and ids)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, encode_special_tokens=False)
        for batch in batches:
            doc = batch.column("doc_id").to_pylist()
            for a, _, flat, per_row in enc.encode(batch.column("text")):
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))}
                at = 0
                for k, m in enumerate(per_row.tolist()):
                    ids = np.append(flat[at:at + m], np.uint32(end_id)).astype("<u4")
                    at, start = at + m, 0
                    for piece, length in enumerate(cut(m + 1, capacity)):
                        part = ids[start:start + length]
                        for name, value in zip(out, (doc[a + k], piece, start, length, zlib.crc32(part.tobytes()), *([part.astype(np.int32)] if with_ids else []))):
                            out[name].append(value)
                        start += length
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(out.values(), kinds)], names=list(out))

    return documents(docs).mapInArrow(rows, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit_rounds(lengths: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int]]:
    """Placements (first piece number, first sequence, offset) of runs of pieces, in piece order.

    ``lengths``: (length, pieces of this length); pieces are numbered longest first.  A run's
    i-th piece goes to the i-th sequence from its first sequence on; a run ends where the next begins.
    """
    todo, number = [], 0                                   # [length, next piece number, pieces left]
    for length, n in sorted(lengths, reverse=True):
        todo.append([length, number, n])
        number += n
    gaps: dict[int, list[list[int]]] = defaultdict(list)    # gap -> runs [first sequence, count]
    out, sequences = [], 0

    def put(run: list[int], seq: int, n: int, gap: int, new: dict) -> None:
        out.append((run[1], seq, capacity - gap))
        if gap > run[0]:
            new[gap - run[0]].append([seq, n])
        run[1], run[2] = run[1] + n, run[2] - n

    while todo:
        placed, new = False, defaultdict(list)
        open_gaps = sorted(g for g, runs in gaps.items() if runs)
        for run in todo:
            k = bisect.bisect_left(open_gaps, run[0])
            while run[2] and k < len(open_gaps):
                runs = gaps[open_gaps[k]]
                if not runs:
                    del open_gaps[k]
                    continue
                seq, n = runs[-1]
                take = min(n, run[2])
                put(run, seq, take, open_gaps[k], new)
                placed = True
                if take == n:
                    runs.pop()
                else:
                    runs[-1] = [seq + take, n - take]
        if not placed:
            large = sum(run[2] for run in todo if 2 * run[0] > capacity)
            left = large or -(-sum(run[0] * run[2] for run in todo) // (2 * capacity))
            for run in todo:
                take = min(left, run[2])
                if take:
                    put(run, sequences, take, capacity, new)
                    sequences, left = sequences + take, left - take
        for g, runs in new.items():
            gaps[g] += runs
        todo = [run for run in todo if run[2]]
    return sorted(out)


def pack(cut_pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``cut_pieces`` (see ``pieces``) with sequence_id and offset."""
    rows, _ = numbered(cut_pieces.withColumn("_longest", -F.col("length")), ["_longest", "doc_id", "piece", "ids_crc32"], "pack-rows")
    lengths = [(r["length"], r["n"]) for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()]     # a row a length
    runs = np.array(best_fit_rounds(lengths, capacity) or [(0, 0, 0)], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").to_numpy()
            k = np.searchsorted(runs[:, 0], row, "right") - 1
            keep = [c for c in batch.schema.names if c not in ("row", "_longest")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(runs[k, 1] + row - runs[k, 0]), pa.array(runs[k, 2])],
                                             names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut_pieces.schema)
    return rows.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    return pack(pin(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves (``packed`` with ids)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))         # a sequence holds at most its capacity
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
