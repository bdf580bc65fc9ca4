"""Token-ID files: independent zstandard frames with a trailing seek table.

A file holds, one after the other,

* for every document one zstandard frame of its ids (two bytes an id where the
  vocabulary allows, else four; little-endian); a document of more than
  ``FRAME_IDS`` ids has several.  Frames carry their own content checksum.
* a skippable frame with the document index: doc_id, whether it is null, ids
  and frames of each document,
* a skippable frame with the seek table in zstandard's seekable format:
  compressed size, plain size and checksum of every frame, then the frame
  count, a flag byte and the magic number 0x8F92EAB1.

A reader takes the seek table from the end of the file and decompresses only
the frames of the documents it wants.  Any zstandard tool can read the file.

Files lie in ascending doc_id order (range partitions); ``manifest`` is a
Parquet table that names them.  A task writes under a name of its own and only
files named in the manifest count, so a retried or lost task does no harm.

Nulls and ties: null text is a document without ids but for the end id; a null
doc_id sorts first and is kept as null; repeated doc_ids are kept, ordered by a
hash of their text; an empty table gives a manifest without files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actionlens.llm.common import documents
from actionlens.llm.tokens import encoder

FRAME_IDS = 1 << 20
# Fixed values of the zstandard seekable format.
SEEK_FRAME, INDEX_FRAME, SEEK_END, HAS_CHECKSUM = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80

MANIFEST = "part int, file string, n_docs long, n_ids long, first_doc long, last_doc long"
ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class FrameWriter:
    """Writes one file; ``add`` per document in order, then ``close``."""

    def __init__(self, out, width: int, level: int = 3) -> None:
        self._out, self._kind = out, {2: "<u2", 4: "<u4"}[width]
        self._zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self._seek, self._docs = [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frames, ids = range(0, max(1, len(ids)), FRAME_IDS), ids.astype(self._kind, copy=False)
        for k in frames:
            plain = ids[k:k + FRAME_IDS].tobytes()
            packed = self._zstd.compress(plain)
            self._out.write(packed)
            self._seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self._docs.append((doc_id or 0, doc_id is None, len(ids), len(frames)))

    def close(self) -> None:
        width = int(self._kind[-1])
        index = struct.pack("<QB", len(self._docs), width) + b"".join(struct.pack("<qBQI", *d) for d in self._docs)
        self._out.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self._seek) + struct.pack("<IBI", len(self._seek), HAS_CHECKSUM, SEEK_END)
        self._out.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)


class FrameReader:
    """Random access to one file (any seekable binary file object)."""

    def __init__(self, f) -> None:
        self._f = f
        end = f.seek(0, 2)
        f.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEK_END:
            raise ValueError("no seek table at the end of the file")
        f.seek(end - 9 - 12 * n)
        seek = np.frombuffer(f.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self._size, self._plain, self._sum = seek[:, 0], seek[:, 1], seek[:, 2]
        self._at = np.cumsum(self._size) - self._size
        f.seek(int(self._size.sum()) + 8)
        docs, self._width = struct.unpack("<QB", f.read(9))
        index = np.frombuffer(f.read(21 * docs), np.dtype([("doc", "<i8"), ("null", "u1"), ("ids", "<u8"), ("frames", "<u4")]))
        self.doc_id, self.is_null = index["doc"], index["null"].astype(bool)
        self.n_ids, frames = index["ids"].astype(np.int64), index["frames"].astype(np.int64)
        self._first = np.cumsum(frames) - frames
        self._frames = frames
        self._zstd = zstandard.ZstdDecompressor()

    def ids(self, k: int) -> np.ndarray:
        """Ids (uint32) of the k-th document of the file; only its frames are read and decompressed."""
        parts = []
        for j in range(self._first[k], self._first[k] + self._frames[k]):
            self._f.seek(int(self._at[j]))
            plain = self._zstd.decompress(self._f.read(int(self._size[j])))
            if len(plain) != self._plain[j] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self._sum[j]:
                raise ValueError(f"frame {j} does not match the seek table")
            parts.append(np.frombuffer(plain, f"<u{self._width}"))
        return np.concatenate(parts).astype("<u4")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every document (plus ``end_id``) and write the files and the manifest to ``folder`` (a shared URI)."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, encode_special_tokens=False)
        width = 2 if max(enc.vocab_size, end_id + 1) <= 1 << 16 else 4
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.zst"
        out = writer = None
        n_docs = n_ids = 0
        low = high = None
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for a, _, flat, per_row in enc.encode(batch.column("text")):
                if out is None:
                    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    writer = FrameWriter(out, width)
                at, ended = 0, np.insert(flat, np.cumsum(per_row), end_id).astype(f"<u{width}")
                for k, m in enumerate(per_row.tolist()):
                    doc = ids_of[a + k]
                    writer.add(doc, ended[at:at + m + 1])
                    at += m + 1
                    n_docs, n_ids = n_docs + 1, n_ids + m + 1
                    if doc is not None:
                        low, high = doc if low is None else low, doc
        if out is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "n_docs": n_docs, "n_ids": n_ids, "first_doc": low, "last_doc": high}],
                                             pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64())]))

    ordered = documents(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(files, MANIFEST).write.parquet(f"{folder}/manifest")


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A row a file (a file a range partition), with the ids of all files before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _open(folder: str, file: str) -> FrameReader:
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    return FrameReader(fs.open_input_file(f"{base}/{file}"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 (of the decompressed ids as 32-bit integers)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                r = _open(folder, f["file"])
                start = f["start"] + np.cumsum(r.n_ids) - r.n_ids
                crc = [zlib.crc32(r.ids(k).tobytes()) for k in range(len(r.n_ids))]
                yield pa.RecordBatch.from_arrays([pa.array(r.doc_id.copy(), pa.int64(), mask=r.is_null), pa.array(start), pa.array(r.n_ids), pa.array(crc, pa.int64())], schema=ROWS)

    files = _manifest(spark, folder).select("file", "start")
    n = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").count()
    return files.repartition(max(1, n), "file").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """doc_id, ids of the wanted documents (column doc_id); only their frames are decompressed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                r = _open(folder, f["file"])
                hits = np.flatnonzero(np.isin(r.doc_id, np.array(f["docs"], np.int64)) & ~r.is_null)
                for k in hits.tolist():
                    yield pa.RecordBatch.from_pylist([{"doc_id": int(r.doc_id[k]), "ids": r.ids(k).tolist()}], pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chunks = ids.join(files, (ids.doc_id >= files.first_doc) & (ids.doc_id <= files.last_doc)).groupBy("file").agg(F.collect_set("doc_id").alias("docs"))
    return chunks.mapInArrow(rows, "doc_id long, ids array<long>")
