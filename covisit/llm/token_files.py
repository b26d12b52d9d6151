"""Token ids in files of independent zstandard frames.

A file is one frame for each document (its ids as little-endian unsigned integers), a frame with the
directory (doc ids, counts of ids, then 1 where a doc id is null, 64 bits each), and a skippable frame with the seek table:
for each frame its compressed and decompressed size and the low 32 bits of the XXH64 of its content.
Readers find a document by the directory and decompress its frame alone. Any zstandard decoder
reads the frames; the seek table is laid out as in zstandard's seekable format.

Files are rows of a table (part, file, first start, content), so whatever store Spark writes to
holds them; ``save`` puts the content of one into a local file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covisit.llm.common import shuffle_partitions, slices, staged, with_key
from covisit.llm.tokens import WORD, worker_pieces

# fixed values of the seek table's format
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: A file ends with the document that takes it to so many ids.
FILE_IDS = 2_000_000
LEVEL = 3
#: Bytes of text that are encoded at once.
_BYTES = 4_000_000
_FILES = "part long, file long, documents long, ids long, content binary"


def _checksum(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


def encode_file(documents: Iterable[tuple[int | None, np.ndarray]], item: str = "<u2") -> bytes:
    """One file of (doc id, ids) pairs. ``item``: the unsigned type that holds every id."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    frames, table, names, counts, nulls = [], [], [], [], []

    def add(content: bytes) -> None:
        frames.append(packer.compress(content))
        table.append(struct.pack("<III", len(frames[-1]), len(content), _checksum(content)))

    for name, ids in documents:
        add(ids.astype(item).tobytes())
        names.append(0 if name is None else name)
        counts.append(len(ids))
        nulls.append(name is None)
    add(np.array([np.dtype(item).itemsize, *names, *counts, *nulls], "<i8").tobytes())
    entries = b"".join(table)
    foot = struct.pack("<IBI", len(table), _CHECKSUMS, _SEEKABLE)
    return b"".join([*frames, struct.pack("<II", _SKIPPABLE, len(entries) + len(foot)), entries, foot])


class FileReader:
    """Reads documents of one file by doc id or place; raises ValueError if a frame is damaged."""

    def __init__(self, content: bytes):
        self._content = content
        frames, flags, magic = struct.unpack("<IBI", content[-9:])
        if magic != _SEEKABLE or flags != _CHECKSUMS:
            raise ValueError("no seek table")
        table = np.frombuffer(content, "<u4", 3 * frames, len(content) - 9 - 12 * frames).reshape(-1, 3)
        self._ends, self._table = np.cumsum(table[:, 0].astype(np.int64)), table
        self._unpacker = zstandard.ZstdDecompressor()
        directory = np.frombuffer(self._frame(frames - 1), "<i8")
        self._item = f"<u{directory[0]}"
        self.doc_ids, self.counts, nulls = directory[1:].reshape(3, frames - 1)
        self.nulls = nulls.astype(bool)

    def _frame(self, k: int) -> bytes:
        packed, size, checksum = (int(x) for x in self._table[k])
        content = self._unpacker.decompress(self._content[self._ends[k] - packed : self._ends[k]], max_output_size=size)
        if len(content) != size or _checksum(content) != checksum:
            raise ValueError(f"frame {k} is damaged")
        return content

    def at(self, k: int) -> np.ndarray:
        return np.frombuffer(self._frame(k), self._item)

    def documents(self, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
        """The ids of those documents that the file has, of a repeated doc id the first; only their frames are decompressed."""
        places = {d: self.places(d) for d in doc_ids}
        return {d: self.at(own[0]) for d, own in places.items() if len(own)}

    def places(self, doc_id: int | None) -> np.ndarray:
        """All places of a doc id, None for null."""
        return np.nonzero(self.nulls if doc_id is None else ~self.nulls & (self.doc_ids == doc_id))[0]


def save(content: bytes, path: str) -> None:
    with open(path, "wb") as f:
        f.write(content)


def token_files(docs: DataFrame, tokenizer: str = WORD, end: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Files (part, file, documents, ids, content) with all documents, in ascending doc_id order.

    Null texts are empty: their document is the end id alone. Rows with null or repeated doc_ids are
    documents of their own, ordered by doc_id (null first) and text. An empty table gives no file.
    """
    keyed = with_key(docs, ["doc_id", "text"]).select("_key", F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = shuffle_partitions(docs.sparkSession)
    ordered = keyed.repartitionByRange(parts, "_key").sortWithinPartitions("_key").withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, kept, size, number, part = worker_pieces(tokenizer), [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": [part], "file": [number], "documents": [len(kept)], "ids": [size], "content": [encode_file(kept)]})

        for batch in (x for batch in batches for x in slices(batch, _BYTES)):
            part = batch.column("part")[0].as_py()
            names = batch.column("doc_id").to_pylist()
            for name, ids in zip(names, pieces.encode(batch.column("text").to_pylist(), end)):
                kept.append((name, ids))
                size += len(ids)
                if size >= file_ids:
                    yield closed()
                    kept, size, number = [], 0, number + 1
        if kept:
            yield closed()

    return ordered.mapInArrow(write, _FILES)


def with_starts(files: DataFrame) -> DataFrame:
    """``files`` with ``start``, the ids of all files before it: sums of parts, then of files within a part."""
    parts = files.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    parts = parts.withColumn("before", F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids"))
    within = F.sum("ids").over(Window.partitionBy("part").orderBy("file")) - F.col("ids")
    counted = files.select("part", "file", "ids").withColumn("within", within)
    starts = counted.join(parts, "part").select("part", "file", (F.col("before") + F.col("within")).alias("start"))
    return files.join(starts, ["part", "file"])


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document in ``files``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column("start").to_pylist(), batch.column("content")):
                reader = FileReader(content.as_py())
                starts = start + np.cumsum(reader.counts) - reader.counts
                for a in range(0, len(starts), 500):
                    b = min(a + 500, len(starts))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(reader.doc_ids[a:b], mask=reader.nulls[a:b]), "start": starts[a:b], "n_tokens": reader.counts[a:b],
                        "ids": [reader.at(k).astype("<u4").tobytes() for k in range(a, b)]})

    return files.select("start", "content").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_ids(docs: DataFrame, tokenizer: str = WORD, end: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids of all documents, written to files in the shared folder and read from them."""
    files = staged(token_files(docs, tokenizer, end), "tokens")
    return read_files(with_starts(files))
