"""Helpers that several operators share: staging, size-checked joins, row keys and word hashing."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import covisit
from covisit.session import Staged

#: ASCII white space: words are the runs between it. ``bytes.split()`` splits on the same six.
SPACE = " \t\n\x0b\x0c\r"
#: A side of at most this many rows of at most about 100 bytes may be broadcast (64 MB).
BROADCAST_ROWS = 500_000
#: Words that a task's counts or lookups hold before they start anew.
VOCABULARY = 500_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; it lives as long as that folder."""
    return Staged(df, label).frame


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their workers can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(covisit.__file__).parent.parent
        archive = Path(tempfile.mkdtemp(prefix="covisit-")) / "covisit.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((root / "covisit").rglob("*.py")):
                out.write(file, file.relative_to(root))
        context.addPyFile(str(archive))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_join(big: DataFrame, small: DataFrame, on: list[str], how: str, label: str) -> DataFrame:
    """A join that broadcasts ``small`` only if its counted rows are within BROADCAST_ROWS.

    ``small`` has few columns of fixed width. Beyond the bound Spark plans the join as it sees fit.
    """
    small = staged(small, label)
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


def with_key(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with a unique ``_key`` that sorts as doc_id does.

    Where doc_id is whole and unique, that is doc_id itself. Else rows are ordered by doc_id (null
    first) and text, and numbered; equal rows are documents of their own.
    """
    docs = docs.select(*(columns or docs.columns))
    count, ids = docs.select(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if count == ids:
        return docs.withColumn("_key", F.col("doc_id").cast("long"))
    ordered = docs.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return staged(ordered.withColumn("_key", F.monotonically_increasing_id()), "keyed")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and each text's word count. Null texts have none."""
    if pa.types.is_binary(texts.type):
        texts = texts.view(pa.string())  # the same bytes
    lists = pc.ascii_split_whitespace(texts)
    words, counts = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    none = np.nonzero(pc.binary_length(words).to_numpy(zero_copy_only=False) == 0)[0]  # before and after outer white space
    if len(none):
        counts -= np.bincount(np.searchsorted(np.cumsum(counts), none, side="right"), minlength=len(counts))
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words, counts


def distinct_numbers(words: pa.Array, apart: bytes = b" ") -> tuple[np.ndarray, list[bytes]]:
    """Each word's number, and the distinct words by number; no word holds ``apart``."""
    encoded = words.dictionary_encode()
    many = len(encoded.dictionary)
    if not many:
        return np.zeros(0, np.int64), []
    joined = pc.binary_join(pa.ListArray.from_arrays([0, many], encoded.dictionary.view(pa.binary())), apart)
    return encoded.indices.to_numpy(), joined[0].as_py().split(apart)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A word's 64-bit hash, for each."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def slices(batch: pa.RecordBatch, most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``most`` bytes of ``column``; a row is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    edges = np.concatenate([np.nonzero(np.diff(part, prepend=-1))[0], [len(part)]])
    for a, b in zip(edges[:-1], edges[1:]):
        yield batch.slice(int(a), int(b - a))


def columns(batches: Iterable[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    """Columns of whole numbers over all batches."""
    got = [[b.column(c).to_numpy(zero_copy_only=False) for c in names] for b in batches]
    return [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, np.int64) for _ in names]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of each run of ``n`` word hashes."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = mixed(total + words[k : k + size] + np.uint64(k))
    return total


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of [start, start + length), range after range."""
    ends = np.cumsum(lengths)
    out = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    if not len(out):
        return out
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    ends = np.cumsum(lengths)
    out[0] = starts[0]
    out[ends[:-1]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(out)
