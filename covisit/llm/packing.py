"""Harmonic packing of token ids into sequences of a fixed capacity.

A document's ids fill whole sequences first. What is left belongs to the class k of lengths in
(capacity / (k + 1), capacity / k], and a class's sequences hold k pieces each. A length that would
leave more than ``waste`` of such a sequence empty is cut at capacity / (k + 1), which fills its
class's sequences whole, and its rest is classed in turn. Every task fills sequences of its own; its
last, unfilled ones are put end to end and cut anew, the last of them at powers of two.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from covisit.llm.common import slices
from covisit.llm.tokens import BYTE, worker_pieces

CAPACITY = 2048
WASTE = 0.03
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Sequence ids of a task: its number, then as many bits for its own sequences.
_OWN_BITS = 40
#: Bytes of text that are encoded at once.
_BYTES = 4_000_000


def cuts(length: int, capacity: int = CAPACITY, waste: float = WASTE) -> list[int]:
    """The lengths of the pieces of a document, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if k * rest >= (1 - waste) * capacity:
            return [*out, rest]
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def _powers(length: int) -> list[int]:
    return [1 << b for b in reversed(range(length.bit_length())) if length >> b & 1]


class Packer:
    """Takes documents one by one; gives finished sequences as lists of (doc_id, start, doc_tokens, ids)."""

    def __init__(self, capacity: int = CAPACITY, waste: float = WASTE):
        self._capacity, self._waste = capacity, waste
        self._open: dict[int, list[tuple]] = defaultdict(list)

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[tuple]]:
        start = 0
        for length in cuts(len(ids), self._capacity, self._waste):
            k = self._capacity // length
            bin_ = self._open[k]
            bin_.append((doc_id, start, len(ids), ids[start : start + length]))
            start += length
            if len(bin_) == k:
                yield self._open.pop(k)

    def rest(self) -> Iterator[list[tuple]]:
        """What no class has filled, cut into whole sequences and one of each power of two at most."""
        pieces = [p for k in sorted(self._open) for p in self._open[k]]
        self._open.clear()
        total = sum(len(p[3]) for p in pieces)
        sizes = [self._capacity] * (total // self._capacity) + _powers(total % self._capacity)
        for room in sizes:
            sequence = []
            while room:
                doc_id, start, whole, ids = pieces.pop(0)
                sequence.append((doc_id, start, whole, ids[:room]))
                if len(ids) > room:
                    pieces.insert(0, (doc_id, start + room, whole, ids[room:]))
                room -= len(sequence[-1][3])
            yield sequence


def pack(docs: DataFrame, tokenizer: str = BYTE, end: int = 1, capacity: int = CAPACITY, waste: float = WASTE) -> DataFrame:
    """A row for each piece: its place in its document and in its sequence, and its ids.

    ``ids`` are little-endian unsigned 32-bit integers. Null texts are empty: the end id alone. A null
    doc_id stays null; rows that share one are packed one by one. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, packer = worker_pieces(tokenizer), Packer(capacity, waste)
        context = TaskContext.get()
        number, rows = (context.partitionId() if context else 0) << _OWN_BITS, []

        def take(sequences: Iterator[list[tuple]]) -> None:
            nonlocal number
            for sequence in sequences:
                offset = 0
                for doc_id, start, whole, ids in sequence:
                    rows.append((doc_id, start, len(ids), whole, number, offset, ids.astype("<u4").tobytes()))
                    offset += len(ids)
                number += 1

        def table() -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = [x.split()[0] for x in _PIECES.split(", ")]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            rows.clear()
            return made

        for part in (x for batch in batches for x in slices(batch, _BYTES)):
            ids_of = pieces.encode(part.column("text").to_pylist(), end)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), ids_of):
                take(packer.add(doc_id, ids))
                if len(rows) >= 2000:
                    yield table()
        take(packer.rest())
        if rows:
            yield table()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)
