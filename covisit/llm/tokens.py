"""Token ids of whole texts, by files of the tokenizers library.

A text is cut where no tokenizer of either kind can join what stands on both sides; each distinct
piece is encoded once in a task, and texts are put together from the pieces' ids.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from covisit.llm.common import distinct_numbers, ranges

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Distinct pieces that a worker keeps; beyond them, those that it met once are forgotten.
PIECES = 400_000
#: Characters that are put together at once.
_AT_ONCE = 4_000_000
#: New pieces that one call encodes. A call's own objects take several times the memory of the ids.
_LEARNT = 4_000
#: Stands alone between pieces of a tokenizer that drops white space: a token of its own there.
_BAR = "|"
_DOUBLE = ("  ", "\n\n", " \n", "\n ")


def vocabulary_path(name: str) -> str:
    """Where the installed vocabulary files lie; a path of one's own may be given in its place."""
    import public_tokenizers

    return name if os.path.isabs(name) else public_tokenizers.path(name)


def _odd(text: str) -> bool:
    """Whether white space is more than one blank or line feed between two other characters."""
    ends = text[:1] + text[-1:]
    return ends.strip(" \n") != ends or any(d in text for d in _DOUBLE) or not text.replace("\n", "").isprintable()


class _Numbers(dict):
    """Numbers pieces as they come and lists the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Pieces:
    """Encodes texts; ``add_special_tokens`` is off. Null texts are empty."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary_path(file))
        #: With white space dropped before pieces are encoded, any blank separates. Else a blank
        #: belongs to the piece after it, and odd white space is left to the tokenizer.
        self._drops_space = self._tokenizer.normalizer is not None
        bar = self._tokenizer.encode(_BAR, add_special_tokens=False).ids
        self._bar = bar[0] if self._drops_space and len(bar) == 1 else None
        #: Bytes that an id stands for, as both kinds spell a byte as one character: they tell where pieces end.
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self._sizes[number] = len(token.removesuffix("</w>"))
        self._clear()

    def _clear(self) -> None:
        self._numbers = _Numbers()
        self._flat = np.zeros(0, np.uint32)
        self._starts = self._lengths = self._met = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the pieces that were met again, if they are half of PIECES at most."""
        again = np.nonzero(self._met > 1)[0]
        pieces, flat, starts, lengths = list(self._numbers), self._flat, self._starts[again], self._lengths[again]
        self._clear()
        if len(again) <= PIECES // 2:
            for number in again:
                self._numbers[pieces[number]] = len(self._numbers)
            self._flat, self._lengths = flat[ranges(starts, lengths)], lengths
            self._starts, self._met = np.cumsum(lengths) - lengths, np.zeros(len(again), np.int64)

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts' pieces in a row, and how many pieces each text has."""
        odd = [] if self._drops_space else [k for k, text in enumerate(texts) if _odd(text)]
        own = pa.array(texts, pa.string())
        if odd:
            own = pa.array(["" if o else t for o, t in zip(np.isin(np.arange(len(texts)), odd).tolist(), texts)], pa.string())
        if self._drops_space:
            apart, own = " ", pc.replace_substring(own, "\n", " ")
        else:
            apart, own = "\0", pc.replace_substring(pc.replace_substring(own, " ", "\0 "), "\n", "\0\n")
        lists = pc.split_pattern(own, apart)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers, distinct = distinct_numbers(lists.flatten(), apart.encode())
        number = self._numbers.__getitem__
        spelt = apart.encode().join(distinct).decode().split(apart) if distinct else []
        numbers = np.fromiter(map(number, spelt), np.int64, len(spelt))[numbers]
        for k, place in zip(odd, (np.cumsum(counts) - counts)[odd].tolist()):
            numbers[place] = number(texts[k])
        return numbers, counts

    def _batch(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    def _plain(self, piece: str) -> bool:
        """Whether the ids of a row of such pieces are theirs in a row, and stand for all their bytes."""
        if self._drops_space:
            return piece.isascii() and piece.isprintable()
        return piece[:1] in (" ", "\n") and len(piece) > 1 and " " not in piece[1:] and piece[1:].isprintable()

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each has."""
        plain = np.fromiter(map(self._plain, pieces), bool, len(pieces))
        joined = [p for p, one in zip(pieces, plain.tolist()) if one]
        flat = self._batch([(" " if self._drops_space else "").join(joined)])[0]
        ends = np.cumsum(np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in joined), np.int64, len(joined)))
        sums = np.concatenate([[0], np.cumsum(self._sizes[flat])])
        at = np.minimum(np.searchsorted(sums, ends), len(flat))
        if not joined or sums[-1] != ends[-1] or (sums[at] != ends).any():
            return self._apart(pieces)
        if plain.all():
            return flat, np.diff(at, prepend=0)
        rest, counts = self._apart([p for p, one in zip(pieces, plain.tolist()) if not one])
        lengths = np.zeros(len(pieces), np.int64)
        lengths[plain], lengths[~plain] = np.diff(at, prepend=0), counts
        both, starts = np.concatenate([flat, rest]), np.zeros(len(pieces), np.int64)
        starts[plain], starts[~plain] = np.cumsum(lengths[plain]) - lengths[plain], len(flat) + np.cumsum(counts) - counts
        return both[ranges(starts, lengths)], lengths

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same, by a token of its own between pieces, or one by one."""
        if self._bar is None:
            return self._batch(pieces)
        odd = [k for k, p in enumerate(pieces) if _BAR in p]
        plain = ["" if _BAR in p else p for p in pieces] if odd else pieces
        flat = self._batch([f" {_BAR} ".join([*plain, ""])])[0]
        bars = np.nonzero(flat == self._bar)[0]
        flat, lengths = np.delete(flat, bars), np.diff(bars, prepend=-1) - 1
        if odd:
            ids, counts = self._batch([pieces[k] for k in odd])
            flat = np.insert(flat, np.repeat((np.cumsum(lengths) - lengths)[odd], counts), ids)
            lengths[odd] = counts
        return flat, lengths

    def _learn(self) -> None:
        new, self._numbers.new = self._numbers.new, []
        if not new:
            return
        found = [self._ids(new[k : k + _LEARNT]) for k in range(0, len(new), _LEARNT)]
        lengths = np.concatenate([n for _, n in found])
        self._starts = np.concatenate([self._starts, len(self._flat) + np.cumsum(lengths) - lengths])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._met = np.concatenate([self._met, np.zeros(len(new), np.int64)])
        self._flat = np.concatenate([self._flat, *(ids for ids, _ in found)])

    def encode(self, texts: list[str | None], end: int) -> Iterator[np.ndarray]:
        """The ids of each text, and ``end`` after them."""
        k = 0
        while k < len(texts):
            size, stop = 0, k
            while stop < len(texts) and size < _AT_ONCE:
                size += len(texts[stop] or "")
                stop += 1
            yield from self._together([t or "" for t in texts[k:stop]], end)
            k = stop

    def _together(self, texts: list[str], end: int) -> Iterator[np.ndarray]:
        if len(self._numbers) > PIECES:
            self._forget()
        numbers, counts = self._cut(texts)
        self._learn()
        self._met += np.bincount(numbers, minlength=len(self._met))
        flat = self._flat[ranges(self._starts[numbers], self._lengths[numbers])]
        ends = np.concatenate([[0], np.cumsum(self._lengths[numbers])])[np.cumsum(counts)]
        last = np.array([end], np.uint32)
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
            yield np.concatenate([flat[a:b], last])


@lru_cache(maxsize=1)
def worker_pieces(file: str) -> Pieces:
    """One per worker process, so that what a task has learnt serves the worker's next task."""
    return Pieces(file)
