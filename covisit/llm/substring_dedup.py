"""Exact substring deduplication over FM-indexes, one per shard of the corpus's windows.

A window is 20 consecutive words. Its anchor is the rarest-ordered run of 3 words in it (smallest
hash; runs known to be very common come last), so equal windows have equal anchors. Consecutive
windows with one anchor in one place form a segment, and segments go to the shard of their anchor: whatever a
window equals is in its own shard, and all shards together hold each window once.

A shard keeps each distinct segment once, with the places where it occurs. Segments whose anchor
only one segment has can repeat nothing. The others are the shard's text; an FM-index of it (wavelet
tree over its Burrows-Wheeler transform, rows ordered by as many words as a window has) is searched
backward with the segments streamed as patterns. The interval of a window's rows tells its first
occurrence; all others are reported. The words they cover are merged per document.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covisit.llm.common import distinct_numbers, gram_hashes, mixed, ranges, shuffle_partitions, slices, split_words, staged, with_key, word_hashes

WINDOW, ANCHOR = 20, 3
#: Words of text for which there is one shard more.
SHARD_WORDS = 1_000_000
#: An anchor with more than one of so many of all segments is common: used where a window has no other.
COMMON_SHARE = 16_384
#: Bytes of text whose segments are gathered before they are sent.
_BYTES = 12_000_000
_LAST = np.uint64(1 << 63)
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- wavelet tree and FM-index ------------------------------------------------------------


class WaveletTree:
    """Rank of symbols in a sequence of numbers below 2 ** bits: one bit vector with counts per level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self._ones, self._zeros = bits, [], []
        # the last level holds the symbols in the order of their bits read backward: where each one begins there
        backward, left = np.zeros(1 << bits, np.int64), np.arange(1 << bits)
        for _ in range(bits):
            backward, left = backward << 1 | left & 1, left >> 1
        counts = np.bincount(symbols, minlength=1 << bits)[backward]
        self._starts = (np.cumsum(counts) - counts)[backward]
        for level in reversed(range(bits)):
            bit = (symbols >> level & 1).astype(np.int32)
            self._ones.append(np.concatenate([np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32)]))
            self._zeros.append(len(bit) - int(self._ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before ``low`` and before ``high``."""
        for k, level in enumerate(reversed(range(self.bits))):
            ones, zeros = self._ones[k], self._zeros[k]
            set_ = (symbols >> level & 1).astype(bool)
            a, b = ones[low], ones[high]
            low = np.where(set_, zeros + a, low - a)
            high = np.where(set_, zeros + b, high - b)
        start = self._starts[symbols]
        return low - start, high - start


def bounded_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ordered by the ``depth`` symbols from them on, and the rank of each position.

    Positions with equal next symbols share a rank. Beyond the end stands a symbol below all others.
    """
    rank, width = text.astype(np.int64), 1
    order = None
    while width < depth:
        step = min(width, depth - width)
        following = np.zeros(len(text), np.int64)
        following[: len(text) - step] = rank[step:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + following
        order = np.argsort(key)
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(len(text), np.int64)
        rank[order] = new
        width += step
    return order, rank


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols in a text of numbers from 1 on; 0 separates."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        self.order, self._rank = bounded_order(text, depth)
        self._text = text
        transform = text[self.order - 1]  # the symbol before; the last one before the first
        counts = np.bincount(text, minlength=int(text.max(initial=0)) + 1)
        self._before = np.cumsum(counts) - counts
        self._tree = WaveletTree(transform, max(1, int(text.max(initial=0)).bit_length()))
        # rows that agree on ``depth`` symbols: bounds, and the first position among them
        of = self._rank[self.order]
        edges = np.nonzero(np.concatenate([[True], np.diff(of) != 0]))[0]
        group = np.cumsum(np.concatenate([[True], np.diff(of) != 0])) - 1
        self._low, self._high = edges[group], np.concatenate([edges[1:], [len(text)]])[group]
        self._least = np.minimum.reduceat(self.order, edges)[group]

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that start with each symbol and go on as the rows of [low, high) do."""
        a, b = self._tree.ranks(symbols, low, high)
        return self._before[symbols] + a, self._before[symbols] + b

    def cut(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that agree with row ``low`` on ``depth`` symbols."""
        return self._low[low], self._high[low]

    def first(self, low: np.ndarray) -> np.ndarray:
        return self._least[low]

    def matches(self, patterns: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of patterns (ranges of one array), all streamed from their ends side by side.

        For each symbol of each pattern: the length of the longest match from it on, ``depth`` at most,
        the number of its occurrences, and, at full depth, the first position of it in the text (else -1).
        """
        total = int(lengths.sum())
        base = np.cumsum(lengths) - lengths
        size, rows, first = np.zeros(total, np.int64), np.zeros(total, np.int64), np.full(total, -1, np.int64)
        by_length = np.argsort(-lengths, kind="stable")
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self._text), np.int64)
        depth = np.zeros(len(starts), np.int64)
        for k in range(int(lengths.max(initial=0))):
            live = by_length[: np.searchsorted(-lengths[by_length], -k, side="left")]
            at = lengths[live] - 1 - k
            symbols = patterns[starts[live] + at]
            a, b = self.step(symbols, low[live], high[live])
            missing = a >= b
            deeper = depth[live] + 1
            if missing.any():
                # the match ends here: search the longest that starts with this symbol from its parts
                lost = np.nonzero(missing)[0]
                for j in lost:
                    a[j], b[j], deeper[j] = self._longest(patterns, starts[live[j]] + at[j], starts[live[j]] + lengths[live[j]])
            over = deeper > self.depth
            if over.any():
                a[over], b[over] = self.cut(a[over])
                deeper[over] = self.depth
            low[live], high[live], depth[live] = a, b, deeper
            slot = base[live] + at
            size[slot], rows[slot] = deeper, b - a
            full = deeper == self.depth
            first[slot[full]] = self.first(a[full])
        return size, rows, first

    def _longest(self, patterns: np.ndarray, start: int, stop: int) -> tuple[int, int, int]:
        """Rows and length of the longest match of patterns[start:stop], by halving its length."""
        good, low, high = 0, 0, len(self._text)
        bad = min(self.depth, stop - start) + 1
        while bad - good > 1:
            middle = (good + bad) // 2
            a, b = np.zeros(1, np.int64), np.full(1, len(self._text), np.int64)
            for k in reversed(range(start, start + middle)):
                a, b = self.step(patterns[k : k + 1], a, b)
            if a[0] < b[0]:
                good, low, high = middle, int(a[0]), int(b[0])
            else:
                bad = middle
        return low, high, good


# --- segments ----------------------------------------------------------------------------


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` consecutive numbers is, the first if there are several."""
    at, done = np.arange(len(x)), 1
    while done < width:
        step = min(done, width - done)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(x[right] < x[left], right, left)
        done += step
    return at


def anchors(words: np.ndarray, counts: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts that lie in a row: text number, first window, number of windows, anchor.

    ``common``: sorted hashes of the anchors to be used last.
    """
    grams = gram_hashes(words, ANCHOR)
    key = grams >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, key), len(common) - 1)
        key = np.where(common[at] == key, key | _LAST, key)
    least = _sliding_least(key, WINDOW - ANCHOR + 1) if len(key) >= WINDOW - ANCHOR + 1 else np.zeros(0, np.int64)
    windows = np.maximum(0, counts - WINDOW + 1)
    base = np.cumsum(counts) - counts
    at = ranges(base, windows)
    text = np.repeat(np.arange(len(counts)), windows)
    least = least[at]
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(least) != 0)])[: len(at)]
    first = np.nonzero(new)[0]
    length = np.diff(np.append(first, len(at)))
    return text[first], at[first] - base[text[first]], length, key[least[first]] & ~_LAST


def common_anchors(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Hashes of the anchors that many segments have, COMMON_SHARE at most, and the words of all texts.

    An anchor with a share of all segments has that share in some batch at least, so each batch reports
    those that reach a quarter of it. Which anchors these are changes no result, only where work is done.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, words_seen, segments = np.zeros(0, np.uint64), 0, 0
        for numbers, counts, _, known in _word_batches(batches):
            _, _, _, found = anchors(word_hashes(known)[numbers], counts, none)
            words_seen, segments = words_seen + len(numbers), segments + len(found)
            values, many = np.unique(found, return_counts=True)
            often = many >= max(4, len(found) / (4 * COMMON_SHARE))
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(values[often].astype(np.int64)), "n": pa.array(many[often])})
        yield pa.RecordBatch.from_pydict({"anchor": pa.array([-1, -2], pa.int64()), "n": pa.array([words_seen, segments], pa.int64())})

    counted = docs.select("_key", F.col("text").cast("binary").alias("text")).mapInArrow(count, "anchor long, n long")
    counted = staged(counted.groupBy("anchor").agg(F.sum("n").alias("n")), "anchors")
    totals = dict(counted.where("anchor < 0").collect())
    limit = max(4, totals.get(-2, 0) / COMMON_SHARE)
    rows = counted.where((F.col("anchor") >= 0) & (F.col("n") > limit)).select("anchor").collect()
    return np.sort(np.array([r[0] for r in rows], np.uint64)), totals.get(-1, 0)


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """Word numbers, words per text, keys, and what the numbers stand for, some texts at a time."""
    for batch in batches:
        for part in slices(batch, _BYTES):
            words, counts = split_words(part.column("text"))
            numbers, known = distinct_numbers(words)
            yield numbers, counts, part.column("_key").to_numpy(zero_copy_only=False), known


def _packed(arrays: list[np.ndarray]) -> bytes:
    head = struct.pack(f"<{2 * len(arrays)}q", *(x for a in arrays for x in (len(a), a.dtype.itemsize)))
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpacked(blob: bytes, count: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    head = struct.unpack_from(f"<{2 * count}q", raw)
    out, at = [], 16 * count
    for n, item in zip(head[::2], head[1::2]):
        out.append(np.frombuffer(raw, f"<u{item}", n, at))
        at += n * item
    return out


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def segments(docs: DataFrame, common: np.ndarray, shards: int) -> DataFrame:
    """(shard, blob): the segments of some texts that go to a shard, each distinct one once with its places."""
    held = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, counts, keys, known in _word_batches(batches):
            words = word_hashes(known)[numbers]
            order = pc.array_sort_indices(pa.array(known, pa.binary())).to_numpy()
            known = [known[k] for k in order.tolist()]
            numbers = np.argsort(order)[numbers]  # in their order
            base = np.cumsum(counts) - counts
            text, start, windows, anchor = anchors(words, counts, held.value)
            length = windows + WINDOW - 1
            # a segment's name: a polynomial of its words, from sums over all words before its ends
            place = base[text] + start
            powers = np.cumprod(np.full(len(words), _ODD, np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words) * powers)])
            inverse = np.cumprod(np.full(len(words), pow(int(_ODD), -1, 1 << 64), np.uint64))
            name = mixed((sums[place + length] - sums[place]) * inverse[place] + length.astype(np.uint64))
            shard = (mixed(anchor) % np.uint64(shards)).astype(np.int64)
            order = np.argsort((shard.astype(np.uint64) << np.uint64(40)) | (name >> np.uint64(24)))
            text, start, length, anchor, place, name, shard = (x[order] for x in (text, start, length, anchor, place, name, shard))
            if not len(shard):
                continue
            new = np.concatenate([[True], (np.diff(name) != 0) | (np.diff(shard) != 0)])
            edges = np.concatenate([np.nonzero(np.concatenate([[True], np.diff(shard) != 0]))[0], [len(shard)]])
            out_shard, out = [], []
            for a, b in zip(edges[:-1], edges[1:]):
                own = slice(a, b)
                lead = np.nonzero(new[own])[0] + a
                own_words, local = np.unique(numbers[ranges(place[lead], length[lead])], return_inverse=True)
                spelled = np.frombuffer(b" ".join([known[k] for k in own_words.tolist()]), np.uint8)
                out_shard.append(int(shard[a]))
                out.append(_packed([
                    (anchor[lead] >> np.uint64(32)).astype("<u4"), _small(length[lead]), spelled, _small(local),
                    keys[text[own]].astype(np.int64).view(np.uint64), _small(start[own]), _small(np.cumsum(new[own]) - 1)]))
            yield pa.RecordBatch.from_pydict({"shard": pa.array(out_shard, pa.int64()), "blob": pa.array(out, pa.binary())})

    source = docs.select("_key", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, "shard long, blob binary")


def _repeats(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one shard: key, first word and end of the word ranges that windows with an earlier equal cover."""
    parts = [_unpacked(blob, 7) for blob in blobs]
    known = np.cumsum([0, *(len(p[0]) for p in parts)])
    anchor, length = np.concatenate([p[0] for p in parts]), np.concatenate([p[1].astype(np.int64) for p in parts])
    key, start = np.concatenate([p[4].view(np.int64) for p in parts]), np.concatenate([p[5].astype(np.int64) for p in parts])
    of = np.concatenate([p[6].astype(np.int64) + k for p, k in zip(parts, known)])
    # segments whose anchor occurs once repeat nothing: their words aren't even looked at
    _, inverse, uses = np.unique(anchor[of], return_inverse=True, return_counts=True)
    keep = uses[inverse] > 1
    key, start, of = key[keep], start[keep], of[keep]
    if not len(key):
        return key, start, start
    wanted = np.zeros(len(anchor), bool)
    wanted[of] = True
    spelt, places, many = [], [], 0
    for (_, lengths, spelled, local, *_), k in zip(parts, known):
        own, long = wanted[k : k + len(lengths)], lengths.astype(np.int64)
        numbers, inverse = np.unique(local[ranges((np.cumsum(long) - long)[own], long[own])], return_inverse=True)
        spelt.append(pc.split_pattern(pa.array([spelled.tobytes()]).view(pa.string()), " ").flatten().take(pa.array(numbers)))
        places.append(many + inverse)
        many += len(numbers)
    length = np.where(wanted, length, 0)
    words = pa.concat_arrays(spelt).dictionary_encode().indices.to_numpy()[np.concatenate(places)]
    # the text: every segment still in use, in the order of its first place
    order = np.lexsort((start, key))
    key, start, of = key[order], start[order], of[order]
    used, first_use = np.unique(of, return_index=True)
    used = used[np.argsort(first_use, kind="stable")]
    base = np.cumsum(length) - length
    text_of = np.full(len(length), -1)
    text_of[used] = np.arange(len(used))
    many = length[used]
    _, symbols = np.unique(words[ranges(base[used], many)], return_inverse=True)
    symbols = symbols.astype(np.int64) + 1
    text = np.zeros(len(symbols) + len(used), np.int64)
    at = np.cumsum(many + 1) - many - 1
    text[ranges(at, many)] = symbols
    index = FMIndex(text, WINDOW)
    size, _, first = index.matches(text, at, many)
    # first places of the text's segments, then of the windows in them
    place = np.sort(first_use)
    windows = many - WINDOW + 1
    inside = ranges(np.zeros(len(used), np.int64), windows)
    owner = np.repeat(np.arange(len(used)), windows)
    found = first[np.repeat(np.cumsum(many) - many, windows) + inside]
    assert (size[np.repeat(np.cumsum(many) - many, windows) + inside] == WINDOW).all()
    # by its first place, a window is the earliest unless an equal one lies in an earlier-placed segment,
    # or in one that starts earlier by its place but later by that of the window: compare places themselves
    own_key, own_start = key[place][owner], start[place][owner] + inside
    group, least = np.unique(found, return_inverse=True)
    ordered = np.lexsort((own_start, own_key, least))
    lead = ordered[np.concatenate([[True], np.diff(least[ordered]) != 0])]
    best_key, best_start = own_key[lead][least], own_start[lead][least]
    # every place of every segment: all windows but the earliest are repeats
    segment = text_of[of]
    many_here = windows[segment]
    w = ranges(np.cumsum(windows)[segment] - many_here, many_here)
    where_key = np.repeat(key, many_here)
    where_start = np.repeat(start, many_here) + inside[w]
    repeated = (where_key != best_key[w]) | (where_start != best_start[w])
    where_key, where_start = where_key[repeated], where_start[repeated]
    order = np.lexsort((where_start, where_key))
    where_key, where_start = where_key[order], where_start[order]
    if not len(where_key):
        return where_key, where_start, where_start
    new = np.concatenate([[True], (np.diff(where_key) != 0) | (np.diff(where_start) > 1)])
    head = np.nonzero(new)[0]
    tail = np.concatenate([head[1:], [len(where_key)]]) - 1
    return where_key[head], where_start[head], where_start[tail] + WINDOW


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """_key, first, stop: word ranges of ``docs`` (_key, text) that windows with an earlier equal cover; ranges may touch."""
    common, words = common_anchors(docs)
    shards = max(2 * shuffle_partitions(docs.sparkSession), words // SHARD_WORDS + 1)

    def search(table: pa.Table) -> pa.Table:
        key, first, stop = _repeats([b.as_py() for b in table.column("blob")])
        return pa.table({"_key": pa.array(key, pa.int64()), "first": pa.array(first, pa.int64()), "stop": pa.array(stop, pa.int64())})

    return segments(docs, common, shards).groupBy("shard").applyInArrow(search, "_key long, first long, stop long")


_RESULT = "doc_id long, n_words long, n_removed long, kept string"


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no words. Rows with null or repeated doc_ids are documents of their own,
    ordered by doc_id (null first) and text; of equal rows all but one lose their windows.
    """
    keyed = with_key(docs, ["doc_id", "text"])
    found = repeated_ranges(keyed.select("_key", "text")).groupBy("_key").agg(
        F.collect_list("first").alias("first"), F.collect_list("stop").alias("stop"))
    joined = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "_key", F.col("text").cast("binary").alias("text")).join(found, "_key", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, firsts, stops = (batch.column(c).to_pylist() for c in ("doc_id", "text", "first", "stop"))
            for a in range(0, len(ids), 500):
                rows = []
                for doc_id, text, first, stop in zip(ids[a : a + 500], texts[a : a + 500], firsts[a : a + 500], stops[a : a + 500]):
                    words = text.split() if text else []
                    left = words
                    if first:
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, first, 1)
                        np.add.at(gone, stop, -1)
                        left = [words[k] for k in np.nonzero(np.cumsum(gone[:-1]) == 0)[0]]
                    rows.append((doc_id, len(words), len(words) - len(left), b" ".join(left).decode()))
                kinds = [pa.int64()] * 3 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in _RESULT.split(", ")])

    return joined.mapInArrow(cut, _RESULT)

