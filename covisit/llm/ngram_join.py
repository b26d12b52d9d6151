"""Jaccard join of documents' sets of 4-word shingles, size-aware: light sets by subsets, heavy by lists.

Two sets link when 100 * common >= 85 * union. Equal sets are one representative first. Then

- light sets (up to a size x) enumerate their subsets of every size that can be a common part. Under
  a shared subset, all link to its smallest set or no two do, so a star of links is whole;
- heavy sets (and light ones that may link to a heavy one) are listed under the first tokens of an
  order common to all, enough of them that linked sets share one. Within a list sets are held
  against the list's smallest first; what is connected then needs no link more, and only pairs of
  different components are held against each other, each of them. Near neighbours of a list come
  first, then those ever further away: what a round connects makes no pairs in the next.

x is where the counted rows of both parts cost least. The order puts shingles that many documents
have last, so lists stay short.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covisit.llm.common import bounded_join, columns, distinct_numbers, gram_hashes, mixed, ranges, slices, split_words, staged, with_key, word_hashes
from covisit.llm.graph import components

SHINGLE, PERCENT = 4, 85
#: Largest set that may be light: beyond it a set has too many subsets.
LIGHT_MOST = 20
#: Of a heavy set's shingles, the share that is compared in the end, in rows of a list.
COMPARED = 0.25
#: A shingle is frequent if so many different sets among some million shingles in a row have it; the most
#: frequent ones are kept, so many at most.
FREQUENT, FREQUENT_MOST, COUNTED = 3, 4_000_000, 4_000_000
#: The neighbours of a list that a round reaches, in those of the round before.
WIDER = 8
_BYTES = 4_000_000
_FLAG = np.uint64(1 << 63)


def least_common(size: int) -> int:
    """The fewest common shingles that a set of ``size`` needs for any link."""
    return -(-PERCENT * size // 100)


def prefix_length(size: int) -> int:
    return size - least_common(size) + 1


def linked(common, a, b):
    """Whether sets of sizes a and b with so many common elements link."""
    return (100 + PERCENT) * common >= PERCENT * (a + b)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Keys and shingle sets (sorted 63-bit hashes), some texts at a time."""
    for batch in batches:
        for part in slices(batch, _BYTES):
            found, counts = split_words(pc.ascii_lower(part.column("text").view(pa.string())))
            numbers, distinct = distinct_numbers(found)
            words = word_hashes(distinct)[numbers]
            grams = gram_hashes(words, SHINGLE) >> np.uint64(1)
            sets, at = [], 0
            for n in counts.tolist():
                if n >= SHINGLE:
                    sets.append(np.unique(grams[at : at + n - SHINGLE + 1]))
                else:
                    sets.append(gram_hashes(words[at : at + n], n)[:1] >> np.uint64(1) if n else words[:0])
                at += n
            yield part.column("_key").to_numpy(zero_copy_only=False), sets


def _texts(keyed: DataFrame) -> DataFrame:
    return keyed.select("_key", F.col("text").cast("binary").alias("text"))


def frequent_shingles(keyed: DataFrame) -> np.ndarray:
    """Sorted hashes of shingles that many documents have. They order lists only: no result depends on them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}  # copies of a set count once
        for _, sets in _sets(batches):
            held.update((xxhash.xxh3_128_digest(x), x) for x in sets)
            if sum(map(len, held.values())) >= COUNTED:
                yield counts(held)
                held = {}
        if held:
            yield counts(held)

    def counts(held: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        values, many = np.unique(np.concatenate(list(held.values())), return_counts=True)
        often = many >= FREQUENT
        return pa.RecordBatch.from_pydict({"token": pa.array(values[often].astype(np.int64)), "n": pa.array(many[often])})

    counted = _texts(keyed).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = staged(counted, "frequent")
    sizes = counted.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("many")).collect()
    power, left = 99, FREQUENT_MOST
    for row in sorted(sizes, reverse=True):
        left -= row["many"]
        if left < 0:
            break
        power = row["power"]
    rows = counted.where(F.col("n") >= F.lit(2.0) ** power).select("token").toArrow()["token"].to_numpy()
    return np.sort(rows.astype(np.uint64))


def set_digests(keyed: DataFrame, frequent: np.ndarray) -> DataFrame:
    """_key, n, two fingerprints of the set, and the first of its tokens in the common order (of light sets all)."""
    held = keyed.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held.value
        for keys, sets in _sets(batches):
            sums, crosses, firsts = [], [], []
            for tokens in sets:
                spread = mixed(tokens)
                sums.append(int(spread.sum(dtype=np.uint64)))
                crosses.append(int(np.bitwise_xor.reduce(mixed(spread), initial=np.uint64(0))))
                if len(last) and len(tokens):
                    at = np.minimum(np.searchsorted(last, tokens), len(last) - 1)
                    tokens = np.sort(np.where(last[at] == tokens, tokens | _FLAG, tokens))
                many = len(tokens) if len(tokens) <= LIGHT_MOST else prefix_length(len(tokens))
                firsts.append(tokens[:many].tobytes())
            yield pa.RecordBatch.from_pydict({
                "_key": pa.array(keys, pa.int64()), "n": pa.array(list(map(len, sets)), pa.int64()),
                "sum": pa.array(np.array(sums, np.uint64).astype(np.int64)), "cross": pa.array(np.array(crosses, np.uint64).astype(np.int64)),
                "first": pa.array(firsts, pa.binary())})

    return _texts(keyed).mapInArrow(run, "_key long, n long, sum long, cross long, first binary")


def light_limit(sizes: dict[int, int]) -> int:
    """The largest light size, by the rows that light and heavy sets make (``sizes``: sets of each size)."""

    def cost(x: int) -> float:
        light = sum(c * sum(comb(n, d) for d in range(n - least_common(n) + 1)) for n, c in sizes.items() if 0 < n <= x)
        return light + sum(c * (prefix_length(n) + COMPARED * n) for n, c in sizes.items() if n >= least_common(x + 1))

    return min(range(LIGHT_MOST + 1), key=cost)


def light_links(sets: DataFrame, limit: int) -> DataFrame:
    """a, b: links among sets (_key, n, first) of at most ``limit`` shingles, a star under each shared subset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, subsets, commons = [], [], [], []
            for key, n, first in zip(*(batch.column(c).to_pylist() for c in ("_key", "n", "first"))):
                tokens = mixed(np.frombuffer(first, np.uint64) & ~_FLAG)
                whole = tokens.sum(dtype=np.uint64)
                for gone in range(n - least_common(n) + 1):
                    if gone:
                        away = tokens[np.array(list(combinations(range(n), gone)))].sum(axis=1, dtype=np.uint64)
                    else:
                        away = np.zeros(1, np.uint64)
                    subsets.append(mixed(whole - away + np.uint64(n - gone)))
                    keys += [key] * len(away)
                    sizes += [n] * len(away)
                    commons += [n - gone] * len(away)
            subset = np.concatenate(subsets).astype(np.int64) if subsets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({
                "subset": pa.array(subset), "common": pa.array(commons, pa.int64()), "b": pa.array(keys, pa.int64()), "n": pa.array(sizes, pa.int64())})

    source = sets.where((F.col("n") > 0) & (F.col("n") <= limit)).select("_key", "n", "first")
    rows = staged(source.mapInArrow(run, "subset long, common long, b long, n long"), "subsets")
    leaders = rows.groupBy("subset", "common").agg(F.min(F.struct("n", "b")).alias("least"), F.count(F.lit(1)).alias("many")).where("many > 1")
    found = rows.join(leaders, ["subset", "common"]).select(F.col("least.b").alias("a"), F.col("least.n").alias("m"), "b", "n", "common")
    return found.where((F.col("a") != F.col("b")) & linked(F.col("common"), F.col("m"), F.col("n"))).select("a", "b").distinct()


def heavy_lists(sets: DataFrame, limit: int) -> DataFrame:
    """token, b, n, place, a: lists of two sets and more. ``place`` is the token's among the set's in the common
    order, ``a`` the smallest set of the list that may link to ``b``, or b itself."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(f, np.uint64)[: prefix_length(n)] for f, n in zip(batch.column("first").to_pylist(), batch.column("n").to_pylist())]
            many = list(map(len, tokens))
            yield pa.RecordBatch.from_pydict({
                "token": pa.array((np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)).astype(np.int64)),
                "b": pa.array(np.repeat(batch.column("_key").to_numpy(zero_copy_only=False), many), pa.int64()),
                "n": pa.array(np.repeat(batch.column("n").to_numpy(zero_copy_only=False), many), pa.int64()),
                "place": pa.array(ranges(np.zeros(len(many), np.int64), np.array(many, np.int64)), pa.int64())})

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, b, n, place = columns(batches, ["token", "b", "n", "place"])
        order = np.lexsort((b, n, token))
        token, b, n, place = token[order], b[order], n[order], place[order]
        new = np.concatenate([[True], np.diff(token) != 0])[: len(token)]
        alone = new & np.concatenate([new[1:], [True]])[: len(token)]
        token, b, n, place = token[~alone], b[~alone], n[~alone], place[~alone]
        heads = np.nonzero(np.concatenate([[True], np.diff(token) != 0])[: len(token)])[0]
        a = b.copy()
        for start, stop in zip(heads, np.append(heads[1:], len(token))):
            k = start
            while k < stop:
                end = start + np.searchsorted(n[start:stop], 100 * n[k] // PERCENT, side="right")
                a[k:end] = b[k]
                k = max(end, k + 1)
        for k in range(0, len(token), 200_000):
            yield pa.RecordBatch.from_pydict({c: pa.array(x[k : k + 200_000], pa.int64()) for c, x in (("token", token), ("b", b), ("n", n), ("place", place), ("a", a))})

    source = sets.where(F.col("n") >= least_common(limit + 1)).where("n > 0").select("_key", "n", "first")
    postings = source.mapInArrow(spread, "token long, b long, n long, place long")
    return postings.repartition("token").mapInArrow(lists, "token long, b long, n long, place long, a long")


def apart(lists: DataFrame, parts: DataFrame, low: int) -> DataFrame:
    """The lists of more than ``low`` sets that are not of one component, with ``component`` (by ``parts``: id, component)."""
    whole = Window.partitionBy("token")
    placed = lists.select("token", "b", "n", "place", "a").join(parts.withColumnRenamed("id", "b"), "b", "left")
    placed = placed.withColumn("component", F.coalesce("component", "b"))
    placed = placed.withColumn("many", F.count(F.lit(1)).over(whole)).where(F.col("many") > low)
    placed = placed.withColumn("least", F.min("component").over(whole)).withColumn("most", F.max("component").over(whole))
    return placed.where("least < most").drop("many", "least", "most")


def crossing_pairs(lists: DataFrame, low: int, high: int) -> DataFrame:
    """a, b: pairs of a list whose components (column ``component``) differ and that may link, from ``low`` to
    ``high`` - 1 places from each other.

    In the list of the first token that two sets share, all their common ones come from there on; what is
    left there must be enough. So a pair that links is found in that list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, b, n, place, a, part = columns(batches, ["token", "b", "n", "place", "a", "component"])
        order = np.lexsort((b, n, token))
        token, b, n, a, part = (x[order] for x in (token, b, n, a, part))
        left = n - place[order]
        heads = np.nonzero(np.concatenate([[True], np.diff(token) != 0])[: len(token)])[0]
        ones, others, size = [], [], 0
        for start, stop in zip(heads, np.append(heads[1:], len(token))):
            if (part[start:stop] == part[start]).all():
                continue
            for k in range(start, stop - low):
                end = start + np.searchsorted(n[start:stop], 100 * n[k] // PERCENT, side="right")
                with_ = np.arange(k + low, min(end, k + high))
                with_ = with_[(part[with_] != part[k]) & (a[with_] != b[k])]
                with_ = with_[linked(np.minimum(left[with_], left[k]), n[with_], n[k])]
                ones.append(np.full(len(with_), b[k]))
                others.append(b[with_])
                size += len(with_)
                if size > 200_000:
                    yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(ones), pa.int64()), "b": pa.array(np.concatenate(others), pa.int64())})
                    ones, others, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(ones), pa.int64()), "b": pa.array(np.concatenate(others), pa.int64())})

    return lists.repartition("token").mapInArrow(run, "a long, b long").distinct()


def _beside(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """a, b and the columns of ``values`` (_key, ...) of both."""
    names = [c for c in values.columns if c != "_key"]
    for end in "ab":
        pairs = pairs.join(values.select(F.col("_key").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in names)), end)
    return pairs


def possible_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose first tokens leave room for a link: beyond them, all the rest could be common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for fa, fb, m, n in zip(*(batch.column(c).to_pylist() for c in ("first_a", "first_b", "n_a", "n_b"))):
                x, y = np.frombuffer(fa, np.uint64), np.frombuffer(fb, np.uint64)
                known = min(x[-1], y[-1])
                x, y = x[: np.searchsorted(x, known, side="right")], y[: np.searchsorted(y, known, side="right")]
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(bool(linked(common + min(m - len(x), n - len(y)), m, n)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _beside(pairs, sets.select("_key", "n", "first")).mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, keyed: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link, by their whole sets."""
    pairs = staged(possible_pairs(pairs, sets), "pairs")
    wanted = pairs.select(F.col("a").alias("_key")).unionAll(pairs.select(F.col("b").alias("_key"))).distinct()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, found in _sets(batches):
            yield pa.RecordBatch.from_pydict({"_key": pa.array(keys, pa.int64()), "tokens": pa.array([t.tobytes() for t in found], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist()):
                x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                keep.append(bool(linked(int((y[at] == x).sum()), len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = bounded_join(_texts(keyed), wanted, ["_key"], "left_semi", "wanted")
    full = staged(texts.mapInArrow(whole, "_key long, tokens binary"), "sets")
    return staged(_beside(pairs, full).mapInArrow(run, "a long, b long"), "verified")


def keyed_components(keyed: DataFrame) -> DataFrame:
    """_key, n_shingles, component (the least _key reachable) of every row of ``keyed`` (_key, text)."""
    digests = staged(set_digests(keyed, frequent_shingles(keyed)), "digests")
    # a set's representative is the least document that has it
    copies = digests.where("n > 0").groupBy("n", "sum", "cross").agg(F.min("_key").alias("rep"))
    copies = staged(copies, "representatives")
    sets = staged(digests.join(copies.select(F.col("rep").alias("_key")), "_key", "left_semi").select("_key", "n", "first"), "representative-sets")
    limit = light_limit(dict(copies.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").agg(F.count(F.lit(1))).collect()))
    light = staged(light_links(sets, limit), "light")
    lists = staged(heavy_lists(sets, limit), "lists")
    links = light.unionAll(verified(lists.where("a <> b").select("a", "b").distinct(), keyed, sets))
    parts = staged(components(links), "parts")
    low = 1
    while not (lists := staged(apart(lists, parts, low), "apart")).isEmpty():
        more = verified(crossing_pairs(lists, low, WIDER * low), keyed, sets)
        if not more.isEmpty():
            stars = parts.select(F.col("id").alias("a"), F.col("component").alias("b"))
            parts = staged(components(stars.unionAll(more)), "parts")
        low *= WIDER
    parts = parts.withColumnRenamed("id", "rep")
    members = digests.drop("first").join(copies, ["n", "sum", "cross"], "left").join(parts, "rep", "left")
    return members.select("_key", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "_key").alias("component"))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    Null texts and texts without words have empty sets and link to nothing. Rows with null or repeated
    doc_ids are documents of their own; their component is named by its least row's doc_id, null first.
    """
    keyed = with_key(docs, ["doc_id", "text"])
    found = keyed_components(keyed)
    names = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "_key")
    roots = names.select(F.col("_key").alias("component"), F.col("doc_id").alias("component_id"))
    return found.join(names, "_key").join(roots, "component").select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are the least of their component."""
    keyed = with_key(docs)
    gone = keyed_components(keyed.select("_key", "text")).where("component <> _key").select("_key")
    return bounded_join(keyed, gone, ["_key"], "left_anti", "gone").select(*docs.columns)
