"""Benchmark decontamination: BM25 retrieval of test items by every passage, then overlap checks.

The test items are the indexed side: an inverted index of impacts, each item's scaled so that a
passage with all its words scores 1. Passages are the queries. Items lie in blocks, with the largest
impact of each term in each block:

1. terms are split so that no item reaches the threshold by the frequent ones alone; a passage is
   followed further only through blocks that one of its rare terms is in (the pivot of WAND);
2. a block is opened if the largest impacts there, of the passage's rare terms, and the most that
   frequent terms give any item there, reach the threshold;
3. the items of open blocks are scored in full.

Bounds are never below scores, so every item above the threshold is retrieved.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covisit.llm.common import VOCABULARY, ranges

K1, B = 1.2, 0.75
#: Items of an index, and characters; a larger benchmark makes several, each held against all documents.
INDEX_ITEMS, INDEX_CHARS = 20_000, 40_000_000
BLOCK = 8
_WORD = re.compile(r"\w+")
_END = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Thresholds:
    """Retrieval: the share of an item's own BM25 score. Verification: the shares of the question's 5-word
    shingles and of the answer's words that the passage has."""

    score: float = 0.6
    question: float = 0.8
    answer: float = 0.8
    shingle: int = 5


def normal_word(word: str) -> str:
    """Letters and digits in lower case."""
    return "".join(_WORD.findall(word.lower()))


def words_of(text: str) -> list[str]:
    return [w for w in map(normal_word, text.split()) if w]


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of all sentences but the last, and of the last. One sentence is a question."""
    sentences = [s for s in map(words_of, _END.split(text)) if s]
    if len(sentences) < 2:
        return words_of(text), []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    """Runs of ``n`` words; fewer words are one shingle."""
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def overlap(item: str, passage: list[str], limits: Thresholds) -> tuple[float, float]:
    """The shares of the item's question shingles and answer words that the passage has."""
    question, answer = question_answer(item)
    sought, sizes = shingles(question, limits.shingle), {min(limits.shingle, max(1, len(question)))}
    there = {tuple(passage[k : k + n]) for n in sizes for k in range(len(passage) - n + 1)}
    words = set(answer)
    return (len(sought & there) / len(sought) if sought else 1.0, len(words & set(passage)) / len(words) if words else 1.0)


class Index:
    """An impact index of test items. Items without words are left out: nothing could match them."""

    def __init__(self, items: list[tuple[int, str]], limits: Thresholds = Thresholds()):
        items = [(i, t) for i, t in items if t and words_of(t)]
        self.limits, self.items = limits, items
        bags = [words_of(t) for _, t in items]
        self.longest = max(map(len, bags), default=1)
        mean = sum(map(len, bags)) / max(1, len(bags))
        self.terms = {w: k for k, w in enumerate(sorted({w for b in bags for w in b}))}
        df = np.zeros(len(self.terms))
        for bag in bags:
            df[[self.terms[w] for w in set(bag)]] += 1
        idf = np.log(1 + (len(bags) - df + 0.5) / (df + 0.5))
        postings = []
        for k, bag in enumerate(bags):
            of = np.bincount([self.terms[w] for w in bag], minlength=0)
            terms = np.nonzero(of)[0]
            impact = idf[terms] * of[terms] * (K1 + 1) / (of[terms] + K1 * (1 - B + B * len(bag) / mean))
            postings += zip(terms.tolist(), [k] * len(terms), (impact / impact.sum()).tolist())
        postings.sort()
        self._term = np.array([p[0] for p in postings], np.int64)
        self.item = np.array([p[1] for p in postings], np.int64)
        self.impact = np.array([p[2] for p in postings])
        self.first = np.searchsorted(self._term, np.arange(len(self.terms) + 1))
        self._split(df)

    def _split(self, df: np.ndarray) -> None:
        """Frequent terms: as many as leave every item below the threshold. Then the block bounds of the others."""
        given = np.zeros(len(self.items))
        self.rare = np.ones(len(self.terms), bool)
        for t in np.argsort(-df, kind="stable"):
            own = slice(self.first[t], self.first[t + 1])
            after = given[self.item[own]] + self.impact[own]
            if after.max(initial=0) < self.limits.score - 1e-6:
                given[self.item[own]] = after
                self.rare[t] = False
        self.blocks = len(self.items) // BLOCK + 1
        self.given = np.zeros(self.blocks)
        np.maximum.at(self.given, np.arange(len(self.items)) // BLOCK, given)
        keep = self.rare[self._term]
        keys, inverse = np.unique(self._term[keep] * self.blocks + self.item[keep] // BLOCK, return_inverse=True)
        self.block, self.block_max = keys % self.blocks, np.zeros(len(keys))
        np.maximum.at(self.block_max, inverse, self.impact[keep])
        self.block_first = np.searchsorted(keys // self.blocks, np.arange(len(self.terms) + 1))

    def open_blocks(self, terms: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages and their blocks whose bound reaches the threshold, from all (term, passage) occurrences."""
        keep = self.rare[terms]
        keys = np.unique(passages[keep] * len(self.terms) + terms[keep])
        passages, terms = keys // len(self.terms), keys % len(self.terms)
        many = self.block_first[terms + 1] - self.block_first[terms]
        at = ranges(self.block_first[terms], many)
        keys, inverse = np.unique(np.repeat(passages, many) * self.blocks + self.block[at], return_inverse=True)
        bound = np.bincount(inverse, self.block_max[at], len(keys)) + self.given[keys % self.blocks]
        keys = keys[bound >= self.limits.score - 1e-6]
        return keys // self.blocks, keys % self.blocks

    def scores(self, terms: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[int, float]]:
        """Items of ``blocks`` at or above the threshold, for one passage's distinct terms."""
        at = ranges(self.first[terms], self.first[terms + 1] - self.first[terms])
        at = at[np.isin(self.item[at] // BLOCK, blocks)]
        items, inverse = np.unique(self.item[at], return_inverse=True)
        totals = np.bincount(inverse, self.impact[at], len(items))
        for k in np.nonzero(totals >= self.limits.score - 1e-9)[0]:
            yield int(items[k]), float(totals[k])


class Searcher:
    """Holds documents against an index. Passages are 3 items long and overlap by one item's length."""

    def __init__(self, index: Index):
        self._index = index
        self._step = 2 * (index.longest + index.longest // 4 + 1)
        self._span = self._step * 3 // 2
        self._clear()

    def _clear(self) -> None:
        self._numbers: dict[str, int] = {}
        self._words: list[str] = []
        self._terms = np.zeros(0, np.int64)

    def _number(self, text: str | None) -> np.ndarray:
        numbers = self._numbers
        words = (text or "").split()
        for w in set(words).difference(numbers):
            numbers[w] = len(self._words)
            self._words.append(normal_word(w))
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))

    def _term_of(self) -> np.ndarray:
        if len(self._terms) < len(self._words):
            new = self._words[len(self._terms) :]
            made = [self._index.terms.get(w, -1) if w else -2 for w in new]
            self._terms = np.concatenate([self._terms, np.array(made, np.int64)])
        return self._terms

    def matches(self, texts: list[str | None]) -> list[dict[int, tuple[float, float, float]]]:
        """For each text the verified items: the best passage's score, question share and answer share."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        if not self._index.items:
            return found
        if len(self._words) > VOCABULARY:
            self._clear()
        numbers = [self._number(t) for t in texts]
        term_of = self._term_of()
        numbers = [n[term_of[n] != -2] for n in numbers]
        lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
        base = np.cumsum(lengths) - lengths
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        terms = term_of[flat]
        # passage numbers: each text's own, one after the other; a text always has one
        passages_of = np.maximum(0, (lengths - self._span + self._step - 1) // self._step) + 1
        first = np.cumsum(passages_of) - passages_of
        text_of = np.repeat(np.arange(len(texts)), lengths)
        place = np.arange(len(flat)) - base[text_of]
        last = np.minimum(place // self._step, passages_of[text_of] - 1)
        known = terms >= 0
        before = known & (last > 0) & (place < (last - 1) * self._step + self._span)
        occurrences = np.concatenate([terms[known], terms[before]])
        in_passage = np.concatenate([(first[text_of] + last)[known], (first[text_of] + last - 1)[before]])
        passages, blocks = self._index.open_blocks(occurrences, in_passage)
        edges = np.searchsorted(passages, np.unique(passages))
        for a, b in zip(edges, [*edges[1:], len(passages)]):
            text = int(np.searchsorted(first, passages[a], side="right")) - 1
            start = base[text] + (passages[a] - first[text]) * self._step
            span = slice(start, min(start + self._span, base[text] + lengths[text]))
            own = np.unique(terms[span])
            words = None
            for item, score in self._index.scores(own[own >= 0], blocks[a:b]):
                words = words or [self._words[n] for n in flat[span]]
                question, answer = overlap(self._index.items[item][1], words, self._index.limits)
                if question >= self._index.limits.question and answer >= self._index.limits.answer:
                    found[text][item] = max(found[text].get(item, (0.0, 0.0, 0.0)), (score, question, answer))
        return found


def indexes(benchmark: DataFrame, limits: Thresholds = Thresholds()) -> Iterator[Index]:
    """Indexes of all items, of INDEX_ITEMS items and about INDEX_CHARS characters at most."""
    items: list[tuple[int, str]] = []
    chars = 0
    for item_id, text in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        items.append((item_id, text))
        chars += len(text)
        if len(items) >= INDEX_ITEMS or chars >= INDEX_CHARS:
            yield Index(items, limits)
            items, chars = [], 0
    if items:
        yield Index(items, limits)


_TEXTS = 500


def leaks(docs: DataFrame, benchmark: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """doc_id, item_id, score, question_share, answer_share of every verified match.

    Null texts match nothing; null ids stay null; repeated rows are matched row by row. An empty table
    on either side gives no rows. Documents are read where they are: nothing is shuffled.
    """
    schema = "doc_id long, item_id long, score double, question_share double, answer_share double"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in indexes(benchmark, limits):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(held.value)
            for batch in batches:
                rows = []
                for a in range(0, batch.num_rows, _TEXTS):
                    part = batch.slice(a, _TEXTS)
                    for doc_id, found in zip(part.column("doc_id").to_pylist(), searcher.matches(part.column("text").to_pylist())):
                        rows += [(doc_id, held.value.items[k][0], *found[k]) for k in sorted(found)]
                columns = zip(*rows) if rows else [[]] * 5
                kinds = [pa.int64()] * 2 + [pa.float64()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in schema.split(", ")])

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionAll(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item."""
    for index in indexes(benchmark, limits):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(held.value)
            for batch in batches:
                for a in range(0, batch.num_rows, _TEXTS):
                    part = batch.slice(a, _TEXTS)
                    found = searcher.matches(part.column("text").to_pylist())
                    yield part.filter(pa.array([not x for x in found]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
