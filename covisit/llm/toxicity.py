"""Toxicity scores from two Kneser-Ney models, one of toxic texts and one of ordinary ones.

Both classes spell a word in two steps, its first letters and then the whole: p(word) = p(stem) p(word | stem).
Each step discounts the class's own counts and gives what that frees to a backoff that both classes share: one
part for each kind of word that either class has below the stem (Kneser-Ney's continuation counts, which
count kinds and not occurrences). So an expression that one class never uses still has the other's likelihood
there, a rare one is not taken for proof, and an inflected form that nobody has seen is judged by its stem.

    p_c(word | stem) = (max(n_c - D, 0) + D kinds_c(stem) / kinds(stem)) / n_c(stem)

A text's score comes from its mean log-likelihood ratio per word, and from how far words exceed a margin,
per word and in all, weighed by a logistic regression on texts that the counts did not see.

Counts are a Spark aggregation over all labelled texts. Documents are scored where they lie: the model
goes to the tasks in slices of a bounded size, each with whole stems, and sums of slices add up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit.llm.common import VOCABULARY, bounded_join, slices, staged, with_key

STEM = 4
DISCOUNT = 0.75
#: A word counts as marked by how far its log-likelihood ratio exceeds this.
MARGIN = 3.0
#: Words that are added to a text's length, so that a word alone is no verdict.
PRIOR_WORDS = 10
#: Log-likelihood ratios are summed as whole numbers of this unit: sums are the same in any order.
UNIT = 1 << 16
#: Entries (16 bytes) of a model slice: what a broadcast holds at most, about.
MODEL_ROWS = 2_000_000
#: Labelled texts on which the regression is fitted, at most: those of the smallest hashes.
CALIBRATION_ROWS = 20_000
#: Of labelled texts for learning, one part in so many is kept from the counts for the regression.
CALIBRATION_PART = 4
#: Bytes of text that a task looks at in a row.
SLICE = 8 << 20
#: Weights (intercept; features as in ``features``) that the regression is drawn to, which hold alone where labels are too few.
PRIOR, RIDGE = np.array([-4.0, 0.0, 1.0, 2.0]), 0.1

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Model:
    """``entries``: key long, stem long, value int (see UNIT), staged; ``weights`` of the regression."""

    entries: DataFrame
    weights: tuple[float, ...]


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _stem_key(word: str) -> int:
    return _key(word[:STEM] + "\n")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, a null id as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id) % 3 == 1


def _for_calibration(doc_id: Column) -> Column:
    return F.floor(remainder(doc_id) / 3) % CALIBRATION_PART == 0


def learnable(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (0 or 1): of labelled ids that are not held out. Of several labels the highest counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))


def word_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """word, stem (hashes), ordinary, toxic: occurrences of each word in labelled texts of either class.

    Tasks add up their own words before they are shuffled.
    """
    known = labels.where(~_for_calibration(F.col("doc_id")))
    rows = bounded_join(docs.select("doc_id", "text"), known, ["doc_id"], "inner", "labels").select("text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def emptied() -> pa.RecordBatch:
            seen = list(counts[0] | counts[1])
            out = [np.array(column, np.int64) for column in (
                list(map(_key, seen)), list(map(_stem_key, seen)), *([c[w] for w in seen] for c in counts))]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["word", "stem", "ordinary", "toxic"])

        for batch in batches:
            for part in slices(batch, SLICE):
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    counts[toxic].update(words(text))
                if sum(map(len, counts)) > VOCABULARY:
                    yield emptied()
        yield emptied()

    found = rows.mapInArrow(run, "word long, stem long, ordinary long, toxic long")
    return found.groupBy("word", "stem").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _ratio(parts: tuple[Column, Column], kinds: tuple[Column, Column], both: Column, whole: tuple[Column, Column]) -> Column:
    """log p_toxic - log p_ordinary of a part below a whole; a class without the whole leaves it to the shared backoff."""
    def likelihood(n: Column, k: Column, total: Column) -> Column:
        free = F.lit(DISCOUNT) * k / both
        return F.when(total > 0, (F.greatest(n - F.lit(DISCOUNT), F.lit(0.0)) + free) / total).otherwise(F.lit(1.0) / both)

    ordinary, toxic = (likelihood(*x) for x in zip(parts, kinds, whole))
    return F.log(toxic) - F.log(ordinary)


def model_entries(counts: DataFrame) -> DataFrame:
    """key, stem, value: of each stem, and of each word that either class has (the stem's part included)."""
    counts = staged(counts, "words")
    stems = staged(counts.groupBy("stem").agg(
        F.sum("ordinary").alias("o"), F.sum("toxic").alias("t"), F.count_if(F.col("ordinary") > 0).alias("ko"),
        F.count_if(F.col("toxic") > 0).alias("kt"), F.count(F.lit(1)).alias("k")), "stems")
    all_ = stems.agg(F.sum("o"), F.sum("t"), F.count_if(F.col("o") > 0), F.count_if(F.col("t") > 0), F.count(F.lit(1))).first()
    if not all_[0] or not all_[1]:  # one class alone says nothing
        return stems.select(F.col("stem").alias("key"), "stem", F.lit(0).alias("value")).limit(0)
    o, t, ko, kt, k = (F.lit(x) for x in all_)
    of_stem = _ratio((F.col("o"), F.col("t")), (ko, kt), k, (o, t))
    stems = stems.withColumn("v", of_stem)
    below = bounded_join(counts, stems, ["stem"], "inner", "stem_values")
    of_word = _ratio((F.col("ordinary"), F.col("toxic")), (F.col("ko"), F.col("kt")), F.col("k"), (F.col("o"), F.col("t")))
    whole = F.rint((F.col("v") + F.col("of_word")) * UNIT).cast("int")
    return stems.select(F.col("stem").alias("key"), "stem", F.rint(F.col("v") * UNIT).cast("int").alias("value")).unionAll(
        below.withColumn("of_word", of_word).select(F.col("word").alias("key"), "stem", whole.alias("value")))


class _Lookup(dict):
    """Numbers words as they come; ``values()[number]`` is a word's ratio: its own, else its stem's, else 0."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        super().__init__()
        self._keys, self._entries, self._new, self._values = keys, values, [], np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self._new.append(word)
        return number

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self._keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return self._entries[at].astype(np.int64), self._keys[at] == keys

    def values(self) -> np.ndarray:
        if self._new:
            own, known = self._find(np.array([_key(w) for w in self._new], np.int64))
            stem, below = self._find(np.array([_stem_key(w) for w in self._new], np.int64))
            self._values = np.concatenate([self._values, np.where(known, own, np.where(below, stem, 0))])
            self._new = []
        return self._values


_SUMS = "n_words long, ratio long, excess long"


def _sums(docs: DataFrame, keep: list[str], model: Broadcast) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the words of its text, the sum of their ratios, and of what exceeds the margin."""
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    margin = int(MARGIN * UNIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = model.value
        lookup = _Lookup(keys, values)
        for batch in batches:
            for part in slices(batch, SLICE):
                if len(lookup) > VOCABULARY:
                    lookup = _Lookup(keys, values)
                numbers, counts = [], []
                for text in part.column("text").to_pylist():
                    found = words(text)
                    counts.append(len(found))
                    numbers.append(np.fromiter(map(lookup.__getitem__, found), np.int64, len(found)))
                ratios = lookup.values()[np.concatenate(numbers)]
                edges = np.concatenate([[0], np.cumsum(counts)])
                totals = [np.concatenate([[0], np.cumsum(x)]) for x in (ratios, np.maximum(ratios - margin, 0))]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(np.array(counts, np.int64)), *(pa.array(x[edges[1:]] - x[edges[:-1]]) for x in totals)],
                    [*keep, "n_words", "ratio", "excess"])

    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, {_SUMS}")


def features(docs: DataFrame, entries: DataFrame, model_rows: int = MODEL_ROWS) -> DataFrame:
    """doc_id, n_words, ratio, excess of every row of ``docs``; ``entries`` is staged.

    Beyond ``model_rows`` entries the model is cut by stems, each slice is sent to all tasks in turn, and a row's
    sums are added over slices; the results are the same.
    """
    spark = docs.sparkSession
    parts = max(1, -(-entries.count() // model_rows))

    def sent(rows: DataFrame) -> Broadcast:
        got = rows.select("key", "value").toArrow()
        keys, values = (got.column(c).to_numpy() for c in ("key", "value"))
        order = np.argsort(keys, kind="stable")
        return spark.sparkContext.broadcast((keys[order], values[order]))

    if parts == 1:
        return _sums(docs, ["doc_id"], sent(entries))
    keyed = with_key(docs, ["doc_id", "text"])
    scans = None
    for part in range(parts):
        one = _sums(keyed, ["_key", "doc_id"], sent(entries.where(F.pmod(F.xxhash64("stem"), F.lit(parts)) == part)))
        scans = one if scans is None else scans.unionAll(one)
    return scans.groupBy("_key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.sum("ratio").alias("ratio"), F.sum("excess").alias("excess")).drop("_key")


def _regressors() -> list[Column]:
    length = F.col("n_words") + PRIOR_WORDS
    excess = F.col("excess") / F.lit(UNIT)
    return [F.col("ratio") / F.lit(UNIT) / length, 20 * excess / length, F.log1p(excess)]


def regression(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic weights by Newton's steps, drawn to PRIOR; they are rounded, so that runs agree."""
    z = np.c_[np.ones(len(x)), x]
    w = PRIOR.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + RIDGE * np.eye(len(w)), z.T @ (p - y) + RIDGE * (w - PRIOR))
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-10:
            break
    return tuple(float(v) for v in np.round(w, 6))


def calibrated(found: DataFrame, labels: DataFrame) -> tuple[float, ...]:
    """The weights, from at most CALIBRATION_ROWS labelled rows that the counts have not seen."""
    known = labels.where(_for_calibration(F.col("doc_id")))
    x = [c.alias(f"x{k}") for k, c in enumerate(_regressors())]
    rows = bounded_join(found, known, ["doc_id"], "inner", "calibration").select(F.xxhash64("doc_id").alias("h"), *x, F.col("toxic").cast("double").alias("y"))
    got = rows.orderBy(*rows.columns).limit(CALIBRATION_ROWS).toPandas().to_numpy(np.float64)
    return regression(got[:, 1:4], got[:, 4])


def scored(docs: DataFrame, labels: DataFrame, model_rows: int = MODEL_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (0 or 1 from 0.7 on), n_words, for every row of ``docs`` (doc_id, text).

    ``labels``: doc_id, toxic; only ids that are not held out are learned from, and no column but the text is scored.
    A null or empty text has no words and the score of that. Repeated rows are scored alike. Without labels of both
    classes every text scores as one without marked words. An empty table gives no rows. Other columns are not used.
    """
    known = staged(learnable(labels.select("doc_id", "toxic")), "known")
    entries = staged(model_entries(word_counts(docs, known)), "model")
    found = staged(features(docs.select("doc_id", "text"), entries, model_rows), "features")
    weights = calibrated(found, known)
    odds = F.lit(weights[0])
    for w, x in zip(weights[1:], _regressors()):
        odds = odds + F.lit(w) * x
    score = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)), 9)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        F.when(score >= 0.7, 1).otherwise(0).alias("predicted"), "n_words")
