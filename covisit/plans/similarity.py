"""Item-to-item similarity from what users have in common."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from covisit.operators import pairing
from covisit.operators.cleaning import distinct_events
from covisit.operators.pairing import (
    anchors,
    best_neighbours,
    both_directions,
    cell_anchors,
    cell_pair_count,
    cut_by_cap,
    item_sets,
    pair_count,
    recent_per_user,
    scores_of_sums,
    sizes,
    sums_of_anchors,
    tasks_for,
    uncapped_cells,
)
from covisit.schemas import SIMILARITY, conform
from covisit.session import Staged

ALPHA = 1.0
TOP_K = 100
USER_CAP = 200
SCORE_DIGITS = 9


def user_sets(
    interactions: DataFrame, alpha: float = ALPHA, user_cap: int = USER_CAP
) -> DataFrame:
    """``user_id, items, deg, weight`` from distinct, complete, capped interactions.

    The cap counts events, not items: the same item at two times counts twice.
    """
    events = distinct_events(interactions, ["user_id", "creation_id", "action_ts"])
    return item_sets(recent_per_user(events, user_cap), alpha)


def cap_losses(interactions: DataFrame, user_cap: int = USER_CAP) -> DataFrame:
    """``users_cut, events_cut``: what ``user_cap`` leaves out."""
    return cut_by_cap(distinct_events(interactions, ["user_id", "creation_id", "action_ts"]), user_cap)


def neighbours(
    scores: DataFrame, top_k: int, symmetric: bool = False, min_score: float | None = None
) -> DataFrame:
    """The ``top_k`` best of each item's scored pairs, in the columns of the similarity table."""
    if min_score is not None:
        scores = scores.where(scores["score"] >= min_score)
    if symmetric:
        scores = both_directions(scores)
    return conform(best_neighbours(scores, top_k), SIMILARITY)


def pairs_at_most(interactions: DataFrame, user_cap: int) -> tuple[int, int]:
    """How many pairs the sets of these interactions can make at most, and how many of them one item can have.

    From counts of events by user and by item, in one job: no set is made for it.
    """
    events = interactions.select("user_id", "creation_id", "action_ts").dropna()
    counts = events.groupingSets([["user_id"], ["creation_id"]], "user_id", "creation_id").agg(
        F.grouping("user_id").alias("of_item"), F.count(F.lit(1)).alias("n"))
    size = F.least("n", F.lit(user_cap).cast("bigint"))
    pairs = F.sum(F.when(F.col("of_item") == 0, F.call_function("div", size * (size - 1), F.lit(2))))
    found = counts.agg(F.coalesce(pairs, F.lit(0)).alias("pairs"), F.coalesce(F.max(F.when(F.col("of_item") == 1, F.col("n"))), F.lit(0)).alias("most")).first()
    return found["pairs"], found["most"] * user_cap


def sums_from_sets(
    sets: DataFrame, largest_set: int | None = USER_CAP, both: bool = False, pairs: int | None = None, lone: int | None = None
) -> DataFrame:
    """The sums of all pairs of ``sets`` (of ``uncapped_cells``, if there is no ``largest_set``).

    Unless their number, ``pairs``, is given, with the promise that no item has too many for one task, one job
    over the sets counts them first: both sides of the shuffle get as many tasks as the pairs call for.
    Adaptive execution would size them by the bytes of the sets, which pairing multiplies by up to half the
    user cap. ``both`` gives each pair under both items. ``lone`` is that of ``sums_of_anchors``.
    """
    pairs, hot = sizes(sets, both) if pairs is None else (pairs * (2 if both else 1), [])
    spread = spread_sets(sets, pairs)
    rows = cell_anchors(spread, both) if largest_set is None else anchors(spread, largest_set, both)
    return sums_of_anchors(rows, _tasks(sets, pairs, pairing.SUMMED_PER_TASK), hot, lone)


def spread_sets(sets: DataFrame, pairs: int) -> DataFrame:
    """Sets that make ``pairs``, dealt to as many tasks as are to send them."""
    cell = ["cell"] if "cell" in sets.columns else []
    return sets.repartition(_tasks(sets, pairs, pairing.SENT_PER_TASK), "user_id", *cell)


def _tasks(sets: DataFrame, pairs: int, per_task: int) -> int:
    return tasks_for(pairs, per_task, sets.sparkSession.sparkContext.defaultParallelism)


def scores_from_sets(
    sets: DataFrame, user_cap: int = USER_CAP, score_digits: int = SCORE_DIGITS
) -> DataFrame:
    """All scored pairs ``item_i < item_j``."""
    return scores_of_sums(sums_from_sets(sets, user_cap), score_digits)


def item_similarity(
    interactions: DataFrame,
    alpha: float = ALPHA,
    top_k: int = TOP_K,
    user_cap: int | None = USER_CAP,
    symmetric: bool = False,
    min_score: float | None = None,
    score_digits: int = SCORE_DIGITS,
) -> DataFrame:
    """``item_i, item_j, score``: for each item its ``top_k`` best-scored items.

    By default a pair is listed once, under its smaller id, so an item does not find its
    smaller neighbours under itself; ``symmetric`` lists it under both. Pairs with one common
    user score 0 and stay; ``min_score`` can drop them. ``user_cap=None`` takes all events of every
    user; ``cap_losses`` says what a cap leaves out.

    Lazy, but for a job that counts events, and one that counts pairs where an item may have too many for one task. Shuffles: distinct events (none if the input is
    already grouped by user and item), events by user, item sets (compact), anchors by item, some five bytes a pair, and
    at most ``top_k`` rows per item and task by item. Without a cap the sets are stored in the shared folder first, and stay.
    ``StagedSimilarity`` computes the same from sets that are stored, and removed.
    """
    if user_cap is None:
        return StagedSimilarity(interactions, alpha, top_k, None, symmetric, min_score, score_digits).frame
    sets = user_sets(interactions, alpha, user_cap)
    pairs, of_one_item = pairs_at_most(interactions, user_cap)
    few = pairs if of_one_item <= pairing.PAIRS_PER_ITEM else None
    return _listed(sets, top_k, user_cap, symmetric, min_score, score_digits, few)


def lone_listed(top_k: int, min_score: float | None) -> int:
    """How many pairs of one common user, which score 0, a list can hold."""
    return 0 if min_score is not None and min_score > 0 else top_k


def _listed(
    sets: DataFrame, top_k: int, user_cap: int | None, symmetric: bool, min_score: float | None, score_digits: int, pairs: int | None = None
) -> DataFrame:
    scores = scores_of_sums(sums_from_sets(sets, user_cap, symmetric, pairs, lone_listed(top_k, min_score)), score_digits)
    return neighbours(scores, top_k, False, min_score)  # sums of both directions are there already


class StagedSimilarity:
    """``item_similarity`` whose files go when it is done, for jobs that write a table.

    The user sets are written to the shared folder first, their pairs counted on the way. So the
    costly half starts from files, which lost executors do not take along, and both sides of its
    shuffle get as many tasks as its pairs call for.

    Use as a context manager. The block's value is the similarity frame; write it inside.
    """

    def __init__(
        self,
        interactions: DataFrame,
        alpha: float = ALPHA,
        top_k: int = TOP_K,
        user_cap: int | None = USER_CAP,
        symmetric: bool = False,
        min_score: float | None = None,
        score_digits: int = SCORE_DIGITS,
    ):
        counts = Observation(f"user_sets_{uuid.uuid4().hex}")
        if user_cap is None:
            complete = interactions.select("user_id", "creation_id", "action_ts").dropna()
            sets, count = uncapped_cells(complete, alpha), cell_pair_count()
        else:
            sets, count = user_sets(interactions, alpha, user_cap), pair_count()
        self._staged = Staged(sets.observe(counts, count.alias("pairs")), "user_sets")
        try:
            self.pairs: int = counts.get["pairs"]
            self.frame = _listed(self._staged.frame, top_k, user_cap, symmetric, min_score, score_digits)
        except BaseException:
            self._staged.close()
            raise

    def __enter__(self) -> DataFrame:
        return self.frame

    def __exit__(self, *exc: object) -> None:
        self._staged.close()
