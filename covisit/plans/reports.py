"""The standing questions about the action table.

Days are yyyyMMdd labels compared as text with the partition column, so each report reads
only the partitions it needs. Every limited report has a total order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit.functions.days import parse_day


def _since(first: str, last: str | None = None) -> Column:
    parse_day(first)
    if last is None:
        return F.col("p_date") >= first
    parse_day(last)
    return F.col("p_date").between(F.lit(first), F.lit(last))


def actions_on_day(action: DataFrame, day: str) -> DataFrame:
    parse_day(day)
    return action.where(F.col("p_date") == day)


def actions_in_range(action: DataFrame, first: str, last: str) -> DataFrame:
    """Both days included."""
    return action.where(_since(first, last))


def actions_by_type(action: DataFrame, day: str) -> DataFrame:
    """``action_type, cnt``, most frequent first."""
    return (
        actions_on_day(action, day)
        .groupBy("action_type")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("cnt").desc(), F.col("action_type").asc())
    )


def actions_by_hour(action: DataFrame, day: str) -> DataFrame:
    """``hour, action_type, cnt``: the heat map of a day."""
    return (
        actions_on_day(action, day)
        .groupBy(F.hour("action_ts").alias("hour"), "action_type")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("hour").asc(), F.col("cnt").desc(), F.col("action_type").asc())
    )


_NEWEST = ("action_ts", "creation_id", "action_type", "p_date")


def _newest_first() -> list[Column]:
    return [F.col(name).desc() for name in _NEWEST]


def user_history(action: DataFrame, user_id: int, first: str, n: int = 20) -> DataFrame:
    """The ``n`` newest actions of one user since a day."""
    mine = action.where(_since(first) & (F.col("user_id") == user_id))
    return mine.orderBy(*_newest_first()).limit(n)


def user_item_history(
    action: DataFrame, user_id: int, creation_id: int, first: str
) -> DataFrame:
    """All actions of one user on one item since a day, newest first."""
    mine = action.where(
        _since(first) & (F.col("user_id") == user_id) & (F.col("creation_id") == creation_id)
    )
    return mine.orderBy(*_newest_first())


def user_activity(
    action: DataFrame, first: str, last: str, n: int = 100, approximate: bool = False
) -> DataFrame:
    """``user_id, action_count, creation_count``: the ``n`` busiest users of a range of days.

    The exact item count goes through (user, item) first, so that a hot user is spread over
    many tasks; ``approximate`` replaces it by a sketch per user.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        actions_in_range(action, first, last)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("action_count"),
            distinct("creation_id").alias("creation_count"),
        )
        .orderBy(F.col("action_count").desc(), F.col("user_id").asc())
        .limit(n)
    )
