"""Latest click per user and item over a window of days."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit.functions.days import parse_day, trailing_days
from covisit.functions.parsing import day_start
from covisit.operators.ranking import latest_time
from covisit.schemas import CLICK, CLICK_CODE, conform


def latest_clicks(
    action: DataFrame,
    end_date: str | None = None,
    days: int = 7,
    action_type: int = CLICK_CODE,
    date_col: str = "p_date",
    ingested: tuple[str, str] | None = None,
) -> DataFrame:
    """``user_id, creation_id, action_ts``: the last time each user acted on each item.

    The window is the ``days`` days that end at ``end_date``. By default it selects ingest days
    (``p_date``) and not event times, as a list of literals, which prunes partitions. Naming a
    timestamp column as ``date_col`` selects by event time instead, and ``ingested`` (first and last
    ingest day) then says which partitions can hold such events. A missing time counts as the start of
    the ingest day.
    """
    if ingested is not None:
        known = [parse_day(day).strftime("%Y%m%d") for day in ingested]
        action = action.where(F.col("p_date").between(*known))
    present = F.col("user_id").isNotNull() & F.col("creation_id").isNotNull()
    clicks = action.where(
        _in_window(action, date_col, trailing_days(end_date, days))
        & (F.col("action_type") == action_type)
        & present
    ).select(
        "user_id", "creation_id",
        F.coalesce(F.col("action_ts"), day_start(F.col("p_date"))).alias("action_ts"),
    )
    return conform(latest_time(clicks, ["user_id", "creation_id"], "action_ts"), CLICK)


def _in_window(action: DataFrame, date_col: str, labels: list[str]) -> Column:
    column = F.col(date_col)
    if date_col == "action_ts":
        column = F.coalesce(column, day_start(F.col("p_date")))
    if isinstance(action.schema[date_col].dataType, T.StringType):
        return column.isin(labels)
    first = datetime.combine(parse_day(labels[0]), datetime.min.time())
    after = datetime.combine(parse_day(labels[-1]), datetime.min.time()) + timedelta(days=1)
    start, end = (
        F.lit(day.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp") for day in (first, after)
    )
    return (column >= start) & (column < end)
