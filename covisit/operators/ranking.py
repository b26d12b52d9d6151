"""The best N rows of each key, and the newest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """Keep the first ``n`` rows of each key in ``order``, which must be total.

    Spark cuts every key to ``n`` rows per task before the shuffle, so a hot key arrives as a few
    rows per task, up to the session's ``windowGroupLimitThreshold`` (see ``session.DEFAULTS``).
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, not {n}")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def latest_time(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The newest ``time`` of each key.

    A maximum says the same as ranking by time when key and time are all that is kept, needs
    no sort, and combines before the shuffle however hot a key is.
    """
    return df.groupBy(*keys).agg(F.max(time).alias(time))


def latest_version(
    df: DataFrame, keys: Sequence[str], version: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The whole row with the highest ``version`` of each key; ties go to the highest
    ``tie_break`` columns, which must be named until the order is total."""
    order = [F.col(c).desc_nulls_last() for c in (version, *tie_break)]
    return top_n_per_key(df, keys, order, 1)
