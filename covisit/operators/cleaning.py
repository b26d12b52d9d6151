"""Row hygiene: duplicates, nulls, and splitting rows by a rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_events(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns``, all of them present."""
    return df.select(*columns).dropna().distinct()


def split_rows(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy ``keep``, and all the others (an unknown outcome counts as "no").

    The second half is the complement of the filter and not a set difference: no shuffle,
    and duplicates stay by themselves.
    """
    known = F.coalesce(keep, F.lit(False))
    return df.where(known), df.where(~known)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` minus ``right``, each row of ``right`` taking away one equal row."""
    return left.exceptAll(right)
