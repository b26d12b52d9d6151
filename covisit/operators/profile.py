"""Counts per column, and counts taken while rows pass through."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def table_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: ``column, n`` (all rows), ``nulls``, ``distinct`` (non-null values).

    One pass over the table. ``approximate`` swaps the exact distinct counts, which shuffle
    every distinct value, for sketches that do not shuffle values at all.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    measures = [F.count(F.lit(1)).alias("n")]
    for place, name in enumerate(df.columns):
        column = F.col(f"`{name}`")
        measures.append(F.count(column).alias(f"present_{place}"))
        measures.append(distinct(column).alias(f"distinct_{place}"))
    rows = F.array(*(
        F.struct(
            F.lit(name).alias("column"),
            F.col("n"),
            (F.col("n") - F.col(f"present_{place}")).alias("nulls"),
            F.col(f"distinct_{place}").alias("distinct"),
        )
        for place, name in enumerate(df.columns)
    ))
    return df.agg(*measures).select(F.inline(rows))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and an observation whose ``get["rows"]`` is its row count once some
    action has run over the frame: the count costs no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
