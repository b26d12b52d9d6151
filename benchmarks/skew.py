"""Similarity with one user and one item that each hold a third of all events.

    python benchmarks/skew.py [events]        (default 6,000,000; BENCH_CPUS as for bench.py)

Every physical form of one setting must print the same count and hash of its rows.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import bench  # noqa: E402
from covisit.plans.similarity import StagedSimilarity, item_similarity  # noqa: E402


def skewed_events(spark: SparkSession, n: int) -> DataFrame:
    def spread(seed: int, values: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(values))

    third = F.col("id") % 3
    return spark.range(n).select(
        F.when(third == 0, F.lit(0)).otherwise(1 + spread(1, n // 10)).alias("user_id"),
        F.when(third == 1, F.lit(0)).otherwise(1 + spread(2, n // 30)).alias("creation_id"),
        F.timestamp_seconds(1_700_000_000 + spread(3, 1_000_000)).alias("action_ts"),
    )


def digest(similar: DataFrame) -> tuple[int, int]:
    rows = similar.select(F.hash("item_i", "item_j", "score").cast("bigint").alias("h"))
    return tuple(rows.agg(F.count(F.lit(1)), F.sum("h")).first())


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    spark = bench.session()
    events = skewed_events(spark, n)
    for cap in (200, 4000):
        start = time.perf_counter()
        rows = digest(item_similarity(events, user_cap=cap))
        print(f"cap {cap} lazy {rows} {time.perf_counter() - start:.1f} s", flush=True)
        start = time.perf_counter()
        with StagedSimilarity(events, user_cap=cap) as similar:
            rows = digest(similar)
        print(f"cap {cap} staged {rows} {time.perf_counter() - start:.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
