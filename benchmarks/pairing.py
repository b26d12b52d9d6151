"""Three ways to make the item pairs of a user, timed on whole similarity runs.

    python benchmarks/pairing.py        (BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS as for bench.py)

native     the library: generators over sorted arrays (lazy form and staged form)
self_join  user-item rows joined with themselves on the user
python     mapInPandas over the item sets, pairs made by itertools
"""

from __future__ import annotations

import json
import sys
from itertools import combinations
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import bench  # noqa: E402
from covisit import fixtures as fx  # noqa: E402
from covisit.operators.pairing import best_neighbours, pair_scores  # noqa: E402
from covisit.plans.similarity import item_similarity, user_sets  # noqa: E402

DIGITS, TOP = 9, 10


def self_join(interactions: DataFrame) -> DataFrame:
    one = user_sets(interactions).select("user_id", "weight", F.explode("items").alias("item_i"))
    other = one.select("user_id", F.col("item_i").alias("item_j"))
    pairs = one.join(other, "user_id").where("item_i < item_j").select(
        "item_i", "item_j", F.col("weight").alias("w"), (F.col("weight") * F.col("weight")).alias("w2"))
    return best_neighbours(pair_scores(pairs, DIGITS), TOP)


def _pairs(frames):
    for frame in frames:
        rows = [(i, j, w, w * w) for items, w in zip(frame["items"], frame["weight"])
                for i, j in combinations(items.tolist(), 2)]
        yield pd.DataFrame(rows, columns=["item_i", "item_j", "w", "w2"])


def python(interactions: DataFrame) -> DataFrame:
    pairs = user_sets(interactions).select("items", "weight").mapInPandas(
        _pairs, "item_i long, item_j long, w double, w2 double")
    return best_neighbours(pair_scores(pairs, DIGITS), TOP)


def main() -> None:
    spark = bench.session()
    basket = fx.basket(spark, bench.SF_DIR)
    seconds = {
        "native_lazy": bench.timed(lambda: bench.run(item_similarity(basket, top_k=TOP))),
        "native_staged": bench.timed(lambda: bench.staged(spark)),
        "self_join": bench.timed(lambda: bench.run(self_join(basket))),
        "python": bench.timed(lambda: bench.run(python(basket))),
    }
    spark.stop()
    print(json.dumps({"sf_dir": bench.SF_DIR, "cpus": bench.CPUS, "seconds": seconds}))


if __name__ == "__main__":
    main()
