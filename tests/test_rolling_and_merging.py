"""Daily maxima that roll, and a table that merges versions: equal to one run over all rows, without shuffles of what is stored."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from covisit import fixtures as fx
from covisit.operators.ranking import latest_version
from covisit.plans.click_window import latest_clicks
from covisit.plans.rolling import RollingClicks
from covisit.schemas import ACTION
from covisit.sources.merging import Layout, MergingTable
from covisit.sources.versions import Conflict

START = datetime(2024, 1, 1)
KEYS, TIES = ["user_id", "creation_id"], ["action_type", "p_date"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def action(spark, days, seed=1):
    rng = random.Random(seed)
    out = []
    for d in days:
        label = (START + timedelta(days=d)).strftime("%Y%m%d")
        out += [(rng.choice([None, *range(6)]), rng.choice([None, START + timedelta(days=d, hours=rng.randrange(48) - 24)]),
                 rng.choice([1, 2, 2, 2]), rng.choice([None, *range(8)]), label) for _ in range(60)]
    return spark.createDataFrame(out, ACTION)


def test_rolling_equals_a_whole_run_and_reads_new_days_only(spark, tmp_path):
    raw = str(tmp_path / "raw")
    action(spark, range(5)).write.partitionBy("p_date").parquet(raw)
    read = lambda: spark.read.schema(ACTION).parquet(raw)
    store = RollingClicks(spark, str(tmp_path / "days"), buckets=3)
    with pytest.raises(LookupError, match="20240103"):
        store.window("20240104", 3)
    assert store.advance(read(), "20240104", 3) == ["20240102", "20240103", "20240104"]
    assert rows(store.window("20240104", 3)) == rows(latest_clicks(read(), "20240104", 3))
    whole = rows(latest_clicks(read(), "20240105", 3))
    for old in ("20240102", "20240103", "20240104"):  # what is stored is not read again, so it may be gone
        spark.createDataFrame([], ACTION).drop("p_date").write.mode("overwrite").parquet(f"{raw}/p_date={old}")
    assert store.advance(read(), "20240105", 3) == ["20240105"]
    assert rows(store.window("20240105", 3)) == whole
    assert store.days() == ["20240103", "20240104", "20240105"] and store.advance(read(), "20240105", 3) == []
    assert "Exchange" not in plan(store.window("20240105", 3))
    # a day that was ingested anew, and a window that goes back
    assert store.advance(read(), "20240105", 3, again=["20240104"]) == ["20240104"]
    assert rows(store.window("20240104", 1)) == []
    assert store.advance(read(), "20240102", 2) == ["20240101", "20240102"]
    with pytest.raises(ValueError, match="action_type"):
        RollingClicks(spark, str(tmp_path / "days"), action_type=3, buckets=3)


def test_a_failed_day_leaves_the_stored_window(spark, tmp_path):
    store = RollingClicks(spark, str(tmp_path / "days"), buckets=2)
    store.advance(action(spark, range(2)), "20240102", 2)
    before = rows(store.window("20240102", 2))
    broken = action(spark, range(3)).withColumn("action_ts", F.raise_error(F.lit("broken")).cast("timestamp"))
    with pytest.raises(Exception, match="broken"):
        store.advance(broken, "20240103", 2)
    assert store.days() == ["20240101", "20240102"] and rows(store.window("20240102", 2)) == before


def merging(spark, path, buckets=4):
    return MergingTable(spark, str(path), ACTION, KEYS, "action_ts", TIES, buckets)


def newest(df):
    return rows(latest_version(df, KEYS, "action_ts", TIES).select(*ACTION.names))


def test_exact_and_eventual_before_and_after_compaction(spark, sf, tmp_path):
    table, whole = merging(spark, tmp_path / "t"), fx.action(spark, sf)
    assert rows(table.exact()) == [] and table.compact() == 0 and table.layout() == Layout(0, 0, 0)
    parts = [whole.where(F.pmod(F.xxhash64("action_ts"), F.lit(3)) == k) for k in range(3)]
    for part in parts:
        table.append(part)
    want = newest(whole)
    assert table.layout() == Layout(4, 4, 12)
    assert rows(table.exact()) == want and table.eventual().count() > len(want)
    assert "Exchange" not in plan(table.exact()) and "Bucketed: true" in plan(table.exact())
    assert set(want) <= set(map(tuple, table.eventual().collect()))
    assert table.compact() == 4 and table.layout() == Layout(4, 0, 4)
    assert rows(table.exact()) == want == rows(table.eventual())
    table.append(parts[1])  # rows that are known, once more
    assert rows(table.exact()) == want
    assert rows(merging(spark, tmp_path / "t").exact()) == want


def test_only_touched_buckets_are_merged(spark, tmp_path):
    table = merging(spark, tmp_path / "t", buckets=8)
    table.append(spark.createDataFrame([(u, START, 1, u, "20240101") for u in range(200)], ACTION))
    table.append(spark.createDataFrame([(5, START + timedelta(days=1), 2, 5, "20240102")], ACTION))
    before = dict(table._entries())
    assert table.layout().touched == 1 and table.compact() == 1
    after = table._entries()
    assert len(set(before.items()) & set(after.items())) == 7 and len(after) == 8
    assert table.exact().where("user_id = 5").first()["action_type"] == 2 and table.exact().count() == 200


def test_ties_nulls_repeated_rows_and_two_writers(spark, tmp_path):
    table = merging(spark, tmp_path / "t", buckets=2)
    odd = [(None, None, None, None, None), (None, START, 1, None, "a"), (1, START, 1, 2, "a"), (1, START, 3, 2, "a"), (1, START, 3, 2, "b"),
           (1, START, 3, 2, "b"), (1, None, 9, 2, "z"), (2, None, None, 2, None)]
    for row in odd:
        table.append(spark.createDataFrame([row], ACTION))
    table.append(spark.createDataFrame(odd, ACTION))
    want = newest(spark.createDataFrame(odd, ACTION))
    assert rows(table.exact()) == want
    table.compact()
    assert rows(table.exact()) == rows(table.eventual()) == want
    late = table._versions.draft()
    table.append(spark.createDataFrame([(7, START, 1, 7, "a")], ACTION))
    with pytest.raises(Conflict):
        late.publish()
    assert table.exact().count() == len(want) + 1
    with pytest.raises(ValueError, match="another"):
        MergingTable(spark, str(tmp_path / "t"), ACTION, ["user_id"], "action_ts", TIES, 2)
