"""Sketches of days against exact counts of their range."""

import pytest
from pyspark.sql import functions as F

from covisit import fixtures as fx
from covisit.operators.profile import table_profile
from covisit.plans.sketches import SketchStore

DAYS = [f"202401{d:02d}" for d in range(1, 31)]


@pytest.fixture(scope="module")
def action(spark):
    from tests.conftest import SF

    return fx.action(spark, SF)


@pytest.fixture(scope="module")
def store(spark, action, tmp_path_factory):
    store = SketchStore(spark, str(tmp_path_factory.mktemp("sketches") / "s"), buckets=4)
    store.add(action, DAYS[:20])
    store.add(action, DAYS[20:])
    return store


def test_users_with_few_items_are_counted_exactly(store, action):
    for first, last in (("20240101", "20240130"), ("20240110", "20240112"), ("20240105", "20240105")):
        got = {r["user_id"]: (r["action_count"], r["creation_count"]) for r in store.user_activity(first, last).collect()}
        days = action.where(F.col("p_date").between(first, last)).groupBy("user_id").agg(F.count(F.lit(1)), F.count_distinct("creation_id"))
        assert got == {r[0]: (r[1], r[2]) for r in days.collect()}


def test_ranges_need_no_shuffle_and_no_actions(store):
    plan = store.user_activity("20240101", "20240130")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan and "creation_id" not in plan


def test_error_of_the_profile(store, action):
    exact = {r["column"]: r for r in table_profile(action).collect()}
    got = {r["column"]: r for r in store.table_profile("20240101", "20240130").collect()}
    assert got.keys() == exact.keys()
    for name, r in exact.items():
        assert (got[name]["n"], got[name]["nulls"]) == (r["n"], r["nulls"])
        assert abs(got[name]["distinct"] - r["distinct"]) <= 0.05 * r["distinct"], name
    one = {r["column"]: r["distinct"] for r in store.table_profile("20240107", "20240107").collect()}
    assert one["p_date"] == 1


def test_a_day_is_replaced_and_others_stay(spark, action, tmp_path):
    store = SketchStore(spark, str(tmp_path / "s"), buckets=2)
    assert store.user_activity("20240101", "20240102").collect() == [] and store.table_profile("20240101", "20240102").collect() == []
    store.add(action, ["20240101", "20240102"])
    both = store.user_activity("20240101", "20240102").agg(F.sum("action_count")).first()[0]
    store.add(action.where("user_id = 1"), ["20240102"])
    assert store.days() == ["20240101", "20240102"]
    first = action.where("p_date = '20240101'").count()
    assert store.user_activity("20240102", "20240102").count() <= 1
    assert first <= store.user_activity("20240101", "20240102").agg(F.sum("action_count")).first()[0] < both
    with pytest.raises(ValueError, match="precision"):
        SketchStore(spark, str(tmp_path / "s"), precision=10, buckets=2)


def test_null_users_and_values(spark, tmp_path):
    rows = spark.createDataFrame([(None, None, None, None, "20240101"), (None, None, 1, 5, "20240101"), (7, None, 1, None, "20240101")],
                                 "user_id long, action_ts timestamp, action_type int, creation_id long, p_date string")
    store = SketchStore(spark, str(tmp_path / "s"), buckets=2)
    store.add(rows, ["20240101", "20240102"])
    assert sorted(map(tuple, store.user_activity("20240101", "20240102").collect()), key=repr) == [(7, 1, 0), (None, 2, 1)]
    got = {r["column"]: (r["n"], r["nulls"], r["distinct"]) for r in store.table_profile("20240101", "20240101").collect()}
    assert got["action_ts"] == (3, 3, 0) and got["creation_id"] == (3, 2, 1) and got["user_id"] == (3, 2, 1)
