import datetime as dt

import pytest
from pyspark.sql import functions as F

from covisit import fixtures as fx
from covisit.functions.days import parse_day, trailing_days
from covisit.plans.click_window import latest_clicks
from covisit.sources.tables import ensure_action_table, ensure_database, overwrite_partitions

ROWS = [
    # user, time, type, item, label
    (1, "2024-01-25 10:00:00", 2, 10, "20240125"),
    (1, "2024-01-27 11:00:00", 2, 10, "20240127"),  # same pair, later
    (2, "2024-01-26 09:00:00", 2, 11, "20240126"),
    (2, "2024-01-26 09:00:00", 2, 11, "20240126"),  # ingested twice
    (3, "2024-01-26 09:00:00", 1, 12, "20240126"),  # no click
    (None, "2024-01-26 09:00:00", 2, 12, "20240126"),
    (3, "2024-01-26 09:00:00", 2, None, "20240126"),
    (4, None, 2, 13, "20240126"),  # time from the label
    (5, "2023-06-01 00:00:00", 2, 14, "20240124"),  # old event, label inside
    (6, "2024-01-26 00:00:00", 2, 15, "20240123"),  # label outside
    (7, "2024-01-30 23:59:59", 2, 16, "20240130"),
]


@pytest.fixture
def action(spark):
    return spark.createDataFrame(
        ROWS, "user_id long, t string, action_type int, creation_id long, p_date string"
    ).select("user_id", F.col("t").cast("timestamp").alias("action_ts"), "action_type",
             "creation_id", "p_date")


def answer(df):
    return {(r.user_id, r.creation_id): str(r.action_ts) for r in df.collect()}


def test_edges(action):
    assert answer(latest_clicks(action, "20240130")) == {
        (1, 10): "2024-01-27 11:00:00", (2, 11): "2024-01-26 09:00:00",
        (4, 13): "2024-01-26 00:00:00", (5, 14): "2023-06-01 00:00:00",
        (7, 16): "2024-01-30 23:59:59",
    }
    assert answer(latest_clicks(action, "20240130", days=1)) == {(7, 16): "2024-01-30 23:59:59"}
    assert answer(latest_clicks(action, "20240130", action_type=1)) == {
        (3, 12): "2024-01-26 09:00:00"}
    by_time = answer(latest_clicks(action, "20240130", date_col="action_ts"))
    assert (5, 14) not in by_time and (6, 15) in by_time and (7, 16) in by_time


def test_days():
    assert trailing_days("20240301", 3) == ["20240228", "20240229", "20240301"]
    assert trailing_days()[-1] == dt.date.today().strftime("%Y%m%d")
    for bad in ("2024-01-30", "20240132", "2024013", "202401301", "abc", "2024 130"):
        with pytest.raises(ValueError):
            parse_day(bad)
    with pytest.raises(ValueError):
        trailing_days("20240130", 0)


def test_prunes_partitions_and_combines_before_the_shuffle(spark, action):
    ensure_database(spark, "cw")
    ensure_action_table(spark, "cw.action")
    overwrite_partitions(action, "cw.action")
    df = latest_clicks(spark.table("cw.action"), "20240130", days=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "p_date" in filters and "20240129" in filters
    assert "partial_max" in plan and "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert df.count() == 1
    assert len(df.inputFiles()) <= 10


def test_event_times_that_are_missing_or_late(spark):
    rows = spark.createDataFrame(
        [(1, None, 2, 5, "20240129"), (2, None, 2, 5, "20240131"), (3, "2024-01-28 00:00:00", 2, 5, "20240205")],
        "user_id long, t string, action_type int, creation_id long, p_date string")
    rows = rows.selectExpr("user_id", "CAST(t AS TIMESTAMP) AS action_ts", "action_type", "creation_id", "p_date")
    found = latest_clicks(rows, "20240130", date_col="action_ts")
    assert sorted(r.user_id for r in found.collect()) == [1, 3]
    found = latest_clicks(rows, "20240130", date_col="action_ts", ingested=("20240124", "20240131"))
    assert [r.user_id for r in found.collect()] == [1]


def test_ingest_days_prune_an_event_time_window(spark, sf, tmp_path):
    fx.action(spark, sf).write.partitionBy("p_date").parquet(str(tmp_path / "a"))
    found = latest_clicks(spark.read.parquet(str(tmp_path / "a")), "20240130", date_col="action_ts", ingested=("20240124", "20240131"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_date" in plan and "p_date#" in plan
