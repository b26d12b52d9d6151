"""Reads of a stored log by offsets: pinned ends, JSON, gaps."""

import json

import pytest
from pyspark.sql import functions as F

from covisit.sources.offsets import BLOCK, DataLoss, OffsetRange, as_json, losses, messages_in, read_log, resolve

LOG = "topic string, partition int, offset long, value binary"


def log_of(spark, rows):
    return spark.createDataFrame([("t", p, o, bytearray(f"{p}:{o}".encode())) for p, o in rows] + [("other", 0, 9999, bytearray(b"x"))], LOG)


def values(df):
    return sorted(bytes(r["value"]).decode() for r in df.collect())


def test_ranges_are_pinned_while_the_log_grows(spark, tmp_path):
    path = str(tmp_path / "log")
    log_of(spark, [(0, o) for o in range(5, 12)] + [(3, o) for o in range(4)]).write.parquet(path)
    read = lambda: spark.read.schema(LOG).parquet(path)
    rows, ranges = read_log(read(), "t")
    assert ranges == [OffsetRange(0, 5, 12), OffsetRange(3, 0, 4)]
    log_of(spark, [(0, 12), (3, 4), (3, 5)]).write.mode("append").parquet(path)
    assert values(messages_in(read(), "t", ranges).select("value")) == values(rows) == sorted([f"0:{o}" for o in range(5, 12)] + [f"3:{o}" for o in range(4)])
    assert resolve(read(), "t", as_json(ranges, "t")) == [OffsetRange(0, 12, 13), OffsetRange(3, 4, 6)]
    assert values(read_log(read(), "t", as_json(ranges, "t"))[0]) == ["0:12", "3:4", "3:5"]
    after = resolve(read(), "t")
    assert values(read_log(read(), "t", as_json(after, "t"))[0]) == []
    plan = messages_in(read(), "t", ranges)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,5)" in plan and "EqualTo(partition,0)" in plan


def test_json_offsets(spark):
    log = log_of(spark, [(p, o) for p in range(2) for o in range(10)])
    ask = lambda **x: json.dumps({"t": {str(k[1:]): v for k, v in x.items()}})
    assert resolve(log, "t", ask(p0=3, p1=-2), ask(p0=-1, p1=7)) == [OffsetRange(0, 3, 10), OffsetRange(1, 0, 7)]
    assert values(read_log(log, "t", ask(p0=8, p1=9), ask(p0=9, p1=-1))[0]) == ["0:8", "1:9"]
    assert values(read_log(log, "t", ask(p0=5, p1=5), ask(p0=5, p1=2))[0]) == []
    for bad in ({"starting": "latest"}, {"ending": "earliest"}, {"starting": ask(p0=1)}, {"ending": ask(p0=1, p1=1, p2=1)}, {"starting": '{"u": {"0": 1}}'}):
        with pytest.raises(ValueError):
            resolve(log, "t", **bad)


def test_gaps_are_found(spark):
    whole = [(0, o) for o in range(2 * BLOCK + 10)] + [(1, o) for o in range(100, 140)]
    gone = {(0, 0), (0, BLOCK - 1), (0, BLOCK), (0, 2 * BLOCK + 3), (1, 120), (1, 121)}
    log = log_of(spark, [x for x in whole if x not in gone] + [(1, 122)] * 5)  # an offset that is stored again hides no gap
    ask = json.dumps({"t": {"0": 0, "1": 90}})
    ranges = resolve(log, "t", ask)
    assert sorted(map(tuple, losses(log, "t", ranges).collect())) == [
        (0, 0, BLOCK, 2), (0, BLOCK, 2 * BLOCK, 1), (0, 2 * BLOCK, 2 * BLOCK + 10, 1), (1, 90, 140, 12)]
    with pytest.raises(DataLoss, match="12 of partition 1"):
        read_log(log, "t", ask)
    assert read_log(log, "t", ask, fail_on_data_loss=False)[0].count() == len(whole) - len(gone) + 5
    with pytest.raises(DataLoss, match="partition 0"):  # an end that the log has not reached
        read_log(log_of(spark, [(0, 0)]), "t", ending='{"t": {"0": 5}}')
    whole_log = log_of(spark, whole)
    assert losses(whole_log, "t", resolve(whole_log, "t")).count() == 0


def test_an_empty_log(spark):
    log = log_of(spark, [])
    rows, ranges = read_log(log, "t")
    assert ranges == [] and rows.count() == 0
    assert log.where(F.col("topic") == "other").count() == 1
