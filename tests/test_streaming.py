import pytest

from covisit import fixtures as fx
from covisit.jobs import main
from covisit.plans.ingest import ingest_actions
from covisit.sources.messages import RAW, read_files, stream_files, topic_options
from covisit.streaming.ingest_stream import ingest_stream, read_accepted, read_quarantine


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture
def folder(spark, sf, tmp_path):
    raw = fx.raw_messages(spark, sf, damaged=True)
    raw.repartition(6).write.parquet(str(tmp_path / "in"))
    return tmp_path


def run(spark, folder, p_date="20240130", quarantine=True, checkpoint="cp"):
    query = ingest_stream(
        stream_files(spark, str(folder / "in"), files_per_batch=4), p_date, str(folder / "ok"),
        str(folder / checkpoint), str(folder / "bad") if quarantine else None)
    query.awaitTermination()
    assert query.exception() is None


def test_takes_each_message_once(spark, folder):
    run(spark, folder)
    batch = read_files(spark, str(folder / "in"))
    accepted, rejected = ingest_actions(batch, "20240130")
    assert accepted.count() > 1000 and rejected.count() > 1000
    assert same(read_accepted(spark, str(folder / "ok")), accepted)
    assert same(read_quarantine(spark, str(folder / "bad")), rejected)
    # nothing new: nothing added
    run(spark, folder)
    assert read_accepted(spark, str(folder / "ok")).count() == accepted.count()
    # one more message
    line = b'{"userId":1,"actionTypeList":"2","creationIdList":"5","timestampList":"1764460800"}'
    spark.createDataFrame([(bytearray(line),)], RAW).write.mode("append").parquet(str(folder / "in"))
    run(spark, folder, "20240131")
    stored = read_accepted(spark, str(folder / "ok"))
    assert stored.count() == accepted.count() + 1
    assert [r.creation_id for r in stored.where("p_date = '20240131'").collect()] == [5]
    plan = stored.where("p_date = '20240131'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_date" in plan


def test_replayed_batches_replace_themselves(spark, folder):
    run(spark, folder)
    before = read_accepted(spark, str(folder / "ok")).drop("p_date").collect()
    # a lost checkpoint replays the same batch numbers, here by a run with another day's label
    run(spark, folder, "20240131", checkpoint="cp2")
    stored = read_accepted(spark, str(folder / "ok"))
    after = stored.drop("p_date").collect()
    assert sorted(map(str, after)) == sorted(map(str, before))
    assert {r.p_date for r in stored.select("p_date").distinct().collect()} == {"20240130"}


def test_a_batch_that_failed_to_commit_is_published_once(spark, folder):
    def publish(day):
        return main(f"publish --accepted-path {folder}/ok --p-date {day} --table once".split(), spark)

    run(spark, folder)
    commits = sorted((folder / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    rows = publish("20240130")
    for path in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        path.unlink(missing_ok=True)
    run(spark, folder, "20240131")  # reads the last batch again
    (folder / "ok" / "p_date=20240131").mkdir(exist_ok=True)
    assert publish("20240131") == 0 and publish("20240130") == rows
    assert spark.table("dwd.once").count() == rows


def test_without_quarantine(spark, folder):
    run(spark, folder, quarantine=False)
    accepted, _ = ingest_actions(read_files(spark, str(folder / "in")), "20240130")
    assert read_accepted(spark, str(folder / "ok")).count() == accepted.count()


def test_text_files(spark, tmp_path):
    (tmp_path / "in.txt").write_text('{"userId":1}\nnot json\n')
    raw = read_files(spark, str(tmp_path / "in.txt"), "text")
    assert raw.dtypes == [("value", "binary")] and raw.count() == 2
    stream = stream_files(spark, str(tmp_path), "text")
    assert stream.isStreaming and stream.dtypes == [("value", "binary")]


def test_topic_options():
    assert topic_options("h:1", "action") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "action", "startingOffsets": "earliest",
        "endingOffsets": "latest", "failOnDataLoss": "false"}
    offsets = '{"action":{"0":5}}'
    more = topic_options("h:1", "action", offsets, None, True, 64)
    assert more["startingOffsets"] == offsets and "endingOffsets" not in more
    assert more["failOnDataLoss"] == "true" and more["minPartitions"] == "64"
    assert topic_options("h:1", "action", ending=None, max_per_batch=7)["maxOffsetsPerTrigger"] == "7"
    day = topic_options("h:1", "action", day="20240130")
    assert (day["startingTimestamp"], day["endingTimestamp"]) == ("1706572800000", "1706659200000")
    assert not {"startingOffsets", "endingOffsets"} & set(day)


@pytest.fixture
def one_shuffle_partition(spark):
    """State is kept for each shuffle partition; one is quicker."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def messages_of(*items):
    return [bytearray(f'{{"userId":1,"actionTypeList":"2","creationIdList":"{i}","timestampList":"1764460800"}}'.encode()) for i in items]


def test_messages_that_were_sent_twice_count_once(spark, tmp_path, one_shuffle_partition):
    def arrive(*items):
        spark.createDataFrame([(m,) for m in messages_of(*items)], RAW).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def ingest(within, checkpoint="cp", ok="ok", files=1):
        query = ingest_stream(
            stream_files(spark, str(tmp_path / "in"), files_per_batch=files), "20240130", str(tmp_path / ok), str(tmp_path / checkpoint),
            str(tmp_path / "bad"), repeats_within=within)
        query.awaitTermination()
        assert query.exception() is None
        return sorted(r.creation_id for r in read_accepted(spark, str(tmp_path / ok)).collect())

    arrive(1, 2, 2)  # within a file
    arrive(2, 3)  # across batches of a run
    assert ingest("1 hour") == [1, 2, 3]
    arrive(3, 1, 4)  # across runs: the state is in the checkpoint
    assert ingest("1 hour") == [1, 2, 3, 4]
    spark.createDataFrame([(None,), (None,), (bytearray(b"junk"),), (bytearray(b"junk"),)], RAW).write.mode("append").parquet(str(tmp_path / "in"))
    assert ingest("1 hour") == [1, 2, 3, 4]
    assert read_quarantine(spark, str(tmp_path / "bad")).count() <= 2
    # without the option all of them count
    assert ingest(None, "cp2", "ok2") == [1, 1, 2, 2, 2, 3, 3, 4]


def test_repeats_are_dropped_again_when_a_batch_is_replayed(spark, tmp_path, one_shuffle_partition):
    for items in ((1, 2), (2, 3)):
        spark.createDataFrame([(m,) for m in messages_of(*items)], RAW).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def ingest():
        query = ingest_stream(
            stream_files(spark, str(tmp_path / "in"), files_per_batch=1), "20240130", str(tmp_path / "ok"), str(tmp_path / "cp"), repeats_within="1 hour")
        query.awaitTermination()
        return sorted(r.creation_id for r in read_accepted(spark, str(tmp_path / "ok")).collect())

    assert ingest() == [1, 2, 3]
    last = max((p for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()  # the last batch wrote its rows and failed to commit
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert ingest() == [1, 2, 3]


def test_what_was_seen_is_forgotten_in_time(spark, tmp_path, one_shuffle_partition):
    import time

    def ingest(*items):
        spark.createDataFrame([(m,) for m in messages_of(*items)], RAW).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = ingest_stream(
            stream_files(spark, str(tmp_path / "in"), files_per_batch=1), "20240130", str(tmp_path / "ok"), str(tmp_path / "cp"), repeats_within="1 second")
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    ingest(1, 2, 3)
    for item in (4, 5, 6):
        time.sleep(2)
        kept = ingest(item)
    assert kept <= 2
