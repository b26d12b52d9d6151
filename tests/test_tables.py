import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit import fixtures as fx
from covisit.operators.cleaning import multiset_difference, split_rows
from covisit.operators.profile import counted, table_profile
from covisit.operators.ranking import latest_version
from covisit.schemas import ACTION, CLICK, EDGE, conform, olap_columns, olap_copy
from covisit.session import Staged, shared_dir
from covisit.sources import tables

from .test_graph import scanned


@pytest.fixture(scope="module")
def db(spark):
    tables.ensure_tables(spark, "tt")
    return "tt"


@pytest.fixture
def action(spark, sf):
    return conform(fx.action(spark, sf), ACTION)


def days(spark, table):
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def location(spark, table):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").replace("file:", "")


def equal(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_created_as_declared(spark, db):
    tables.ensure_tables(spark, db)  # a second time does nothing
    fact = spark.table("tt.action")
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in ACTION]
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE tt.action").collect()}
    assert described["creation_id"] == "item acted on"
    assert [(f.name, f.dataType) for f in spark.table("tt.click7aggre").schema] == [
        (f.name, f.dataType) for f in CLICK]
    assert spark.catalog.listColumns("tt.action")[-1].isPartition


def test_row_group_target_and_codec_reach_the_files(spark, db, sf):
    tables.ensure_table(spark, "tt.groups", CLICK, row_group_bytes=65_536)
    tables.append_rows(fx.basket(spark, sf).coalesce(1), "tt.groups")
    meta = pq.ParquetFile(glob.glob(location(spark, "tt.groups") + "/*.parquet")[0]).metadata
    assert meta.num_row_groups > 5
    assert meta.row_group(0).column(0).compression == "SNAPPY"


def test_append_matches_by_name_and_adds(spark, db, action):
    tables.ensure_action_table(spark, "tt.appended")
    day = action.where("p_date = '20240105'")
    shuffled_columns = day.select(*reversed(day.columns))
    tables.append_rows(shuffled_columns, "tt.appended")
    tables.append_rows(day, "tt.appended")
    assert equal(spark.table("tt.appended"), day.union(day))


def test_overwrite_day_can_run_again(spark, db, action):
    tables.ensure_action_table(spark, "tt.fact")
    tables.overwrite_partitions(action, "tt.fact")
    assert equal(spark.table("tt.fact"), action)
    for _ in range(2):
        day = action.where("p_date = '20240105'").limit(7)
        assert tables.overwrite_day(day, "tt.fact", "20240105") == 7
    assert spark.table("tt.fact").where("p_date = '20240105'").count() == 7
    others = action.where("p_date <> '20240105'")
    assert equal(spark.table("tt.fact").where("p_date <> '20240105'"), others)
    # no rows: the day is empty afterwards, and known
    assert tables.overwrite_day(action.where("false"), "tt.fact", "20240105") == 0
    assert spark.table("tt.fact").where("p_date = '20240105'").count() == 0
    assert "p_date=20240105" in days(spark, "tt.fact")
    tables.overwrite_partitions(action.where("p_date = '20240105'"), "tt.fact")
    assert equal(spark.table("tt.fact"), action)


def test_register_and_retention(spark, db):
    tables.ensure_action_table(spark, "tt.kept")
    for day in ("20240101", "20240102", "20240103", "20240103"):
        tables.register_partition(spark, "tt.kept", day)
    assert tables.drop_expired(spark, "tt.kept", "20240103") == ["20240101", "20240102"]
    assert days(spark, "tt.kept") == ["p_date=20240103"]
    assert tables.drop_expired(spark, "tt.kept", "20240103") == []
    with pytest.raises(ValueError):
        tables.register_partition(spark, "tt.kept", "x'); DROP")


def test_snapshot_may_read_itself_and_survives_failure(spark, db):
    rows = spark.range(10).select(
        F.col("id").alias("user_id"), F.col("id").alias("creation_id"),
        F.timestamp_seconds("id").alias("action_ts"))
    assert tables.replace_snapshot(rows, "tt.snap", CLICK) == 10
    assert tables.replace_snapshot(spark.table("tt.snap").where("user_id < 4"), "tt.snap", CLICK) == 4
    broken = rows.withColumn("user_id", F.raise_error(F.lit("boom")).cast("long"))
    with pytest.raises(Exception, match="boom"):
        tables.replace_snapshot(broken, "tt.snap", CLICK)
    assert spark.table("tt.snap").count() == 4
    assert not [t.name for t in spark.catalog.listTables("tt") if "__" in t.name]


def test_quarantine_day_is_replaced(spark, tmp_path):
    rows = spark.range(5).select("id", F.lit("20240101").alias("p_date"))
    for p_date, n in (("20240101", 5), ("20240102", 3), ("20240101", 2), ("20240102", 0)):
        assert tables.write_quarantine(rows.where(F.col("id") < n), str(tmp_path), p_date) == n
    stored = spark.read.schema("id long, p_date string").parquet(str(tmp_path))
    assert [r.p_date for r in stored.collect()] == ["20240101"] * 2


def test_clustered_layout(spark, db, action):
    tables.ensure_action_table(spark, "tt.layout")
    tables.write_clustered(action, "tt.layout")
    assert equal(spark.table("tt.layout"), action)
    files = sorted(glob.glob(location(spark, "tt.layout") + "/p_date=*/*.parquet"))
    assert len({f.split("p_date=")[1][:8] for f in files}) == 30
    seen = {}
    for file in files:
        frame = pq.ParquetFile(file).read(["user_id", "action_ts"]).to_pandas()
        keys = list(zip(frame.user_id, frame.action_ts))
        assert keys == sorted(keys)
        # files of one day do not overlap
        day = file.split("p_date=")[1][:8]
        for low, high in seen.setdefault(day, []):
            assert keys[-1] < low or keys[0] > high
        seen[day].append((keys[0], keys[-1]))


def test_one_users_rows_spread_over_tasks(spark):
    hot = spark.range(20_000).select(
        F.lit(1).cast("long").alias("user_id"), F.timestamp_seconds("id").alias("action_ts"),
        F.lit(2).alias("action_type"), F.col("id").alias("creation_id"),
        F.lit("20240101").alias("p_date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in tables.clustered(hot).groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1))).select("count(1)").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 5_000


def test_conform(spark):
    wide = spark.sql("SELECT '7' AS dstid, 1 AS srcid, 0.5D AS simscore, 'x' AS other")
    assert conform(wide, EDGE).collect() == [(1, 7, 0.5)]
    with pytest.raises(Exception, match="null in not-null column dstid"):
        conform(wide.withColumn("dstid", F.lit(None).cast("string")), EDGE).collect()


def test_olap_copy(spark):
    row = spark.sql(
        "SELECT 1L AS user_id, timestamp'2024-01-01 00:00:01.9' AS action_ts, 2 AS action_type, "
        "3L AS creation_id, '20240101' AS p_date")
    assert str(olap_copy(row, ACTION).first().action_ts) == "2024-01-01 00:00:01"
    assert olap_columns(ACTION) == {
        "user_id": "Int64", "action_ts": "DateTime", "action_type": "Int32",
        "creation_id": "Int64", "p_date": "String"}


def test_latest_version_keeps_one_whole_row(spark):
    rows = [(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (2, None, "d"), (2, 0, "e"), (3, None, "f")]
    df = spark.createDataFrame(rows, "k long, v long, x string")
    got = latest_version(df, ["k"], "v", ["x"])
    assert sorted(got.collect()) == [(1, 3, "c"), (2, 0, "e"), (3, None, "f")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan


def test_profile(spark):
    rows = [(1, "a", None), (1, None, None), (2, "b", None)]
    df = spark.createDataFrame(rows, "x long, y string, z double")
    want = [("x", 3, 0, 2), ("y", 3, 1, 2), ("z", 3, 3, 0)]
    assert table_profile(df).collect() == want
    assert table_profile(df, approximate=True).collect() == want
    assert table_profile(df.where("false")).collect() == [("x", 0, 0, 0), ("y", 0, 0, 0), ("z", 0, 0, 0)]


def test_counting_while_writing(spark, tmp_path):
    rows, seen = counted(spark.range(100), "hundred")
    rows.write.parquet(str(tmp_path / "out"))
    assert seen.get["rows"] == 100


def test_split_and_difference(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x long")
    yes, no = split_rows(df, F.col("x") == 1)
    assert yes.count() == 2 and no.count() == 2
    once = spark.createDataFrame([(1,)], "x long")
    assert sorted(multiset_difference(df, once).collect(), key=str) == [(1,), (2,), (None,)]


def test_staged_frames(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with Staged(spark.range(5).toDF("x"), "five") as frame:
        assert frame.count() == 5 and frame.schema == T.StructType([T.StructField("x", T.LongType())])
        path = frame.inputFiles()[0]
        assert path.startswith("file://") and shared_dir(spark) in path
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_local_disks_are_no_shared_folder():
    from covisit.session import fallback_dir

    assert fallback_dir("file:/w", "local[4]") == "file:/w/_covisit_shared"
    assert fallback_dir("s3a://b/w", "yarn") == "s3a://b/w/_covisit_shared"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError):
            fallback_dir(warehouse, "yarn")


def test_a_failed_staging_leaves_nothing(spark):
    from pyspark.sql import functions as F

    from covisit.session import Staged, shared_dir

    with pytest.raises(Exception):
        Staged(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), "failing")
    folder = spark._jvm.java.io.File(f"{shared_dir(spark)}/staged")
    assert not [name for name in folder.list() or [] if name.startswith("failing")]


def test_one_run_at_a_time_owns_a_day(spark, db, action):
    tables.ensure_action_table(spark, "tt.owned")
    day = action.where("p_date = '20240105'")
    with tables.claimed_day(spark, "tt.owned", "20240105"):
        with pytest.raises(tables.DayTaken):
            tables.overwrite_day(day, "tt.owned", "20240105")
        tables.overwrite_day(day.limit(0), "tt.owned", "20240106")  # another day
    assert spark.table("tt.owned").count() == 0
    assert tables.overwrite_day(day, "tt.owned", "20240105") == day.count()
    bad = day.withColumn("user_id", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        tables.overwrite_day(bad, "tt.owned", "20240105")
    assert tables.overwrite_day(day, "tt.owned", "20240105") == day.count()  # a failed run gives the day back
    # a run that was given up, and comes back
    with pytest.raises(tables.DayTaken, match="taken over"):
        with tables.claimed_day(spark, "tt.owned", "20240105"):
            tables.release_day(spark, "tt.owned", "20240105")
            with tables.claimed_day(spark, "tt.owned", "20240105"):
                pass
            tables.create_text(spark, tables._claim_path(spark, "tt.owned", "20240105"), "someone")
    tables.release_day(spark, "tt.owned", "20240105")
    assert equal(spark.table("tt.owned"), day)


def test_two_runs_at_once_leave_a_whole_day(spark, db, action):
    from concurrent.futures import ThreadPoolExecutor

    tables.ensure_action_table(spark, "tt.raced")
    parts = [action.where("p_date = '20240105'"), action.where("p_date = '20240106'").withColumn("p_date", F.lit("20240105"))]

    def run(part):
        try:
            return tables.overwrite_day(part, "tt.raced", "20240105")
        except tables.DayTaken:
            return None

    for _ in range(2):
        with ThreadPoolExecutor(2) as pool:
            done = list(pool.map(run, parts))
        won = [part for part, rows in zip(parts, done) if rows is not None]
        assert won and any(equal(spark.table("tt.raced"), part) for part in won)


def test_layout_in_two_dimensions(spark, tmp_path):
    rows = spark.range(120_000).selectExpr(
        "pmod(xxhash64(id), 3000) as user_id", "timestamp_seconds(id) as action_ts", "2 as action_type",
        "pmod(xxhash64(id, 1), 2000) as creation_id", "if(id % 2 = 0, '20240101', '20240102') as p_date")
    rows = rows.unionByName(rows.limit(5).withColumns({"user_id": F.lit(None).cast("long"), "creation_id": F.lit(None).cast("long")}))
    path = str(tmp_path / "plane")
    tables.write_plane(rows, path, row_group_bytes=32 * 1024)
    stored = spark.read.schema(rows.schema).parquet(path)
    assert equal(stored, rows)
    read = {}
    for column in ("user_id", "creation_id"):
        one = stored.where(F.col(column) == 77)
        assert equal(one, rows.where(F.col(column) == 77))
        read[column] = scanned(one)
    assert max(read.values()) < 20_000  # either skips most of 120,000 rows
    by_user = str(tmp_path / "by_user")
    tables.clustered(rows).write.option("parquet.block.size", 32 * 1024).partitionBy("p_date").parquet(by_user)
    assert scanned(spark.read.schema(rows.schema).parquet(by_user).where("creation_id = 77")) > 2 * read["creation_id"]


def test_plane_order(spark):
    rows = spark.createDataFrame([(u, i) for u in range(8) for i in range(8)], "user_id int, creation_id int")
    found = {(r[0], r[1]): r[2] for r in rows.select("user_id", "creation_id", tables.plane_order(rows, bits=3)).collect()}

    def spread(x):
        return sum((x >> b & 1) << 2 * b for b in range(3))

    # cuts are values themselves, so ranks may differ by one from the values, but keep their order
    assert len(set(found.values())) >= 49
    assert all(found[u, i] <= found[u + 1, i + 1] for u in range(7) for i in range(7))
    assert found[0, 0] == min(found.values()) and found[7, 7] == max(found.values()) <= spread(7) * 3
