"""Catalog tables: creation, writes that can be run again, retention, layout."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit.functions.days import parse_day
from covisit.operators.profile import counted
from covisit.schemas import ACTION, CLICK, conform

ROW_GROUP_BYTES = 268_435_456  # fixed value: row-group target of the fact table
PARTITION = "p_date"

# what the fact table is clustered by within a day; the item only splits ties
CLUSTER = ("p_date", "user_id", "action_ts", "creation_id")
# columns of the layout in two dimensions, and into how many ranks each is cut (as bits)
PLANE, RANK_BITS = ("user_id", "creation_id"), 6
PAGE_ROWS = 8192  # fixed value: rows of the documented sparse index, here of a page


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(db)}")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partitioned: bool = False,
    comment: str = "",
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Create a Snappy Parquet table with the columns and comments of ``schema``."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT '{f.metadata['comment']}'" if "comment" in f.metadata else "")
        for f in schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING parquet "
        f"OPTIONS ('compression'='snappy', 'parquet.block.size'='{row_group_bytes}') "
        + (f"PARTITIONED BY (`{PARTITION}`) " if partitioned else "")
        + f"COMMENT '{comment}'"
    )
    _note_schema(spark, table, schema, partitioned)


# --- a catalog that is a folder: where no metastore keeps tables from one process to the next -------

_SCHEMA, _CURRENT, _VERSION = "_schema.json", "_current", "version-"


def file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path as it takes it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return jvm_path.getFileSystem(conf), jvm_path


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, target = file_system(spark, path)
    out = files.create(target, True)
    out.write(text.encode())
    out.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet: of two that try, one is refused."""
    files, target = file_system(spark, path)
    out = files.create(target, False)
    out.write(text.encode())
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    files, source = file_system(spark, path)
    if not files.exists(source):
        return None
    stream = files.open(source)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


def _root(spark: SparkSession, table: str) -> str:
    """The table's own folder, also while it shows a version below it."""
    here = location(spark, table)
    return here.rpartition("/")[0] if here.rpartition("/")[2].startswith(_VERSION) else here


def _note_schema(spark: SparkSession, table: str, schema: T.StructType, partitioned: bool) -> None:
    path = f"{_root(spark, table)}/{_SCHEMA}"
    if read_text(spark, path) is None:
        write_text(spark, path, json.dumps({"partitioned": partitioned, "schema": schema.jsonValue()}))


def attach(spark: SparkSession, folder: str) -> list[str]:
    """Make the tables below ``folder``, which earlier processes left there, known to this session.

    The session's warehouse must be ``folder``. With a metastore there is nothing to attach.
    """
    known = []
    files, root = file_system(spark, folder)
    if not files.exists(root):
        return known
    for db in files.listStatus(root):
        name = db.getPath().getName()
        if not db.isDirectory() or not name.endswith(".db"):
            continue
        ensure_database(spark, name.removesuffix(".db"))
        for entry in files.listStatus(db.getPath()):
            here, table = entry.getPath().toString(), f"{name.removesuffix('.db')}.{entry.getPath().getName()}"
            noted = read_text(spark, f"{here}/{_SCHEMA}") if entry.isDirectory() else None
            if noted is None or spark.catalog.tableExists(table):
                continue
            about = json.loads(noted)
            columns = T.StructType.fromJson(about["schema"])
            current = read_text(spark, f"{here}/{_CURRENT}")
            spark.sql(
                f"CREATE TABLE {_quoted(table)} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in columns)}) USING parquet "
                + (f"PARTITIONED BY (`{PARTITION}`) " if about["partitioned"] else "")
                + f"LOCATION '{here}{f'/{current}' if current else ''}'"
            )
            if about["partitioned"]:
                spark.sql(f"ALTER TABLE {_quoted(table)} RECOVER PARTITIONS")
            known.append(table)
    return known


def ensure_action_table(spark: SparkSession, table: str, **options) -> None:
    ensure_table(spark, table, ACTION, partitioned=True, comment="user actions", **options)


def ensure_click_table(spark: SparkSession, table: str) -> None:
    ensure_table(spark, table, CLICK, comment="latest click per user and item")


def ensure_tables(
    spark: SparkSession, db: str, action: str = "action", click: str = "click7aggre"
) -> None:
    """The database, the partitioned fact table and the click snapshot."""
    ensure_database(spark, db)
    ensure_action_table(spark, f"{db}.{action}")
    ensure_click_table(spark, f"{db}.{click}")


def append_rows(df: DataFrame, table: str) -> None:
    """Add rows to a table, matching its columns by name. Running it twice adds them twice."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.insertInto(table)


def register_partition(spark: SparkSession, table: str, p_date: str) -> None:
    """Make a day known to the catalog, even if it holds no rows."""
    parse_day(p_date)
    spark.sql(
        f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS PARTITION ({PARTITION}='{p_date}')"
    )


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the days that occur in ``df``; other days stay."""
    target = df.sparkSession.table(table)
    (
        df.select(*target.columns)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .insertInto(table)
    )


class DayTaken(RuntimeError):
    """Another run owns the day, or has taken it over."""


def _claim_path(spark: SparkSession, table: str, p_date: str) -> str:
    return f"{_root(spark, table)}/_claims/{p_date}"


@contextmanager
def claimed_day(spark: SparkSession, table: str, p_date: str) -> Iterator[None]:
    """Own a day of a table while the block runs, as a file that is created only if it is absent.

    A run that finds the day taken is refused with ``DayTaken`` before it writes. A run that loses its claim (see
    ``release_day``) fails at the end of the block, so it does not report a day that another may have written since.
    """
    path, owner = _claim_path(spark, table, parse_day(p_date).strftime("%Y%m%d")), uuid.uuid4().hex
    try:
        create_text(spark, path, owner)
    except Py4JJavaError as refused:
        if "FileAlreadyExists" not in str(refused.java_exception.getClass().getName()):
            raise
        raise DayTaken(f"{p_date} of {table} is being written by another run; if that one is dead, release it") from None
    try:
        yield
        if read_text(spark, path) != owner:
            raise DayTaken(f"{p_date} of {table} was taken over while it was written; run again")
    finally:
        if read_text(spark, path) == owner:
            release_day(spark, table, p_date)


def release_day(spark: SparkSession, table: str, p_date: str) -> None:
    """Take away whatever claim there is on a day: for a run that died without giving it back."""
    files, path = file_system(spark, _claim_path(spark, table, p_date))
    files.delete(path, False)


def overwrite_day(df: DataFrame, table: str, p_date: str) -> int:
    """Replace one day of the fact table by ``df`` and give the number of rows written.

    The day is named in the statement, so a run that yields no rows empties it too. Running it
    again leaves the same table. One run at a time owns the day: another is refused (``DayTaken``).
    """
    with claimed_day(df.sparkSession, table, p_date):
        return _overwrite_owned_day(df, table, p_date)


def _overwrite_owned_day(df: DataFrame, table: str, p_date: str) -> int:
    spark = df.sparkSession
    rows, seen = counted(df, f"rows_{uuid.uuid4().hex}")
    columns = [c for c in spark.table(table).columns if c != PARTITION]
    view = f"day_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {_quoted(table)} PARTITION ({PARTITION}='{p_date}') "
            f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)
    register_partition(spark, table, p_date)
    return seen.get["rows"]


def replace_snapshot(df: DataFrame, table: str, schema: T.StructType) -> int:
    """Replace a whole table by ``df`` and give the number of rows written.

    The rows go to a new folder, then the table's location is switched to it. So ``df`` may read the
    table it replaces, a failed run leaves the table as it was, and there is no moment without one.
    The version before stays for readers that have begun; older ones go.
    """
    spark = df.sparkSession
    ensure_table(spark, table, schema)
    root, version = _root(spark, table), f"{_VERSION}{uuid.uuid4().hex}"
    before = location(spark, table).removeprefix(root).strip("/")
    rows, seen = counted(conform(df, schema), version)
    try:
        rows.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{root}/{version}")
    except BaseException:
        files, path = file_system(spark, f"{root}/{version}")
        files.delete(path, True)
        raise
    spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION '{root}/{version}'")
    write_text(spark, f"{root}/{_CURRENT}", version)
    spark.catalog.refreshTable(table)
    files, path = file_system(spark, root)
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith(_VERSION) and name not in (version, before):
            files.delete(entry.getPath(), True)
    return seen.get["rows"]


def write_quarantine(rejected: DataFrame, path: str, p_date: str) -> int:
    """Replace the day's directory of rejected rows; an empty result empties it."""
    parse_day(p_date)
    rows, seen = counted(rejected.drop(PARTITION), f"rejected_{uuid.uuid4().hex}")
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{PARTITION}={p_date}")
    return seen.get["rows"]


def drop_expired(spark: SparkSession, table: str, first_kept: str) -> list[str]:
    """Drop all days before ``first_kept`` and give their labels. Reads the catalog only."""
    parse_day(first_kept)
    days = [
        row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()
    ]
    expired = sorted(day for day in days if day < first_kept)
    if expired:
        specs = ", ".join(f"PARTITION ({PARTITION}='{day}')" for day in expired)
        spark.sql(f"ALTER TABLE {_quoted(table)} DROP IF EXISTS {specs}")
    return expired


def clustered(action: DataFrame) -> DataFrame:
    """Rows ranged and sorted by day, user and time, so that files and row groups of a day hold
    few users each and scans for one user skip the rest.

    The range covers the full sort key: one user's many rows split over tasks by time.
    """
    return action.repartitionByRange(*CLUSTER).sortWithinPartitions(*CLUSTER)


def write_clustered(action: DataFrame, table: str) -> None:
    """Replace the days in ``action`` by the same rows in clustered order."""
    overwrite_partitions(clustered(action), table)


def _rank(value: Column, cuts: Sequence[int], low: int = 0) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``, in as many comparisons as the number has bits."""
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    return F.when(value < F.lit(cuts[middle]), _rank(value, cuts[:middle], low)).otherwise(_rank(value, cuts[middle + 1 :], low + middle + 1))


def plane_order(action: DataFrame, columns: Sequence[str] = PLANE, bits: int = RANK_BITS) -> Column:
    """A number whose bits alternate between the ranks of the columns (Z-order): near numbers are near in each.

    Ranks come from approximate quantiles, ``2 ** bits - 1`` cuts a column, which is all that the driver sees. Nulls are 0.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = action.select(*(F.percentile_approx(c, shares).alias(c) for c in columns)).first()
    order = F.lit(0)
    for k, name in enumerate(columns):
        rank = F.coalesce(F.when(F.col(name).isNotNull(), _rank(F.col(name), sorted(set(found[name] or [])))), F.lit(0))
        for bit in range(bits):
            order = order.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1), bit * len(columns) + k))
    return order


def clustered_plane(action: DataFrame) -> DataFrame:
    """Rows ranged and sorted by day and Z-order: files, row groups and pages of a day hold few users and few items, so
    scans for either skip most of it. ``clustered`` serves users alone, and better.

    The range covers the full key, so a hot user's or item's rows split over tasks.
    """
    keys = [F.col("p_date"), F.col("_plane"), *(F.col(c) for c in PLANE), F.col("action_ts")]
    rows = action.withColumn("_plane", plane_order(action))
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_plane")


def write_plane(action: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """The rows of ``clustered_plane`` as Parquet below ``path``, a folder for each day, with pages of ``PAGE_ROWS`` rows."""
    (
        clustered_plane(action).write.option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.block.size", row_group_bytes)
        .partitionBy(PARTITION).mode("overwrite").parquet(path)
    )
