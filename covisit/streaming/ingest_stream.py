"""Ingest as a stream: each message is taken once, however often the job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.storagelevel import StorageLevel

from covisit.functions.days import parse_day
from covisit.plans.ingest import parse_actions, split_parsed
from covisit.schemas import ACTION, QUARANTINE

BATCH_DIR = "batch_id"


def without_repeats(raw: DataFrame, within: str) -> DataFrame:
    """The first of messages with the same bytes, if the others are read at most ``within`` (an interval) later.

    A checkpoint stops messages from being read twice, not a producer from sending them twice. Those have the
    same content, the times of their actions included. What has been read is keyed state: a digest, and the time of
    its batch, by which it is forgotten, after twice ``within`` at most. That time is written with the batch's offsets,
    so a batch that is replayed decides as it did, and no message is ever late. State is kept with the checkpoint, so
    it outlives the run, and in RocksDB (see ``session.DEFAULTS``), so it needs no memory in proportion. Null messages
    are alike.
    """
    named = raw.select("value", F.sha2("value", 256).alias("digest"), F.current_timestamp().alias("read"))
    return named.withWatermark("read", within).dropDuplicatesWithinWatermark(["digest"]).select("value")


def ingest_stream(
    raw: DataFrame,
    p_date: str,
    accepted_path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    align: str = "compact",
    precision: str = "s",
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Parse everything new in ``raw`` (a streaming frame with ``value``), then stop.

    With ``repeats_within``, messages that were sent twice count once, see ``without_repeats``.

    The checkpoint remembers what was read; a second run adds only what came since. Each
    micro-batch owns one directory per sink, below the day it was first read under, and replaces it
    as a whole: a batch that is replayed after a failure, even by a run with another day's label,
    keeps its day and leaves no duplicates, published or not.
    """
    parse_day(p_date)
    if repeats_within is not None:
        raw = without_repeats(raw, repeats_within)

    def write(batch: DataFrame, batch_id: int) -> None:
        label = _label_of(batch.sparkSession, accepted_path, batch_id, p_date)
        parsed = parse_actions(batch, label, align, precision)
        if quarantine_path is None:
            _replace(split_parsed(parsed)[0], accepted_path, label, batch_id)
            return
        # bounded by the source's limit per batch (files or offsets); a lost block is read again
        # from the same offsets
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted, rejected = split_parsed(parsed)
            _replace(accepted, accepted_path, label, batch_id)
            _replace(rejected, quarantine_path, label, batch_id)
        finally:
            parsed.unpersist()

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _label_of(spark: SparkSession, accepted_path: str, batch_id: int, p_date: str) -> str:
    """The day a batch was first read under, kept beside the rows (readers pass over the folder)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{accepted_path.rstrip('/')}/_labels/{batch_id}")
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        draft = path.suffix(".draft")
        out = files.create(draft, True)
        out.writeBytes(p_date)
        out.close()
        files.rename(draft, path)
    source = files.open(path)
    label = bytes(source.readAllBytes()).decode()
    source.close()
    return label


def _folder(path: str, p_date: str) -> str:
    return f"{path.rstrip('/')}/p_date={p_date}"


def _replace(rows: DataFrame, path: str, p_date: str, batch_id: int) -> None:
    rows.drop("p_date").write.mode("overwrite").parquet(f"{_folder(path, p_date)}/{BATCH_DIR}={batch_id}")


def _read(spark: SparkSession, path: str, schema: T.StructType, p_date: str | None) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField(BATCH_DIR, T.LongType())])
    reader = spark.read.schema(stored).option("basePath", path)
    return reader.parquet(path if p_date is None else _folder(path, p_date)).select(*schema.fieldNames())


def read_accepted(spark: SparkSession, path: str, p_date: str | None = None) -> DataFrame:
    """Accepted rows, with the columns of the action table. With ``p_date`` no other day's folders
    are listed."""
    return _read(spark, path, ACTION, p_date)


def read_quarantine(spark: SparkSession, path: str, p_date: str | None = None) -> DataFrame:
    return _read(spark, path, QUARANTINE, p_date)
