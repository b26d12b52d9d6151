"""Where raw messages come from: a broker topic, or files and tables that stand in for one.

Every reader gives a frame with a binary ``value`` column.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit.functions.days import parse_day

RAW = T.StructType([T.StructField("value", T.BinaryType())])


def topic_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str | None = "latest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_per_batch: int | None = None,
    day: str | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. ``starting`` and ``ending`` are ``earliest``, ``latest`` or
    JSON offsets per partition; ``day`` takes the messages of that day (UTC) instead, by their
    timestamps, so that daily runs do not take them twice. ``min_partitions`` splits topic partitions
    into more tasks: a topic's own partition count otherwise bounds how wide the scan runs.
    ``max_per_batch`` bounds a stream's batches."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if day is not None:
        first = datetime.combine(parse_day(day), datetime.min.time(), tzinfo=timezone.utc)
        options["startingTimestamp"] = str(int(first.timestamp() * 1000))
        options["endingTimestamp"] = str(int((first + timedelta(days=1)).timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = starting
        if ending is not None:
            options["endingOffsets"] = ending
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, **options) -> DataFrame:
    """A bounded read of a topic (arguments of ``topic_options``). Needs Spark's Kafka package."""
    return spark.read.format("kafka").options(**topic_options(**options)).load().select("value")


def stream_topic(spark: SparkSession, **options) -> DataFrame:
    """The same topic as a stream; where it ends is the trigger's business."""
    settings = topic_options(**{**options, "ending": None})
    return spark.readStream.format("kafka").options(**settings).load().select("value")


def read_files(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Messages kept in files: Parquet with a ``value`` column, or text with one per line."""
    reader = spark.read.format(format)
    files = reader.load(path) if format == "text" else reader.schema(RAW).load(path)
    return files.select(F.col("value").cast("binary"))


def stream_files(
    spark: SparkSession, path: str, format: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """A folder of message files as a stream, a bounded number of files per batch."""
    reader = spark.readStream.format(format).option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(path) if format == "text" else reader.schema(RAW).load(path)
    return files.select(F.col("value").cast("binary"))


def decode(raw: DataFrame) -> DataFrame:
    """``value`` as text, in ``json_str``."""
    return raw.select(F.col("value").cast("string").alias("json_str"))
