"""Bounded reads of a stored message log by offsets, with ranges that are resolved once and gaps that are found.

A log is a table of ``topic, partition, offset, value`` (a topic as an archiver keeps it, say). A read names where
each partition starts and ends as the Kafka source does: ``earliest``, ``latest``, or JSON of offsets in which -2
and -1 mean the same. ``latest`` is looked up once and then pinned, so that all passes over the log, and a run that is
repeated, read the same messages while the log grows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: offsets in JSON that stand for the ends of a partition
EARLIEST, LATEST = -2, -1
#: Offsets that one bitmap of Spark's holds.
BLOCK = 32_768
#: Gaps that an error message lists.
SHOWN = 20


class DataLoss(RuntimeError):
    """Messages of the ranges are not in the log."""


@dataclass(frozen=True)
class OffsetRange:
    """Offsets from ``start`` to before ``end`` of a partition."""

    partition: int
    start: int
    end: int


def _asked(text: str, topic: str, name: str, allowed: str) -> dict[int, int] | str:
    if text in ("earliest", "latest"):
        if text != allowed:
            raise ValueError(f"a bounded read cannot have {name} at {text}")
        return text
    by_topic = json.loads(text)
    if set(by_topic) != {topic}:
        raise ValueError(f"{name} must name the topic {topic} alone, not {sorted(by_topic)}")
    return {int(p): int(o) for p, o in by_topic[topic].items()}


def resolve(log: DataFrame, topic: str, starting: str = "earliest", ending: str = "latest") -> list[OffsetRange]:
    """The ranges that a read takes, of all partitions of the topic in the log. One pass over two columns."""
    bounds = log.where(F.col("topic") == topic).groupBy("partition").agg(
        F.min("offset").alias("first"), (F.max("offset") + 1).alias("after")).collect()  # a row for each partition
    starts, ends = _asked(starting, topic, "starting", "earliest"), _asked(ending, topic, "ending", "latest")
    known = {r["partition"]: (r["first"], r["after"]) for r in bounds}
    for asked, name in ((starts, "starting"), (ends, "ending")):
        if not isinstance(asked, str) and set(asked) != set(known):
            raise ValueError(f"{name} must name the partitions {sorted(known)}, not {sorted(asked)}")
    out = []
    for p, (first, after) in sorted(known.items()):
        start = EARLIEST if isinstance(starts, str) else starts[p]
        end = LATEST if isinstance(ends, str) else ends[p]
        pinned = [{EARLIEST: first, LATEST: after}.get(o, o) for o in (start, end)]
        out.append(OffsetRange(p, pinned[0], max(pinned)))
    return out


def as_json(ranges: Sequence[OffsetRange], topic: str) -> str:
    """Where the next read starts: the ends of these."""
    return json.dumps({topic: {str(r.partition): r.end for r in ranges}})


def messages_in(log: DataFrame, topic: str, ranges: Sequence[OffsetRange]) -> DataFrame:
    """The rows of the ranges. They are literals on ``partition`` and ``offset``, which reach the scan."""
    chosen = F.lit(False)
    for r in ranges:
        chosen = chosen | ((F.col("partition") == r.partition) & (F.col("offset") >= r.start) & (F.col("offset") < r.end))
    return log.where((F.col("topic") == topic) & chosen)


def losses(log: DataFrame, topic: str, ranges: Sequence[OffsetRange]) -> DataFrame:
    """``partition, first, after, missing``: the blocks of offsets in which messages of the ranges are missing, and how many.

    Offsets are marked in bitmaps within tasks, and bitmaps are joined: no row is shuffled, however large a
    partition is, and an offset that is stored twice counts once.
    """
    spark = log.sparkSession
    asked = spark.createDataFrame([(r.partition, r.start, r.end) for r in ranges], "partition int, start long, end long")
    block = F.explode(F.sequence(F.call_function("div", F.col("start"), F.lit(BLOCK)), F.call_function("div", F.col("end") - 1, F.lit(BLOCK))))
    blocks = asked.where("start < end").select("*", block.alias("block"))
    blocks = blocks.select(
        "partition", "block", F.greatest("start", F.col("block") * BLOCK).alias("first"), F.least("end", (F.col("block") + 1) * BLOCK).alias("after"))
    number = F.col("offset") + 1  # bitmaps count from 1
    marked = messages_in(log, topic, ranges).groupBy(
        F.col("partition").cast("int").alias("partition"), (F.bitmap_bucket_number(number) - 1).alias("block")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("marks"))
    found = marked.select("partition", "block", F.bitmap_count("marks").alias("n"))
    missing = F.col("after") - F.col("first") - F.coalesce("n", F.lit(0))
    return blocks.join(found, ["partition", "block"], "left").select("partition", "first", "after", missing.alias("missing")).where("missing > 0")


def read_log(
    log: DataFrame, topic: str, starting: str = "earliest", ending: str = "latest", fail_on_data_loss: bool = True
) -> tuple[DataFrame, list[OffsetRange]]:
    """``value`` of the messages in the ranges, and the ranges as they were pinned.

    A range may reach where the log has no message, because it was dropped or never came. That raises ``DataLoss``,
    or is passed over without ``fail_on_data_loss``.
    """
    ranges = resolve(log, topic, starting, ending)
    if fail_on_data_loss:
        gaps = losses(log, topic, ranges).orderBy("partition", "first").limit(SHOWN).collect()
        if gaps:
            listed = ", ".join(f"{r['missing']} of partition {r['partition']} in [{r['first']}, {r['after']})" for r in gaps)
            raise DataLoss(f"messages of {topic} are missing: {listed}{' and more' if len(gaps) == SHOWN else ''}")
    return messages_in(log, topic, ranges).select("value"), ranges
