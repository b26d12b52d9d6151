"""Packed JSON action messages to rows: accepted ones, and rejected ones with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit.functions.days import parse_day
from covisit.functions.parsing import instant, spaced_number, split_list, whole_number
from covisit.operators.cleaning import split_rows
from covisit.schemas import ACTION, MESSAGE, QUARANTINE, conform
from covisit.sources.messages import decode

_CORRUPT = "_corrupt_record"
REASONS = ("null_payload", "corrupt_json", "missing_user", "bad_time", "bad_type")


def parse_actions(
    raw: DataFrame, p_date: str, align: str = "compact", precision: str = "s"
) -> DataFrame:
    """One row per list element of each message, with the columns of the quarantine table.

    ``reason`` is null for a valid row: one with a user, a time and a type. Otherwise it names
    the first rule broken: ``null_payload``, ``corrupt_json``, ``missing_user``, ``bad_time``,
    ``bad_type``. A message whose lists are all empty makes one row of nulls. ``p_date`` labels
    every row and filters nothing.

    ``raw`` is the text a rejected row came from, fit to be mended and ingested again. It is the
    element by itself in the form of a message, so that a long list with many bad elements is
    not kept once per element; the whole message where it could not be read as one.

    ``align``: the three lists are matched by position after blank elements are dropped
    ("compact"), or with blanks holding their positions ("strict").
    """
    parse_day(p_date)
    if align not in ("compact", "strict"):
        raise ValueError(f"align must be 'compact' or 'strict', not {align!r}")

    schema = T.StructType([*MESSAGE.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    messages = decode(raw).select(
        F.col("json_str"), F.from_json("json_str", schema, options).alias("data")
    )

    def elements(name: str) -> Column:
        return split_list(F.col(f"data.{name}"), keep_blanks=align == "strict")

    lists = messages.select(
        "json_str",
        F.col("data").isNull().alias("unread"),
        F.col(f"data.{_CORRUPT}").isNotNull().alias("corrupt"),
        F.col("data.userId").alias("user_id"),
        F.arrays_zip(
            elements("timestampList").alias("time"),
            elements("actionTypeList").alias("type"),
            elements("creationIdList").alias("item"),
        ).alias("elements"),
    )
    unreadable = F.col("unread") | F.col("corrupt") | (F.size("elements") == 0)
    exploded = lists.select(
        F.when(unreadable, F.col("json_str")).alias("message"),
        "unread", "corrupt", "user_id",
        F.posexplode_outer("elements").alias("pos", "element"),
    )
    numbers = exploded.select("*", whole_number(F.col("element.time")).alias("time_number"))
    typed = numbers.select(
        "user_id",
        instant(F.col("element.time"), precision, F.col("time_number")).alias("action_ts"),
        whole_number(F.col("element.type"), "int").alias("action_type"),
        spaced_number(F.col("element.item")).alias("creation_id"),
        F.lit(p_date).alias("p_date"),
        "message", "unread", "corrupt", "pos", "element",
    )
    judged = typed.withColumn("reason", _reason())
    rows = conform(judged.withColumn("raw", _source_text()), QUARANTINE)
    # One struct out of a generator: a filter on these columns cannot be pushed below it, where
    # it would parse every element a second time.
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def _source_text() -> Column:
    element = F.to_json(F.struct(
        F.col("user_id").alias("userId"),
        F.col("element.type").alias("actionTypeList"),
        F.col("element.item").alias("creationIdList"),
        F.col("element.time").alias("timestampList"),
    ))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    whole = F.col("message").isNotNull() & first
    text = F.when(F.col("pos").isNull() | whole, F.col("message")).otherwise(element)
    return F.when(F.col("reason").isNotNull(), text)


def _reason() -> Column:
    user, time, kind = (F.col(c).isNull() for c in ("user_id", "action_ts", "action_type"))
    broken = (
        F.when(F.col("unread"), "null_payload")
        .when(F.col("corrupt"), "corrupt_json")
        .when(user, "missing_user")
        .when(time, "bad_time")
        .when(kind, "bad_type")
    )
    return F.when(user | time | kind, broken)


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (columns of the action table) and rejected rows (of the quarantine)."""
    accepted, rejected = split_rows(parsed, F.col("reason").isNull())
    return conform(accepted, ACTION), rejected


def ingest_actions(
    raw: DataFrame, p_date: str, align: str = "compact", precision: str = "s"
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of ``raw``, a frame with a binary ``value`` column.

    Two lazy filters over one parse. Where the source may answer two reads differently, stage
    the parsed rows first, as the ingest job does.
    """
    return split_parsed(parse_actions(raw, p_date, align, precision))
