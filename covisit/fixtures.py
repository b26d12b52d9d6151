"""Inputs derived from the supplied test tables: actions, baskets, packed messages.

All of it is Spark over the whole tables. Times in the test tables have no zone; they become
timestamps in the session zone here, and ``zoneless`` turns results back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
ACTION_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
FIRST_DAY, LAST_DAY = "20240101", "20240130"
DAMAGE = {1: "corrupt_json", 2: "missing_user", 3: "bad_type", 4: "bad_time"}
# ----------------------------------------------------------------------------------------

# the stored topic, and a read of it
LOG_TOPIC = "action"
LOG_FROM, LOG_TO = {"0": 100, "1": -2, "2": 0, "3": 150}, {"0": -1, "1": 180, "2": -1, "3": 151}
# items that are in every order of the skewed basket
HOT_ITEMS = 3
# events packed into one message at most: ids are given out in time order
MESSAGE_SPAN = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the shape of the action table."""
    return _actions(table(spark, sf_dir, "events")).drop("event_id")


def _actions(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    code = F.coalesce(*(F.when(kind == name, code) for name, code in ACTION_CODES.items()))
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("action_ts"),
        code.cast("int").alias("action_type"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("creation_id"),
        F.date_format("ts", "yyyyMMdd").alias("p_date"),
    )


def basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who ordered what and when: a dense interaction log."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("creation_id"),
        F.col("o_orderdate").cast("timestamp").alias("action_ts"),
    )


def skewed_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``basket`` with HOT_ITEMS more items (negative ids) in every order."""
    orders = table(spark, sf_dir, "orders")
    hot = orders.select(
        F.col("o_custkey").alias("user_id"),
        F.explode(F.array(*(F.lit(-i).cast("bigint") for i in range(1, HOT_ITEMS + 1)))).alias("creation_id"),
        F.col("o_orderdate").cast("timestamp").alias("action_ts"),
    )
    return basket(spark, sf_dir).unionByName(hot)


def late_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions of which every third came two days late, and every fifth lost its time."""
    rows = _actions(table(spark, sf_dir, "events"))
    came = F.date_format(F.col("action_ts") + F.expr("INTERVAL 2 DAYS"), "yyyyMMdd")
    return rows.select(
        "user_id",
        F.when(F.col("event_id") % 5 != 0, F.col("action_ts")).alias("action_ts"),
        "action_type", "creation_id",
        F.when(F.col("event_id") % 3 == 0, came).otherwise(F.col("p_date")).alias("p_date"),
    )


def raw_messages(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """``events`` packed into JSON messages, one per user, day and span of event ids.

    The span bounds a message, however many events one user has on one day. ``damaged`` spoils
    messages by ``user_id % 7`` as ``DAMAGE`` says and leaves the other residues intact.
    """
    span = F.call_function("div", F.col("event_id"), F.lit(MESSAGE_SPAN))
    element = F.struct(
        F.col("event_id").alias("n"),
        F.unix_millis("action_ts").alias("time"),
        F.col("action_type").alias("type"),
        F.col("creation_id").alias("item"),
    )
    packed = (
        _actions(table(spark, sf_dir, "events"))
        .groupBy("user_id", "p_date", span.alias("span"))
        .agg(F.sort_array(F.collect_list(element)).alias("e"))
    )

    def joined(field: str, spoilt: str | None = None) -> Column:
        return F.array_join(
            F.transform("e", lambda x: F.lit(spoilt) if spoilt else x[field].cast("string")), ","
        )

    user, kinds, times = F.col("user_id"), joined("type"), joined("time")
    residue = F.col("user_id") % 7
    if damaged:
        by_reason = {reason: residue == r for r, reason in DAMAGE.items()}
        user = F.when(~by_reason["missing_user"], user)
        kinds = F.when(by_reason["bad_type"], joined("type", "x")).otherwise(kinds)
        times = F.when(by_reason["bad_time"], joined("time", "junk")).otherwise(times)
    text = F.to_json(F.struct(
        kinds.alias("actionTypeList"), joined("item").alias("creationIdList"),
        times.alias("timestampList"), user.alias("userId"),
    ))
    if damaged:
        text = F.when(by_reason["corrupt_json"], "not json").otherwise(text)
    return packed.select(text.cast("binary").alias("value"))


def _single(events: DataFrame, time: Column, kind: Column, item: Column) -> DataFrame:
    """One message for each event, as text; null lists are left out of it."""
    text = F.to_json(F.struct(
        kind.alias("actionTypeList"), item.alias("creationIdList"), time.alias("timestampList"), F.col("user_id").alias("userId")))
    return events.select("event_id", text.alias("text"))


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stored topic of four partitions, a message each."""
    events = _actions(table(spark, sf_dir, "events"))
    rows = _single(events, F.unix_millis("action_ts").cast("string"), F.col("action_type").cast("string"), F.col("creation_id").cast("string"))
    return rows.select(
        F.lit(LOG_TOPIC).alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.call_function("div", F.col("event_id"), F.lit(4)).alias("offset"), F.col("text").cast("binary").alias("value"))


def untidy_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for each event, untidy by ``event_id % 8``.

    0: blanks around and beside list elements; 1: a missing list; 2: no payload (null, or empty); 3: an ISO time;
    4: blanks between the digits of an item; 5: fractions; 6: empty lists; 7: as it should be.
    """
    events = _actions(table(spark, sf_dir, "events"))
    way = F.col("event_id") % 8
    millis, kind, item = F.unix_millis("action_ts").cast("string"), F.col("action_type").cast("string"), F.col("creation_id").cast("string")
    spaced = F.concat(F.lit("\t "), item, F.lit(" "))
    rows = _single(
        events,
        F.when(way == 0, F.concat(F.lit(" ,"), millis, F.lit("  "))).when(way == 3, F.date_format("action_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(way == 5, F.concat(millis, F.lit(".75"))).when(way == 6, F.lit(" , ")).otherwise(millis),
        F.when(way == 0, F.concat(F.lit(" "), kind, F.lit(" , "))).when(way == 5, F.concat(kind, F.lit(".0"))).when(way == 6, F.lit(""))
        .when(way != 1, kind),
        F.when(way == 0, spaced).when(way == 4, F.regexp_replace(item, "(.)$", " $1")).when(way == 5, F.concat(item, F.lit(".")))
        .when(way == 6, F.lit("")).otherwise(item),
    )
    text = F.when(F.col("event_id") % 16 == 2, F.lit("")).when(F.col("event_id") % 8 != 2, F.col("text"))
    return rows.select(text.cast("binary").alias("value"))


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times, the type the test tables use."""
    times = {name for name, kind in df.dtypes if kind == "timestamp"}
    return df.select(
        *(F.col(c).cast("timestamp_ntz").alias(c) if c in times else F.col(c) for c in df.columns)
    )
