"""Fixed schemas of every table, and the one projection that makes a frame fit one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: wire format, column names and types, action codes -------------------
MESSAGE = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("actionTypeList", T.StringType()),
    T.StructField("creationIdList", T.StringType()),
    T.StructField("timestampList", T.StringType()),
])

ACTION = T.StructType([
    T.StructField("user_id", T.LongType(), True, {"comment": "acting user"}),
    T.StructField("action_ts", T.TimestampType(), True, {"comment": "time of the action"}),
    T.StructField("action_type", T.IntegerType(), True, {"comment": "action code"}),
    T.StructField("creation_id", T.LongType(), True, {"comment": "item acted on"}),
    T.StructField("p_date", T.StringType(), True, {"comment": "ingest day, yyyyMMdd"}),
])

CLICK = T.StructType([
    T.StructField("user_id", T.LongType(), True, {"comment": "acting user"}),
    T.StructField("creation_id", T.LongType(), True, {"comment": "item acted on"}),
    T.StructField("action_ts", T.TimestampType(), True, {"comment": "latest time in the window"}),
])

SIMILARITY = T.StructType([
    T.StructField("item_i", T.LongType()),
    T.StructField("item_j", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

VERTEX = T.StructType([T.StructField("creation_id", T.LongType(), False)])

EDGE = T.StructType([
    T.StructField("srcid", T.LongType(), False),
    T.StructField("dstid", T.LongType(), False),
    T.StructField("simscore", T.DoubleType(), False),
])

QUARANTINE = T.StructType([
    *ACTION.fields,
    T.StructField("raw", T.StringType(), True, {"comment": "text the row came from"}),
    T.StructField("reason", T.StringType(), True, {"comment": "first rule the row broke"}),
])

CLICK_CODE = 2

# column types of a columnar OLAP copy, by Spark type
OLAP_TYPES = {"bigint": "Int64", "int": "Int32", "string": "String", "timestamp": "DateTime"}
# ----------------------------------------------------------------------------------------


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, in its order, cast to its types.

    A column the schema calls not-null is checked while rows pass through; a null fails the
    job that writes it instead of reaching the table.
    """

    def fit(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            problem = F.raise_error(F.lit(f"null in not-null column {field.name}"))
            value = F.coalesce(value, problem.cast(field.dataType))
        return value.alias(field.name)

    return df.select(*(fit(field) for field in schema.fields))


def olap_copy(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``conform`` for a store whose times hold whole seconds only."""
    out = conform(df, schema)
    times = {f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)}
    return out.select(
        *(F.date_trunc("second", c).alias(c) if c in times else F.col(c) for c in out.columns)
    )


def olap_columns(schema: T.StructType) -> dict[str, str]:
    """Column name -> type name in the OLAP copy."""
    return {f.name: OLAP_TYPES[f.dataType.simpleString()] for f in schema.fields}
