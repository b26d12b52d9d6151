"""Where vertices and edges go: Parquet laid out for lookups, a store that is fed by key, or any Spark connector."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit.operators.profile import counted
from covisit.operators.ranking import top_n_per_key
from covisit.schemas import EDGE, VERTEX, conform
from covisit.sources.merging import BUCKETS, MergingTable
from covisit.sources.versions import Versions

BATCH = 1000  # fixed value: rows per write request of a graph connector
#: Ids of a lookup that go into the scan as literals; beyond, the scan is joined with their table.
LITERAL_IDS = 1000
_ROWS = "rows"


# --- replaced as a whole -----------------------------------------------------------------------------


def write_vertices(vertices: DataFrame, path: str) -> int:
    """Replace the vertices: ranged and sorted by id, so a lookup reads few row groups."""
    ordered = vertices.repartitionByRange("creation_id").sortWithinPartitions("creation_id")
    return _replace(conform(ordered, VERTEX), path, "creation_id")


def write_edges(edges: DataFrame, path: str) -> int:
    """Replace the edges: ranged by both ends and sorted by source, strongest first."""
    ordered = edges.repartitionByRange("srcid", "dstid").sortWithinPartitions(
        F.col("srcid"), F.col("simscore").desc(), F.col("dstid")
    )
    return _replace(conform(ordered, EDGE), path, "srcid")


def _replace(rows: DataFrame, path: str, key: str) -> int:
    """Write beside the served rows, then point to the new ones: there is no moment without a graph, and no copy.

    Files carry Bloom filters of the key, so that a row group whose range holds an id without having it is passed over.
    """
    rows, seen = counted(rows, f"graph_{uuid.uuid4().hex}")
    with Versions(rows.sparkSession, path).draft() as draft:
        draft.write(rows, _ROWS, options={f"parquet.bloom.filter.enabled#{key}": "true"})
        draft.publish()
    return seen.get["rows"]


def _read(spark: SparkSession, path: str) -> DataFrame:
    rows = Versions(spark, path).read(_ROWS)
    if rows is None:
        raise LookupError(f"nothing is stored at {path} yet")
    return rows


def read_vertices(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path)


def edges_of(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """The stored edges out of the items of ``ids`` (its first column; repeated and null ids count once and not at all).

    Up to ``LITERAL_IDS`` of them reach the scan as literals: row groups are chosen by their ranges and Bloom filters.
    More are joined, which Spark plans by their size.
    """
    wanted = ids.select(F.col(ids.columns[0]).cast("long").alias("srcid")).where("srcid IS NOT NULL").distinct()
    some = [row[0] for row in wanted.limit(LITERAL_IDS + 1).collect()]
    if len(some) <= LITERAL_IDS:
        return edges.where(F.col("srcid").isin(some)) if some else edges.limit(0)
    return edges.join(wanted, "srcid", "left_semi")


def similar_items_of_many(edges: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``srcid, dstid, simscore``: the ``n`` strongest edges out of each of many items; equal scores go to the smaller item."""
    strongest = [F.col("simscore").desc(), F.col("dstid").asc()]
    return top_n_per_key(edges_of(edges, ids), ["srcid"], strongest, n)


# --- fed by key ----------------------------------------------------------------------------------------


class KeyedGraph:
    """Vertices and edges below ``path`` that are inserted by key: a later insert of a key replaces the earlier one.

    An insert is one commit: Spark's tasks write files of their own, of which those of failed and repeated attempts
    are left out, and the rows appear together. Inserting the same rows again changes nothing. Reads see each key once;
    ``compact`` merges what many inserts have left (see ``sources.merging``).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        def table(name: str, schema: T.StructType, keys: list[str]) -> MergingTable:
            loaded = T.StructType([*schema.fields, T.StructField("load", T.LongType())])
            return MergingTable(spark, f"{path.rstrip('/')}/{name}", loaded, keys, "load", buckets=buckets)

        self._vertices = table("vertices", VERTEX, ["creation_id"])
        self._edges = table("edges", EDGE, ["srcid", "dstid"])

    def insert_vertices(self, vertices: DataFrame) -> None:
        self._insert(self._vertices, conform(vertices, VERTEX))

    def insert_edges(self, edges: DataFrame) -> None:
        """Of rows with one key the highest score counts."""
        self._insert(self._edges, conform(edges, EDGE))

    @staticmethod
    def _insert(table: MergingTable, rows: DataFrame) -> None:
        table.append(rows.withColumn("load", F.lit(table.number() + 1).cast("long")))

    def vertices(self) -> DataFrame:
        return self._vertices.exact().drop("load")

    def edges(self) -> DataFrame:
        return self._edges.exact().drop("load")

    def compact(self) -> int:
        return self._vertices.compact() + self._edges.compact()


# --- handed on -----------------------------------------------------------------------------------------


def write_connector(
    df: DataFrame, format: str, options: dict[str, str], batch: int = BATCH
) -> int:
    """Hand vertices or edges to a graph database connector on the class path.

    Vertices are keyed by ``creation_id``, edges by (``srcid``, ``dstid``). Writing by key makes
    a task that runs twice harmless.
    """
    rows, seen = counted(df, f"graph_{uuid.uuid4().hex}")
    rows.write.format(format).mode("overwrite").options(**{"batch": str(batch), **options}).save()
    return seen.get["rows"]
