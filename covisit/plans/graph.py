"""Similarity as a property graph: vertices, directed edges, and the reads it serves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covisit.schemas import EDGE, VERTEX, conform


def graph_vertices(similarity: DataFrame) -> DataFrame:
    """``creation_id``: every item at either end of a pair, once, from a single scan."""
    ends = F.explode(F.array("item_i", "item_j")).alias("creation_id")
    return conform(similarity.select(ends).distinct(), VERTEX)


def graph_edges(similarity: DataFrame, unique: bool = False) -> DataFrame:
    """``srcid, dstid, simscore``: one edge per ordered pair.

    If a pair occurs more than once its highest score counts. ``unique`` promises that none
    does, which saves the shuffle when the pairs come from a table.
    """
    edges = similarity.select(
        F.col("item_i").alias("srcid"), F.col("item_j").alias("dstid"),
        F.col("score").alias("simscore"),
    )
    if not unique:
        edges = edges.groupBy("srcid", "dstid").agg(F.max("simscore").alias("simscore"))
    return conform(edges, EDGE)


def similarity_graph(
    similarity: DataFrame, vertices: bool = True, edges: bool = True, unique: bool = False
) -> tuple[DataFrame | None, DataFrame | None]:
    """The two halves of the export; either may be left out."""
    return (
        graph_vertices(similarity) if vertices else None,
        graph_edges(similarity, unique) if edges else None,
    )


def vertex_lookup(vertices: DataFrame, ids: Sequence[int]) -> DataFrame:
    """The vertices among ``ids``. On the stored vertex table, which is laid out by id, the
    filter skips all row groups that cannot hold them."""
    return vertices.where(F.col("creation_id").isin(list(ids)))


def similar_items(edges: DataFrame, item: int, n: int) -> DataFrame:
    """``dstid, simscore``: the ``n`` strongest edges out of ``item``."""
    return (
        edges.where(F.col("srcid") == item)
        .select("dstid", "simscore")
        .orderBy(F.col("simscore").desc(), F.col("dstid").asc())
        .limit(n)
    )
