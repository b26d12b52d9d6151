"""Connected components of links, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covisit.llm.common import staged


def _least(links: DataFrame) -> DataFrame:
    """Per first end, the least of it and all second ends."""
    return links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _are_stars(links: DataFrame) -> bool:
    """Whether every first end has one link, and no second end is a first one."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """id, component for every end of ``links`` (a, b: long, not null): the least id that links lead to.

    Each round joins every node's larger neighbours to its least one, then the smaller ones, until
    every larger end has one link, to an end that has none to a smaller (large and small stars). Rounds grow with the logarithm of the longest chain.
    Each is written to the shared folder, which ends its lineage.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = staged(links, "links")
    while not _are_stars(links):
        ways = _both_ways(links)
        large = ways.where("b > a").join(_least(ways), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.join(_least(large), "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(small.select("a", F.col("m").alias("b")))
        links = staged(small.where("a <> b").distinct(), "links")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
