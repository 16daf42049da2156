"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cupom.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node it is connected with.

    Each round joins every node's neighbours to its smallest one, first the larger neighbours, then
    the others, until nothing changes (rounds grow as the logarithm of a component's size). A
    round is a map-side aggregation and an equi-join that AQE splits at hot nodes, written to the shared folder; only
    a count and a checksum reach the driver. Null ends are ignored; a node linked only with itself is left out.
    """
    edges = stored(links.select("a", "b").where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(small, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        edges = stored(rest.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
