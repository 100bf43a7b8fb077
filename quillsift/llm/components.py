"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.scratch import staged


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is tied to the least of u and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every neighbour below u, and u, is tied to the least of them. Edges point down: u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """id, component (least id) of every end of ``edges`` (a, b). Each round is a table in the shared folder."""
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        now = staged(_small(_large(now)).where("u <> v").distinct(), "stars")
        seen = tuple(now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(v, u) as decimal(38, 0)))")).first())
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
