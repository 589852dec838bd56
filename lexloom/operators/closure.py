"""Groups of values linked by pairs, by alternating stars: every value ends at the smallest of its group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.session import Scope, discard, materialise


def closure(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """value, root: each value of a pair with both ends and the smallest value linked to it, directly or through others.

    Large stars hang every larger neighbour on a value's least neighbour, small stars the smaller ones, until nothing moves:
    a logarithmic number of rounds; a hub's edges are grouped with partial aggregation, never gathered into a list. Null ends
    are left out, self pairs make a group of one, an empty table gives an empty table.
    """
    with Scope() as scope:
        ends = pairs.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
        values = materialise(ends.select(F.explode(F.array("u", "v")).alias("value")).distinct(), "values")
        edges = materialise(ends.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links", n=F.count(F.lit(1)), s=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            large = materialise(large, "large-star")
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
            after = materialise(small, "small-star", n=F.count(F.lit(1)), s=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
            same = after.counts == edges.counts
            discard(edges, large)
            edges = after
            if same:
                break
        out = values.join(edges.select(F.col("u").alias("value"), F.col("v").alias("root")), "value", "left").select("value", F.coalesce("root", "value").alias("root"))
        return scope.keep(materialise(out, "roots"))
