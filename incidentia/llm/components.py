"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentia.session import written


def _around(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with ``m``, the smallest node among ``u`` and its neighbours."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest.select("u", F.least("u", "m").alias("m")), "u")


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root): the smallest node of the component of every node that has
    an edge to another one.

    Alternates large stars (larger neighbours move to the smallest one) and
    small stars (the rest) until nothing changes, which takes a number of
    rounds of the order of the logarithm of the longest path. Every round is
    written to the shared folder, so a lost executor costs one round at most.
    """
    now = written(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where("u > v")
        .distinct(),
        "edges",
    )
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _around(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v")
            .distinct()
        )
        small = _around(large)
        now = written(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u > v")
            .distinct(),
            "edges",
        )
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = seen
