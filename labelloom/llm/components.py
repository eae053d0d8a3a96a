"""Connected components of a table of links, by alternating neighbourhood minima.

Each round runs two steps (large star, small star) until only stars are left. Both shrink the distance to the
smallest member exponentially, so the rounds grow with the logarithm of a component's diameter. A vertex
with very many links is the smallest of its group after the first rounds; all steps are aggregates with
map-side combining and joins that AQE can split, and no component is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale


def _with_minimum(links: DataFrame) -> DataFrame:
    """Every link in both directions, with the smallest vertex of its source's closed neighbourhood."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(lowest, "a")


def _tidy(links: DataFrame) -> DataFrame:
    return (links.filter(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(a, b)`` links of any ordered type to ``(vertex, component)``: the smallest vertex reachable.

    Vertices without a link to another one do not appear; self links, repeated links and either direction
    are fine. An empty table gives an empty one.
    """
    now = scale.stage(_tidy(links.filter("a is not null and b is not null")), "links")
    for _ in range(max_rounds):
        # In stars, every link leads to a vertex that has no smaller one.
        rows, sources = now.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
        if rows == sources and now.join(now.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        # Large star: every larger neighbour moves to the smallest one.
        large = _with_minimum(now).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scale.stage(_tidy(large), "links")
        # Small star: a vertex and its smaller neighbours move to the smallest of these.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lowest.select("a", F.col("m").alias("b"))))
        now = scale.stage(_tidy(small), "links")
    else:
        raise RuntimeError("components did not settle")
    return (now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
            .union(now.select(F.col("b").alias("vertex"), F.col("b").alias("component"))).distinct())
