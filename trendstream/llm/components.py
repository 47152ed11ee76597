"""Connected components by alternating large-star and small-star rounds.

The links and the result stay distributed.  Each round takes, for every node,
the smallest neighbour (an aggregate combined on the map side) and points the
node's links at it; the joins that carry the minimum back have plain exchanges
on both sides, so AQE can split a node with very many links.  The number of
rounds grows with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstream.session import materialize


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reached.

    Nodes may be of any type with an order.  Links with a null end and links of
    a node with itself are ignored; repeated links do no harm.  No links: an
    empty result.
    """
    stars = materialize(
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-links")
    state = _state(stars)
    while state[0]:
        # large-star: larger neighbours of u go to the smallest of u and its neighbours
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "cc-min")
        large = materialize(both.filter("b > a").join(least.hint("merge"), "a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "cc-large")
        # small-star: u and its smaller neighbours go to the smallest of them
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "cc-min")
        stars = materialize(
            large.join(least.hint("merge"), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "cc-links")
        before, state = state, _state(stars)
        if state == before:
            break
    return (stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
