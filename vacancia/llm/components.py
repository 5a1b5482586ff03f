"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import keep


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest one of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node's smaller neighbours, and the node, to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    pairs = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return links.join(least, "a").select(F.inline(pairs)).where("a > b").distinct()


def components(links: DataFrame, nodes: int | None = None) -> DataFrame:
    """(node, root) of links (a, b): each node that isn't the smallest of its component, and that one.

    Large-star and small-star steps alternate until no link changes, which takes about the logarithm
    of the longest path. A node's neighbours are never gathered: their smallest is a partial
    aggregate, and joins on a node with many neighbours can be split, as the other side has one row.
    Each round is written to the shared folder; ``nodes`` is a bound of their number. Links with a null end, of a node to itself, and
    repeated links add nothing; no links, no rows.
    """
    ordered = links.where("a is not null and b is not null and a != b")
    now = keep(ordered.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", nodes)
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        now = keep(_small_star(_large_star(now)), "links", mark[0])
