"""Connected components of a link table, by hooking to smaller neighbours and halving paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm.scratch import kept


def labels_of(edges: DataFrame) -> DataFrame:
    """``copy`` and ``root`` (its component's smallest member) for every end of ``edges(a, b)``.

    Alternates two steps on links that point from larger to smaller members: all larger
    neighbours of a member are hung on its smallest neighbour, then all smaller ones, until the
    links stay the same. Their number does not grow, and rounds grow with the logarithm of the number of members. Links
    are de-duplicated before they meet at a member, and a member's smallest neighbour is found by
    partial aggregation; the rest is a join, which deals a hot member out.
    """
    links = kept(_down(edges.where("a <> b")), "links")
    seen = _digest(links)
    while seen[0]:
        large = _hang(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                      "b > a")
        links = kept(_down(_hang(_down(large), "b <= a")), "links", seen[0])
        before, seen = seen, _digest(links)
        if seen == before:
            break
    roots = links.select(F.col("b").alias("copy"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("copy"), F.col("b").alias("root")).unionByName(roots)


def _digest(links: DataFrame) -> tuple:
    """Number of links and two sums of their hashes: the same for the same set of links."""
    return tuple(links.agg(F.count(F.lit(1)), *[
        F.sum(F.xxhash64(F.lit(i), "a", "b").cast("decimal(38,0)")) for i in range(2)]).first())


def _down(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                        F.least("a", "b").alias("b")).distinct()


def _hang(edges: DataFrame, which: str) -> DataFrame:
    """Each neighbour ``b`` of ``a`` that fits ``which``, linked to the least of a's neighbourhood."""
    least = edges.groupBy("a").agg(F.min(F.least("a", "b")).alias("least"))
    return edges.where(which).join(least, "a").select(
        F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b")))
