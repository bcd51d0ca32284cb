"""Connected components by alternating star contractions.

Every round hangs each node's neighbours on the smallest one, first the larger neighbours, then
the smaller ones; the number of rounds grows with the logarithm of the graph's size, not with
its diameter.  Rounds are written to the shared folder, so lineage stays one round deep, and
joins read their two sides from tables, so that skewed ones (a node with very many links) can
be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import staged


def _smallest(links: DataFrame) -> DataFrame:
    """Per node ``a`` the smallest neighbour."""
    return staged(links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "star")


def _star(links: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        small = _smallest(both)
        hung = both.where("b > a").join(small, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.least("m", "u").alias("b"))
    else:
        small = _smallest(links)
        hung = links.join(small, F.col("a") == F.col("u")).where("b > m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        hung = hung.unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a <> b").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has a link; component: the smallest node reachable.

    Links may repeat, point both ways or to the node itself; those with a null end are ignored.
    No links give no rows."""
    x, y = F.col(a), F.col(b)
    now = staged(links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
                 .where(x.isNotNull() & y.isNotNull() & (x != y)).distinct(), "links")

    def mark(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(now)
    for _ in range(max_rounds if seen[0] else 0):
        now = staged(_star(_star(now, larger=True), larger=False), "links")
        if (new := mark(now)) == seen:
            break
        seen = new
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
