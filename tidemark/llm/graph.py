"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b): the smallest id reachable from it.

    Each round points every id at its smallest neighbour or itself, replaces both ends of every link by what they
    point at, and drops links that became loops. Pointers only lead to smaller ids, so a round ends with at most half
    the ids of each component; star-shaped links need two rounds. Minima are combined before the shuffle, and no list
    of neighbours is ever built, so a hub costs no more than its links. Ids that are null and loops are ignored.
    """
    a, b = F.col("a"), F.col("b")
    links = stored(
        edges.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links"
    )
    labels = None
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select(b.alias("a"), a.alias("b")))
        parent = stored(
            both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("p")), "parents"
        )
        if labels is None:
            labels = parent.select(F.col("a").alias("id"), F.col("p").alias("root"))
        else:
            up = parent.select(F.col("a").alias("root"), "p")
            labels = stored(
                labels.join(up, "root", "left").select("id", F.coalesce("p", "root").alias("root")), "labels"
            )
        of_a = parent.select("a", F.col("p").alias("pa"))
        of_b = parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = links.join(of_a, "a").join(of_b, "b").where(F.col("pa") != F.col("pb"))
        links = stored(
            moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links"
        )
    if labels is None:
        labels = edges.select(a.alias("id"), b.alias("root")).limit(0)
    return labels
