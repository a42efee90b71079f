"""Connected components of an edge table, as joins and groupings of narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthgrid.llm.shared import counted, stored


def _state(pairs: DataFrame) -> tuple:
    """Row count and order-free checksum, which tell whether a round changed anything."""
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(pairs.agg(F.count(F.lit(1)), checksum).first())


def components(
    edges: DataFrame, a: str = "a", b: str = "b", at_most: int | None = None
) -> DataFrame:
    """(node, label) for every node with an edge; the label is the smallest node it reaches.

    ``at_most`` is a known bound of the edges; no round has more edges than the first.

    Alternates two steps until the edges stop changing. Large star: every neighbour larger than
    a node is linked to the smallest node of its neighbourhood. Small star: the same for the
    smaller neighbours. Both keep connectivity and end in stars around the smallest nodes, after
    about log(n) rounds; each round is stored, so none is recomputed. The smallest neighbour is a
    map-side combined minimum, and the join that hands it out is one that AQE can split.
    """
    pairs, rows = counted(
        edges.select(
            F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
        ).filter("u <> v").distinct(),
        at_most,
    )
    before = _state(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join shuffles both sides and AQE can split the rows of a hub.
        low = stored(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
            2 * rows,
        )
        large = stored(
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct(),
            rows,
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
        )
        pairs = stored(small.filter("u <> v").distinct(), rows)
        after = _state(pairs)
        if after == before:
            break
        before = after
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return leaves.union(roots)
