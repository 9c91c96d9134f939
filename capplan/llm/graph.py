"""Connected components of an edge table, by rounds of joins over the edges that are left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from capplan.llm.common import cut

#: Rounds after which the edges must have settled; each round at least halves the chains that are left.
ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a`` and ``b``): the least node it reaches.

    Alternates two steps until nothing changes: every node links its larger neighbours to its least
    neighbour, then every node links its smaller neighbours and itself to the least of them. Edges stay at
    most as many as nodes and edges at first, a node with very many neighbours is only ever aggregated and
    joined, and no component is brought together in one place. Nodes may be of any orderable type without
    NULL; loops are ignored, an empty table has no components.
    """
    kind = StructType([edges.schema["a"]])["a"].dataType
    pairs = cut(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    for _ in range(ROUNDS):
        both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("w"))
        # larger neighbours of each node go to the least of the node and its neighbours
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("w", "u").alias("v"))
        )
        down = cut(large.where("u != v").distinct())
        # now every edge points down: smaller neighbours and the node go to the least of them
        least = down.groupBy("u").agg(F.min("v").alias("w"))
        small = down.join(least, "u")
        pairs = cut(
            small.select(F.col("v").alias("u"), F.col("w").alias("v"))
            .union(small.select("u", F.col("w").alias("v")))
            .where("u != v")
            .distinct()
        )
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components have not settled after {ROUNDS} rounds")
    stars = pairs.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select(F.col("u").cast(kind).alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
