"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from silverbrook.llm.storage import delete, written


#: Edges from which on a node may be a hub, and the share of all edges that it must have.
HUB_EDGES, HUB_PART = 1000, 50_000


def _join_least(both: DataFrame, least: DataFrame, edges: int) -> DataFrame:
    """Add to each pair (u, v) the minimum of u."""
    hubs = least.where(F.col("n") > max(HUB_EDGES, edges // HUB_PART)).select("u", "m").collect()
    if not hubs:
        return both.join(least, "u")
    known = F.broadcast(both.sparkSession.createDataFrame(hubs, least.select("u", "m").schema))
    rest = both.join(known, "u", "left_anti").join(least.select("u", "m"), "u")
    return rest.unionByName(both.join(known, "u"))


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """``(id, component)`` for every id in an edge; the component is its smallest id.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each keeps the components, pulls edges towards
    the smallest neighbour and needs O(log n) rounds in practice.  Neighbourhoods are never gathered: a step is one
    grouped minimum, which combines before the shuffle, and one join.  The edges of hubs, nodes with more than
    ``HUB_EDGES`` edges and more than a 50,000th of all, are not shuffled for it: such nodes are fewer than 100,000
    whatever the graph, and their minima are broadcast.  Edges with a null end and loops are ignored; repeated edges count
    once.  Ids are of any type with an order; whole numbers become long.
    """
    def settled(df: DataFrame) -> tuple[DataFrame, dict, str]:
        """The edges as a table, with their number and a sum of hashes, both taken while it is written, and its path."""
        seen = Observation()
        table, path = written(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31)).alias("h")), "edges")
        return table, seen.get, path

    kinds = dict(edges.dtypes)
    kind = "long" if {kinds[a], kinds[b]} <= {"tinyint", "smallint", "int", "bigint"} else kinds[a]
    now, state, path = settled(edges.select(F.greatest(a, b).cast(kind).alias("u"), F.least(a, b).cast(kind).alias("v")).where("u is not null and v is not null and u <> v").distinct())
    before = None
    for _ in range(most):
        if not state["n"] or before == state:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = _join_least(both, least, state["n"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        old = path
        now, state, path = settled(small)
        delete(now.sparkSession, old)
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    top = now.groupBy("u").agg(F.min("v").alias("component"))
    return top.select(F.col("u").alias("id"), "component").unionByName(
        top.select(F.col("component").alias("id"), "component").distinct()
    )
