"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.llm.common import discard, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(id, root) of every id in ``links``; root is the smallest id it reaches.

    Each round hangs larger neighbours (large-star), then smaller ones
    (small-star), on the smallest neighbour, until no edge changes; then all edges point at the
    roots. Minima are aggregated before the shuffle, so a node with
    very many edges is one row of the minima and its edges stay spread by the join.
    Every round is a table in the shared folder.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .filter("u <> v").distinct()
    edges = written(edges, "cc-edges")
    state = _state(edges)
    for _ in range(most_rounds):
        if state[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"))
        # an edge to another than the smallest becomes two: (v, m) above and (u, m)
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        old, edges = edges, written(small, "cc-edges")
        discard(old)
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("root"))
                             .distinct())
