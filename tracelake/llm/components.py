"""Connected components of an edge table, with no step that needs a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import common


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges`` (a, b: bigint); component is the least node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each connects
    neighbours to a local minimum, found by an aggregation that combines before the
    shuffle. Every round's edges go to the shared folder, which cuts the lineage; the
    rounds grow with the logarithm of the number of nodes. Rows with a null end and
    loops are left out; repeated edges count once.
    """
    now = common.stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = common.stored(small.filter("a <> b").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Equal for two rounds only if nothing changed: one small row."""
    return tuple(edges.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first())
