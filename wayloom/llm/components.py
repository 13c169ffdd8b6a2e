"""Connected components of a link table, as joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.session import cut


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """id, root (smallest id of its component) of every end of a link ``(a, b)``.

    Alternates two star steps: neighbours above a node are tied to its smallest
    neighbour, then those below. Each step is one grouped minimum and one join, a
    node of any degree folds before the shuffle. Ends when a round changes nothing.
    """
    edges = cut(links.where("a != b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct())
    seen = None
    for _ in range(most_rounds):
        both = edges.union(edges.selectExpr("v as u", "u as v"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u and v > m").selectExpr("v as u", "m as v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        edges = cut(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.selectExpr("u as id", "v as root").union(edges.selectExpr("v", "v").distinct())
        seen = state
    raise RuntimeError("components did not settle")
