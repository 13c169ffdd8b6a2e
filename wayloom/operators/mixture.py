"""Two-mode models per cell, fitted by rounds of partial aggregation.

No cell's points are gathered: equal readings of a cell are folded into one
weighted row first, and a round is one join of cell parameters plus one
``groupBy``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.functions.cells import to_i16
from wayloom.session import cut

MIN_VAR = {"z": 0.01, "intensity": 1.0}
SCALE = {"z": 100.0, "intensity": 1.0}


def _readings(points: DataFrame, size: float, value: str, min_n: int, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Distinct readings per cell with their counts, for cells of at least ``min_n`` points."""
    keys = [*by, "row", "col"]
    d = points.groupBy(*by, F.floor(F.col("y") / size).alias("row"), F.floor(F.col("x") / size).alias("col"),
                       F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    big = d.groupBy(*keys).agg(F.sum("c").alias("n")).filter(F.col("n") >= min_n).select(*keys)
    return cut(d.join(big, keys, "left_semi")), keys


def _start(readings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Modes at the extremes; deterministic, unlike random starts."""
    return readings.groupBy(*keys).agg(F.min("v").alias("u1"), F.max("v").alias("u2"), F.sum("c").alias("n"))


def kmeans_value(points: DataFrame, size: float, value: str, min_n: int = 7, iters: int = 10,
                 by: Sequence[str] = ()) -> DataFrame:
    """Two-means of one value per cell: weights, means, floored population variances."""
    d, keys = _readings(points, size, value, min_n, by)
    m = _start(d, keys).drop("n")
    one = F.abs(F.col("v") - F.col("u1")) <= F.abs(F.col("v") - F.col("u2"))

    def fold(cond: Column, x: Column) -> Column:
        return F.sum(F.when(cond, x))

    for _ in range(iters):
        j = d.join(m, keys)
        g = j.groupBy(*keys).agg(F.first("u1").alias("_p1"), F.first("u2").alias("_p2"),
                                 fold(one, F.col("c")).alias("_c1"), fold(~one, F.col("c")).alias("_c2"),
                                 fold(one, F.col("c") * F.col("v")).alias("_s1"),
                                 fold(~one, F.col("c") * F.col("v")).alias("_s2"))
        nxt = g.select(*keys, F.coalesce(F.col("_s1") / F.col("_c1"), "_p1").alias("u1"),
                       F.coalesce(F.col("_s2") / F.col("_c2"), "_p2").alias("u2"), "_p1", "_p2")
        nxt = cut(nxt)
        moved = nxt.filter((F.abs(F.col("u1") - F.col("_p1")) > 1e-12) | (F.abs(F.col("u2") - F.col("_p2")) > 1e-12))
        m = nxt.drop("_p1", "_p2")
        if moved.isEmpty():
            break
    j = d.join(m, keys)

    def dev(u):
        return F.col("c") * (F.col("v") - F.col(u)) * (F.col("v") - F.col(u))

    g = j.groupBy(*keys).agg(F.sum("c").alias("n"), F.first("u1").alias("u1"), F.first("u2").alias("u2"),
                             F.coalesce(fold(one, F.col("c")), F.lit(0)).alias("c1"),
                             F.coalesce(fold(~one, F.col("c")), F.lit(0)).alias("c2"),
                             fold(one, dev("u1")).alias("_d1"), fold(~one, dev("u2")).alias("_d2"))
    low = F.lit(MIN_VAR.get(value, 0.0))
    return g.select(*keys, "n", (F.col("c1") / F.col("n")).alias("w1"), "u1",
                    F.greatest(low, F.coalesce(F.col("_d1") / F.nullif(F.col("c1"), F.lit(0)), F.lit(0.0))).alias("s1"),
                    (F.col("c2") / F.col("n")).alias("w2"), "u2",
                    F.greatest(low, F.coalesce(F.col("_d2") / F.nullif(F.col("c2"), F.lit(0)), F.lit(0.0))).alias("s2"))


def em_value(points: DataFrame, size: float, value: str, min_n: int = 6, iters: int = 300,
             by: Sequence[str] = (), floor: float = 1e-4, tol: float = 0.1) -> DataFrame:
    """Two-mode expectation-maximisation of one value per cell, with the last log-likelihood.

    A cell stops when its log-likelihood changes by less than ``tol`` and leaves
    the later rounds; ``converged`` is false for cells that reach ``iters`` first.
    """
    d, keys = _readings(points, size, value, min_n, by)
    st = d.groupBy(*keys).agg(F.sum("c").alias("n"), F.min("v").alias("u1"), F.max("v").alias("u2"),
                              F.sum(F.col("c") * F.col("v")).alias("_a"), F.sum(F.col("c") * F.col("v") * F.col("v")).alias("_b"))
    var = F.greatest(F.lit(floor), F.col("_b") / F.col("n") - (F.col("_a") / F.col("n")) * (F.col("_a") / F.col("n")))
    half = F.lit(0.5)
    m = st.select(*keys, "n", half.alias("w1"), "u1", var.alias("s1"), half.alias("w2"), "u2", var.alias("s2"),
                  F.lit(None).cast("double").alias("loglik"))

    def logd(k):
        u, s = F.col(f"u{k}"), F.col(f"s{k}")
        return F.log(F.greatest(F.col(f"w{k}"), F.lit(1e-12))) - 0.5 * F.log(2 * math.pi * s) - (F.col("v") - u) * (F.col("v") - u) / (2 * s)

    done = None
    for i in range(iters):
        j = d.join(m, keys).withColumn("_l1", logd(1)).withColumn("_l2", logd(2))
        j = j.withColumn("_m", F.greatest("_l1", "_l2"))
        j = j.withColumn("_z", F.col("_m") + F.log(F.exp(F.col("_l1") - F.col("_m")) + F.exp(F.col("_l2") - F.col("_m"))))
        j = j.withColumn("_r1", F.col("c") * F.exp(F.col("_l1") - F.col("_z"))).withColumn("_r2", F.col("c") - F.col("_r1"))
        dev = [(F.col("v") - F.col(f"u{k}")) for k in (1, 2)]
        g = j.groupBy(*keys).agg(
            F.first("n").alias("n"), F.first("loglik").alias("_before"), F.sum(F.col("c") * F.col("_z")).alias("loglik"),
            *[F.first(f"u{k}").alias(f"_o{k}") for k in (1, 2)],
            *[F.sum(f"_r{k}").alias(f"_n{k}") for k in (1, 2)],
            *[F.sum(F.col(f"_r{k}") * dev[k - 1]).alias(f"_a{k}") for k in (1, 2)],
            *[F.sum(F.col(f"_r{k}") * dev[k - 1] * dev[k - 1]).alias(f"_b{k}") for k in (1, 2)])
        cols = [*keys, "n", "loglik", F.coalesce(F.abs(F.col("loglik") - F.col("_before")) < tol, F.lit(False)).alias("converged")]
        for k in (1, 2):
            w = F.greatest(F.col(f"_n{k}"), F.lit(1e-9))
            sh = F.col(f"_a{k}") / w
            cols += [(F.col(f"_n{k}") / F.col("n")).alias(f"w{k}"), (F.col(f"_o{k}") + sh).alias(f"u{k}"),
                     F.greatest(F.lit(floor), F.col(f"_b{k}") / w - sh * sh).alias(f"s{k}")]
        g = cut(g.select(*cols))
        ready = g if i == iters - 1 else g.filter("converged")
        done = ready if done is None else done.unionByName(ready)
        m = g.filter("not converged").drop("converged")
        if m.isEmpty():
            break
    return done


def _stored(m: DataFrame, value: str, keys: Sequence[str], tag: str, root: bool) -> DataFrame:
    """Weights in percent, means and spreads scaled to the stored integers."""
    k = SCALE.get(value, 1.0)
    spread = (lambda c: F.sqrt(c)) if root else (lambda c: c)
    return m.select(*keys, F.col("n"), *[c for i in (1, 2) for c in (
        to_i16(F.col(f"w{i}") * 100).alias(f"{tag}w{i}"), to_i16(F.col(f"u{i}") * k).alias(f"{tag}u{i}"),
        to_i16(spread(F.col(f"s{i}")) * k).alias(f"{tag}s{i}"))])


def _both(fit, points, size, by, root, **kw) -> DataFrame:
    keys = [*by, "row", "col"]
    a = _stored(fit(points, size, "z", by=by, **kw), "z", keys, "a", root)
    r = _stored(fit(points, size, "intensity", by=by, **kw), "intensity", keys, "r", root)
    return a.join(r.drop("n"), keys)


def gmm_em(points: DataFrame, size: float, min_n: int = 6, iters: int = 300, by: Sequence[str] = ()) -> DataFrame:
    """Stored two-mode cells of altitude and intensity, fitted by expectation-maximisation."""
    return _both(em_value, points, size, by, True, min_n=min_n, iters=iters)


def gmm_kmeans(points: DataFrame, size: float, min_n: int = 7, iters: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Stored two-mode cells of altitude and intensity, fitted by two-means."""
    return _both(kmeans_value, points, size, by, False, min_n=min_n, iters=iters)


def tile_gmm(points: DataFrame, tile: float, cell: float, min_n: int = 7, iters: int = 10) -> DataFrame:
    """:func:`gmm_kmeans` per tile, with the number of trained cells of the tile."""
    d = points.withColumn("tile_x", F.floor(F.col("x") / tile)).withColumn("tile_y", F.floor(F.col("y") / tile))
    by = ["tile_x", "tile_y"]
    m = gmm_kmeans(d, cell, min_n, iters, by)
    return m.join(m.groupBy(*by).agg(F.count(F.lit(1)).alias("effective_cells")), by)
