"""Occupancy rasters from sweeps."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

START, LOW, HIGH = 127, 117, 137  # fixed values: unknown, and the soft limits of a pixel
RAY_MAX, NEAR_FREE = 80.0, 0.2  # fixed values
PIXEL = ["submap_id", "px", "py"]


def _then(first: Column, second: Column) -> Column:
    """One clamped addition after another is again one: shift, low, high."""
    def clip(v):
        return F.least(second["hi"], F.greatest(second["lo"], v + second["s"]))

    return F.struct((first["s"] + second["s"]).alias("s"), clip(first["lo"]).alias("lo"), clip(first["hi"]).alias("hi"))


def _fold(col: str) -> Column:
    same = F.struct(F.lit(0).cast("long").alias("s"), F.lit(LOW).cast("long").alias("lo"), F.lit(HIGH).cast("long").alias("hi"))
    return F.aggregate(col, same, lambda acc, e: _then(acc, e["op"]))


def occupancy(obs: DataFrame, slice_width: int = 1000) -> DataFrame:
    """Pixel values after ordered hits (−1 above 117) and free looks (+1 below 137).

    ``obs`` carries ``submap_id, px, py, seq, hit``; within one ``seq`` hits come
    first.  Clamped additions compose, so runs are folded per frame, then per
    slice of frames, then per pixel: a pixel seen a billion times never lies in
    one array.
    """
    n = obs.groupBy(*PIXEL, "seq", "hit").agg(F.count(F.lit(1)).alias("_n"))
    op = F.struct(F.when(F.col("hit"), -F.col("_n")).otherwise(F.col("_n")).alias("s"),
                  F.lit(LOW).cast("long").alias("lo"), F.lit(HIGH).cast("long").alias("hi"))
    e = F.struct(F.col("seq"), (~F.col("hit")).alias("o"), op.alias("op"))
    d = n.groupBy(*PIXEL, F.floor(F.col("seq") / slice_width).alias("_sl")).agg(F.sort_array(F.collect_list(e)).alias("_l"))
    d = d.select(*PIXEL, "_sl", _fold("_l").alias("op"))
    d = d.groupBy(*PIXEL).agg(F.sort_array(F.collect_list(F.struct("_sl", "op"))).alias("_l"))
    f = d.select(*PIXEL, _fold("_l").alias("op"))
    return f.select(*PIXEL, F.least(F.col("op.hi"), F.greatest(F.col("op.lo"), START + F.col("op.s"))).alias("v"))


def merge_rasters(rasters: DataFrame) -> DataFrame:
    """Sub-map rasters on one grid: signed sum around 127, saturated, with the class."""
    v = F.greatest(F.lit(0), F.least(F.lit(255), START + F.sum(F.col("v") - START)))
    d = rasters.groupBy("px", "py").agg(v.alias("v"))
    return d.withColumn("class", F.when(F.col("v") > START, "free").when(F.col("v") < START, "occupied").otherwise("unknown"))


def fill_free(raster: DataFrame) -> DataFrame:
    """Unknown pixels whose four neighbours are free become free."""
    free = raster.filter(F.col("class") == "free")
    beside = F.array(*[F.struct((F.col("px") + a).alias("px"), (F.col("py") + b).alias("py"))
                       for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))])
    votes = free.select(F.explode(beside).alias("_n")).groupBy("_n.px", "_n.py").agg(F.count(F.lit(1)).alias("_k"))
    filled = votes.filter(F.col("_k") == 4).drop("_k").withColumn("_fill", F.lit(True))
    d = raster.join(filled, ["px", "py"], "full_outer")
    cls = F.coalesce("class", F.lit("unknown"))
    d = d.withColumn("class", F.when((cls == "unknown") & F.coalesce("_fill", F.lit(False)), "free").otherwise(cls))
    return d.select("px", "py", F.coalesce("v", F.lit(START)).alias("v"), "class")


def to_2d_scan(points: DataFrame, planes: DataFrame, low: float = 0.3, high: float = 1.2, min_hits: int = 5) -> DataFrame:
    """Nearest obstacle per whole degree, from points between two heights above the floor.

    ``planes`` is ``frame_id, a, b, c, d``.  A direction needs ``min_hits``
    different distances.
    """
    d = points.join(planes, "frame_id")
    h = F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("c") * F.col("z") + F.col("d")
    far = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    d = d.filter((far <= RAY_MAX) & (h > low) & (h < high))
    deg = F.pmod(F.round(F.degrees(F.atan2("y", "x"))).cast("int") + 360, F.lit(360))
    d = d.groupBy("frame_id", deg.alias("deg"), F.hypot("x", "y").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    g = d.groupBy("frame_id", "deg").agg(F.min("_d").alias("dist"), F.count(F.lit(1)).alias("hits"))
    return g.filter(F.col("hits") >= min_hits)


def template(spark: SparkSession, half: float, res: float) -> DataFrame:
    """Cells around the sensor: offset, range and direction."""
    n = int(round(2 * half / res))
    d = spark.range(n * n).select((-half + F.floor(F.col("id") / n) * res).alias("dx"), (-half + F.col("id") % n * res).alias("dy"))
    ang = F.degrees(F.atan2("dy", "dx"))
    return d.select("dx", "dy", F.hypot("dx", "dy").alias("range"), F.when(ang < 0, ang + 360).otherwise(ang).alias("angle"))


def free_cells(scan2d: DataFrame, cells: DataFrame, res: float) -> DataFrame:
    """Template cells seen free from each frame: ``frame_id, dx, dy``.

    A cell is free when it lies close to the sensor or nearer than the obstacle
    in its direction; directions between two whole degrees are interpolated when
    both are seen and similar.
    """
    hole = F.lit(-1.0)
    at = scan2d.groupBy("frame_id").agg(F.map_from_entries(F.collect_list(F.struct("deg", "dist"))).alias("_m"))  # ≤ 360 entries
    rays = at.select("frame_id", "_m", F.explode(F.sequence(F.lit(0), F.lit(359))).alias("deg"))
    rays = rays.select("frame_id", "deg", F.coalesce(F.element_at("_m", F.col("deg")), hole).alias("r1"),
                       F.when(F.col("deg") == 359, F.lit(None)).otherwise(
                           F.coalesce(F.element_at("_m", F.col("deg") + 1), hole)).alias("r2"))
    c = cells.withColumn("deg", F.pmod(F.floor("angle").cast("int"), F.lit(360)))
    d = c.join(rays, "deg")
    bad1 = (F.col("r1") < 0) | (F.col("r1") > RAY_MAX)
    bad2 = (F.col("r2") < 0) | (F.col("r2") > RAY_MAX)
    s = F.col("angle") - F.col("deg")
    second = (~bad2 & bad1) | (~bad1 & ~bad2 & (F.abs(F.col("r1") - F.col("r2")) > 0.3) & (s > 0.5))
    first = F.col("r2").isNull() | bad2 | (~bad1 & (F.abs(F.col("r1") - F.col("r2")) > 0.3))
    d = d.withColumn("_ray", F.when(F.col("r2").isNull(), F.col("r1")).when(second, F.col("r2")).when(first, F.col("r1"))
                     .otherwise(F.col("r1") * (1 - s) + F.col("r2") * s))
    d = d.withColumn("_ang", F.radians(F.when(F.col("r2").isNull(), F.col("angle")).when(second, F.col("deg") + 1.0)
                                       .when(first, F.col("deg") * 1.0).otherwise(F.col("angle"))))
    seen = (F.col("_ray") >= 0) & (F.col("_ray") <= RAY_MAX)
    at_end = ((F.abs(F.col("_ray") * F.cos("_ang") - F.col("dx")) < res)
              & (F.abs(F.col("_ray") * F.sin("_ang") - F.col("dy")) < res))
    free = (F.col("range") < NEAR_FREE) | (seen & ~at_end & (F.col("_ray") > F.col("range")))
    return d.filter(free).select("frame_id", "dx", "dy")


def floor_plane(points: DataFrame, tries: int = 32, dist: float = 0.25, z_max: float = 0.3, min_up: float = 0.99,
                min_inliers: int = 100) -> DataFrame:
    """Floor plane per frame by consensus of seeded point triples, refitted to its inliers.

    Triples are the points of lowest hash, so a re-run picks the same ones.  All
    points of a frame are scored against all its candidate planes; nothing is
    sampled in the scoring.  Frames whose plane is not level or has too few
    inliers drop out.
    """
    low = points.filter(F.col("z") < z_max).select("frame_id", "x", "y", "z")
    w = Window.partitionBy("frame_id").orderBy("_h", "x", "y", "z")
    seeds = low.distinct().withColumn("_h", F.xxhash64("frame_id", "x", "y", "z"))
    seeds = seeds.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 3 * tries)
    seeds = seeds.withColumn("_try", F.floor((F.col("_rn") - 1) / 3)).withColumn("_k", (F.col("_rn") - 1) % 3)
    tri = seeds.groupBy("frame_id", "_try").agg(*[
        F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"{c}{k}") for k in range(3) for c in "xyz"]).filter("x2 IS NOT NULL")
    u = [F.col(f"{c}1") - F.col(f"{c}0") for c in "xyz"]
    v = [F.col(f"{c}2") - F.col(f"{c}0") for c in "xyz"]
    n = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    tri = tri.select("frame_id", "_try", "x0", "y0", "z0", *[c.alias(k) for c, k in zip(n, ("na", "nb", "nc"))])
    size = F.sqrt(F.col("na") * F.col("na") + F.col("nb") * F.col("nb") + F.col("nc") * F.col("nc"))
    tri = tri.withColumn("_size", size).filter(F.col("_size") > 1e-9)
    tri = tri.select("frame_id", "_try", *[(F.col(k) / F.col("_size")).alias(k) for k in ("na", "nb", "nc")], "x0", "y0", "z0")

    def gap():
        return F.abs(F.col("na") * (F.col("x") - F.col("x0")) + F.col("nb") * (F.col("y") - F.col("y0")) + F.col("nc") * (F.col("z") - F.col("z0")))

    votes = low.join(tri, "frame_id").groupBy("frame_id", "_try").agg(F.sum((gap() < dist).cast("long")).alias("_in"))
    best = votes.groupBy("frame_id").agg(F.max_by("_try", F.struct(F.col("_in"), -F.col("_try"))).alias("_try"))
    near_ = low.join(tri.join(best, ["frame_id", "_try"]), "frame_id").filter(gap() < dist)
    d = {c: F.col(c) - F.col(f"{c}0") for c in "xyz"}
    sums = near_.groupBy("frame_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(f"{c}0").alias(f"{c}0") for c in "xyz"], *[F.sum(d[c]).alias(f"s{c}") for c in "xyz"],
        *[F.sum(d[a] * d[b]).alias(f"s{a}{b}") for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")])

    def fit(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf["n"].to_numpy()[:, None]
            m = pdf[["sx", "sy", "sz"]].to_numpy() / k
            c = pdf[["sxx", "sxy", "sxz", "sxy", "syy", "syz", "sxz", "syz", "szz"]].to_numpy().reshape(-1, 3, 3)
            _, vec = np.linalg.eigh(c / k[:, :, None] - m[:, :, None] * m[:, None, :])
            nrm = vec[:, :, 0] * np.where(vec[:, 2:, 0] < 0, -1.0, 1.0)
            mean = m + pdf[["x0", "y0", "z0"]].to_numpy()
            yield pd.DataFrame({"frame_id": pdf["frame_id"], "a": nrm[:, 0], "b": nrm[:, 1], "c": nrm[:, 2],
                                "d": -(nrm * mean).sum(1), "inliers": pdf["n"]})

    out = sums.mapInPandas(fit, "frame_id long, a double, b double, c double, d double, inliers long")
    return out.filter((F.col("c") >= min_up) & (F.col("inliers") >= min_inliers))


def pixel(x, y, res: float, width: int = 2000) -> Column:
    """Pixel of a sub-map point (half a cell is added, then truncated)."""
    h = width / 2
    return F.struct((x / res + h + 0.5).cast("long").alias("px"), (y / res + h + 0.5).cast("long").alias("py"))


def hits_of(points: DataFrame, planes: DataFrame, low: float = 0.3, high: float = 1.2) -> DataFrame:
    """Obstacle points of each frame, to be marked as hits."""
    h = F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("c") * F.col("z") + F.col("d")
    far = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    return points.join(planes, "frame_id").filter((far <= RAY_MAX) & (h > low) & (h < high)).select("frame_id", "x", "y")


