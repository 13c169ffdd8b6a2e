"""Point filters and cell, voxel, tile aggregations.

All aggregations are plain ``groupBy`` with algebraic aggregates, so each task
folds its own rows before the shuffle and a crowded cell costs one row per task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayloom.functions import pose as P
from wayloom.functions.cells import to_i16, trunc
from wayloom.operators.ordered import SLICE, blocked

GAUSS_MIN_P = 1e-5  # fixed value: floor of a point's likelihood
MIN_LOGP = math.log(GAUSS_MIN_P)


# --- filters and row mappings -------------------------------------------------

def within_range(points: DataFrame, r: float) -> DataFrame:
    return points.filter(F.hypot("x", "y") <= r)


def above(points: DataFrame, z: float) -> DataFrame:
    return points.filter(F.col("z") > z)


def z_band(points: DataFrame, lo: float, hi: float) -> DataFrame:
    return points.filter((F.col("z") > lo) & (F.col("z") < hi))


def ring_band(points: DataFrame, lo: int, hi: int) -> DataFrame:
    return points.filter((F.col("ring") >= lo) & (F.col("ring") < hi))


def valid_returns(points: DataFrame, lo: float = 1.0, hi: float = 60.0, rng: str = "range") -> DataFrame:
    return points.filter(F.col(rng).isNotNull() & (F.col(rng) >= lo) & (F.col(rng) <= hi))


def in_box(points: DataFrame, cx: float, cy: float, size: float) -> DataFrame:
    """Half-open square box around a centre."""
    h = size / 2
    return points.filter((F.col("x") >= cx - h) & (F.col("x") < cx + h)
                         & (F.col("y") >= cy - h) & (F.col("y") < cy + h))


def offset(points: DataFrame, dx: float, dy: float) -> DataFrame:
    return points.withColumn("x", F.col("x") - dx).withColumn("y", F.col("y") - dy)


def to_map_points(points: DataFrame) -> DataFrame:
    """Raw timed points to map points; rows with a missing coordinate drop out."""
    ok = F.lit(True)
    for c in "xyz":
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    zero = F.lit(0.0)
    return points.filter(ok).select("frame_id", "x", "y", "z", zero.alias("height"), zero.alias("range"),
                                    "intensity", F.lit(0).alias("intensity_vi"), "ring", F.lit(0).alias("type"))


def block_sample(df: DataFrame, by: Sequence[str], order: Sequence[str], block: int, every: int = 5,
                 width: float = SLICE) -> DataFrame:
    """One block of ``block`` consecutive rows out of every ``every`` blocks."""
    d = blocked(df, by, order, width)
    return d.filter(F.floor((F.col("_rn") - 1) / block) % every == 0).drop("_rn", "_block")


# --- voxels -------------------------------------------------------------------

def _voxel(size: float) -> list[Column]:
    return [trunc(F.col(c) / size).alias(f"v{c}") for c in "xyz"]


def voxel_first(points: DataFrame, size: float, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """First point (by ``order``) of every voxel; truncating cell index."""
    g = points.select(*[F.col(c) for c in by], *_voxel(size), F.struct(*points.columns).alias("_row"),
                      F.struct(*order).alias("_ord"))
    g = g.groupBy(*by, "vx", "vy", "vz").agg(F.min_by("_row", "_ord").alias("_row"))
    return g.select("_row.*")


def voxel_centroid(points: DataFrame, size: float, by: Sequence[str] = ()) -> DataFrame:
    """Mean point of every voxel (floor cells)."""
    keys = [F.floor(F.col(c) / size).alias(f"v{c}") for c in "xyz"]
    extra = [c for c in ("intensity",) if c in points.columns]
    return (points.groupBy(*by, *keys)
            .agg(*[F.avg(c).alias(c) for c in ("x", "y", "z", *extra)], F.count(F.lit(1)).alias("n")))


def voxel_sums(points: DataFrame, size: float, by: Sequence[str] = ()) -> DataFrame:
    """Counts, first and second moments per voxel, about the voxel's corner."""
    d = points.select(*by, *[F.floor(F.col(c) / size).alias(f"v{c}") for c in "xyz"], "x", "y", "z")
    rel = {c: F.col(c) - F.col(f"v{c}") * size for c in "xyz"}
    pairs = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    return d.groupBy(*by, "vx", "vy", "vz").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(rel[c]).alias(f"s{c}") for c in "xyz"],
        *[F.sum(rel[a] * rel[b]).alias(f"s{a}{b}") for a, b in pairs])


def _floor_and_invert(floor_ratio: float):
    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            cov = np.stack(pdf["cov"].to_numpy()).reshape(-1, 3, 3)
            val, vec = np.linalg.eigh(cov)
            low = np.maximum(val[:, 2:3] * floor_ratio, 1e-12)
            val = np.maximum(val, low)
            fixed = np.einsum("nij,nj,nkj->nik", vec, val, vec)
            inv = np.einsum("nij,nj,nkj->nik", vec, 1.0 / val, vec)
            pdf = pdf.assign(cov=list(fixed.reshape(-1, 9)), icov=list(inv.reshape(-1, 9)))
            yield pdf
    return run


def voxel_gaussians(points: DataFrame, size: float, min_n: int = 6, floor_ratio: float = 0.01,
                    by: Sequence[str] = ()) -> DataFrame:
    """Per voxel: count, mean, covariance with floored eigenvalues, and its inverse."""
    s = voxel_sums(points, size, by).filter(F.col("n") >= min_n)
    n = F.col("n").cast("double")

    def cov(a, b):
        k = "".join(sorted((a, b)))
        return (F.col(f"s{k}") - F.col(f"s{a}") * F.col(f"s{b}") / n) / (n - 1)

    s = s.select(*by, "vx", "vy", "vz", "n",
                 F.array(*[F.col(f"v{c}") * size + F.col(f"s{c}") / n for c in "xyz"]).alias("mean"),
                 F.array(*[cov(a, b) for a in "xyz" for b in "xyz"]).alias("cov"))
    schema = T.StructType([*s.schema.fields, T.StructField("icov", T.ArrayType(T.DoubleType()))])
    return s.mapInPandas(_floor_and_invert(floor_ratio), schema)


# --- cells --------------------------------------------------------------------

def _layer(z0) -> Column:
    z0 = F.lit(float(z0)) if isinstance(z0, (int, float)) else z0
    return F.when(F.col("z") < z0, 0).otherwise(1)


def cell_stats(points: DataFrame, res: float, z0, by: Sequence[str] = ()) -> DataFrame:
    """Altitude and intensity mean/variance (population form) per cell and height layer."""
    return points.groupBy(*by, trunc(F.col("y") / res).alias("row"), trunc(F.col("x") / res).alias("col"),
                          _layer(z0).alias("layer")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("z").alias("mean_alt"), F.var_pop("z").alias("var_alt"),
        F.avg("intensity").alias("mean_int"), F.var_pop("intensity").alias("var_int"))


def cell_pyramid(points: DataFrame, res0: float, depth: int, z0, by: Sequence[str] = ()) -> DataFrame:
    """:func:`cell_stats` at resolutions ``res0·2^level``.

    Points are folded once at the finest level; only cell rows are expanded to
    the other levels (truncation halves exactly).
    """
    i = F.col("intensity").cast("double")
    z = F.col("z")
    base = points.groupBy(*by, trunc(F.col("y") / res0).alias("row"), trunc(F.col("x") / res0).alias("col"),
                          _layer(z0).alias("layer")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(z).alias("a1"), F.sum(z * z).alias("a2"),
        F.sum(i).alias("i1"), F.sum(i * i).alias("i2"))
    up = base.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth - 1))))
    scale = F.pow(F.lit(2.0), F.col("level"))
    g = up.groupBy(*by, "level", trunc(F.col("row") / scale).alias("row"), trunc(F.col("col") / scale).alias("col"),
                   "layer").agg(*[F.sum(c).alias(c) for c in ("n", "a1", "a2", "i1", "i2")])
    n = F.col("n")
    return g.select(*by, "level", "row", "col", "layer", "n", (F.col("a1") / n).alias("mean_alt"),
                    F.greatest(F.lit(0.0), F.col("a2") / n - (F.col("a1") / n) * (F.col("a1") / n)).alias("var_alt"),
                    (F.col("i1") / n).alias("mean_int"),
                    F.greatest(F.lit(0.0), F.col("i2") / n - (F.col("i1") / n) * (F.col("i1") / n)).alias("var_int"))


def point_logp() -> Column:
    """Log-likelihood of a point under the joined cell, floored."""
    da, di = F.col("mean_alt") - F.col("z"), F.col("mean_int") - F.col("intensity")
    va, vi = F.col("var_alt") + 0.1, F.col("var_int") + 0.5
    p = -F.log(va) - da * da / va - F.log(vi) - di * di / vi
    return F.when(F.col("n") >= 2, F.greatest(p, F.lit(MIN_LOGP))).otherwise(F.lit(MIN_LOGP))


def scan_logp(points: DataFrame, cells: DataFrame, search: int, res: float, z0,
              by: Sequence[str] = (), cell_by: Sequence[str] = ()) -> DataFrame:
    """Mean log-likelihood of a scan at every cell offset within ``±search``.

    ``cells`` holds one row per (``cell_by``, row, col, layer); a point without a
    usable cell takes the floor.
    """
    offs = F.sequence(F.lit(-search), F.lit(search))
    d = points.select(*{*by, *cell_by}, "z", "intensity", _layer(z0).alias("layer"),
                      trunc(F.col("y") / res).alias("_r"), trunc(F.col("x") / res).alias("_c"))
    d = d.withColumn("d_row", F.explode(offs)).withColumn("d_col", F.explode(offs))
    d = d.withColumn("row", F.col("_r") + F.col("d_row")).withColumn("col", F.col("_c") + F.col("d_col"))
    usable = cells.filter(F.col("n") >= 2)
    hit = d.join(usable, [*cell_by, "row", "col", "layer"], "left")
    return hit.groupBy(*by, "d_row", "d_col").agg(F.avg(F.coalesce(point_logp(), F.lit(MIN_LOGP))).alias("logp"))


def gmm_split(points: DataFrame, size: float, ground: DataFrame | None = None, cut_above: float = 2.0,
              ground_height: float = 0.0, min_n: int = 6) -> DataFrame:
    """Cell statistics below and above ``ground + 2``, weights fixed at 50/50, stored in centimetres.

    ``ground`` may give a height per cell (``row, col, ground``); cells without
    one use ``ground_height``.
    """
    d = points.withColumn("row", F.floor(F.col("y") / size)).withColumn("col", F.floor(F.col("x") / size))
    if ground is not None:
        d = d.join(ground.select("row", "col", "ground"), ["row", "col"], "left")
        cut = F.coalesce("ground", F.lit(ground_height)) + cut_above
    else:
        cut = F.lit(ground_height + cut_above)
    low = F.col("z") < cut
    aggs = [F.count(F.lit(1)).alias("n")]
    for tag, cond in (("1", low), ("2", ~low)):
        aggs += [F.count(F.when(cond, 1)).alias(f"n{tag}"), F.avg(F.when(cond, F.col("z"))).alias(f"ua{tag}"),
                 F.var_pop(F.when(cond, F.col("z"))).alias(f"sa{tag}"),
                 F.avg(F.when(cond, F.col("intensity"))).alias(f"ur{tag}"),
                 F.var_pop(F.when(cond, F.col("intensity"))).alias(f"sr{tag}")]
    g = d.groupBy("row", "col").agg(*aggs).filter(F.col("n") >= min_n)
    one, two = F.col("n1") > 1, F.col("n2") > 1
    out = [F.col("row"), F.col("col"), F.col("n"),
           F.when(~two, 100).when(one, 50).otherwise(0).cast("int").alias("w1"),
           F.when(~two, 0).when(one, 50).otherwise(100).cast("int").alias("w2")]
    for tag, ok in (("1", one), ("2", two)):
        for name, scale in (("ua", 100), ("sa", 100), ("ur", 1), ("sr", 1)):
            # rounding first keeps exact products from truncating one short
            out.append(F.when(ok, to_i16(F.round(F.col(f"{name}{tag}") * scale, 6))).otherwise(0).alias(f"{name}{tag}"))
    return g.select(*out)


def choose_min_points(points: DataFrame, size: float) -> DataFrame:
    """Smallest point count whose share of occupied cells lies in [0.1, 2.1) %, minus one.

    The largest count is left out, as the reference's loop stops before it; one
    row, NULL when no count qualifies.
    """
    cells = points.groupBy(F.floor(F.col("y") / size).alias("row"), F.floor(F.col("x") / size).alias("col")).agg(
        F.count(F.lit(1)).alias("n"))
    hist = cells.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    tot = hist.agg(F.sum("c").alias("_cells"), F.max("n").alias("_max"))
    share = F.col("c") * 100.0 / F.col("_cells")
    # one total row; count is bounded by one row, so the broadcast is fixed in size
    return (hist.join(F.broadcast(tot)).agg(
        (F.min(F.when((F.col("n") < F.col("_max")) & (share >= 0.1) & (share < 2.1), F.col("n"))) - 1)
        .alias("min_points")))


def bounds(df: DataFrame, pad: float, res: float, by: Sequence[str] = ()) -> DataFrame:
    """Padded bounding box and the rows/columns of a grid over it."""
    b = df.groupBy(*by).agg(*[f(c).alias(f"{n}_{c}") for c in "xy" for f, n in ((F.min, "min"), (F.max, "max"))])
    b = b.select(*by, *[(F.col(f"min_{c}") - pad).alias(f"min_{c}") for c in "xy"],
                 *[(F.col(f"max_{c}") + pad).alias(f"max_{c}") for c in "xy"])
    return b.withColumn("cols", F.floor((F.col("max_x") - F.col("min_x")) / res) + 1).withColumn(
        "rows", F.floor((F.col("max_y") - F.col("min_y")) / res) + 1)


# --- tiles and assembled maps ---------------------------------------------------

def tiles(points: DataFrame, size: float, leaf: float, min_n: int = 10) -> DataFrame:
    """Tile index, per-tile voxel thinning, and removal of tiles with fewer than ``min_n`` points.

    The limit applies to the raw and to the thinned count.
    """
    d = points.withColumn("tile_x", F.floor(F.col("x") / size)).withColumn("tile_y", F.floor(F.col("y") / size))
    thin = voxel_centroid(d, leaf, ["tile_x", "tile_y"])
    per = thin.groupBy("tile_x", "tile_y").agg(F.sum("n").alias("_raw"), F.count(F.lit(1)).alias("_thin"))
    keep = per.filter((F.col("_raw") >= min_n) & (F.col("_thin") >= min_n)).select("tile_x", "tile_y")
    out = thin.join(keep, ["tile_x", "tile_y"], "left_semi")
    return out.withColumn("tile", F.concat_ws("_", F.col("tile_y"), F.col("tile_x"), F.lit(int(size))))


def write_tiles(tiled: DataFrame, path: str) -> None:
    tiled.write.mode("overwrite").partitionBy("tile").parquet(path)


def world_points(keyframes: DataFrame, points: DataFrame, pose: str = "pose") -> DataFrame:
    """Move each point by its frame's pose."""
    d = points.join(keyframes.select(F.col("id").alias("frame_id"), "trajectory_id", F.col(pose).alias("_pose")),
                    "frame_id")
    wx, wy, wz = P.transform(F.col("_pose"), "x", "y", "z")
    rest = [c for c in points.columns if c not in ("frame_id", "x", "y", "z")]
    return d.select("trajectory_id", "frame_id", wx.alias("x"), wy.alias("y"), wz.alias("z"), *rest)


def assemble_map(keyframes: DataFrame, points: DataFrame, pose: str = "pose", leaf: float = 0.1,
                 chunk: int = 2000, width: float = 1_000_000.0) -> DataFrame:
    """World cloud per trajectory and chunk of frames, thinned per frame and again per chunk."""
    numbered = blocked(keyframes, ["trajectory_id"], ["id"], width)
    chunks = numbered.select(F.col("id").alias("frame_id"), F.floor((F.col("_rn") - 1) / chunk).alias("chunk"))
    world = world_points(keyframes, points, pose)
    per_frame = voxel_centroid(world, leaf, ["trajectory_id", "frame_id"]).drop("n", "vx", "vy", "vz")
    return voxel_centroid(per_frame.join(chunks, "frame_id"), leaf, ["trajectory_id", "chunk"])
