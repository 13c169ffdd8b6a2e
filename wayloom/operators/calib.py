"""Calibration: beam intensities by expectation-maximisation, lidar–GNSS offset.

Readings are folded to counts per (beam, value, voxel) before anything else;
beam tables have at most 256 × 100 × 100 rows whatever the data size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.functions import rigid as N
from wayloom.operators.ordered import blocked, near, tidy
from wayloom.operators.sequence import TRAJ
from wayloom.session import cut

LEVELS = 100  # fixed value: intensity levels of the model


def measurements(points: DataFrame, voxel: float, max_range: float | None = None) -> DataFrame:
    """Counts per beam, value and voxel (``b, a, k, c``); values from 0 to 99."""
    d = points if max_range is None else points.filter(F.col("range") <= max_range)
    a = F.col("intensity").cast("int")
    key = F.struct(*[F.floor(F.col(c) / voxel).alias(f"v{c}") for c in "xyz"])
    d = d.filter((a >= 0) & (a < LEVELS))
    return d.groupBy(F.col("ring").alias("b"), a.alias("a"), key.alias("k")).agg(F.count(F.lit(1)).alias("c"))


def _bell(i, a, std: float) -> Column:
    return F.exp(-(i - a) * (i - a) / (2 * std * std)) / (std * math.sqrt(2 * math.pi))


def _levels() -> Column:
    return F.sequence(F.lit(0), F.lit(LEVELS - 1))


def start_model(m: DataFrame, std: float = 1.0, eps: float = 0.1) -> DataFrame:
    """First beam model (``b, a, i, p``): a bell around the reading, columns normalised."""
    beams = m.select("b").distinct()
    d = beams.withColumn("a", F.explode(_levels())).withColumn("i", F.explode(_levels()))
    d = d.withColumn("p", _bell(F.col("i"), F.col("a"), std) + eps)
    return _columns_to_one(d)


def _columns_to_one(d: DataFrame) -> DataFrame:
    w = Window.partitionBy("b", "a")  # one model column: 100 rows
    return d.withColumn("p", F.col("p") / F.sum("p").over(w))


def _cells(m: DataFrame, model: DataFrame, eps: float, precision: float) -> DataFrame:
    """Posterior of each voxel's true level (``k, i, q``)."""
    lg = model.groupBy("b", "a").agg(F.sort_array(F.collect_list(F.struct("i", F.log("p").alias("l")))).alias("_l"))  # 100 entries
    d = m.join(lg, ["b", "a"]).select("k", "c", F.explode("_l").alias("_e"))
    d = d.groupBy("k", F.col("_e.i").alias("i")).agg(F.sum(F.col("c") * F.col("_e.l")).alias("_s"))
    w = Window.partitionBy("k")  # 100 rows
    gap = F.col("_s") - F.max("_s").over(w)
    d = d.withColumn("q", F.when(gap >= math.log(precision) - math.log(LEVELS), F.exp(gap)).otherwise(F.lit(eps)))
    return d.select("k", "i", (F.col("q") / F.sum("q").over(w)).alias("q"))


def top_values(m: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent values of each beam (``b, a, c``), lower values first on a tie."""
    g = m.groupBy("b", "a").agg(F.sum("c").alias("c"))  # at most 100 rows per beam
    w = Window.partitionBy("b").orderBy(F.desc("c"), "a")
    return g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def calibrate_intensity(points: DataFrame, voxel: float = 0.5, max_range: float | None = None, iters: int = 5,
                        tol: float = 1e-4, std: float = 1.0, eps: float = 1e-3, precision: float = 1e-6,
                        min_cell: int = 3, top_n: int = 60, beams: int = 256) -> DataFrame:
    """Beam model (``b, a, i, p``): probability of true level ``i`` for reading ``a`` on beam ``b``.

    Expectation gives each voxel a level posterior from all its readings;
    maximisation counts posteriors per beam and reading over voxels with
    ``min_cell`` readings.  Readings 0–2, readings outside the beam's ``top_n``
    and beams from ``beams`` on keep their columns.  Stops when the model's mean
    change falls below ``tol``.
    """
    m = cut(measurements(points, voxel, max_range))
    model = cut(start_model(m, std))
    busy = cut(m.groupBy("k").agg(F.sum("c").alias("_n")).filter(F.col("_n") >= min_cell).select("k"))
    counted = cut(m.join(busy, "k", "left_semi"))
    open_cols = cut(top_values(counted, top_n).filter((F.col("a") > 2) & (F.col("b") < beams)).select("b", "a"))
    for _ in range(iters):
        q = _cells(m, model, eps, precision)
        n = counted.join(q, "k").groupBy("b", "a", "i").agg(F.sum(F.col("c") * F.col("q")).alias("_w"))
        d = model.join(n, ["b", "a", "i"], "left").join(open_cols.withColumn("_open", F.lit(True)), ["b", "a"], "left")
        w = Window.partitionBy("b", "a")
        total = F.coalesce(F.sum("_w").over(w), F.lit(0.0))
        new = F.when(total < 1, _bell(F.col("i"), F.col("a"), 1.0) + 0.001).otherwise(F.coalesce("_w", F.lit(0.0)) + 1e-12)
        d = d.withColumn("_new", F.when(F.coalesce("_open", F.lit(False)), new).otherwise(F.col("p")))
        nxt = cut(_columns_to_one(d.select("b", "a", "i", F.col("_new").alias("p"), F.col("p").alias("_old"))))
        change = nxt.groupBy("b").agg(F.sqrt(F.sum((F.col("p") - F.col("_old")) * (F.col("p") - F.col("_old")))).alias("_d"))
        moved = change.agg(F.avg("_d")).first()[0] or 0.0
        model = nxt.drop("_old")
        if moved < tol:
            break
    return model


def beam_map(model: DataFrame, min_p: float = 0.5, max_shift: int = 5) -> DataFrame:
    """Best true level per beam and reading (``b, a, best``); doubtful ones map to themselves."""
    g = model.groupBy("b", "a").agg(F.max(F.struct(F.col("p"), (-F.col("i")).alias("_i"))).alias("_m"))
    g = g.select("b", "a", F.col("_m.p").alias("p"), (-F.col("_m._i")).alias("i"))
    return g.select("b", "a", F.when((F.col("p") < min_p) | (F.abs(F.col("i") - F.col("a")) > max_shift), F.col("a"))
                    .otherwise(F.col("i")).alias("best"))


def apply_calibration(points: DataFrame, mapping: DataFrame, coef: float = 1.0, cap: int = 255,
                      max_range: float = 60.0) -> DataFrame:
    """Corrected ``intensity_vi``: mapped reading within range, times the coefficient, capped.

    The optimiser broadcasts the mapping if its size allows.
    """
    m = mapping.select(F.col("b").alias("ring"), F.col("a").alias("_a"), "best")
    near_ = (F.col("range") < max_range) & (F.col("intensity") < LEVELS)
    d = points.withColumn("_a", F.when(near_, F.col("intensity"))).join(m, ["ring", "_a"], "left")
    vi = F.coalesce("best", "intensity_vi" if "intensity_vi" in points.columns else "intensity")
    vi = F.least((vi * coef).cast("double").cast("int"), F.lit(cap))
    return d.drop("intensity_vi").withColumn("intensity_vi", vi).drop("_a", "best")


def intensity_coefficient(points: DataFrame, order: list[str], first: int = 500) -> DataFrame:
    """Global coefficient from the mean intensity of the first 500 ground points (one row).

    The bound is part of the rule; the first points are found by a top-k, not a sort.
    """
    low = points.filter((F.col("z") > -0.2) & (F.col("z") < 0.2)).orderBy(*order).limit(first)
    m = low.agg(F.count(F.lit(1)).alias("n"), F.avg("intensity").alias("mean"))
    few = (F.col("n") < first - 1) | (F.col("mean") < 3.0) | F.col("mean").isNull()
    return m.withColumn("coef", F.when(few, 2.0).when(F.col("mean") > 30, 1.0).otherwise(4.0 - 0.1 * F.col("mean")))


# --- lidar–GNSS offset ----------------------------------------------------------------

_TRI = [(r, c) for r in range(6) for c in range(r, 6)]


def _plane(p: str) -> Column:
    return P.from_yaw(F.col(f"{p}.x"), F.col(f"{p}.y"), F.lit(0.0), P.yaw_deg(p) * P.RAD)


def calibrate_offset(keyframes: DataFrame, iters: int = 50, delta: float = 0.01, min_pairs: int = 10,
                     max_deg: float = 3.0, max_shift: float = 0.5, order: str = "id",
                     width: float = 1_000_000.0) -> DataFrame:
    """Offset pose between lidar and GNSS from consecutive well-fixed frames (one row).

    Frames carry ``usable`` (fixed fix, inlier, valid heading), ``matching_pose``
    and ``gps_pose``.  Each round sums one 6×6 system over all pairs; only its 29
    numbers reach the driver.  Pairs above the robust limit are dropped for the
    second half.  ``accepted`` is false for an offset beyond 3° or 0.5 m.
    """
    d = keyframes.select(*TRAJ, order, F.col("usable").alias("_u"), _plane("matching_pose").alias("_m"), _plane("gps_pose").alias("_g"))
    d = near(blocked(d, TRAJ, [order], width), TRAJ, 0, 1, {
        "_u2": lambda w: F.lead("_u").over(w), "_m2": lambda w: F.lead("_m").over(w), "_g2": lambda w: F.lead("_g").over(w)})
    d = tidy(d).filter(F.col("_u") & F.col("_u2"))
    rel = d.select(P.between("_m", "_m2").alias("meas"), P.between("_g", "_g2").alias("gnss"))
    rel = cut(rel.select(*[F.col("meas")[f].alias(f"m_{f}") for f in P.FIELDS], *[F.col("gnss")[f].alias(f"g_{f}") for f in P.FIELDS]))
    names = [f"h{k}" for k in range(21)] + [f"b{k}" for k in range(6)] + ["chi2", "n"]
    x = np.array([[0.0, 0, 0, 0, 0, 0, 1.0]])
    n = 0
    spark = keyframes.sparkSession
    for rnd in range(iters):
        hard = rnd >= iters // 2

        def fold(batches, x=x, hard=hard):
            for pdf in batches:
                if not len(pdf):
                    continue
                meas, gnss = N.from_frame(pdf, "m_"), N.from_frame(pdf, "g_")

                def error(at):
                    at = np.repeat(at, len(pdf), 0)
                    return N.minimal(N.between(meas, N.compose(N.between(at, gnss), at))) * np.array([1, 1, 1, 2, 2, 2.0])

                e0 = error(x)
                chi2 = (e0 * e0).sum(1)
                keep = (chi2 <= delta).astype(float) if hard else 1.0 / (1.0 + chi2 / delta**2)
                jac = np.empty((len(pdf), 6, 6))
                for k in range(6):
                    inc = np.zeros((1, 6))
                    inc[0, k] = 1e-6
                    jac[:, :, k] = (error(N.retract(x, inc)) - e0) / 1e-6
                h = np.einsum("nik,n,nil->kl", jac, keep, jac)
                b = np.einsum("nik,n,ni->k", jac, keep, e0)
                yield pd.DataFrame([[*[h[r, c] for r, c in _TRI], *b, (chi2 * keep).sum(), (keep > 0).sum()]], columns=names).astype(float)

        row = rel.mapInPandas(fold, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c).alias(c) for c in names]).first()
        n = int(row["n"] or 0)
        if n < min_pairs:
            break
        h = np.zeros((6, 6))
        for k, (r, c) in enumerate(_TRI):
            h[r, c] = h[c, r] = row[f"h{k}"]
        b = np.array([row[f"b{k}"] for k in range(6)])
        inc = -np.linalg.solve(h + np.eye(6) * (1e-9 + 1e-6 * np.trace(h)), b)[None]
        x = N.retract(x, inc)
        if np.abs(inc).max() < 1e-8 and hard:
            break
    x[0, 2] = 0.0
    turn = 2 * math.degrees(math.atan2(np.linalg.norm(x[0, 3:6]), abs(x[0, 6])))
    fine = n >= min_pairs and turn <= max_deg and abs(x[0, 0]) <= max_shift and abs(x[0, 1]) <= max_shift
    return spark.range(1).select(P.make(*[F.lit(float(v)) for v in x[0]]).alias("offset"), F.lit(turn).alias("angle_deg"),
                                 F.lit(n).alias("pairs"), F.lit(bool(fine)).alias("accepted"))
