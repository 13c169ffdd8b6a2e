"""Quality figures and run reports."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.functions import geodesy as G
from wayloom.operators.ordered import order_statistics

# The origin used without any fix, and the one used when no log settled.
NO_FIX_ORIGIN = (667220.60791066091, 3523126.7262191805, 0.0, 50)
UNSET_ORIGIN = (443684.11088364013, 4436651.256764573, 42.694816589355469, 50)


def bounded(df: DataFrame, bound: float, cols: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Drop rows with an implausible coordinate."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & (F.abs(F.col(c)) <= bound)
    return df.filter(ok)


def valid_path(path: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Rows whose GNSS position is not zero."""
    return path.filter((F.abs("x") > eps) | (F.abs("y") > eps))


def scene_type(bags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Census of GNSS quality over logs (``name, quality``) and the scene class it implies.

    Names starting with ``d`` build the map, with ``z`` validate it.
    """
    kind = F.substring("name", 1, 1)
    q = F.col("quality")

    def count(letter, cond):
        return F.count(F.when((kind == letter) & cond, 1))

    any_log = kind.isin("d", "z")
    g = bags.groupBy(*by).agg(
        count("d", F.lit(True)).alias("d_n"), count("d", q > 0).alias("d_good"), count("d", q == 0).alias("d_bad"),
        count("z", F.lit(True)).alias("z_n"), count("z", q > 0).alias("z_good"), count("z", q == 0).alias("z_bad"),
        F.count(F.when(any_log & (q <= -1), 1)).alias("no_gps"),
        F.max(F.when(kind == "d", q)).alias("best"))
    c = {n: F.col(n) for n in ("d_n", "d_good", "d_bad", "z_n", "z_good", "z_bad", "no_gps")}
    outdoor = (((c["d_good"] + c["d_bad"] == c["d_n"]) & (c["d_good"] != 0))
               | ((c["z_good"] + c["z_bad"] == c["z_n"]) & (c["z_good"] != 0))
               | (c["d_good"] == c["d_n"]) | (c["z_good"] == c["z_n"]))
    scene = (F.when(c["no_gps"] > 0, "Indoor")
             .when(((c["d_bad"] > 0) | (c["z_bad"] > 0)) & (c["d_good"] == 0), "Half Indoor")
             .when(((c["d_good"] == 0) & (c["d_bad"] == 0)) | ((c["z_good"] == 0) & (c["z_bad"] == 0)), "Indoor")
             .when(outdoor, "Outdoor").otherwise("Half Indoor"))
    return g.withColumn("scene", scene)


def choose_origin(bags: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored origin, else the first log's (by ``seq``) with any fix, else a default.

    ``bags`` carries ``seq, name, quality, x, y, z, zone``; both aggregates are
    single rows.
    """
    row = F.struct("x", "y", "z", "zone")
    first = bags.agg(F.min_by(row, F.when(F.col("quality") > -1, F.col("seq"))).alias("_first"),
                     F.max(F.when(F.substring("name", 1, 1) == "d", F.col("quality"))).alias("_best"))
    kept = stored.agg(F.first(F.struct("x", "y", "z", "zone")).alias("_kept"))

    def const(v):
        return F.struct(*[F.lit(a).alias(n) for a, n in zip(v, ("x", "y", "z", "zone"))])

    d = first.crossJoin(F.broadcast(kept))  # one row each
    pick = (F.when(F.col("_kept").isNotNull(), F.col("_kept"))
            .when(F.coalesce(F.col("_best"), F.lit(-1)) <= -1, const(NO_FIX_ORIGIN))
            .otherwise(F.coalesce(F.col("_first"), const(UNSET_ORIGIN))))
    src = (F.when(F.col("_kept").isNotNull(), "stored").when(F.coalesce(F.col("_best"), F.lit(-1)) <= -1, "no fix")
           .when(F.col("_first").isNotNull(), "first log").otherwise("default"))
    return d.select(pick.alias("o"), src.alias("source")).select("o.*", "source")


def checked_ratio(pairs: DataFrame, keyframes: DataFrame, by: str = "trajectory_id") -> DataFrame:
    """Share of validation frames found in any pair, per trajectory and overall (key NULL)."""
    hit = pairs.select(F.col("id_first").alias("id")).distinct().withColumn("_hit", F.lit(1))
    d = keyframes.select("id", by).join(hit, "id", "left")
    return (d.rollup(by).agg(F.count(F.lit(1)).alias("frames"), F.count("_hit").alias("checked"))
            .withColumn("ratio", F.col("checked") / F.col("frames")))


def run_report(runs: DataFrame) -> DataFrame:
    """Success rate and linear fits of time against size and area over all runs (one row)."""
    ok = F.col("status") == "ok"
    t = F.when(ok, F.col("seconds"))
    return runs.agg(F.count(F.lit(1)).alias("runs"), F.avg(ok.cast("double")).alias("success_rate"),
                    F.regr_slope(t, F.col("size")).alias("size_slope"),
                    F.regr_intercept(t, F.col("size")).alias("size_intercept"),
                    F.regr_slope(t, F.col("area")).alias("area_slope"),
                    F.regr_intercept(t, F.col("area")).alias("area_intercept"))


def status_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def poly_fit(df: DataFrame, x: str, y: str, degree: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares polynomial per key: power sums in one aggregate, a small solve per key row.

    The abscissa is centred and scaled first, so the normal matrix stays well
    conditioned; ``coef`` belongs to ``u = (x − shift) / scale``, lowest power first.
    """
    m = df.groupBy(*by).agg(F.avg(x).alias("shift"), F.max(F.abs(x)).alias("_m"), F.stddev_pop(x).alias("_sd"))
    m = m.select(*by, "shift", F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0)).alias("scale"))
    d = df.join(m, list(by)) if by else df.crossJoin(F.broadcast(m))  # without keys: one row
    u = (F.col(x) - F.col("shift")) / F.col("scale")
    sums = [F.sum(F.pow(u, F.lit(float(k)))).alias(f"s{k}") for k in range(2 * degree + 1)]
    sums += [F.sum(F.pow(u, F.lit(float(k))) * F.col(y)).alias(f"t{k}") for k in range(degree + 1)]
    g = d.groupBy(*by, "shift", "scale").agg(*sums)
    g = g.select(*by, "shift", "scale", F.array(*[f"s{k}" for k in range(2 * degree + 1)]).alias("s"),
                 F.array(*[f"t{k}" for k in range(degree + 1)]).alias("t"))
    n = degree + 1

    def solve(batches):
        for pdf in batches:
            if len(pdf):
                s, t = np.stack(pdf["s"].to_numpy()), np.stack(pdf["t"].to_numpy())
                idx = np.add.outer(np.arange(n), np.arange(n))
                coef = [np.linalg.lstsq(a[idx], b, rcond=None)[0] for a, b in zip(s, t)]
                yield pd.DataFrame({**{k: pdf[k] for k in by}, "shift": pdf["shift"], "scale": pdf["scale"], "coef": coef})

    head = ", ".join(f"{k} {dict(g.dtypes)[k]}" for k in by)
    return g.mapInPandas(solve, (head + ", " if head else "") + "shift double, scale double, coef array<double>")


def poly_eval(coef, shift, scale, x):
    """Value of a fitted polynomial at ``x`` (columns)."""
    u = (x - shift) / scale
    return F.aggregate(F.reverse(coef), F.lit(0.0), lambda acc, c: acc * u + c)


def error_histogram(errors: DataFrame, col: str = "err", bins: int = 200, lo: float = 0.0, hi: float = 8.0) -> DataFrame:
    """Normalised histogram: density per non-empty bin; the last bin is closed."""
    step = (hi - lo) / bins
    b = F.least(F.floor((F.col(col) - lo) / step), F.lit(bins - 1))
    g = errors.filter(F.col(col).between(lo, hi)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("_t"))  # one row
    return g.crossJoin(F.broadcast(total)).select("bin", "n", (F.col("n") / F.col("_t") / step).alias("density"))


def align_paths(fused: DataFrame, gps: DataFrame, opt: DataFrame, antenna: tuple[float, float, float],
                origin: tuple[float, float]) -> DataFrame:
    """Fused, GNSS and optimised paths in one local frame with a source tag.

    ``fused``/``gps`` carry ``id, lon, lat, height, heading``; the GNSS path is
    moved by the antenna arm.  ``opt`` carries ``id, x, y``.
    """
    def local(d, name, shift):
        at = (G.shift_lonlat("lon", "lat", "height", "heading", *antenna) if shift
              else F.struct(F.col("lon").alias("lon"), F.col("lat").alias("lat")))
        d = d.withColumn("_p", at).withColumn("_u", G.to_utm(F.col("_p.lon"), F.col("_p.lat")))
        return d.select(F.lit(name).alias("source"), "id", (F.col("_u.x") - origin[0]).alias("x"),
                        (F.col("_u.y") - origin[1]).alias("y"))

    return (local(fused, "fused", False).unionByName(local(gps, "gps", True))
            .unionByName(opt.select(F.lit("optimised").alias("source"), "id", "x", "y")))


def shift_height(keyframes: DataFrame, poses: Sequence[str], noise: str = "gps_noise0", tiny: float = 1e-7,
                 limit: float = 10.0, ref: str | None = None) -> DataFrame:
    """Lower all poses by the mean height of the near-zero-noise frames.

    Only when that mean exceeds ``limit`` in size and more than two frames enter
    it (the original's counter starts at one).
    """
    ref = ref or poses[-1]
    sure = F.when(F.col(noise) < tiny, F.col(f"{ref}.z"))
    m = keyframes.agg(F.avg(sure).alias("_mean"), F.count(sure).alias("_n"))  # one row
    by = F.when((F.abs("_mean") > limit) & (F.col("_n") + 1 > 3), F.col("_mean")).otherwise(F.lit(0.0))
    d = keyframes.crossJoin(F.broadcast(m)).withColumn("_by", by)
    for p in poses:
        d = d.withColumn(p, F.col(p).withField("z", F.col(f"{p}.z") - F.col("_by")))
    return d.drop("_mean", "_n", "_by")


def chi2_summary(edges: DataFrame, by: Sequence[str] = (), chi2: str = "chi2") -> DataFrame:
    """Count, mean, median, 10 % and 90 % elements and maximum of active edges' chi²."""
    d = edges.filter(F.col("active")) if "active" in edges.columns else edges
    keys = list(by) or ["_all"]
    if not by:
        d = d.withColumn("_all", F.lit(1))
    base = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(chi2).alias("mean"), F.max(chi2).alias("max"))
    at = order_statistics(d, keys, chi2, {"median": lambda n: F.floor(n / 2), "p10": lambda n: F.floor(n * 0.1),
                                          "p90": lambda n: F.floor(n * 0.9)})
    return base.join(at, keys).drop("_all")


def adaptive_threshold(edges: DataFrame, th: float, ratio: float = 0.1, doublings: int = 3,
                       chi2: str = "chi2", by: Sequence[str] = ()) -> DataFrame:
    """Double the threshold until more than ``ratio`` of the edges are inliers, ``doublings`` times at most.

    All candidate thresholds are counted in one pass.
    """
    n = F.count(F.lit(1))
    tries = [th * 2**k for k in range(doublings)]
    aggs = [F.count(F.when(F.col(chi2) <= t, 1)).alias(f"_i{k}") for k, t in enumerate(tries)]
    d = edges.groupBy(*by).agg(n.alias("n"), *aggs)
    out, inl = F.lit(th * 2**doublings), F.col(f"_i{doublings - 1}")
    for k in reversed(range(doublings)):
        hit = F.col(f"_i{k}") > ratio * F.col("n")
        out, inl = F.when(hit, F.lit(tries[k])).otherwise(out), F.when(hit, F.col(f"_i{k}")).otherwise(inl)
    return d.select(*by, "n", out.alias("threshold"), inl.alias("inliers"), (inl / F.col("n")).alias("inlier_ratio"))


def gps_inlier_stats(edges: DataFrame, th: float, by: Sequence[str] = ()) -> DataFrame:
    """Inliers, outliers, inlier rate, and how many fixes were nominally good."""
    inl = F.count(F.when(F.col("chi2") <= th, 1))
    return edges.groupBy(*by).agg(inl.alias("inliers"), F.count(F.when(F.col("chi2") > th, 1)).alias("outliers"),
                                  (inl / F.count(F.lit(1))).alias("inlier_ratio"),
                                  F.count(F.when(F.col("status") == 4, 1)).alias("good_fixes"))


def flag_outliers(edges: DataFrame, th: float, chi2: str = "chi2") -> DataFrame:
    """Mark edges above the threshold inactive; nothing is deleted."""
    return edges.withColumn("active", F.col(chi2) <= th)


def drop_degenerate(keyframes: DataFrame, th: float = 150.0, value: str = "degeneracy") -> DataFrame:
    return keyframes.filter(F.col(value) > th)


def matching_quality(matches: DataFrame, th: float) -> DataFrame:
    """Six noise terms from the registration score, and the degeneracy value (100 or 200)."""
    k = F.lit(0.3) / F.col("score")
    noise = F.array(*[k * 0.05] * 3, *[k * 0.008] * 3)
    flat = F.col("lambda_max") / F.col("lambda_min") > th
    return matches.withColumn("noise", noise).withColumn("degeneracy", F.when(flat, 100.0).otherwise(200.0))
