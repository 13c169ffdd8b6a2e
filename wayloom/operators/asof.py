"""Time-aware joins.

All of them tag and union the two sides, look left and right inside a time slice,
and take what lies beyond the slice from one summary row per slice.  There is no
range condition in any join, and no task sees a whole trajectory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators.ordered import SLICE, blocked, near, slice_of, tidy


def bracket(q: DataFrame, s: DataFrame, by: Sequence[str], t: str = "t", width: float = SLICE,
            ties: Sequence[str] = (), strict_before: bool = True) -> DataFrame:
    """Add ``_prev`` and ``_next`` (structs of the sample columns) to every query row.

    ``_prev`` is the last sample before the query (at or before it when
    ``strict_before`` is false), ``_next`` the first sample at or after it.
    ``ties`` are sample columns that order samples of equal time.
    """
    by = list(by)
    keys = [*by, "_slice"]
    payload = F.struct(*[F.col(c) for c in s.columns])
    left = q.select(*[F.col(c) for c in by], F.col(t).cast("double").alias("_at"), F.lit(0).alias("_tag"),
                    F.struct(*[F.col(c) for c in q.columns]).alias("_query"))
    right = s.select(*[F.col(c) for c in by], F.col(t).cast("double").alias("_at"), F.lit(1).alias("_tag"),
                     payload.alias("_sample"), *[F.col(c).alias(f"_tie_{c}") for c in ties])
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_slice", slice_of("_at", width))
    tie = [f"_tie_{c}" for c in ties]
    tag = F.col("_tag") if strict_before else -F.col("_tag")
    fwd = Window.partitionBy(*keys).orderBy("_at", tag, *tie).rowsBetween(Window.unboundedPreceding, 0)
    back = (Window.partitionBy(*keys).orderBy(F.desc("_at"), F.desc("_tag"), *[F.desc(c) for c in tie])
            .rowsBetween(Window.unboundedPreceding, 0))
    inside = both.select("*", F.last("_sample", True).over(fwd).alias("_p"),
                         F.last("_sample", True).over(back).alias("_n")).filter(F.col("_tag") == 0)
    place = F.struct("_at", *tie)
    sampled = F.when(F.col("_tag") == 1, place)
    ends = both.groupBy(*keys).agg(F.max_by("_sample", sampled).alias("_last"),
                                   F.min_by("_sample", sampled).alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*by).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, F.last("_last", True).over(earlier).alias("_cp"),
                       F.last("_first", True).over(later).alias("_cn"))
    out = inside.join(ends, keys)
    return out.select("_query.*", F.coalesce("_p", "_cp").alias("_prev"), F.coalesce("_n", "_cn").alias("_next"))


def _fraction(t: str) -> Column:
    gap = F.col(f"_next.{t}") - F.col(f"_prev.{t}")
    return (F.col(t) - F.col(f"_prev.{t}")) / gap


def _sample_columns(s: DataFrame, by, t, prefix, source: str, skip=()) -> list[Column]:
    return [F.col(f"{source}.{c}").alias(prefix + c) for c in s.columns if c not in {*by, *skip}]


def asof_interpolate(q: DataFrame, s: DataFrame, by: Sequence[str], t: str = "t", pose: str = "pose",
                     max_gap: float | None = None, max_dist: float | None = None, width: float = SLICE,
                     prefix: str = "s_", extrapolate: bool = False) -> DataFrame:
    """Pose at the query time, with the payload of the nearer of the two samples.

    Outside the sampled span the pose is NULL; ``extrapolate`` instead runs the
    first segment backwards.  ``max_gap`` bounds the two samples' distance,
    ``max_dist`` the distance to the nearer sample; violations give NULL.
    """
    d = bracket(q, s, by, t, width)
    exact = (F.col(f"_next.{t}") == F.col(t)) & F.col("_prev").isNull()
    if extrapolate:
        heads = (s.groupBy(*by).agg(F.min_by(F.struct(*s.columns), t).alias("_h0"))
                 .join(s.select(*by, F.struct(*s.columns).alias("_h")), list(by))
                 .filter(F.col(f"_h.{t}") > F.col(f"_h0.{t}"))
                 .groupBy(*by).agg(F.first("_h0").alias("_h0"), F.min_by("_h", f"_h.{t}").alias("_h1")))
        d = d.join(heads, list(by), "left")
        early = F.col("_prev").isNull() & ~F.coalesce(exact, F.lit(False)) & F.col("_next").isNotNull()
        d = (d.withColumn("_early", early)
             .withColumn("_prev", F.when(F.col("_early"), F.col("_h0")).otherwise(F.col("_prev")))
             .withColumn("_next", F.when(F.col("_early"), F.col("_h1")).otherwise(F.col("_next")))
             .drop("_h0", "_h1", "_early"))
        exact = (F.col(f"_next.{t}") == F.col(t)) & F.col("_prev").isNull()
    d = d.withColumn("_s", F.when(exact, F.lit(1.0)).otherwise(_fraction(t)))
    ok = F.col("_s").isNotNull()
    if max_gap is not None:
        ok = ok & (exact | (F.col(f"_next.{t}") - F.col(f"_prev.{t}") <= max_gap))
    near_t = F.when(F.col("_s") < 0.5, F.col(f"_prev.{t}")).otherwise(F.col(f"_next.{t}"))
    if max_dist is not None:
        ok = ok & (F.abs(near_t - F.col(t)) <= max_dist)
    d = d.withColumn("_s", F.when(ok, F.col("_s")))
    d = d.withColumn("_best", F.when(F.col("_s") < 0.5, F.col("_prev")).when(F.col("_s") >= 0.5, F.col("_next")))
    d = d.withColumn("_a", F.coalesce(F.col(f"_prev.{pose}"), F.col(f"_next.{pose}")))
    d = P.add_interpolated(d.withColumn("_b", F.col(f"_next.{pose}")), "_at", "_a", "_b", "_s")
    at = F.col("_at")
    return d.select(*q.columns, at.alias(pose if pose not in q.columns else prefix + pose),
                    *_sample_columns(s, by, t, prefix, "_best", (pose,)))


def asof_nearest(q: DataFrame, s: DataFrame, by: Sequence[str], t: str = "t", tol: float | None = None,
                 width: float = SLICE, prefix: str = "s_") -> DataFrame:
    """Nearest sample in time (the earlier one on a tie); NULL beyond ``tol``."""
    d = bracket(q, s, by, t, width)
    dp = F.col(t) - F.col(f"_prev.{t}")
    dn = F.col(f"_next.{t}") - F.col(t)
    best = (F.when(F.col("_next").isNull(), F.col("_prev")).when(F.col("_prev").isNull(), F.col("_next"))
            .when(dp <= dn, F.col("_prev")).otherwise(F.col("_next")))
    d = d.withColumn("_best", best)
    if tol is not None:
        d = d.withColumn("_best", F.when(F.abs(F.col(f"_best.{t}") - F.col(t)) <= tol, F.col("_best")))
    return d.select(*q.columns, F.col(f"_best.{t}").alias(prefix + t),
                    *_sample_columns(s, by, t, prefix, "_best", (t,)))


def asof_backward(q: DataFrame, s: DataFrame, by: Sequence[str], t: str = "t", width: float = SLICE,
                  prefix: str = "s_") -> DataFrame:
    """Latest sample not after the query."""
    d = bracket(q, s, by, t, width, strict_before=False)
    return d.select(*q.columns, F.col(f"_prev.{t}").alias(prefix + t),
                    *_sample_columns(s, by, t, prefix, "_prev", (t,)))


def asof_forward(q: DataFrame, s: DataFrame, by: Sequence[str], t: str = "t", width: float = SLICE,
                 prefix: str = "s_") -> DataFrame:
    """Earliest sample at or after the query."""
    d = bracket(q, s, by, t, width)
    return d.select(*q.columns, F.col(f"_next.{t}").alias(prefix + t),
                    *_sample_columns(s, by, t, prefix, "_next", (t,)))


def asof_triplet(q: DataFrame, s: DataFrame, by: Sequence[str], t: str = "t", tol: float | None = None,
                 width: float = SLICE, prefix: str = "s_") -> DataFrame:
    """Nearest sample plus the samples just before and after it (their times)."""
    b = blocked(s, by, [t], width)
    sides = tidy(near(b, by, 1, 1, {f"before_{t}": lambda w: F.lag(t).over(w),
                                    f"after_{t}": lambda w: F.lead(t).over(w)}))
    return asof_nearest(q, sides, by, t, tol, width, prefix)


def attach_scans(keyframes: DataFrame, scans: DataFrame, by: Sequence[str], t: str = "t", tol: float = 20.0,
                 count: str = "n_points", width: float = SLICE) -> DataFrame:
    """Give every key frame its nearest scan; frames without a scan or with an empty one drop out."""
    d = asof_nearest(keyframes, scans, by, t, tol, width, "scan_")
    return d.filter(F.col(f"scan_{count}") > 0)


def restamp(frames: DataFrame, gps: DataFrame, dr: DataFrame, by: Sequence[str], scan_t: str = "scan_t",
            max_gap: float = 0.5, max_dist: float = 0.2, tol: float | None = None,
            width: float = SLICE) -> DataFrame:
    """Move frames to their scan time, then read GNSS and dead-reckoned pose again at that time."""
    at = frames.withColumn("t", F.col(scan_t)).drop(scan_t)
    with_gps = asof_interpolate(at, gps, by, "t", "pose", max_gap, max_dist, width, "gps_")
    with_gps = with_gps.withColumnRenamed("pose", "gps_pose")
    return asof_nearest(with_gps, dr, by, "t", tol, width, "dr_")


def scan_window_poses(scans: DataFrame, poses: DataFrame, by: Sequence[str], start: str = "t_start",
                      end: str = "t_end", shortest: float = 0.085, longest: float = 0.15,
                      tol: float | None = None, width: float = SLICE) -> DataFrame:
    """Nearest poses to a scan's first and last point; only scans of plausible duration."""
    d = scans.filter((F.col(end) - F.col(start)).between(shortest, longest))
    a = asof_nearest(d.withColumn("t", F.col(start)), poses, by, "t", tol, width, "start_").drop("t")
    b = asof_nearest(a.withColumn("t", F.col(end)), poses, by, "t", tol, width, "end_").drop("t")
    return b.filter(F.col("start_t").isNotNull() & F.col("end_t").isNotNull())


def suggest_id(wanted: DataFrame, keyframes: DataFrame, by: Sequence[str], width: float = 1_000_000.0) -> DataFrame:
    """Smallest existing ``id`` at or after each requested ``id``."""
    q = wanted.withColumn("t", F.col("id").cast("double"))
    s = keyframes.select(*by, F.col("id").cast("double").alias("t"), F.col("id").alias("found"))
    return asof_forward(q, s, by, "t", width, "").select(*wanted.columns, F.col("found").alias("suggested_id"))
