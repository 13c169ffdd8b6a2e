"""Sequence operators on trajectories, built on blocked windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators.asof import asof_backward
from wayloom.operators.ordered import SLICE, blocked, carried, near, running, tidy
from wayloom.session import cut

TRAJ = ("trajectory_id",)


def stable_runs(df: DataFrame, by: Sequence[str], order: Sequence[str], conds: Mapping[str, Column], n: int = 10,
                sample: Sequence[str] = ("id",), width: float = SLICE) -> DataFrame:
    """First place where each condition has held ``n`` rows running, and the row ``n // 2`` back.

    One row per key: ``<name>_rn`` and ``<name>`` (struct of ``sample`` columns),
    NULL where the condition never held that long.
    """
    d = blocked(df, by, order, width)
    d = d.select("*", F.struct(*sample).alias("_smp"),
                 *[F.when(c, 1).otherwise(0).alias(f"_c_{k}") for k, c in conds.items()])
    exprs = {f"_h_{k}": (lambda w, k=k: F.sum(f"_c_{k}").over(w.rowsBetween(-(n - 1), 0))) for k in conds}
    exprs["_back"] = lambda w: F.lag("_smp", n // 2).over(w)
    d = near(d, by, max(n - 1, n // 2), 0, exprs)
    aggs = []
    for k in conds:
        hit = F.when(F.col(f"_h_{k}") == n, F.col("_rn"))
        aggs += [F.min(hit).alias(f"{k}_rn"), F.min_by("_back", hit).alias(k)]
    return d.groupBy(*by).agg(*aggs)


def gnss_quality(gps: DataFrame, by: Sequence[str], order: Sequence[str], n: int = 10,
                 sample: Sequence[str] = ("id",), width: float = SLICE) -> DataFrame:
    """Overall GNSS quality of each log (3, 2, 0, -1) and the sample it settled at.

    Fixed position and valid heading together win over fixed position, which
    wins over any signal.
    """
    fixed, heading, some = F.col("status") == 4, F.col("heading_valid"), F.col("status") != 0
    r = stable_runs(gps, by, order, {"sync": fixed & heading, "fixed": fixed, "heading": heading, "some": some}, n,
                    sample, width)
    quality = (F.when(F.col("sync_rn").isNotNull(), 3)
               .when(F.col("fixed_rn").isNotNull() & F.col("heading_rn").isNotNull(), 2)
               .when(F.col("fixed_rn").isNotNull() | F.col("some_rn").isNotNull(), 0).otherwise(-1))
    settled = (F.when(F.col("sync_rn").isNotNull(), F.col("sync"))
               .when(F.col("fixed_rn").isNotNull(), F.col("fixed")).otherwise(F.col("some")))
    return r.select(*by, quality.alias("quality"), settled.alias("settled"))


def step_distance(df: DataFrame, by: Sequence[str] = TRAJ, order: Sequence[str] = ("t",), width: float = SLICE,
                  name: str = "step", keep_blocks: bool = False) -> DataFrame:
    """Planar distance to the previous row, 0 for the first."""
    d = near(blocked(df, by, order, width), by, 1, 0,
             {"_px": lambda w: F.lag("x").over(w), "_py": lambda w: F.lag("y").over(w)})
    dx, dy = F.col("x") - F.col("_px"), F.col("y") - F.col("_py")
    d = d.withColumn(name, F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0))).drop("_px", "_py")
    return d if keep_blocks else tidy(d)


def trimmed_mean(df: DataFrame, value: str, by: Sequence[str] = TRAJ, order: Sequence[str] = ("t",), n: int = 7,
                 width: float = SLICE, name: str = "smooth") -> DataFrame:
    """Centred moving mean over ``n`` rows without one minimum and one maximum.

    Edges follow the queue of the original: the first row takes the first full
    window, the next ``n // 2`` rows the second, the last ``n // 2`` rows the last
    one; keys with ``n`` rows or fewer stay as they are.
    """
    h = n // 2
    total = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    d = blocked(df, by, order, width).join(total, list(by))

    def centred(w):
        f = w.rowsBetween(-h, h)
        v = (F.sum(value).over(f) - F.min(value).over(f) - F.max(value).over(f)) / (n - 2)
        return F.when(F.count(value).over(f) == n, v)

    d = near(d, by, h, h, {"_mid": centred})
    shifts = {f"_f{k}": (lambda w, k=k: F.lead("_mid", k).over(w)) for k in range(1, h + 1)}
    shifts |= {f"_b{k}": (lambda w, k=k: F.lag("_mid", k).over(w)) for k in range(1, h + 1)}
    d = near(d, by, h, h, shifts)
    rn = F.col("_rn")
    out = F.when(F.col("_rows") <= n, F.col(value)).when(rn == 1, F.col(f"_f{h}"))
    for i in range(2, h + 2):  # rows 2 … h+1 take the window centred on row h+2
        out = out.when(rn == i, F.col(f"_f{h + 2 - i}"))
    for k in range(1, h + 1):  # the k-th row after the last full window
        out = out.when(rn == F.col("_rows") - h + k, F.col(f"_b{k}"))
    return tidy(d.withColumn(name, out.otherwise(F.col("_mid")))).drop("_mid", "_rows", *shifts)


def path_curvature(df: DataFrame, half: int = 10, by: Sequence[str] = TRAJ, order: Sequence[str] = ("t",),
                   width: float = SLICE, name: str = "curvature") -> DataFrame:
    """Length of Σ(neighbour − self) over ``±half`` rows; edge rows take the nearest full window."""
    size = 2 * half + 1
    total = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    d = blocked(df, by, order, width).join(total, list(by))

    def spread(w):
        f = w.rowsBetween(-half, half)
        dx = F.sum("x").over(f) - size * F.col("x")
        dy = F.sum("y").over(f) - size * F.col("y")
        return F.when(F.count("x").over(f) == size, F.sqrt(dx * dx + dy * dy))

    d = near(d, by, half, half, {"_mid": spread})
    d = near(d, by, half, half, {
        "_prev": lambda w: F.last("_mid", True).over(w.rowsBetween(-half, 0)),
        "_next": lambda w: F.first("_mid", True).over(w.rowsBetween(0, half))})
    return tidy(d.withColumn(name, F.coalesce("_mid", "_prev", "_next"))).drop("_mid", "_prev", "_next", "_rows")


def extract_keyframes(poses: DataFrame, d: float = 0.5, a: float = 5.0, t: float = 30.0,
                      by: Sequence[str] = TRAJ, order: str = "t", pose: str = "pose", width: float = SLICE,
                      block: int = 2000) -> DataFrame:
    """Keep a pose when it is far from the last kept one in place, angle or time.

    The choice at a row depends on all earlier choices, so it is a fold; yet no
    task folds a whole trajectory.  Every block of ``block`` rows is folded from
    a guessed entry state (the last pose kept by the block before it in the
    previous round), and rounds repeat until no entry state changes.  The first
    block is right after round one and each right block makes the next one right,
    so the fixed point is the sequential answer; chains that start apart mostly
    meet after a few poses, which ends the rounds early.
    """
    by = list(by)
    keys = [*by, "_block"]
    row = F.struct(F.col("_rn"), F.col(order).cast("double").alias("t"), F.col(pose).alias("pose"),
                   F.struct(*poses.columns).alias("row"))
    arrays = cut(blocked(poses, by, [order], width, block).groupBy(*keys)
                 .agg(F.sort_array(F.collect_list(row)).alias("_rows")))

    def far(last, e):
        return ((P.planar_distance(last["pose"], e["pose"]) > d)
                | (P.angle_between(last["pose"], e["pose"]) > a)
                | (F.abs(last["t"] - e["t"]) > t))

    def fold(entered: Column) -> Column:
        state = F.struct(entered.alias("last"), F.slice(F.col("_rows"), 1, 0).alias("kept"))

        def step(acc, e):
            keep = acc["last"].isNull() | far(acc["last"], e)
            return F.struct(F.when(keep, F.struct(e["t"].alias("t"), e["pose"].alias("pose")))
                            .otherwise(acc["last"]).alias("last"),
                            F.when(keep, F.concat(acc["kept"], F.array(e))).otherwise(acc["kept"]).alias("kept"))

        return F.aggregate("_rows", state, step)

    nothing = F.lit(None).cast(f"struct<t:double,pose:{P.POSE_TYPE}>")
    folded = cut(arrays.withColumn("_in", nothing).withColumn("_f", fold(F.col("_in"))))
    if not folded.filter(F.col("_block") > 0).isEmpty():
        while True:
            ends = folded.select(*by, (F.col("_block") + 1).alias("_block"), F.col("_f.last").alias("_entry"))
            nxt = folded.join(ends, keys, "left")
            stale = ~F.col("_entry").eqNullSafe(F.col("_in"))
            if nxt.filter(stale).isEmpty():
                break
            folded = cut(nxt.withColumn("_f", F.when(stale, fold(F.col("_entry"))).otherwise(F.col("_f")))
                         .withColumn("_in", F.col("_entry")).drop("_entry"))
    return folded.select(F.explode("_f.kept").alias("_k")).select("_k.row.*")


def context_window(poses: DataFrame, half: int = 10, by: Sequence[str] = TRAJ, order: Sequence[str] = ("t",),
                   value: Sequence[str] = ("t",), width: float = SLICE, name: str = "context") -> DataFrame:
    """The ``half`` rows before and ``half - 1`` after, with the row itself, as an array."""
    v = F.struct(*value) if len(value) > 1 else F.col(value[0])
    d = near(blocked(poses, by, order, width), by, half, half - 1,
             {name: lambda w: F.collect_list(v).over(w.rowsBetween(-half, half - 1))})
    return tidy(d)


def interleave(a: DataFrame, b: DataFrame, by: Sequence[str] = TRAJ, t: str = "t", width: float = SLICE) -> DataFrame:
    """Both streams in time order; on equal times the second one comes first."""
    both = a.withColumn("source", F.lit(1)).unionByName(b.withColumn("source", F.lit(0)), allowMissingColumns=True)
    d = blocked(both, by, [t, "source"], width)
    return d.withColumn("seq", F.col("_rn")).withColumn("source", 2 - F.col("source")).drop("_rn", "_block")


def fix_dt(imu: DataFrame, by: Sequence[str] = TRAJ, t: str = "t", tag: str = "tag_ms",
           width: float = SLICE) -> DataFrame:
    """Repair sensor intervals: counter wrap, then out-of-range values replaced by 10 ms."""
    d = near(blocked(imu, by, [t], width), by, 1, 0,
             {"_pt": lambda w: F.lag(t).over(w), "_pm": lambda w: F.lag(tag).over(w)})
    ms = F.col(tag) - F.coalesce("_pm", F.lit(0))
    ms = F.when(ms < 0, ms + 655360).otherwise(ms) / 1000.0
    ros = F.col(t) - F.coalesce("_pt", F.lit(0.0))
    d = d.withColumn("dt_tag", F.when((ms < 0.001) | (ms > 0.05), F.lit(0.01)).otherwise(ms))
    d = d.withColumn("dt", F.when((ros < 1e-5) | (ros > 0.05), F.lit(0.01)).otherwise(ros))
    return tidy(d).drop("_pt", "_pm")


def propagate_from_fix(keyframes: DataFrame, by: Sequence[str] = TRAJ, order: Sequence[str] = ("id",),
                       width: float = 1_000_000.0) -> DataFrame:
    """Initial pose of each frame: its fix, or the last fix carried along the odometry.

    Needs ``gps_pose``, ``usable``, ``heading_valid`` and ``matching_pose``.
    """
    d = blocked(keyframes, by, order, width)
    fix = F.when(F.col("usable"), F.struct(F.col("gps_pose").alias("g"), F.col("matching_pose").alias("m")))
    d = near(carried(d, by, {"_at": fix}), by, 1, 0, {"_before": lambda w: F.lag("_at").over(w)})
    src = F.when(F.col("usable"), F.col("_before")).otherwise(F.col("_at"))
    d = d.withColumn("_src", src)
    d = d.withColumn("_rel", P.between(F.col("_src.m"), F.col("matching_pose")))
    d = d.withColumn("_est", F.when(F.col("_src").isNull(), F.col("matching_pose"))
                     .otherwise(P.compose(F.col("_src.g"), F.col("_rel"))))
    g, e = F.col("gps_pose"), F.col("_est")
    own = F.when(F.col("heading_valid"), g).otherwise(
        P.make(g["x"], g["y"], g["z"], e["qx"], e["qy"], e["qz"], e["qw"]))
    how = F.when(F.col("usable"), "fix").when(F.col("_src").isNotNull(), "carried").otherwise("odometry")
    d = d.withColumn("init_pose", F.when(F.col("usable"), own).otherwise(e)).withColumn("init_from", how)
    return tidy(d).drop("_at", "_before", "_src", "_rel", "_est")


def dead_reckon_2d(imu: DataFrame, odom: DataFrame, by: Sequence[str] = TRAJ, t: str = "t",
                   width: float = SLICE) -> DataFrame:
    """Planar path: heading is Σω·dt, position Σv·direction·dt.

    ``imu`` carries ``t, wz, dt`` (rad/s, s), ``odom`` ``t, v``; speed is the
    latest reading not after the sample, 0 before the first.
    """
    d = asof_backward(imu, odom.select(*by, t, "v"), by, t, width, "odom_")
    d = d.withColumn("_v", F.coalesce("odom_v", F.lit(0.0)))
    d = blocked(d, by, [t], width)
    d = running(d, by, {"heading": F.col("wz") * F.col("dt")})
    d = running(d, by, {"x": F.col("_v") * F.cos("heading") * F.col("dt"),
                        "y": F.col("_v") * F.sin("heading") * F.col("dt")})
    return tidy(d).drop("_v", "odom_v", "odom_t")


def endpoints(keyframes: DataFrame, by: Sequence[str] = TRAJ, order: str = "id") -> DataFrame:
    """First and last frame of every trajectory."""
    row = F.struct(*keyframes.columns)
    g = keyframes.groupBy(*by).agg(F.min_by(row, order).alias("first"), F.max_by(row, order).alias("last"))
    return g


def back_to_start(keyframes: DataFrame, by: Sequence[str] = TRAJ, order: str = "t", reach: float = 1.0,
                  min_frames: int = 10, width: float = SLICE) -> DataFrame:
    """Frames less than ``reach`` from their trajectory's first frame, after more than ``min_frames``."""
    first = keyframes.groupBy(*by).agg(F.min_by("x", order).alias("_x0"), F.min_by("y", order).alias("_y0"))
    d = blocked(keyframes, by, [order], width).join(first, list(by))
    dx, dy = F.col("x") - F.col("_x0"), F.col("y") - F.col("_y0")
    near_start = F.sqrt(dx * dx + dy * dy) < reach
    return tidy(d.withColumn("at_start", near_start & (F.col("_rn") > min_frames))).drop("_x0", "_y0")


def imu_static_stats(imu: DataFrame, n: int = 100, min_n: int = 10, by: Sequence[str] = TRAJ,
                     order: Sequence[str] = ("t",), width: float = SLICE) -> DataFrame:
    """Norms of the sample variances of gyro and accelerometer over the last ``n`` rows."""
    cols = ["wx", "wy", "wz", "ax", "ay", "az"]
    exprs = {f"_{c}": (lambda w, c=c: F.var_samp(c).over(w.rowsBetween(-(n - 1), 0))) for c in cols}
    exprs["_cnt"] = lambda w: F.count(F.lit(1)).over(w.rowsBetween(-(n - 1), 0))
    d = near(blocked(imu, by, order, width), by, n - 1, 0, exprs)

    def norm(three):
        s = sum((F.col(f"_{c}") * F.col(f"_{c}") for c in three[1:]), F.col(f"_{three[0]}") * F.col(f"_{three[0]}"))
        return F.when(F.col("_cnt") >= min_n, F.sqrt(s))

    d = d.withColumn("gyro_var_norm", norm(cols[:3])).withColumn("acce_var_norm", norm(cols[3:]))
    return tidy(d).drop("_cnt", *[f"_{c}" for c in cols])


def number_marks(marks: DataFrame, by: Sequence[str] = ("mark_id",), order: Sequence[str] = ("t",),
                 width: float = SLICE) -> DataFrame:
    """1, 2, 3 … for repeated marks of one id."""
    return blocked(marks, by, order, width).withColumn("number", F.col("_rn")).drop("_rn", "_block")


def path_length(keyframes: DataFrame, by: Sequence[str] = TRAJ, order: Sequence[str] = ("id",),
                swath: float = 8.5, width: float = 1_000_000.0) -> DataFrame:
    """Length of each trajectory and the area it sweeps."""
    d = step_distance(keyframes, by, order, width)
    return d.groupBy(*by).agg(F.sum("step").alias("length"), F.count(F.lit(1)).alias("frames")).withColumn(
        "area", swath * F.col("length"))


