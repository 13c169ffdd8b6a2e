"""Operators inside one sensor sweep, and the filtered dead reckoning.

A sweep (``frame_id``) has at most 16 × 1800 cells, so per-sweep groups are
bounded by the sensor; row-frame operators still run in blocks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators.ordered import SLICE, blocked, near, running, tidy
from wayloom.operators.sequence import TRAJ
from wayloom.session import cut

ROWS, COLS = 16, 1800
SWEEP = ["frame_id"]
WIDE = 1e6  # a sweep is one slice


# --- motion inside a sweep ------------------------------------------------------

def sweep_fraction(points: DataFrame, order: str = "seq") -> DataFrame:
    """Relative time of each point in its sweep, from azimuth (``fraction``).

    The second half of the turn begins after the first point more than half a
    turn from the start.
    """
    az = -F.atan2("y", "x")
    ends = points.groupBy(*SWEEP).agg(F.min_by(az, order).alias("_start"), F.max_by(az, order).alias("_last"))
    end = F.col("_last") + 2 * math.pi
    turn = end - F.col("_start")
    end = F.when(turn > 3 * math.pi, end - 2 * math.pi).when(turn < math.pi, end + 2 * math.pi).otherwise(end)
    ends = ends.select(*SWEEP, "_start", end.alias("_end"))
    d = points.join(ends, SWEEP).withColumn("_az", az)
    pi = math.pi
    early = (F.when(F.col("_az") < F.col("_start") - pi / 2, F.col("_az") + 2 * pi)
             .when(F.col("_az") > F.col("_start") + 1.5 * pi, F.col("_az") - 2 * pi).otherwise(F.col("_az")))
    turned = F.col("_az") + 2 * pi
    late = (F.when(turned < F.col("_end") - 1.5 * pi, turned + 2 * pi)
            .when(turned > F.col("_end") + pi / 2, turned - 2 * pi).otherwise(turned))
    d = d.withColumn("_early", early).withColumn("_late", late)
    d = d.withColumn("_over", (F.col("_early") - F.col("_start") > pi).cast("long"))
    d = running(blocked(d, SWEEP, [order], WIDE), SWEEP, {"_seen": F.col("_over")})
    ori = F.when(F.col("_seen") - F.col("_over") > 0, F.col("_late")).otherwise(F.col("_early"))
    out = d.withColumn("fraction", (ori - F.col("_start")) / (F.col("_end") - F.col("_start")))
    return tidy(out).drop("_start", "_end", "_az", "_early", "_late", "_over", "_seen")


def _scaled_motion(d: DataFrame, motion: str, s: str) -> DataFrame:
    d = d.withColumn("_unit", P.make(F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    return P.add_interpolated(d, "_part", "_unit", motion, s).drop("_unit")


def _moved(d: DataFrame, pose: str) -> DataFrame:
    x, y, z = P.transform(pose, "x", "y", "z")
    return d.withColumn("_x", x).withColumn("_y", y).withColumn("_z", z).drop("x", "y", "z").withColumnsRenamed(
        {"_x": "x", "_y": "y", "_z": "z"})


def to_sweep_start(points: DataFrame, motions: DataFrame) -> DataFrame:
    """Points as seen from the sweep's start; ``motions`` is ``frame_id, motion`` over the sweep."""
    d = _scaled_motion(points.join(motions.select("frame_id", "motion"), SWEEP), "motion", "fraction")
    return _moved(d.withColumn("_inv", P.inverse("_part")), "_inv").drop("_part", "_inv", "motion")


def to_sweep_end(points: DataFrame, motions: DataFrame) -> DataFrame:
    """Points as seen from the sweep's end."""
    d = to_sweep_start(points, motions).join(motions.select("frame_id", F.col("motion").alias("_m")), SWEEP)
    return _moved(d.withColumn("_back", P.inverse("_m")), "_back").drop("_m", "_back")


def deskew(points: DataFrame, scan_poses: DataFrame, lo: float = 1.0, hi: float = 60.0) -> DataFrame:
    """Move each point to the sweep's end pose by the time left to the end.

    ``scan_poses`` carries ``frame_id, t_start, t_end, start_pose, end_pose``;
    points carry ``t`` and ``range`` and are kept inside the range annulus.
    """
    d = points.filter(F.col("range").isNotNull() & F.col("range").between(lo, hi))
    rel = scan_poses.select("frame_id", "t_start", "t_end", P.between("end_pose", "start_pose").alias("_rel"))
    d = d.join(rel, SWEEP)
    d = d.withColumn("_s", (F.col("t_end") - F.col("t")) / (F.col("t_end") - F.col("t_start")))
    d = _scaled_motion(d, "_rel", "_s")
    return _moved(d, "_part").drop("_part", "_rel", "_s", "t_start", "t_end")


# --- smoothness and features ------------------------------------------------------

def smoothness(points: DataFrame, order: str = "seq") -> DataFrame:
    """Squared (sum of ten neighbour ranges − 10 × own); NULL at the ends of a sweep."""
    def fold(w):
        f = w.rowsBetween(-5, 5)
        diff = F.sum("range").over(f) - 11 * F.col("range")
        return F.when(F.count("range").over(f) == 11, diff * diff)

    return tidy(near(blocked(points, SWEEP, [order], WIDE), SWEEP, 5, 5, {"curvature": fold}))


def occluded(points: DataFrame, order: str = "seq") -> DataFrame:
    """Mark points beside a depth jump on its far side, and points on beams nearly parallel to the surface."""
    d = near(blocked(points, SWEEP, [order], WIDE), SWEEP, 5, 6, {
        "_r0": lambda w: F.lag("range").over(w), "_r2": lambda w: F.lead("range").over(w),
        "_c2": lambda w: F.lead("col").over(w), "_b5": lambda w: F.lag("range", 5).over(w),
        "_a6": lambda w: F.lead("range", 6).over(w)})
    inner = F.col("_b5").isNotNull() & F.col("_a6").isNotNull()
    close = inner & (F.abs(F.col("_c2") - F.col("col")) < 10)
    r = F.col("range")
    drop, rise = close & (r - F.col("_r2") > 0.3), close & (F.col("_r2") - r > 0.3)
    thin = inner & (F.abs(F.col("_r0") - r) > 0.02 * r) & (F.abs(F.col("_r2") - r) > 0.02 * r)
    d = d.withColumn("_drop", drop.cast("int")).withColumn("_rise", (rise & ~drop).cast("int")).withColumn("_thin", thin.cast("int"))
    d = near(d, SWEEP, 6, 5, {"_near": lambda w: F.greatest(
        F.max("_drop").over(w.rowsBetween(0, 5)), F.coalesce(F.max("_rise").over(w.rowsBetween(-6, -1)), F.lit(0)))})
    out = d.withColumn("occluded", (F.greatest("_near", "_thin") > 0))
    return tidy(out).drop("_r0", "_r2", "_c2", "_b5", "_a6", "_drop", "_rise", "_thin", "_near")


def select_features(points: DataFrame, edge_th: float = 0.1, surf_th: float = 0.1) -> DataFrame:
    """Sharp, less sharp and flat points of every ring, at most 2 / 20 / 4 per sixth of the ring.

    Points carry ``frame_id, ring, seq, col, curvature, occluded, ground``.  A
    pick silences up to five neighbours each way, across sixths, so a ring (at
    most 1800 points) is handled whole; a group is a sweep with all its rings.
    """
    def pick(col, cur, known, taken, ground) -> list[str]:
        n = len(cur)
        label = ["less_flat"] * n
        jump = (np.abs(np.diff(col)) > 10).tolist()
        cur, known, taken, ground = cur.tolist(), known.tolist(), taken.tolist(), ground.tolist()

        def silence(i):
            taken[i] = True
            for j in range(i + 1, min(i + 6, n)):
                if jump[j - 1]:
                    break
                taken[j] = True
            for j in range(i - 1, max(i - 6, -1), -1):
                if jump[j]:
                    break
                taken[j] = True

        first, last = 4, n - 6
        for s in range(6):
            sp = (first * (6 - s) + last * s) // 6
            ep = (first * (5 - s) + last * (s + 1)) // 6 - 1
            if sp >= ep:
                continue
            rank = [*sorted(range(sp, ep), key=cur.__getitem__), ep]
            k = 0
            for i in reversed(rank):  # what is silenced stays so: one pass finds every pick
                if not taken[i] and known[i] and not ground[i] and cur[i] > edge_th:
                    k += 1
                    label[i] = "sharp" if k <= 2 else "less_sharp"
                    silence(i)
                    if k == 20:
                        break
            k = 0
            for i in rank:
                if not taken[i] and known[i] and ground[i] and cur[i] < surf_th:
                    k += 1
                    label[i] = "flat"
                    silence(i)
                    if k == 4:
                        break
        return label

    def run(frame: pa.Table) -> pa.Table:
        null = {c: frame[c].is_null().to_numpy() for c in ("ring", "seq", "col", "curvature")}
        ring, seq = (frame[c].fill_null(0).to_numpy() for c in ("ring", "seq"))
        order = np.lexsort((seq, null["seq"], ring, null["ring"]))
        col, cur = (np.where(null[c], np.nan, frame[c].fill_null(0).to_numpy().astype(float))[order] for c in ("col", "curvature"))
        taken, ground = (frame[c].fill_null(False).to_numpy()[order] for c in ("occluded", "ground"))
        known = ~np.isnan(cur)
        cur = np.where(known, cur, 0.0)
        ring, none = ring[order], null["ring"][order]
        cuts = [0, *(np.flatnonzero((ring[1:] != ring[:-1]) | (none[1:] != none[:-1])) + 1).tolist(), len(ring)]
        label = [x for a, b in itertools.pairwise(cuts) for x in pick(col[a:b], cur[a:b], known[a:b], taken[a:b], ground[a:b])]
        return frame.select(["frame_id", "ring", "seq"]).take(order).append_column("feature", pa.array(label, pa.string()))

    d = points.select(F.col("frame_id").cast("long"), F.col("ring").cast("int"), F.col("seq").cast("long"), "col", "curvature", "occluded", "ground")
    return d.groupBy("frame_id").applyInArrow(run, "frame_id long, ring int, seq long, feature string")


# --- range image --------------------------------------------------------------------

def ground_cells(image: DataFrame, last_row: int = 7, max_deg: float = 10.0) -> DataFrame:
    """Flag cells that lie flat with the cell of the next ring above or below.

    ``image`` is one row per ``frame_id, row, col`` with ``x, y, z``; a column
    holds at most 16 rows.
    """
    w = Window.partitionBy("frame_id", "col").orderBy("row")

    def flat(r0, r1, a, b):
        run = F.hypot(F.col(f"{b}x") - F.col(f"{a}x"), F.col(f"{b}y") - F.col(f"{a}y"))
        tilt = F.degrees(F.atan2(F.col(f"{b}z") - F.col(f"{a}z"), run))
        return (r1 - r0 == 1) & (r0 < last_row) & F.abs(tilt).__le__(max_deg)

    d = image.select("*", *[F.lead(c).over(w).alias(f"_u{c}") for c in ("row", "x", "y", "z")],
                     *[F.lag(c).over(w).alias(f"_d{c}") for c in ("row", "x", "y", "z")])
    up = flat(F.col("row"), F.col("_urow"), "", "_u")
    down = flat(F.col("_drow"), F.col("row"), "_d", "")
    ground = F.coalesce(up, F.lit(False)) | F.coalesce(down, F.lit(False))
    return d.withColumn("ground", ground).drop(*[f"_{s}{c}" for s in "ud" for c in ("row", "x", "y", "z")])


def segment_scan(image: DataFrame, alpha_x: float = 0.1 * math.pi / 180, alpha_y: float = 2.0 * math.pi / 180,
                 theta: float = 1.0472, big: int = 30, small: int = 5, lines: int = 3) -> DataFrame:
    """Connected components of a sweep's range image (``frame_id, row, col, range, ground``).

    Adjacent cells (columns wrap around) belong together when the angle of the
    line between them is steep enough.  Components of ``big`` cells, or of
    ``small`` cells over ``lines`` rows, get a positive label; others get 0.  One
    sweep is one dense 16 × 1800 array; minimum labels spread over whole arrays.
    """
    def run(pdf):
        rng = np.full((ROWS, COLS), np.inf)
        r, c = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        live = ~pdf["ground"].to_numpy(bool)
        rng[r[live], c[live]] = pdf["range"].to_numpy()[live]
        has = np.isfinite(rng)

        def linked(a, b, both, alpha):
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            with np.errstate(invalid="ignore"):
                ang = np.arctan2(lo * np.sin(alpha), hi - lo * np.cos(alpha))
            return both & (ang > theta)

        right = linked(rng, np.roll(rng, -1, 1), has & np.roll(has, -1, 1), alpha_x)
        up = linked(rng[:-1], rng[1:], has[:-1] & has[1:], alpha_y)
        lab = np.where(has, np.arange(ROWS * COLS).reshape(ROWS, COLS), ROWS * COLS)
        while True:
            new = lab.copy()
            nxt = np.roll(new, -1, 1)
            low = np.minimum(new, nxt)
            new = np.where(right, low, new)
            back = np.roll(np.where(right, low, ROWS * COLS), 1, 1)
            new = np.minimum(new, back)
            low = np.where(up, np.minimum(new[:-1], new[1:]), ROWS * COLS)
            new[:-1] = np.minimum(new[:-1], low)
            new[1:] = np.minimum(new[1:], low)
            flat = np.append(new.ravel(), ROWS * COLS)
            new = np.where(has, flat[flat[:-1]].reshape(ROWS, COLS), ROWS * COLS)  # jump to the label's own label
            if (new == lab).all():
                break
            lab = new
        ids, at, n = np.unique(lab[has], return_inverse=True, return_counts=True)
        rows_of = np.zeros((len(ids), ROWS), bool)
        rows_of[at, np.nonzero(has)[0]] = True
        good = (n >= big) | ((n >= small) & (rows_of.sum(1) >= lines))
        num = np.where(good, np.cumsum(good), 0)
        full = np.zeros((ROWS, COLS), dtype="i8")
        full[has] = num[at]
        return pd.DataFrame({"frame_id": pdf["frame_id"], "row": r, "col": c, "label": np.where(live, full[r, c], 0)})

    return image.select("frame_id", "row", "col", "range", "ground").groupBy("frame_id").applyInPandas(
        run, "frame_id long, row int, col int, label long")


# --- filtered dead reckoning ---------------------------------------------------------

GRAVITY = 9.80665  # fixed value
STATE = 1 + 4 + 3 + 3 + 3 + 36 + 3 + 1  # started, q, v, p, wheel velocity, P, gyro bias, last time


def _predict_correct(state: np.ndarray, rows: pd.DataFrame, gyro_noise: float, acc_noise: float, wheel_noise: float,
                     gate: float) -> tuple[np.ndarray, np.ndarray]:
    """Run the six-state filter (attitude and velocity error) over time-ordered rows.

    Wheel rows (``v`` set) correct the velocity axis by axis behind a gate;
    inertial rows predict.  Attitude starts from gravity at the first inertial row.
    """
    s = state.copy()
    q, v, p, wheel = s[1:5], s[5:8], s[8:11], s[11:14]
    cov, bias = s[14:50].reshape(6, 6), s[50:53]
    noise = np.diag([gyro_noise**2] * 3 + [acc_noise**2] * 3)
    out = np.empty((len(rows), 8))
    vals = rows[["t", "wx", "wy", "wz", "ax", "ay", "az", "v"]].to_numpy(dtype=float)
    for i, (t, wx, wy, wz, ax, ay, az, speed) in enumerate(vals):
        dt = t - s[53] if s[53] > 0 else 0.0
        if s[53] > 0 and (dt < 1e-5 or dt > 0.05):  # fixed values: the rule of fix_dt
            dt = 0.01
        rot = _matrix(q)
        if not np.isnan(speed):
            wheel[:] = rot @ np.array([speed, 0.0, 0.0])
            err = np.zeros(6)
            for k in range(3):
                innov = v[k] - wheel[k] - err[k + 3]
                var = cov[k + 3, k + 3] + wheel_noise**2
                if innov * innov / var < gate:
                    gain = cov[:, k + 3] / var
                    err = err + gain * innov
                    ikh = np.eye(6)
                    ikh[:, k + 3] -= gain
                    cov[:] = ikh @ cov @ ikh.T + np.outer(gain, gain) * wheel_noise**2
            v -= err[3:]
            q[:] = _turn(q, -err[:3], left=True)
        elif not s[0]:
            roll, pitch = math.atan2(ay, az), math.atan2(-ax, math.hypot(ay, az))
            cr, sr, cp, sp = math.cos(roll / 2), math.sin(roll / 2), math.cos(pitch / 2), math.sin(pitch / 2)
            q[:] = [sr * cp, cr * sp, -sr * sp, cr * cp]
            s[0], s[53] = 1.0, t
        else:
            force = rot @ np.array([ax, ay, az])
            p += wheel * dt
            v += (force - np.array([0.0, 0.0, GRAVITY])) * dt
            q[:] = _turn(q, (np.array([wx, wy, wz]) - bias) * dt)
            trans = np.eye(6)
            trans[3:, :3] = np.array([[0, -force[2], force[1]], [force[2], 0, -force[0]], [-force[1], force[0], 0]]) * -dt
            g = np.zeros((6, 6))
            g[:3, :3], g[3:, 3:] = -rot, rot
            cov[:] = trans @ cov @ trans.T + g @ noise @ g.T * dt
            s[53] = t
        out[i] = [*p, *q, np.linalg.norm(v)]
    return s, out


def _matrix(q):
    x, y, z, w = q
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
                     [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
                     [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


def _turn(q, w, left=False):
    th = math.sqrt(float(w @ w))
    k = 0.5 if th < 1e-12 else math.sin(th / 2) / th
    d = np.array([*(w * k), math.cos(th / 2)])
    a, b = (d, q) if left else (q, d)
    out = np.array([*(a[3] * b[:3] + b[3] * a[:3] + np.cross(a[:3], b[:3])), a[3] * b[3] - a[:3] @ b[:3]])
    return out / np.linalg.norm(out)


def dead_reckon(imu: DataFrame, odom: DataFrame, gyro_noise: float = 1e-3, acc_noise: float = 1e-2,
                wheel_noise: float = 0.1, gate: float = 50.0, static_rows: int = 100, static_var: float = 1e-3,
                by: Sequence[str] = TRAJ, block: int = 100_000, width: float = SLICE) -> DataFrame:
    """Six-state filtered dead reckoning per trajectory: ``t, pose, speed`` after every message.

    The filter is sequential, so trajectories run in parallel and each one block
    after block: a round filters the next ``block`` rows of every trajectory that
    still has rows, from the state the round before left.  A task never holds
    more than one block.  ``imu``: ``t, wx, wy, wz`` (rad/s), ``ax, ay, az``;
    ``odom``: ``t, v``.  The gyro bias is the mean of the first ``static_rows``
    samples if their variance is below ``static_var``.
    """
    by = list(by)
    axes = ["wx", "wy", "wz", "ax", "ay", "az"]
    numbered = blocked(imu.select(*by, "t", *axes), by, ["t"], width)
    still = numbered.filter(F.col("_rn") <= static_rows).groupBy(*by).agg(
        *[F.avg(c).alias(f"_b{c}") for c in axes[:3]],
        F.greatest(*[F.coalesce(F.var_samp(c), F.lit(0.0)) for c in axes[:3]]).alias("_var"))
    bias = F.when(F.col("_var") < static_var, F.array(*[f"_b{c}" for c in axes[:3]])).otherwise(F.array(*[F.lit(0.0)] * 3))
    head = F.array(*[F.lit(v) for v in [0.0, 0, 0, 0, 1.0] + [0.0] * 9 + list(np.eye(6).ravel() * 0.01)])
    state = still.select(*by, F.concat(head, bias, F.array(F.lit(0.0))).alias("state"))
    both = imu.select(*by, "t", *axes, F.lit(None).cast("double").alias("v")).unionByName(
        odom.select(*by, "t", "v"), allowMissingColumns=True).withColumn("_src", F.col("v").isNull().cast("int"))
    rows = cut(blocked(both, by, ["t", "_src"], width, block))
    last = int(rows.agg(F.max("_block")).first()[0] or 0)
    types = dict(both.dtypes)
    keys = ", ".join(f"{c} {types[c]}" for c in by)
    schema = keys + ", t double, " + ", ".join(f"p_{f} double" for f in P.FIELDS) + ", speed double, state array<double>"

    def run(pdf):
        pdf = pdf.sort_values("_rn")
        s, out = _predict_correct(np.asarray(pdf["state"].iloc[0], float), pdf, gyro_noise, acc_noise, wheel_noise, gate)
        res = pdf[by + ["t"]].reset_index(drop=True)
        for i, f in enumerate(P.FIELDS):
            res[f"p_{f}"] = out[:, i]
        res["speed"] = out[:, 7]
        res["state"] = [None] * (len(res) - 1) + [s.tolist()]
        return res

    parts = None
    for b in range(last + 1):
        todo = rows.filter(F.col("_block") == b).join(state, by)
        done = cut(todo.groupBy(*by).applyInPandas(run, schema))
        state = done.filter(F.col("state").isNotNull()).select(*by, "state")
        part = done.select(*by, "t", P.from_columns("p_").alias("pose"), "speed")
        parts = part if parts is None else parts.unionByName(part)
    return parts
