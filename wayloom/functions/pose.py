"""Rigid-body algebra as native columns.

A pose is ``STRUCT<x, y, z, qx, qy, qz, qw: DOUBLE>`` (unit quaternion).
Everything below is plain column arithmetic, so it stays inside code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("x", "y", "z", "qx", "qy", "qz", "qw")
POSE_TYPE = "struct<" + ",".join(f"{f}:double" for f in FIELDS) + ">"
RAD = math.pi / 180.0


def lit(v: float) -> Column:
    return F.lit(float(v))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def make(x, y, z, qx=None, qy=None, qz=None, qw=None) -> Column:
    """Pose from parts; the rotation defaults to identity."""
    parts = [x, y, z, *(p if p is not None else lit(d) for p, d in zip((qx, qy, qz, qw), (0, 0, 0, 1)))]
    return F.struct(*[_c(p).cast("double").alias(n) for p, n in zip(parts, FIELDS)])


def from_columns(prefix: str = "") -> Column:
    return make(*[F.col(prefix + f) for f in FIELDS])


def _q(p):
    return tuple(p[f] for f in FIELDS[3:])


def _t(p):
    return tuple(p[f] for f in FIELDS[:3])


def _mul(a, b):
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return (aw * bx + ax * bw + ay * bz - az * by,
            aw * by - ax * bz + ay * bw + az * bx,
            aw * bz + ax * by - ay * bx + az * bw,
            aw * bw - ax * bx - ay * by - az * bz)


def _rotate(q, v):
    qx, qy, qz, qw = q
    vx, vy, vz = v
    return ((1 - 2 * (qy * qy + qz * qz)) * vx + 2 * (qx * qy - qz * qw) * vy + 2 * (qx * qz + qy * qw) * vz,
            2 * (qx * qy + qz * qw) * vx + (1 - 2 * (qx * qx + qz * qz)) * vy + 2 * (qy * qz - qx * qw) * vz,
            2 * (qx * qz - qy * qw) * vx + 2 * (qy * qz + qx * qw) * vy + (1 - 2 * (qx * qx + qy * qy)) * vz)


def _conj(q):
    return (-q[0], -q[1], -q[2], q[3])


def compose(a, b) -> Column:
    """``a ∘ b``: apply ``b`` first."""
    a, b = _c(a), _c(b)
    r = _rotate(_q(a), _t(b))
    return make(*[m + n for m, n in zip(r, _t(a))], *_mul(_q(a), _q(b)))


def inverse(a) -> Column:
    a = _c(a)
    q = _conj(_q(a))
    return make(*_rotate(q, tuple(-v for v in _t(a))), *q)


def between(a, b) -> Column:
    """``a⁻¹ ∘ b``: pose of ``b`` seen from ``a``."""
    a, b = _c(a), _c(b)
    q = _conj(_q(a))
    d = tuple(m - n for m, n in zip(_t(b), _t(a)))
    return make(*_rotate(q, d), *_mul(q, _q(b)))


def transform(p, x, y, z) -> tuple[Column, Column, Column]:
    """Move a point by a pose; returns three columns."""
    p = _c(p)
    r = _rotate(_q(p), (_c(x), _c(y), _c(z)))
    return tuple(m + n for m, n in zip(r, _t(p)))


def to_rpy(p) -> Column:
    """Roll, pitch, yaw (radians) of Rz(yaw)·Ry(pitch)·Rx(roll)."""
    p = _c(p)
    x, y, z, w = _q(p)
    s = 2 * (w * y - z * x)
    s = F.greatest(lit(-1), F.least(lit(1), s))
    return F.struct(p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z"),
                    F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)).alias("roll"),
                    F.asin(s).alias("pitch"),
                    F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)).alias("yaw"))


def from_rpy(x, y, z, roll, pitch, yaw) -> Column:
    cr, sr = F.cos(_c(roll) / 2), F.sin(_c(roll) / 2)
    cp, sp = F.cos(_c(pitch) / 2), F.sin(_c(pitch) / 2)
    cy, sy = F.cos(_c(yaw) / 2), F.sin(_c(yaw) / 2)
    return make(x, y, z, sr * cp * cy - cr * sp * sy, cr * sp * cy + sr * cp * sy,
                cr * cp * sy - sr * sp * cy, cr * cp * cy + sr * sp * sy)


def from_yaw(x, y, z, yaw) -> Column:
    h = _c(yaw) / 2
    return make(x, y, z, lit(0), lit(0), F.sin(h), F.cos(h))


def _angle_of(v, w) -> Column:
    n = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    return 2 * F.atan2(n, F.abs(w))


def angle_between(a, b) -> Column:
    """Rotation distance in degrees (norm of the rotation logarithm)."""
    d = _mul(_conj(_q(_c(a))), _q(_c(b)))
    return _angle_of(d[:3], d[3]) / RAD


def rotation_log(p) -> tuple[Column, Column, Column]:
    """Rotation vector of a pose, the short way round."""
    p = _c(p)
    x, y, z, w = _q(p)
    n = F.sqrt(x * x + y * y + z * z)
    sign = F.when(w < 0, lit(-1)).otherwise(lit(1))
    k = F.when(n < 1e-12, lit(2)).otherwise(2 * F.atan2(n, F.abs(w)) / n) * sign
    return x * k, y * k, z * k


def yaw_deg(p) -> Column:
    p = _c(p)
    x, y, z, w = _q(p)
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)) / RAD


def interpolate(a, b, s) -> Column:
    """Slerp of the rotation, straight line of the translation."""
    a, b, s = _c(a), _c(b), _c(s)
    qa, qb = _q(a), _q(b)
    d = sum((m * n for m, n in zip(qa[1:], qb[1:])), qa[0] * qb[0])
    ad = F.abs(d)
    th = F.acos(F.least(ad, lit(1)))
    flat = ad >= 1 - 2.3e-16
    ka = F.when(flat, 1 - s).otherwise(F.sin((1 - s) * th) / F.sin(th))
    kb = F.when(flat, s).otherwise(F.sin(s * th) / F.sin(th))
    kb = F.when(d < 0, -kb).otherwise(kb)
    return make(*[m * (1 - s) + n * s for m, n in zip(_t(a), _t(b))],
                *[m * ka + n * kb for m, n in zip(qa, qb)])


def add_interpolated(df: DataFrame, out: str, a: str, b: str, s: str) -> DataFrame:
    """:func:`interpolate` as staged columns, so the generated code stays small; NULL where ``s`` is."""
    qa, qb = _q(F.col(a)), _q(F.col(b))
    d = df.withColumn("_dot", sum((m * n for m, n in zip(qa[1:], qb[1:])), qa[0] * qb[0]))
    d = d.withColumn("_th", F.acos(F.least(F.abs("_dot"), lit(1))))
    flat = F.col("_th") < 2.2e-8
    d = d.withColumn("_ka", F.when(flat, 1 - F.col(s)).otherwise(F.sin((1 - F.col(s)) * F.col("_th")) / F.sin("_th")))
    d = d.withColumn("_kb", F.when(flat, F.col(s)).otherwise(F.sin(F.col(s) * F.col("_th")) / F.sin("_th"))
                     * F.when(F.col("_dot") < 0, lit(-1)).otherwise(lit(1)))
    ka, kb = F.col("_ka"), F.col("_kb")
    mixed = make(*[m * (1 - F.col(s)) + n * F.col(s) for m, n in zip(_t(F.col(a)), _t(F.col(b)))],
                 *[m * ka + n * kb for m, n in zip(qa, qb)])
    return d.withColumn(out, F.when(F.col(s).isNotNull(), mixed)).drop("_dot", "_th", "_ka", "_kb")


def planar_distance(a, b) -> Column:
    a, b = _c(a), _c(b)
    return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))


def pose_to_ground(a, ref) -> Column:
    """Keep x, y, yaw of ``a``; take roll, pitch and z from ``ref``.

    Roll and pitch change sign when the two yaws lie on different sides of the fold.
    """
    ra, rr = to_rpy(a), to_rpy(ref)
    turn = F.abs(ra["yaw"] - rr["yaw"])
    sign = F.when((turn > math.pi) & (turn < 2 * math.pi), lit(-1)).otherwise(lit(1))
    return from_rpy(ra["x"], ra["y"], rr["z"], sign * rr["roll"], sign * rr["pitch"], ra["yaw"])


# Attitude of the inertial unit: (roll about y, pitch about x, heading about z
# counted clockwise).

def att_to_quat(roll, pitch, heading) -> Column:
    cr, sr = F.cos(_c(roll) / 2), F.sin(_c(roll) / 2)
    cp, sp = F.cos(_c(pitch) / 2), F.sin(_c(pitch) / 2)
    ch, sh = F.cos(_c(heading) / 2), F.sin(_c(heading) / 2)
    # product of a turn by -heading about z, pitch about x and roll about y
    w = ch * cp * cr + sh * sp * sr
    x = ch * sp * cr + sh * cp * sr
    y = ch * cp * sr - sh * sp * cr
    z = ch * sp * sr - sh * cp * cr
    return F.struct(x.alias("qx"), y.alias("qy"), z.alias("qz"), w.alias("qw"))


def quat_to_att(q) -> Column:
    q = _c(q)
    x, y, z, w = (q[f] for f in FIELDS[3:])
    s = F.greatest(lit(-1), F.least(lit(1), 2 * (w * x + y * z)))
    return F.struct(F.atan2(2 * (w * y - x * z), w * w - x * x - y * y + z * z).alias("roll"),
                    F.asin(s).alias("pitch"),
                    F.atan2(2 * (x * y - w * z), w * w - x * x + y * y - z * z).alias("heading"))


def att_to_dcm(roll, pitch, heading) -> Column:
    """Body-to-navigation direction cosines, row major (9)."""
    cr, sr = F.cos(_c(roll)), F.sin(_c(roll))
    cp, sp = F.cos(_c(pitch)), F.sin(_c(pitch))
    ch, sh = F.cos(_c(heading)), F.sin(_c(heading))
    return F.array(cr * ch + sr * sp * sh, cp * sh, sr * ch - cr * sp * sh,
                   sr * sp * ch - cr * sh, cp * ch, -(sr * sh) - cr * sp * ch,
                   -(sr * cp), sp, cr * cp)
