"""Sweep operators; order lines of one supplier make one sweep."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import scans as S
from wayloom.plans import views as V
from wayloom.plans.registry import query
from wayloom.plans.views import POINTS, POSES, r6

SWEEP = """cells AS (SELECT frame_id, ring, col, ring * 1800 + col AS seq, min(r) AS range, arg_min(x, (r, x, y, z)) AS x, arg_min(y, (r, x, y, z)) AS y, arg_min(z, (r, x, y, z)) AS z FROM (
  SELECT *, CAST(trunc((CASE WHEN a < 0 THEN a + 360 ELSE a END) / 2e0) AS BIGINT) AS col FROM (SELECT *, sqrt(x * x + y * y + z * z) AS r, -degrees(atan2(y, x)) AS a FROM points)) GROUP BY frame_id, ring, col)"""


def sweep(spark, sf):
    """Nearest return per frame, ring and two-degree column, numbered along the sweep."""
    a = -F.degrees(F.atan2("y", "x"))
    a = F.when(a < 0, a + 360).otherwise(a)
    r = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    d = V.points(spark, sf).groupBy("frame_id", "ring", (a / 2).cast("long").alias("col")).agg(
        F.min(F.struct(r.alias("range"), "x", "y", "z")).alias("_m"))
    return d.select("frame_id", "ring", "col", (F.col("ring") * 1800 + F.col("col")).alias("seq"), "_m.*")


def image(spark, sf):
    return sweep(spark, sf).withColumn("row", F.col("ring").cast("int")).withColumn("col", (F.col("col") * 10).cast("int"))


@query("sweep_fraction_g25", POINTS, SWEEP, """
SELECT frame_id, seq, round((CASE WHEN coalesce(max(CASE WHEN early - st > pi() THEN 1 ELSE 0 END) OVER (PARTITION BY frame_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
   THEN CASE WHEN az + 2 * pi() < en - 1.5e0 * pi() THEN az + 4 * pi() WHEN az + 2 * pi() > en + pi() / 2 THEN az ELSE az + 2 * pi() END ELSE early END - st) / (en - st), 6) + 0e0 AS fraction
FROM (SELECT *, CASE WHEN az < st - pi() / 2 THEN az + 2 * pi() WHEN az > st + 1.5e0 * pi() THEN az - 2 * pi() ELSE az END AS early FROM (
  SELECT frame_id, seq, az, st, CASE WHEN la + 2 * pi() - st > 3 * pi() THEN la WHEN la + 2 * pi() - st < pi() THEN la + 4 * pi() ELSE la + 2 * pi() END AS en FROM (
    SELECT frame_id, seq, -atan2(y, x) AS az, arg_min(-atan2(y, x), seq) OVER (PARTITION BY frame_id) AS st, arg_max(-atan2(y, x), seq) OVER (PARTITION BY frame_id) AS la FROM cells)))""")
def sweep_fraction(spark, sf):
    return S.sweep_fraction(sweep(spark, sf)).select("frame_id", "seq", r6("fraction").alias("fraction"))


def _motion(d):
    return d.select("frame_id").distinct().withColumn("motion", P.from_yaw(F.lit(1.0), F.lit(-0.5), F.lit(0.1), F.lit(0.2)))


MOVE = """mv AS (SELECT *, seq % 8 / 8e0 AS s FROM cells)"""


@query("to_sweep_start_g26", POINTS, SWEEP, MOVE, """
SELECT frame_id, seq, round(cos(0.2e0 * s) * (x - s) + sin(0.2e0 * s) * (y + 0.5e0 * s), 6) + 0e0 AS x, round(-sin(0.2e0 * s) * (x - s) + cos(0.2e0 * s) * (y + 0.5e0 * s), 6) + 0e0 AS y, round(z - 0.1e0 * s, 6) + 0e0 AS z FROM mv""")
def to_sweep_start(spark, sf):
    d = sweep(spark, sf).withColumn("fraction", F.col("seq") % 8 / 8.0)
    return S.to_sweep_start(d, _motion(d)).select("frame_id", "seq", *[r6(c).alias(c) for c in "xyz"])


@query("to_sweep_end_g26", POINTS, SWEEP, MOVE, """
SELECT frame_id, seq, round(cos(0.2e0) * (u - 1) + sin(0.2e0) * (v + 0.5e0), 6) + 0e0 AS x, round(-sin(0.2e0) * (u - 1) + cos(0.2e0) * (v + 0.5e0), 6) + 0e0 AS y, round(z - 0.1e0 * s - 0.1e0, 6) + 0e0 AS z
FROM (SELECT *, cos(0.2e0 * s) * (x - s) + sin(0.2e0 * s) * (y + 0.5e0 * s) AS u, -sin(0.2e0 * s) * (x - s) + cos(0.2e0 * s) * (y + 0.5e0 * s) AS v FROM mv)""")
def to_sweep_end(spark, sf):
    d = sweep(spark, sf).withColumn("fraction", F.col("seq") % 8 / 8.0)
    return S.to_sweep_end(d, _motion(d)).select("frame_id", "seq", *[r6(c).alias(c) for c in "xyz"])


@query("deskew_g24", POINTS, SWEEP, MOVE, """
SELECT frame_id, seq, round(cos(-0.2e0 * w) * x - sin(-0.2e0 * w) * y + w * tx, 6) + 0e0 AS x, round(sin(-0.2e0 * w) * x + cos(-0.2e0 * w) * y + w * ty, 6) + 0e0 AS y
FROM (SELECT *, 1 - s AS w, -(cos(0.2e0) * 1 + sin(0.2e0) * -0.5e0) AS tx, -(-sin(0.2e0) * 1 + cos(0.2e0) * -0.5e0) AS ty FROM mv WHERE range BETWEEN 1 AND 30)""")
def deskew(spark, sf):
    d = sweep(spark, sf).withColumn("t", 10.0 + F.col("seq") % 8 / 80.0)
    poses = d.select("frame_id").distinct().select(
        "frame_id", F.lit(10.0).alias("t_start"), F.lit(10.1).alias("t_end"), P.make(F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("start_pose"),
        P.from_yaw(F.lit(1.0), F.lit(-0.5), F.lit(0.0), F.lit(0.2)).alias("end_pose"))
    return S.deskew(d, poses, 1.0, 30.0).select("frame_id", "seq", r6("x").alias("x"), r6("y").alias("y"))


@query("smoothness_w16", POINTS, SWEEP, """
SELECT frame_id, seq, round(CASE WHEN count(*) OVER w = 11 THEN pow(sum(range) OVER w - 11 * range, 2) END, 4) AS curvature FROM cells
WINDOW w AS (PARTITION BY frame_id ORDER BY seq ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)""")
def smoothness(spark, sf):
    return S.smoothness(sweep(spark, sf)).select("frame_id", "seq", F.round("curvature", 4).alias("curvature"))


@query("occluded_w17", POINTS, SWEEP, """
SELECT frame_id, seq, greatest(coalesce(max(dr) OVER (PARTITION BY frame_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING), 0),
   coalesce(max(ri) OVER (PARTITION BY frame_id ORDER BY seq ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 0), th) > 0 AS occluded
FROM (SELECT *, CASE WHEN ok AND abs(c2 - col) < 10 AND range - r2 > 0.3e0 THEN 1 ELSE 0 END AS dr, CASE WHEN ok AND abs(c2 - col) < 10 AND r2 - range > 0.3e0 THEN 1 ELSE 0 END AS ri,
   CASE WHEN ok AND abs(r0 - range) > 0.02e0 * range AND abs(r2 - range) > 0.02e0 * range THEN 1 ELSE 0 END AS th
  FROM (SELECT *, lag(range) OVER o AS r0, lead(range) OVER o AS r2, lead(col) OVER o AS c2, lag(range, 5) OVER o IS NOT NULL AND lead(range, 6) OVER o IS NOT NULL AS ok FROM cells WINDOW o AS (PARTITION BY frame_id ORDER BY seq)))""")
def occluded(spark, sf):
    return S.occluded(sweep(spark, sf)).select("frame_id", "seq", "occluded")


@query("select_features_w18")
def select_features(spark, sf):
    d = S.occluded(S.smoothness(sweep(spark, sf))).withColumn("ground", F.col("z") < 0.5)
    return S.select_features(d)


@query("ground_cells_w19", POINTS, SWEEP, """
SELECT frame_id, ring AS row, col * 10 AS col, coalesce(lead(ring) OVER o - ring = 1 AND ring < 4 AND abs(degrees(atan2(lead(z) OVER o - z, sqrt(pow(lead(x) OVER o - x, 2) + pow(lead(y) OVER o - y, 2))))) <= 10, false)
  OR coalesce(ring - lag(ring) OVER o = 1 AND lag(ring) OVER o < 4 AND abs(degrees(atan2(z - lag(z) OVER o, sqrt(pow(x - lag(x) OVER o, 2) + pow(y - lag(y) OVER o, 2))))) <= 10, false) AS ground
FROM cells WINDOW o AS (PARTITION BY frame_id, col ORDER BY ring)""")
def ground_cells(spark, sf):
    return S.ground_cells(image(spark, sf), 4).select("frame_id", "row", "col", "ground")


@query("segment_scan_r9")
def segment_scan(spark, sf):
    return S.segment_scan(S.ground_cells(image(spark, sf), 4), alpha_x=0.04, alpha_y=0.04, theta=0.6, big=8)


@query("dead_reckon_w21")
def dead_reckon(spark, sf):
    d = V.steps(spark, sf)
    t = F.col("id") / 100.0  # event numbers as a 100 Hz clock
    imu = d.filter("event_type <> 'purchase'").select("trajectory_id", t.alias("t"), F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"),
                                                      (F.col("dx") / 10).alias("wz"), F.lit(0.0).alias("ax"), F.lit(0.0).alias("ay"), F.lit(9.80665).alias("az"))
    odom = d.filter("event_type = 'purchase'").select("trajectory_id", t.alias("t"), (F.col("value") / 10).alias("v"))
    out = S.dead_reckon(imu, odom, width=50.0)
    return out.select("trajectory_id", "t", "pose.x", "pose.y", "speed")
