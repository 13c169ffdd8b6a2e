"""Pose-graph edges, residuals, relaxation, sub-maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import calib as CB
from wayloom.operators import graph as G
from wayloom.operators import submaps as SM
from wayloom.plans import views as V
from wayloom.plans.registry import query
from wayloom.plans.views import FIXES, POSES, r6
from wayloom.session import cut

BY = ["trajectory_id"]
SPAN = 5000.0


@query("relative_edges_j16", POSES, """
SELECT i, j, round(cos(a) * (x2 - x) + sin(a) * (y2 - y), 6) + 0e0 AS x, round(-sin(a) * (x2 - x) + cos(a) * (y2 - y), 6) + 0e0 AS y, round(sin((a2 - a) / 2), 6) + 0e0 AS qz, 2e0 AS info0
FROM (SELECT p.id AS i, q.id AS j, p.x, p.y, q.x AS x2, q.y AS y2, radians(p.k * 0.9e0) AS a, radians(q.k * 0.9e0) AS a2 FROM
  (SELECT *, row_number() OVER (PARTITION BY trajectory_id ORDER BY id) AS rn FROM poses) p JOIN (SELECT *, row_number() OVER (PARTITION BY trajectory_id ORDER BY id) AS rn FROM poses) q
  ON p.trajectory_id = q.trajectory_id AND q.rn - p.rn BETWEEN 1 AND 2)""")
def relative_edges(spark, sf):
    e = G.relative_edges(V.posed(spark, sf), 3, "pose", weight=2.0, width=SPAN)
    return e.select("i", "j", r6(F.col("meas.x")).alias("x"), r6(F.col("meas.y")).alias("y"), r6(F.col("meas.qz")).alias("qz"), F.col("info")[0].alias("info0"))


@query("prior_edges_j17", FIXES, """
SELECT 'prior' AS kind, id AS i, x AS mx, round(0.5e0 / pow(n, 2), 6) AS i0, round(0.5e0 / pow(n * 3, 2), 6) AS i2, round(0.5e0 / pow(CASE WHEN heading_valid THEN 0.08e0 ELSE 1e6 END, 2), 6) AS i3 FROM (
  SELECT *, CASE status WHEN 4 THEN 0.15e0 WHEN 5 THEN 0.5e0 WHEN 2 THEN 0.4e0 WHEN 1 THEN 10e0 ELSE 1e6 END AS n FROM fixes)
UNION ALL SELECT 'height', id, x, 0e0, 0.5e0, 0e0 FROM fixes UNION ALL SELECT 'rot', id, 0e0, 0e0, 0e0, round(pow(36 / pi(), 2), 6) FROM fixes""")
def prior_edges(spark, sf):
    from wayloom.functions.cells import gps_noise
    kf = V.fixes(spark, sf).withColumn("gps_pose", P.make("x", "y", "z")).withColumn("gps_noise", gps_noise("status", "heading_valid"))
    e = G.prior_edges(kf, "gnss", weight=0.5, height_ratio=3.0)
    e = e.unionByName(G.prior_edges(kf, "height", weight=0.5)).unionByName(G.prior_edges(kf, "rotation"))
    return e.select("kind", "i", F.col("meas.x").alias("mx"), *[F.round(F.col("info")[k], 6).alias(f"i{k}") for k in (0, 2, 3)])


def _chain_edges(d):
    """Edges to the next two frames, measured with a known error; one in eleven is wrong."""
    e = G.relative_edges(d, 3, "pose", weight=25.0, width=SPAN)
    bad = F.when((F.col("i") + F.col("j")) % 11 == 0, 3.0).otherwise(0.02)
    off = P.from_yaw(bad, F.lit(-0.01), F.lit(0.0), F.lit(0.01))
    return e.withColumn("meas", P.compose("meas", off))


@query("edge_residuals_r1", POSES, """
SELECT i, j, round(r0, 6) + 0e0 AS r0, round(r1, 6) + 0e0 AS r1, round(r5, 6) + 0e0 AS r5, round(25 * (r0 * r0 + r1 * r1 + r2 * r2 + r5 * r5), 4) AS chi2 FROM (
  SELECT i, j, -cos(0.01e0) * bad + sin(0.01e0) * 0.01e0 AS r0, sin(0.01e0) * bad + cos(0.01e0) * 0.01e0 AS r1, 0e0 AS r2, sin(-0.005e0) AS r5 FROM (
    SELECT p.id AS i, q.id AS j, CASE WHEN (p.id + q.id) % 11 = 0 THEN 3e0 ELSE 0.02e0 END AS bad FROM
  (SELECT *, row_number() OVER (PARTITION BY trajectory_id ORDER BY id) AS rn FROM poses) p JOIN (SELECT *, row_number() OVER (PARTITION BY trajectory_id ORDER BY id) AS rn FROM poses) q
  ON p.trajectory_id = q.trajectory_id AND q.rn - p.rn BETWEEN 1 AND 2))""")
def edge_residuals(spark, sf):
    d = V.posed(spark, sf)
    r = G.edge_residuals(_chain_edges(d), d)
    return r.select("i", "j", *[r6(F.col("residual")[k]).alias(f"r{k}") for k in (0, 1, 5)], F.round("chi2", 4).alias("chi2"))


def _drifted(d):
    """Poses off the truth by an error that grows along the ids, up to three metres and six degrees."""
    u = (F.col("id") % 1000) / 1000.0
    return P.compose("pose", P.from_yaw(u * 3, u * -2, F.lit(0.0), u * 0.1))


def _graph(spark, sf):
    """Frames with the first of each trajectory fixed, and exact edges beside some that are three metres off."""
    d = cut(V.posed(spark, sf).select("trajectory_id", "id", "k", "pose"))
    first = d.groupBy("trajectory_id").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("fixed"))
    kf = d.join(first, "id", "left").withColumn("fixed", F.coalesce("fixed", F.lit(False)))
    kf = kf.withColumn("start", F.when(F.col("fixed"), F.col("pose")).otherwise(_drifted(d)))
    wrong = G.relative_edges(d, 3, "pose", weight=25.0, width=SPAN).where((F.col("i") + F.col("j")) % 11 == 0)
    wrong = wrong.withColumn("meas", P.compose("meas", P.from_yaw(F.lit(3.0), F.lit(-1.0), F.lit(0.0), F.lit(0.01))))
    return cut(kf), G.relative_edges(d, 3, "pose", weight=400.0, width=SPAN), wrong


@query("optimise_poses_r2", POSES, "SELECT id, round(x, 2) + 0e0 AS x, round(y, 2) + 0e0 AS y, true AS converged FROM poses")
def optimise_poses(spark, sf):
    """From drifted starts, with one edge in eleven doubled by a wrong one, back to the true poses."""
    kf, good, wrong = _graph(spark, sf)
    new = G.optimise_poses(kf, good.unionByName(wrong).withColumn("delta", F.lit(1.0)), pose="start", outlier=9.0)
    return new.select("id", (F.round("pose.x", 2) + 0.0).alias("x"), (F.round("pose.y", 2) + 0.0).alias("y"), "converged")


@query("optimise_stage_r2", POSES, """
SELECT id, round(x, 2) + 0e0 AS x, round(y, 2) + 0e0 AS y, k % 7 <> 0 AS gnss_inlier, true AS converged FROM poses""")
def optimise_stage(spark, sf):
    """Two solutions over odometry, matches and fixes, one fix in seven fifty metres off: these are switched off."""
    kf, good, wrong = _graph(spark, sf)
    off = F.when(F.col("k") % 7 == 0, 50.0).otherwise(0.0)
    fixes = kf.withColumn("gps_pose", P.compose("pose", P.make(off, F.lit(0.0), F.lit(0.0)))).withColumn("gps_noise", F.array(*[F.lit(0.2)] * 6))
    dr = lambda e, role: e.withColumn("role", F.lit(role)).withColumn("delta", F.lit(3.0))
    gnss = dr(G.prior_edges(fixes, "gnss"), "gnss")
    heights = G.prior_edges(fixes, "height", pose="pose").withColumn("role", F.lit("height"))
    edges = dr(good, "dr").unionByName(dr(wrong, "match")).unionByName(gnss)
    out, _ = G.optimise_stage(kf.drop("fixed"), edges, 9.0, heights, pose="start")
    return out.select("id", (F.round("pose.x", 2) + 0.0).alias("x"), (F.round("pose.y", 2) + 0.0).alias("y"), "gnss_inlier", "converged")


@query("calibrate_offset_r3", """SELECT 0.1e0 AS x, -0.2e0 AS y, 1.5e0 AS yaw, true AS accepted""")
def calibrate_offset(spark, sf):
    d = V.posed(spark, sf)
    off = P.from_yaw(F.lit(0.1), F.lit(-0.2), F.lit(0.0), F.lit(1.5 * P.RAD))
    d = d.withColumn("gps_pose", P.from_yaw("x", "y", F.lit(0.0), F.radians(F.col("k") * 0.9))).withColumn("off", off)
    d = d.withColumn("matching_pose", P.compose("gps_pose", "off")).withColumn("usable", F.col("k") % 5 != 0)
    r = CB.calibrate_offset(d, 20, width=SPAN)
    return r.select(r6(F.round("offset.x", 3)).alias("x"), r6(F.round("offset.y", 3)).alias("y"), r6(F.round(P.yaw_deg("offset"), 3)).alias("yaw"), "accepted")


@query("split_submaps_r10")
def split_submaps(spark, sf):
    return SM.split_submaps(V.poses(spark, sf), 40, 50.0, 5.0, 0.25, width=SPAN).select("id", "map_id")


@query("refine_submaps_r11")
def refine_submaps(spark, sf):
    d = V.poses(spark, sf).withColumn("map_id", F.floor(F.col("x") / 3)).select("trajectory_id", "id", "x", "y", "z", "map_id")
    return SM.refine_submaps(d, 4, 50.0, 4.0, width=SPAN).select("id", "map_id")
