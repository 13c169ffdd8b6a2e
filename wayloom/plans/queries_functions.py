"""Pose, geodesy and cell functions over every row of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import cells as C
from wayloom.functions import geodesy as G
from wayloom.functions import pose as P
from wayloom.operators import grid
from wayloom.plans import views as V
from wayloom.plans.registry import query
from wayloom.plans.views import FIXES, POINTS, POSES, r6

ANTENNA = (0.3, -0.2, 1.5)


def flat(p, tag=""):
    p = F.col(p) if isinstance(p, str) else p
    return [r6(p[f]).alias(tag + f) for f in P.FIELDS]


def _two(spark, sf):
    """Each pose with a second one made from its step."""
    b = P.from_yaw("dx", "dy", F.col("value") / 50.0, F.radians((F.col("id") % 9 - 4) * 20.0))
    return V.posed(spark, sf).withColumn("b", b)


TWO = POSES + """,
two AS (SELECT *, radians(k * 0.9e0) AS a1, radians((id % 9 - 4) * 20e0) AS a2, value / 50e0 AS dz FROM poses)"""


@query("pose_compose_g1", TWO, """
SELECT id, round(x + cos(a1) * dx - sin(a1) * dy, 6) + 0e0 AS x, round(y + sin(a1) * dx + cos(a1) * dy, 6) + 0e0 AS y,
       round(z + dz, 6) + 0e0 AS z, 0e0 AS qx, 0e0 AS qy, round(sin((a1 + a2) / 2), 6) + 0e0 AS qz,
       round(cos((a1 + a2) / 2), 6) + 0e0 AS qw FROM two""")
def pose_compose(spark, sf):
    return _two(spark, sf).select("id", P.compose("pose", "b").alias("c")).select("id", *flat("c"))


@query("pose_inverse_g1", TWO, """
SELECT id, round(-(cos(a1) * x + sin(a1) * y), 6) + 0e0 AS x, round(sin(a1) * x - cos(a1) * y, 6) + 0e0 AS y,
       round(-z, 6) + 0e0 AS z, 0e0 AS qx, 0e0 AS qy, round(-sin(a1 / 2), 6) + 0e0 AS qz,
       round(cos(a1 / 2), 6) + 0e0 AS qw FROM two""")
def pose_inverse(spark, sf):
    return _two(spark, sf).select("id", P.inverse("pose").alias("c")).select("id", *flat("c"))


@query("pose_between_g1", TWO, """
SELECT id, round(cos(a1) * (dx - x) + sin(a1) * (dy - y), 6) + 0e0 AS x,
       round(-sin(a1) * (dx - x) + cos(a1) * (dy - y), 6) + 0e0 AS y, round(dz - z, 6) + 0e0 AS z,
       0e0 AS qx, 0e0 AS qy, round(sin((a2 - a1) / 2), 6) + 0e0 AS qz, round(cos((a2 - a1) / 2), 6) + 0e0 AS qw FROM two""")
def pose_between(spark, sf):
    return _two(spark, sf).select("id", P.between("pose", "b").alias("c")).select("id", *flat("c"))


@query("pose_transform_g1", TWO, """
SELECT id, round(x + cos(a1) * dx - sin(a1) * dy, 6) + 0e0 AS x, round(y + sin(a1) * dx + cos(a1) * dy, 6) + 0e0 AS y,
       round(z + dz, 6) + 0e0 AS z FROM two""")
def pose_transform(spark, sf):
    d = _two(spark, sf)
    return d.select("id", *[r6(c).alias(n) for c, n in zip(P.transform("pose", "dx", "dy", F.col("value") / 50.0), "xyz")])


RPY = POSES + """,
rpy AS (SELECT id, radians((id % 9 - 4) * 15e0) AS r, radians((k % 7 - 3) * 25e0) AS p, radians(k * 3.5e0 - 170e0) AS w FROM poses)"""


def _rpy(spark, sf):
    return V.posed(spark, sf).select(
        "id", F.radians((F.col("id") % 9 - 4) * 15.0).alias("r"), F.radians((F.col("k") % 7 - 3) * 25.0).alias("p"),
        F.radians(F.col("k") * 3.5 - 170.0).alias("w"), "x", "y", "z")


@query("pose_from_rpy_g2", RPY, """
SELECT id, round(sin(r/2)*cos(p/2)*cos(w/2) - cos(r/2)*sin(p/2)*sin(w/2), 6) + 0e0 AS qx,
       round(cos(r/2)*sin(p/2)*cos(w/2) + sin(r/2)*cos(p/2)*sin(w/2), 6) + 0e0 AS qy,
       round(cos(r/2)*cos(p/2)*sin(w/2) - sin(r/2)*sin(p/2)*cos(w/2), 6) + 0e0 AS qz,
       round(cos(r/2)*cos(p/2)*cos(w/2) + sin(r/2)*sin(p/2)*sin(w/2), 6) + 0e0 AS qw FROM rpy""")
def pose_from_rpy(spark, sf):
    d = _rpy(spark, sf).withColumn("c", P.from_rpy("x", "y", "z", "r", "p", "w"))
    return d.select("id", *flat("c")[3:])


@query("pose_to_rpy_g2", RPY, """
SELECT id, round(r, 6) + 0e0 AS roll, round(p, 6) + 0e0 AS pitch, round(w, 6) + 0e0 AS yaw FROM rpy""")
def pose_to_rpy(spark, sf):
    d = _rpy(spark, sf).withColumn("c", P.from_rpy("x", "y", "z", "r", "p", "w")).withColumn("e", P.to_rpy("c"))
    return d.select("id", *[r6(F.col(f"e.{n}")).alias(n) for n in ("roll", "pitch", "yaw")])


@query("attitude_quaternion_g3", RPY, """
SELECT id, round(r, 6) + 0e0 AS roll, round(p, 6) + 0e0 AS pitch, round(w, 6) + 0e0 AS heading,
       round(cos(w/2)*sin(p/2)*cos(r/2) + sin(w/2)*cos(p/2)*sin(r/2), 6) + 0e0 AS qx,
       round(cos(w/2)*cos(p/2)*cos(r/2) + sin(w/2)*sin(p/2)*sin(r/2), 6) + 0e0 AS qw FROM rpy""")
def attitude_quaternion(spark, sf):
    d = _rpy(spark, sf).withColumn("q", P.att_to_quat("r", "p", "w")).withColumn("a", P.quat_to_att("q"))
    return d.select("id", *[r6(F.col(f"a.{n}")).alias(n) for n in ("roll", "pitch", "heading")],
                    r6(F.col("q.qx")).alias("qx"), r6(F.col("q.qw")).alias("qw"))


@query("attitude_dcm_g3", RPY, """
SELECT id, round(cos(r)*cos(w) + sin(r)*sin(p)*sin(w), 6) + 0e0 AS c0, round(cos(p)*sin(w), 6) + 0e0 AS c1,
       round(sin(r)*cos(w) - cos(r)*sin(p)*sin(w), 6) + 0e0 AS c2, round(-cos(r)*sin(w) + sin(r)*sin(p)*cos(w), 6) + 0e0 AS c3,
       round(cos(p)*cos(w), 6) + 0e0 AS c4, round(-sin(r)*sin(w) - cos(r)*sin(p)*cos(w), 6) + 0e0 AS c5,
       round(-sin(r)*cos(p), 6) + 0e0 AS c6, round(sin(p), 6) + 0e0 AS c7, round(cos(r)*cos(p), 6) + 0e0 AS c8 FROM rpy""")
def attitude_dcm(spark, sf):
    d = _rpy(spark, sf).withColumn("m", P.att_to_dcm("r", "p", "w"))
    return d.select("id", *[r6(F.col("m")[i]).alias(f"c{i}") for i in range(9)])


@query("pose_interpolate_g4", TWO, """
SELECT id, round(x * 0.75e0 + dx * 0.25e0, 6) + 0e0 AS x, round(y * 0.75e0 + dy * 0.25e0, 6) + 0e0 AS y,
       round(z * 0.75e0 + dz * 0.25e0, 6) + 0e0 AS z, 0e0 AS qx, 0e0 AS qy,
       round(sin((a1 + (a2 - a1) * 0.25e0) / 2), 6) + 0e0 AS qz, round(cos((a1 + (a2 - a1) * 0.25e0) / 2), 6) + 0e0 AS qw
FROM two""")
def pose_interpolate(spark, sf):
    return _two(spark, sf).select("id", P.interpolate("pose", "b", F.lit(0.25)).alias("c")).select("id", *flat("c"))


@query("rotation_distance_g5", TWO, "SELECT id, round(abs(degrees(a2 - a1)), 6) + 0e0 AS angle FROM two")
def rotation_distance(spark, sf):
    return _two(spark, sf).select("id", r6(P.angle_between("pose", "b")).alias("angle"))


@query("yaw_g6", TWO, "SELECT id, round(k * 0.9e0, 6) + 0e0 AS yaw, round((id % 9 - 4) * 20e0, 6) + 0e0 AS yaw_b FROM two")
def yaw(spark, sf):
    return _two(spark, sf).select("id", r6(P.yaw_deg("pose")).alias("yaw"), r6(P.yaw_deg("b")).alias("yaw_b"))


@query("heading_angle_g7", FIXES, """
SELECT id, round(CASE WHEN 90 - heading < -180 THEN 450 - heading WHEN 90 - heading > 180 THEN -270 - heading ELSE 90 - heading END, 6) + 0e0 AS angle,
       round(CASE WHEN 90 - heading < 0 THEN 450 - heading WHEN 90 - heading > 360 THEN -270 - heading ELSE 90 - heading END, 6) + 0e0 AS heading_back,
       round(CASE WHEN heading > 180 THEN heading - 360 WHEN heading < -180 THEN heading + 360 ELSE heading END, 6) + 0e0 AS wrapped
FROM fixes""")
def heading_angle(spark, sf):
    return V.fixes(spark, sf).select("id", r6(G.heading_to_angle("heading")).alias("angle"),
                                     r6(G.angle_to_heading("heading")).alias("heading_back"),
                                     r6(G.wrap180("heading")).alias("wrapped"))


LEVER = FIXES + """,
bearing AS (SELECT *, heading + 1.5e0 - degrees(atan2(0.2e0, -0.3e0)) AS b0, radians(lat) AS la FROM fixes),
lever AS (SELECT *, radians(CASE WHEN b0 > 180 THEN b0 - 360 WHEN b0 < -180 THEN b0 + 360 ELSE b0 END) AS b,
          6378137e0 * (1 - 2 / 298.257e0 + 3 / 298.257e0 * sin(la) * sin(la)) + height AS rm,
          6378137e0 * (1 + 1 / 298.257e0 * sin(la) * sin(la)) + height AS rn FROM bearing),
shifted AS (SELECT *, lon + degrees(sqrt(0.13e0) * sin(b) / (rn * cos(la))) AS slon, lat + degrees(sqrt(0.13e0) * cos(b) / rm) AS slat FROM lever)"""


@query("lever_arm_g8", LEVER, "SELECT id, round(slon, 8) AS lon, round(slat, 8) AS lat FROM shifted")
def lever_arm(spark, sf):
    d = V.fixes(spark, sf).withColumn("s", G.shift_lonlat("lon", "lat", "height", "heading", *ANTENNA))
    return d.select("id", F.round("s.lon", 8).alias("lon"), F.round("s.lat", 8).alias("lat"))


def utm_sql(src: str, lon: str, lat: str, tag: str = "") -> str:
    """SQL of the forward projection, written in the textbook's plain power form."""
    return f"""
m{tag} AS (SELECT *, radians({lat}) AS phi, radians({lon}) - radians(-183 + (floor(({lon} + 180) / 6) + 1) * 6) AS l,
   (6378137e0 - 6356752.31425e0) / (6378137e0 + 6356752.31425e0) AS n,
   (pow(6378137e0, 2) - pow(6356752.31425e0, 2)) / pow(6356752.31425e0, 2) AS ep2 FROM {src}),
u{tag} AS (SELECT *, ep2 * pow(cos(phi), 2) AS nu2, tan(phi) AS tt FROM m{tag}),
w{tag} AS (SELECT *, pow(6378137e0, 2) / (6356752.31425e0 * sqrt(1 + nu2)) AS nn,
   (6378137e0 + 6356752.31425e0) / 2 * (1 + pow(n, 2) / 4 + pow(n, 4) / 64) * (phi
     + (-3 * n / 2 + 9 * pow(n, 3) / 16 - 3 * pow(n, 5) / 32) * sin(2 * phi) + (15 * pow(n, 2) / 16 - 15 * pow(n, 4) / 32) * sin(4 * phi)
     + (-35 * pow(n, 3) / 48 + 105 * pow(n, 5) / 256) * sin(6 * phi) + (315 * pow(n, 4) / 512) * sin(8 * phi)) AS arc FROM u{tag}),
utm{tag} AS (SELECT *, 500000 + 0.9996e0 * (nn * cos(phi) * l + nn / 6 * pow(cos(phi), 3) * (1 - pow(tt, 2) + nu2) * pow(l, 3)
     + nn / 120 * pow(cos(phi), 5) * (5 - 18 * pow(tt, 2) + pow(tt, 4) + 14 * nu2 - 58 * pow(tt, 2) * nu2) * pow(l, 5)
     + nn / 5040 * pow(cos(phi), 7) * (61 - 479 * pow(tt, 2) + 179 * pow(tt, 4) - pow(tt, 6)) * pow(l, 7)) AS ux,
   0.9996e0 * (arc + tt / 2 * nn * pow(cos(phi), 2) * pow(l, 2) + tt / 24 * nn * pow(cos(phi), 4) * (5 - pow(tt, 2) + 9 * nu2 + 4 * pow(nu2, 2)) * pow(l, 4)
     + tt / 720 * nn * pow(cos(phi), 6) * (61 - 58 * pow(tt, 2) + pow(tt, 4) + 270 * nu2 - 330 * pow(tt, 2) * nu2) * pow(l, 6)
     + tt / 40320 * nn * pow(cos(phi), 8) * (1385 - 3111 * pow(tt, 2) + 543 * pow(tt, 4) - pow(tt, 6)) * pow(l, 8)) AS uy FROM w{tag})"""


@query("to_utm_g9", FIXES, utm_sql("fixes", "lon", "lat"), """
SELECT id, round(ux, 4) AS x, round(uy, 4) AS y, CAST(floor((lon + 180) / 6) + 1 AS INT) AS zone FROM utm""")
def to_utm(spark, sf):
    d = V.fixes(spark, sf).withColumn("u", G.to_utm("lon", "lat"))
    return d.select("id", F.round("u.x", 4).alias("x"), F.round("u.y", 4).alias("y"), "u.zone")


@query("from_utm_g10", FIXES, "SELECT id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM fixes")
def from_utm(spark, sf):
    d = V.fixes(spark, sf).withColumn("u", G.to_utm("lon", "lat"))
    d = G.add_lonlat(d, F.col("u.x"), F.col("u.y"), F.col("u.zone"), F.lit(False))
    return d.select("id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


@query("earth_centred_g11", FIXES, """
SELECT id, round(rn * cos(la) * cos(lo) + height * cos(la) * cos(lo), 4) + 0e0 AS x,
       round((rn + height) * cos(la) * sin(lo), 4) + 0e0 AS y, round(((1 - 0.00669437999013e0) * rn + height) * sin(la), 4) + 0e0 AS z,
       round(lon, 7) AS lon, round(lat, 7) AS lat, round(height, 4) + 0e0 AS h
FROM (SELECT *, radians(lon) AS lo, radians(lat) AS la, 6378137e0 / sqrt(1 - 0.00669437999013e0 * pow(sin(radians(lat)), 2)) AS rn FROM fixes)""")
def earth_centred(spark, sf):
    d = V.fixes(spark, sf).withColumn("e", G.blh_to_xyz(F.radians("lon"), F.radians("lat"), F.col("height")))
    d = d.withColumn("b", G.xyz_to_blh(F.col("e.x"), F.col("e.y"), F.col("e.z")))
    return d.select("id", *[(F.round(F.col(f"e.{c}"), 4) + 0.0).alias(c) for c in "xyz"],
                    F.round(F.degrees("b.lon"), 7).alias("lon"), F.round(F.degrees("b.lat"), 7).alias("lat"),
                    (F.round("b.h", 4) + 0.0).alias("h"))


@query("curvature_radii_g12", FIXES, """
SELECT id, round(6378137e0 * (1 - 2 * f + 3 * f * s * s), 4) AS rm, round(6378137e0 * (1 + f * s * s), 4) AS rn
FROM (SELECT id, 1 / 298.257223563e0 AS f, sin(radians(lat)) AS s FROM fixes)""")
def curvature_radii(spark, sf):
    return V.fixes(spark, sf).select("id", F.round(G.rm("lat"), 4).alias("rm"), F.round(G.rn("lat"), 4).alias("rn"))


@query("gps_pose_g13", LEVER, utm_sql("shifted", "slon", "slat"), """
SELECT id, round(ux - 756000, 3) + 0e0 AS x, round(uy - 4432000, 3) + 0e0 AS y, round(height - 10, 6) + 0e0 AS z,
       round(sin(radians(CASE WHEN 88.5e0 - heading < -180 THEN 448.5e0 - heading WHEN 88.5e0 - heading > 180 THEN -271.5e0 - heading ELSE 88.5e0 - heading END) / 2), 6) + 0e0 AS qz
FROM utm""")
def gps_pose(spark, sf):
    origin = spark.range(1).select(F.lit(756000.0).alias("x"), F.lit(4432000.0).alias("y"), F.lit(10.0).alias("z"))
    d = G.gps_to_pose(V.fixes(spark, sf), origin, ANTENNA)
    return d.select("id", (F.round("pose.x", 3) + 0.0).alias("x"), (F.round("pose.y", 3) + 0.0).alias("y"),
                    r6(F.col("pose.z")).alias("z"), r6(F.col("pose.qz")).alias("qz"))


@query("map_origin_g14", LEVER, utm_sql("shifted", "slon", "slat"), """
SELECT id, round(ux, 3) AS x, round(uy, 3) AS y, round(height, 6) + 0e0 AS z, CAST(floor((lon + 180) / 6) + 1 AS INT) AS zone,
       lat < 0 AS southern FROM utm""")
def map_origin(spark, sf):
    d = G.origin_from(V.fixes(spark, sf), ANTENNA)
    return d.select("id", F.round("origin.x", 3).alias("x"), F.round("origin.y", 3).alias("y"),
                    r6(F.col("origin.z")).alias("z"), "origin.zone", "origin.southern")


@query("gps_noise_g15", FIXES, """
SELECT id, CASE status WHEN 4 THEN 0.15e0 WHEN 5 THEN 0.5e0 WHEN 2 THEN 0.4e0 WHEN 1 THEN 10e0 ELSE 1e6 END AS pos,
       CASE WHEN heading_valid THEN 0.08e0 ELSE 1e6 END AS rot FROM fixes""")
def gps_noise(spark, sf):
    d = V.fixes(spark, sf).withColumn("n", C.gps_noise("status", "heading_valid"))
    return d.select("id", F.col("n")[0].alias("pos"), F.col("n")[5].alias("rot"))


@query("range_image_index_g16", POINTS, """
SELECT row, col, count(*) AS n FROM (
  SELECT CAST(trunc((degrees(atan2(z - 1, sqrt(x * x + y * y))) + 15.1e0) / 2e0) AS BIGINT) AS row,
         CAST(CASE WHEN degrees(atan2(x, y)) <= -90 THEN -trunc(degrees(atan2(x, y)) / 0.2e0) - 450
              ELSE 1350 - trunc(degrees(atan2(x, y)) / 0.2e0) END AS BIGINT) % 1800 AS col FROM points)
WHERE row >= 0 AND row < 16 GROUP BY row, col""")
def range_image_index(spark, sf):
    d = V.points(spark, sf).withColumn("c", C.range_image_index(F.col("x"), F.col("y"), F.col("z") - 1))
    return d.filter("c IS NOT NULL").groupBy("c.row", "c.col").agg(F.count(F.lit(1)).alias("n"))


@query("polar_bin_g17", POINTS, """
SELECT col, row, count(*) AS n FROM (
  SELECT CAST(trunc((CASE WHEN a < 0 THEN a + 360 ELSE a END) / 6e0) AS BIGINT) AS col, CAST(trunc(sqrt(x * x + y * y) / 4e0) AS BIGINT) AS row
  FROM (SELECT *, -degrees(atan2(y, x)) AS a FROM points)) GROUP BY col, row""")
def polar_bin(spark, sf):
    d = V.points(spark, sf).withColumn("b", C.polar_bin("x", "y"))
    return d.groupBy("b.col", "b.row").agg(F.count(F.lit(1)).alias("n"))


@query("cell_voxel_keys_g18", POINTS, """
SELECT CAST(floor(x / 0.5e0) AS BIGINT) AS cx, CAST(floor(y / 0.5e0) AS BIGINT) AS cy, CAST(trunc(x / 1.5e0) AS BIGINT) AS vx,
       CAST(trunc(y / 1.5e0) AS BIGINT) AS vy, CAST(trunc(z / 1.5e0) AS BIGINT) AS vz, count(*) AS n
FROM points GROUP BY ALL""")
def cell_voxel_keys(spark, sf):
    d = V.points(spark, sf).withColumn("c", C.cell_key("x", "y", 0.5)).withColumn("v", C.voxel_key("x", "y", "z", 1.5))
    return d.groupBy("c.cx", "c.cy", "v.vx", "v.vy", "v.vz").agg(F.count(F.lit(1)).alias("n"))


@query("quantise_g19", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(greatest(-30000, least(30000, trunc((l_extendedprice - 40000) * 2))) AS INT) AS i16,
       CAST(greatest(0, least(255, trunc(l_extendedprice / 100 - 200))) AS INT) AS u8 FROM lineitem""")
def quantise(spark, sf):
    p = F.col("l_extendedprice")
    return V.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                 C.to_i16(p - 40000, 2.0).alias("i16"), C.to_u8(p / 100 - 200).alias("u8"))


@query("remap_intensity_g20", POINTS, """
SELECT intensity, CAST(least(255, trunc(intensity * 3.25e0)) AS INT) AS mapped, count(*) AS n FROM points GROUP BY ALL""")
def remap_intensity(spark, sf):
    d = V.points(spark, sf).withColumn("mapped", C.remap_intensity("intensity", 3.25))
    return d.groupBy("intensity", "mapped").agg(F.count(F.lit(1)).alias("n"))


@query("pose_to_ground_g21", RPY, """
SELECT id, round(w, 6) + 0e0 AS yaw, round(CASE WHEN turn > pi() AND turn < 2 * pi() THEN -0.1e0 ELSE 0.1e0 END, 6) AS roll,
       round(CASE WHEN turn > pi() AND turn < 2 * pi() THEN 0.05e0 ELSE -0.05e0 END, 6) AS pitch, 7e0 AS z
FROM (SELECT *, abs(w - 2e0) AS turn FROM rpy)""")
def pose_to_ground(spark, sf):
    d = _rpy(spark, sf).withColumn("a", P.from_rpy("x", "y", "z", "r", "p", "w"))
    d = d.withColumn("ref", P.from_rpy(F.lit(1.0), F.lit(2.0), F.lit(7.0), F.lit(0.1), F.lit(-0.05), F.lit(2.0)))
    d = d.withColumn("g", P.pose_to_ground("a", "ref")).withColumn("e", P.to_rpy("g"))
    return d.select("id", *[r6(F.col(f"e.{c}")).alias(c) for c in ("yaw", "roll", "pitch", "z")])


@query("site_difficulty_g22", """
SELECT o_orderkey, CASE WHEN s = 'Indoor' THEN 3 + (g > 1.5e0)::INT + (g > 4)::INT
    WHEN s = 'Half Indoor' THEN 1 + (g > 1.5e0)::INT + (g > 3)::INT + (g > 5)::INT + (g > 10)::INT
    WHEN s = 'Outdoor' THEN 1 + (g > 3)::INT + (g > 7)::INT + (g > 15)::INT ELSE 2 END AS level
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Indoor' WHEN 'O' THEN 'Outdoor' ELSE 'Half Indoor' END AS s,
             o_totalprice * 50000 / 1073741824e0 AS g FROM orders)""")
def site_difficulty(spark, sf):
    s = F.when(F.col("o_orderstatus") == "F", "Indoor").when(F.col("o_orderstatus") == "O", "Outdoor").otherwise("Half Indoor")
    return V.table(spark, sf, "orders").select("o_orderkey", C.difficulty(s, F.col("o_totalprice") * 50000).alias("level"))


@query("angular_step_g23", POINTS, """
SELECT frame_id, round(max(acos(1 - 0.25e0 / (2 * (x * x + y * y)))), 6) AS coarsest, round(min(acos(1 - 0.25e0 / (2 * (x * x + y * y)))), 6) AS finest
FROM points WHERE x * x + y * y >= 1 GROUP BY frame_id""")
def angular_step(spark, sf):
    d = V.points(spark, sf).filter(F.col("x") * F.col("x") + F.col("y") * F.col("y") >= 1)
    a = C.angular_step(F.lit(0.5), F.hypot("x", "y"))
    return d.groupBy("frame_id").agg(F.round(F.max(a), 6).alias("coarsest"), F.round(F.min(a), 6).alias("finest"))


@query("gps_predicates_p7", FIXES, """
SELECT id, status IN (4, 5, 2, 1) AS usable, status IN (2, 0) AS low FROM fixes""")
def gps_predicates(spark, sf):
    return V.fixes(spark, sf).select("id", C.gps_usable("status").alias("usable"), C.gps_low("status").alias("low"))


# --- filters ---

def _per_frame(d):
    return d.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum("z").alias("sz"))


AGG = "SELECT frame_id, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(z) AS sz FROM points WHERE {} GROUP BY frame_id"


@query("within_range_p1", POINTS, AGG.format("sqrt(x * x + y * y) <= 20"))
def within_range(spark, sf):
    return _per_frame(grid.within_range(V.points(spark, sf), 20.0))


@query("above_ground_p2", POINTS, AGG.format("z > 1"))
def above_ground(spark, sf):
    return _per_frame(grid.above(V.points(spark, sf), 1.0))


@query("z_band_p3", POINTS, AGG.format("z > 0 AND z < 3"))
def z_band(spark, sf):
    return _per_frame(grid.z_band(V.points(spark, sf), 0.0, 3.0))


@query("ring_band_p4", POINTS, AGG.format("ring >= 2 AND ring < 5"))
def ring_band(spark, sf):
    return _per_frame(grid.ring_band(V.points(spark, sf), 2, 5))


@query("valid_returns_p5", POINTS, AGG.format("z <> 0 AND sqrt(x * x + y * y) >= 1 AND sqrt(x * x + y * y) <= 30"))
def valid_returns(spark, sf):
    d = V.points(spark, sf).withColumn("range", F.when(F.col("z") != 0, F.hypot("x", "y")))
    return _per_frame(grid.valid_returns(d, 1.0, 30.0))


@query("in_box_p6", POINTS, AGG.format("x >= -7.5e0 AND x < 12.5e0 AND y >= -5e0 AND y < 15e0"))
def in_box(spark, sf):
    return _per_frame(grid.in_box(V.points(spark, sf), 2.5, 5.0, 20.0))


@query("offset_p14", POINTS, "SELECT frame_id, count(*) AS n, sum(x - 3.5e0) AS sx, sum(y + 2.25e0) AS sy, sum(z) AS sz FROM points GROUP BY frame_id")
def offset(spark, sf):
    return _per_frame(grid.offset(V.points(spark, sf), 3.5, -2.25))


@query("to_map_points_p15", POINTS, """
SELECT frame_id, ring, count(*) AS n, sum(x) AS sx, sum(intensity) AS si, sum(0e0) AS height, sum(0) AS type FROM points
WHERE x <> 0 GROUP BY frame_id, ring""")
def to_map_points(spark, sf):
    d = V.points(spark, sf).withColumn("x", F.when(F.col("x") != 0, F.col("x")))
    return grid.to_map_points(d).groupBy("frame_id", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("intensity").alias("si"),
        F.sum("height").alias("height"), F.sum("type").alias("type"))


@query("block_sample_p10", POSES, """
SELECT trajectory_id, id FROM (SELECT trajectory_id, id, row_number() OVER (PARTITION BY trajectory_id ORDER BY t, id) AS rn FROM poses)
WHERE ((rn - 1) // 3) % 5 = 0""")
def block_sample(spark, sf):
    return grid.block_sample(V.steps(spark, sf), ["trajectory_id"], ["t", "id"], 3, 5, V.WIDTH).select("trajectory_id", "id")
