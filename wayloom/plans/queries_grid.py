"""Cells, voxels, tiles and assembled maps over the order lines as points."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import grid as O
from wayloom.operators import mixture, place
from wayloom.operators.sequence import step_distance
from wayloom.plans import views as V
from wayloom.plans.registry import query
from wayloom.plans.views import POINTS, POSES, r6

VOX = "CAST(trunc(x / 2e0) AS BIGINT) AS vx, CAST(trunc(y / 2e0) AS BIGINT) AS vy, CAST(trunc(z / 2e0) AS BIGINT) AS vz"


@query("voxel_first_a1", POINTS, f"""
SELECT frame_id, x, y, z, intensity, ring FROM (SELECT *, row_number() OVER (PARTITION BY vx, vy, vz ORDER BY frame_id, x, y, z, intensity, ring) AS rn
FROM (SELECT *, {VOX} FROM points)) WHERE rn = 1""")
def voxel_first(spark, sf):
    return O.voxel_first(V.points(spark, sf), 2.0, ["frame_id", "x", "y", "z", "intensity", "ring"])


@query("voxel_centroid_a2", POINTS, """
SELECT CAST(floor(x) AS BIGINT) AS vx, CAST(floor(y) AS BIGINT) AS vy, CAST(floor(z) AS BIGINT) AS vz, round(avg(x), 6) + 0e0 AS x,
  round(avg(y), 6) + 0e0 AS y, round(avg(z), 6) + 0e0 AS z, round(avg(intensity), 6) AS intensity, count(*) AS n FROM points GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3"))
def voxel_centroid(spark, sf):
    d = O.voxel_centroid(V.points(spark, sf), 1.0)
    return d.select("vx", "vy", "vz", *[r6(c).alias(c) for c in "xyz"], F.round("intensity", 6).alias("intensity"), "n")


@query("voxel_sums_a3", POINTS, """
SELECT frame_id, CAST(floor(x / 8e0) AS BIGINT) AS vx, CAST(floor(y / 8e0) AS BIGINT) AS vy, CAST(floor(z / 8e0) AS BIGINT) AS vz, count(*) AS n,
  round(covar_samp(x, x) + 1e-9, 5) + 0e0 AS cxx, round(covar_samp(x, y) + 1e-9, 5) + 0e0 AS cxy, round(covar_samp(y, z) + 1e-9, 5) + 0e0 AS cyz FROM points GROUP BY 1, 2, 3, 4 HAVING count(*) >= 6""")
def voxel_sums(spark, sf):
    s = O.voxel_sums(V.points(spark, sf), 8.0, ["frame_id"]).filter("n >= 6")

    def cov(a, b):
        return (F.round((F.col(f"s{a}{b}") - F.col(f"s{a}") * F.col(f"s{b}") / F.col("n")) / (F.col("n") - 1) + 1e-9, 5) + 0.0).alias(f"c{a}{b}")

    return s.select("frame_id", "vx", "vy", "vz", "n", cov("x", "x"), cov("x", "y"), cov("y", "z"))


@query("voxel_gaussians_a3")
def voxel_gaussians(spark, sf):
    return O.voxel_gaussians(V.points(spark, sf), 4.0)


CELLS = """cells AS (SELECT CAST(trunc(y / 1.5e0) AS BIGINT) AS row, CAST(trunc(x / 1.5e0) AS BIGINT) AS col, CASE WHEN z < 2 THEN 0 ELSE 1 END AS layer, count(*) AS n,
  avg(z) AS ma, var_pop(z) AS va, avg(intensity) AS mi, var_pop(intensity) AS vi FROM points GROUP BY 1, 2, 3)"""


@query("cell_stats_a4", POINTS, CELLS, """
SELECT row, col, layer, n, round(ma + 1e-9, 6) + 0e0 AS mean_alt, round(va + 1e-9, 6) + 0e0 AS var_alt, round(mi + 1e-9, 6) + 0e0 AS mean_int, round(vi + 1e-9, 6) + 0e0 AS var_int FROM cells""")
def cell_stats(spark, sf):
    d = O.cell_stats(V.points(spark, sf), 1.5, 2.0)
    return d.select("row", "col", "layer", "n", *[r6(F.col(c) + 1e-9).alias(c) for c in ("mean_alt", "var_alt", "mean_int", "var_int")])


@query("cell_pyramid_a5", POINTS, """
SELECT l.i AS level, CAST(trunc(y / (0.5e0 * pow(2, l.i))) AS BIGINT) AS row, CAST(trunc(x / (0.5e0 * pow(2, l.i))) AS BIGINT) AS col, CASE WHEN z < 2 THEN 0 ELSE 1 END AS layer,
  count(*) AS n, round(avg(z) + 1e-9, 6) + 0e0 AS mean_alt, round(var_pop(z) + 1e-9, 5) + 0e0 AS var_alt, round(avg(intensity) + 1e-9, 6) + 0e0 AS mean_int, round(var_pop(intensity) + 1e-9, 5) + 0e0 AS var_int
FROM points, range(4) l(i) GROUP BY 1, 2, 3, 4""")
def cell_pyramid(spark, sf):
    d = O.cell_pyramid(V.points(spark, sf), 0.5, 4, 2.0)
    return d.select("level", "row", "col", "layer", "n", *[r6(F.col(c) + 1e-9).alias(c) for c in ("mean_alt", "mean_int")],
                    *[(F.round(F.col(c) + 1e-9, 5) + 0.0).alias(c) for c in ("var_alt", "var_int")])


@query("scan_logp_a6", POINTS, CELLS, """
SELECT frame_id, a.i AS d_row, b.i AS d_col, round(avg(CASE WHEN c.n >= 2 THEN greatest(-ln(va + 0.1e0) - (ma - z) ** 2 / (va + 0.1e0) - ln(vi + 0.5e0) - (mi - intensity) ** 2 / (vi + 0.5e0), ln(1e-5)) ELSE ln(1e-5) END), 6) AS logp
FROM points p CROSS JOIN range(-1, 2) a(i) CROSS JOIN range(-1, 2) b(i) LEFT JOIN cells c ON c.row = CAST(trunc(y / 1.5e0) AS BIGINT) + a.i AND c.col = CAST(trunc(x / 1.5e0) AS BIGINT) + b.i
  AND c.layer = CASE WHEN z < 2 THEN 0 ELSE 1 END GROUP BY frame_id, a.i, b.i""".replace("(ma - z) ** 2", "pow(ma - z, 2)").replace("(mi - intensity) ** 2", "pow(mi - intensity, 2)"))
def scan_logp(spark, sf):
    p = V.points(spark, sf)
    d = O.scan_logp(p, O.cell_stats(p, 1.5, 2.0), 1, 1.5, 2.0, ["frame_id"])
    return d.withColumn("logp", F.round("logp", 6))


@query("gmm_em_a7")
def gmm_em(spark, sf):
    return mixture.gmm_em(V.points(spark, sf), 2.0, min_n=6)


@query("gmm_kmeans_a8")
def gmm_kmeans(spark, sf):
    return mixture.gmm_kmeans(V.points(spark, sf), 2.0, min_n=7)


@query("gmm_split_a9", POINTS, """
SELECT row, col, n, CASE WHEN n2 <= 1 THEN 100 WHEN n1 > 1 THEN 50 ELSE 0 END AS w1, CASE WHEN n2 <= 1 THEN 0 WHEN n1 > 1 THEN 50 ELSE 100 END AS w2,
  CASE WHEN n1 > 1 THEN CAST(trunc(round(a1 * 100, 6)) AS INT) ELSE 0 END AS ua1, CASE WHEN n1 > 1 THEN CAST(trunc(round(v1 * 100, 6)) AS INT) ELSE 0 END AS sa1,
  CASE WHEN n1 > 1 THEN CAST(trunc(round(i1, 6)) AS INT) ELSE 0 END AS ur1, CASE WHEN n1 > 1 THEN CAST(trunc(round(w1v, 6)) AS INT) ELSE 0 END AS sr1,
  CASE WHEN n2 > 1 THEN CAST(trunc(round(a2 * 100, 6)) AS INT) ELSE 0 END AS ua2, CASE WHEN n2 > 1 THEN CAST(trunc(round(v2 * 100, 6)) AS INT) ELSE 0 END AS sa2,
  CASE WHEN n2 > 1 THEN CAST(trunc(round(i2, 6)) AS INT) ELSE 0 END AS ur2, CASE WHEN n2 > 1 THEN CAST(trunc(round(w2v, 6)) AS INT) ELSE 0 END AS sr2
FROM (SELECT CAST(floor(y / 2e0) AS BIGINT) AS row, CAST(floor(x / 2e0) AS BIGINT) AS col, count(*) AS n, count(*) FILTER (z < 2) AS n1, count(*) FILTER (z >= 2) AS n2,
  avg(z) FILTER (z < 2) AS a1, var_pop(z) FILTER (z < 2) AS v1, avg(intensity) FILTER (z < 2) AS i1, var_pop(intensity) FILTER (z < 2) AS w1v,
  avg(z) FILTER (z >= 2) AS a2, var_pop(z) FILTER (z >= 2) AS v2, avg(intensity) FILTER (z >= 2) AS i2, var_pop(intensity) FILTER (z >= 2) AS w2v FROM points GROUP BY 1, 2) WHERE n >= 6""")
def gmm_split(spark, sf):
    return O.gmm_split(V.points(spark, sf), 2.0)


@query("choose_min_points_a10", POINTS, """
SELECT min(n) - 1 AS min_points FROM (SELECT n, count(*) AS c, sum(count(*)) OVER () AS t, max(n) OVER () AS m FROM (
  SELECT floor(x / 2e0), floor(y / 2e0), count(*) AS n FROM points GROUP BY 1, 2) GROUP BY n) WHERE n < m AND c * 100e0 / t >= 0.1e0 AND c * 100e0 / t < 2.1e0""")
def choose_min_points(spark, sf):
    return O.choose_min_points(V.points(spark, sf), 2.0)


@query("bounds_a11", POINTS, """
SELECT frame_id, min(x) - 1.5e0 AS min_x, max(x) + 1.5e0 AS max_x, min(y) - 1.5e0 AS min_y, max(y) + 1.5e0 AS max_y,
  CAST(floor((max(x) - min(x) + 3e0) / 2e0) AS BIGINT) + 1 AS cols, CAST(floor((max(y) - min(y) + 3e0) / 2e0) AS BIGINT) + 1 AS rows FROM points GROUP BY frame_id""")
def bounds(spark, sf):
    return O.bounds(V.points(spark, sf), 1.5, 2.0, ["frame_id"])


@query("place_descriptor_a15", POINTS, """
SELECT frame_id, col, row, max(z + 10) AS h FROM (
  SELECT *, CAST(trunc((CASE WHEN a < 0 THEN a + 360 ELSE a END) / 6e0) AS BIGINT) AS col, CAST(trunc(sqrt(x * x + y * y) / 4e0) AS BIGINT) AS row
  FROM (SELECT *, -degrees(atan2(y, x)) AS a FROM points)) WHERE col < 60 AND row < 20 AND z + 10 > 0 AND z + 10 < 100 GROUP BY 1, 2, 3""")
def place_descriptor(spark, sf):
    return place.place_descriptor(V.points(spark, sf))


@query("descriptor_arrays_a15", POINTS, """
SELECT frame_id, round(sum(h), 6) AS total, count(*) AS bins FROM (SELECT frame_id, col, row, max(z + 10) AS h FROM (
  SELECT *, CAST(trunc((CASE WHEN a < 0 THEN a + 360 ELSE a END) / 6e0) AS BIGINT) AS col, CAST(trunc(sqrt(x * x + y * y) / 4e0) AS BIGINT) AS row
  FROM (SELECT *, -degrees(atan2(y, x)) AS a FROM points)) WHERE col < 60 AND row < 20 GROUP BY 1, 2, 3) GROUP BY frame_id""")
def descriptor_arrays(spark, sf):
    d = place.descriptor_arrays(place.place_descriptor(V.points(spark, sf)))
    return d.select("frame_id", F.round(F.aggregate("descriptor", F.lit(0.0), lambda a, e: a + e), 6).alias("total"),
                    F.size(F.filter("descriptor", lambda e: e > 0)).cast("long").alias("bins"))


@query("tiles_a24", POINTS, """
SELECT tile_x, tile_y, vx, vy, vz, round(x, 6) + 0e0 AS x, round(z, 6) + 0e0 AS z, n, concat_ws('_', tile_y, tile_x, '10') AS tile FROM (
  SELECT *, sum(n) OVER w AS raw, count(*) OVER w AS thin FROM (
    SELECT CAST(floor(x / 10e0) AS BIGINT) AS tile_x, CAST(floor(y / 10e0) AS BIGINT) AS tile_y, CAST(floor(x) AS BIGINT) AS vx, CAST(floor(y) AS BIGINT) AS vy,
      CAST(floor(z) AS BIGINT) AS vz, avg(x) AS x, avg(z) AS z, count(*) AS n FROM points GROUP BY 1, 2, 3, 4, 5)
  WINDOW w AS (PARTITION BY tile_x, tile_y)) WHERE raw >= 10 AND thin >= 10""")
def tiles(spark, sf):
    d = O.tiles(V.points(spark, sf), 10.0, 1.0, 10)
    return d.select("tile_x", "tile_y", "vx", "vy", "vz", r6("x").alias("x"), r6("z").alias("z"), "n", "tile")


@query("tile_gmm_a25")
def tile_gmm(spark, sf):
    return mixture.tile_gmm(V.points(spark, sf), 10.0, 2.0)


@query("assemble_map_a39", POINTS, """
SELECT trajectory_id, chunk, CAST(floor(x / 4e0) AS BIGINT) AS vx, CAST(floor(y / 4e0) AS BIGINT) AS vy, CAST(floor(z / 4e0) AS BIGINT) AS vz, round(avg(x), 6) + 0e0 AS x, round(avg(y), 6) + 0e0 AS y, round(avg(z), 6) + 0e0 AS z, count(*) AS n
FROM (SELECT tr AS trajectory_id, frame_id, chunk, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM (
    SELECT s_nationkey AS tr, frame_id, (row_number - 1) // 2 AS chunk, p.x + s_suppkey / 8e0 AS x, p.y - s_suppkey / 4e0 AS y, p.z
    FROM points p JOIN (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS row_number FROM supplier) ON s_suppkey = frame_id)
  GROUP BY tr, frame_id, chunk, floor(x / 4e0), floor(y / 4e0), floor(z / 4e0)) GROUP BY 1, 2, 3, 4, 5""")
def assemble_map(spark, sf):
    k = F.col("s_suppkey")
    kf = V.table(spark, sf, "supplier").select(k.alias("id"), F.col("s_nationkey").alias("trajectory_id"),
                                               P.make(k / 8.0, -k / 4.0, F.lit(0.0)).alias("pose"))
    d = O.assemble_map(kf, V.points(spark, sf).drop("intensity", "ring"), "pose", 4.0, 2)
    return d.select("trajectory_id", "chunk", "vx", "vy", "vz", *[r6(c).alias(c) for c in "xyz"], "n")


@query("step_distance_w3", POSES, """
SELECT id, round(coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0), 6) AS step FROM poses WINDOW w AS (PARTITION BY trajectory_id ORDER BY t)""")
def step_dist(spark, sf):
    d = step_distance(V.poses(spark, sf), ["trajectory_id"], ["t"], V.WIDTH)
    return d.select("id", F.round("step", 6).alias("step"))
