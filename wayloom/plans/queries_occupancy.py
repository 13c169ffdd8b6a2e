"""Occupancy rasters and intensity calibration over the order lines as points."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.operators import calib as CB
from wayloom.operators import occupancy as O
from wayloom.plans import views as V
from wayloom.plans.registry import query
from wayloom.plans.views import POINTS, r6


def _obs(spark, sf):
    d = V.table(spark, sf, "lineitem")
    return d.select((F.col("l_suppkey") % 4).alias("submap_id"), (F.col("l_partkey") % 40).alias("px"), (F.col("l_orderkey") % 40).alias("py"),
                    F.col("l_orderkey").alias("seq"), (F.col("l_quantity") > 20).alias("hit"))


OCC = """obs AS (SELECT l_suppkey % 4 AS submap_id, l_partkey % 40 AS px, l_orderkey % 40 AS py, l_orderkey AS seq, l_quantity > 20 AS hit FROM lineitem),
lists AS (SELECT submap_id, px, py, list(CASE WHEN hit THEN -1 ELSE 1 END ORDER BY seq, NOT hit) AS l FROM obs GROUP BY 1, 2, 3),
occ AS (SELECT submap_id, px, py, list_reduce(list_prepend(127, l), lambda v, e: CASE WHEN e < 0 THEN CASE WHEN v > 117 THEN v - 1 ELSE v END ELSE CASE WHEN v < 137 THEN v + 1 ELSE v END END) AS v FROM lists)"""


@query("occupancy_a18", OCC, "SELECT submap_id, px, py, v FROM occ")
def occupancy(spark, sf):
    return O.occupancy(_obs(spark, sf), 1000)


RASTER = """rst AS (SELECT px, py, greatest(0, least(255, 127 + sum(v - 127))) AS v FROM occ GROUP BY 1, 2),
cls AS (SELECT *, CASE WHEN v > 127 THEN 'free' WHEN v < 127 THEN 'occupied' ELSE 'unknown' END AS class FROM rst)"""


@query("merge_rasters_a19", OCC, RASTER, "SELECT px, py, v, class FROM cls")
def merge_rasters(spark, sf):
    return O.merge_rasters(O.occupancy(_obs(spark, sf)))


@query("fill_free_a20", """cells AS (SELECT l_partkey % 60 AS px, l_suppkey % 60 AS py, CASE WHEN max(l_quantity) > 25 THEN 'free' ELSE 'occupied' END AS class FROM lineitem GROUP BY 1, 2)""", """
SELECT px, py, CASE WHEN class = 'free' THEN 130 ELSE 120 END AS v, class FROM cells UNION ALL
SELECT px, py, 127, 'free' FROM (SELECT px + d.a AS px, py + d.b AS py FROM cells, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(a, b) WHERE class = 'free') n
WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.px = n.px AND c.py = n.py) GROUP BY px, py HAVING count(*) = 4
UNION ALL SELECT px, py, 127, 'unknown' FROM (SELECT px + d.a AS px, py + d.b AS py FROM cells, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(a, b) WHERE false) z""")
def fill_free(spark, sf):
    d = V.table(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 60).alias("px"), (F.col("l_suppkey") % 60).alias("py")).agg(F.max("l_quantity").alias("q"))
    r = d.select("px", "py", F.when(F.col("q") > 25, 130).otherwise(120).alias("v"), F.when(F.col("q") > 25, "free").otherwise("occupied").alias("class"))
    return O.fill_free(r)


def _planes(d):
    return d.select("frame_id").distinct().select("frame_id", F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(1.0).alias("c"), F.lit(0.5).alias("d"))


SCAN = """s2 AS (SELECT frame_id, deg, min(d) AS dist, count(DISTINCT d) AS hits FROM (
  SELECT frame_id, (CAST(round(degrees(atan2(y, x))) AS INT) + 360) % 360 AS deg, sqrt(x * x + y * y) AS d FROM (SELECT frame_id % 10 AS frame_id, x, y, z FROM points) WHERE z + 0.5e0 > 0.3e0 AND z + 0.5e0 < 4.2e0 AND sqrt(x * x + y * y + z * z) <= 80)
  GROUP BY 1, 2 HAVING count(DISTINCT d) >= 5)"""


def _scan2d(spark, sf):
    d = V.points(spark, sf).withColumn("frame_id", F.col("frame_id") % 10)
    return O.to_2d_scan(d, _planes(d), 0.3, 4.2)


@query("to_2d_scan_a21", POINTS, SCAN, "SELECT frame_id, deg, round(dist, 6) AS dist, hits FROM s2")
def to_2d_scan(spark, sf):
    return _scan2d(spark, sf).withColumn("dist", F.round("dist", 6))


@query("free_cells_a22", POINTS, SCAN, """
SELECT frame_id, round(dx, 3) AS dx, round(dy, 3) AS dy FROM (SELECT *, CASE WHEN r2 IS NULL THEN r1 WHEN sec THEN r2 WHEN fst THEN r1 ELSE r1 * (1 - s) + r2 * s END AS ray,
  radians(CASE WHEN r2 IS NULL THEN ang WHEN sec THEN deg + 1e0 WHEN fst THEN deg * 1e0 ELSE ang END) AS ra FROM (
  SELECT *, (NOT b2 AND b1) OR (NOT b1 AND NOT b2 AND abs(r1 - r2) > 0.3e0 AND s > 0.5e0) AS sec, r2 IS NULL OR b2 OR (NOT b1 AND abs(r1 - r2) > 0.3e0) AS fst FROM (
    SELECT f.frame_id, t.*, ang - t.deg AS s, coalesce(p.dist, -1e0) AS r1, CASE WHEN t.deg = 359 THEN NULL ELSE coalesce(n.dist, -1e0) END AS r2,
       coalesce(p.dist, -1e0) < 0 OR coalesce(p.dist, -1e0) > 80 AS b1, coalesce(n.dist, -1e0) < 0 OR coalesce(n.dist, -1e0) > 80 AS b2
    FROM (SELECT DISTINCT frame_id FROM s2) f CROSS JOIN (SELECT dx, dy, sqrt(dx * dx + dy * dy) AS range, a AS ang, CAST(floor(a) AS INT) % 360 AS deg FROM (
        SELECT dx, dy, CASE WHEN degrees(atan2(dy, dx)) < 0 THEN degrees(atan2(dy, dx)) + 360 ELSE degrees(atan2(dy, dx)) END AS a FROM (SELECT -10 + i.i * 0.5e0 AS dx, -10 + j.j * 0.5e0 AS dy FROM range(40) i(i), range(40) j(j)))) t
    LEFT JOIN s2 p ON p.frame_id = f.frame_id AND p.deg = t.deg LEFT JOIN s2 n ON n.frame_id = f.frame_id AND n.deg = t.deg + 1)))
WHERE range < 0.2e0 OR (ray >= 0 AND ray <= 80 AND NOT (abs(ray * cos(ra) - dx) < 0.5e0 AND abs(ray * sin(ra) - dy) < 0.5e0) AND ray > range)""")
def free_cells(spark, sf):
    d = O.free_cells(_scan2d(spark, sf), O.template(spark, 10.0, 0.5), 0.5)
    return d.select("frame_id", F.round("dx", 3).alias("dx"), F.round("dy", 3).alias("dy"))


@query("floor_plane_a23", """SELECT l_suppkey AS frame_id, count(*) >= 100 AS enough, 0e0 AS a, 0e0 AS b, 1e0 AS c FROM lineitem WHERE l_quantity <= 48 GROUP BY 1 HAVING count(*) >= 100""")
def floor_plane(spark, sf):
    # a level floor at −1 with four per cent of the points elsewhere below the cut
    p = V.points(spark, sf)
    d = p.withColumn("z", F.when(F.col("z") <= 5.0, F.lit(-1.0)).otherwise(0.1))
    r = O.floor_plane(d)
    return r.select("frame_id", (F.col("inliers") >= 100).alias("enough"), *[r6(c).alias(c) for c in "abc"])


def _readings(spark, sf):
    """Beam readings distorted by a known shift per ring."""
    p = V.points(spark, sf).withColumn("range", F.hypot("x", "y"))
    true = (F.floor((F.col("x") + 25) / 5) * 4 + F.floor((F.col("y") + 25) / 5) * 3 + 10).cast("int")
    return p.withColumn("intensity", true + F.when(F.col("ring") == 3, 2).otherwise(0))


@query("calibrate_intensity_a26")
def calibrate_intensity(spark, sf):
    return CB.calibrate_intensity(_readings(spark, sf), 5.0)


@query("top_values_a27", POINTS, """
SELECT b, a, c, rank FROM (SELECT ring AS b, intensity AS a, count(*) AS c, row_number() OVER (PARTITION BY ring ORDER BY count(*) DESC, intensity) AS rank FROM points WHERE intensity BETWEEN 0 AND 99 GROUP BY 1, 2) WHERE rank <= 5""")
def top_values(spark, sf):
    return CB.top_values(CB.measurements(V.points(spark, sf), 0.5), 5)


@query("apply_calibration_a28", POINTS, """
SELECT ring, intensity, CAST(least(CAST(trunc(CASE WHEN sqrt(x * x + y * y) < 20 AND intensity < 100 AND ring <= 4 THEN intensity + 1 ELSE intensity END * 2.5e0) AS INT), 200) AS INT) AS intensity_vi, count(*) AS n FROM points GROUP BY 1, 2, 3""")
def apply_calibration(spark, sf):
    p = V.points(spark, sf).withColumn("range", F.hypot("x", "y"))
    m = spark.range(5 * 100).select((F.col("id") / 100).cast("int").alias("b"), (F.col("id") % 100).cast("int").alias("a")).withColumn("best", F.col("a") + 1)
    d = CB.apply_calibration(p, m, 2.5, 200, 20.0)
    return d.groupBy("ring", "intensity", "intensity_vi").agg(F.count(F.lit(1)).alias("n"))


@query("intensity_coefficient_a29", POINTS, """
SELECT n, mean, CASE WHEN n < 499 OR mean < 3 THEN 2e0 WHEN mean > 30 THEN 1e0 ELSE 4 - 0.1e0 * mean END AS coef FROM (
  SELECT count(*) AS n, avg(intensity) AS mean FROM (SELECT intensity FROM points WHERE z > -0.2e0 AND z < 0.2e0 ORDER BY frame_id, x, y, z, ring, intensity LIMIT 500))""")
def intensity_coefficient(spark, sf):
    return CB.intensity_coefficient(V.points(spark, sf), ["frame_id", "x", "y", "z", "ring", "intensity"])


@query("beam_map_a30", POINTS, """
SELECT b, a, CASE WHEN p < 0.2e0 OR abs(i - a) > 5 THEN a ELSE i END AS best FROM (SELECT b, a, max(p) AS p, arg_max(i, (p, -i)) AS i FROM (
  SELECT ring AS b, intensity // 10 AS a, CAST(floor(z) AS BIGINT) + 1 AS i, count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY ring, intensity // 10) AS p FROM points GROUP BY 1, 2, 3) GROUP BY 1, 2)""")
def beam_map(spark, sf):
    d = V.points(spark, sf).groupBy(F.col("ring").alias("b"), F.floor(F.col("intensity") / 10).alias("a"), (F.floor("z") + 1).alias("i")).agg(F.count(F.lit(1)).alias("n"))
    t = d.groupBy("b", "a").agg(F.sum("n").alias("t"))
    return CB.beam_map(d.join(t, ["b", "a"]).withColumn("p", F.col("n") * 1.0 / F.col("t")), 0.2, 5)
