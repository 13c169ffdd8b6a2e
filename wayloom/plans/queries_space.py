"""Spatial joins over trajectories and points."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.operators import spatial as S
from wayloom.operators import submaps
from wayloom.plans import views as V
from wayloom.plans.registry import query
from wayloom.plans.views import POSES, r6


def _at(spark, sf, *more):
    return V.poses(spark, sf).select("id", "trajectory_id", "t", "x", "y", *more)


SITES = """sites AS (SELECT s_suppkey AS sid, (s_suppkey * 37 % 81 - 40) / 4e0 AS sx, (s_suppkey * 53 % 81 - 40) / 4e0 AS sy FROM supplier)"""


def _sites(spark, sf):
    k = F.col("s_suppkey")
    return V.table(spark, sf, "supplier").select(k.alias("sid"), ((k * 37 % 81 - 40) / 4.0).alias("sx"), ((k * 53 % 81 - 40) / 4.0).alias("sy"))


@query("radius_join_j9", POSES, SITES, """
SELECT id, sid, round(sqrt((x - sx) * (x - sx) + (y - sy) * (y - sy)), 6) AS dist FROM poses, sites
WHERE (x - sx) * (x - sx) + (y - sy) * (y - sy) <= 2.25e0""")
def radius_join(spark, sf):
    d = S.radius_join(_at(spark, sf), _sites(spark, sf), 1.5, b_at=("sx", "sy"), deal=True)
    return d.select("id", "sid", F.round("dist", 6).alias("dist"))


@query("neighbours_j10", POSES, """
SELECT a.id, count(*) AS n, round(sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 6) AS total
FROM poses a JOIN poses b ON a.trajectory_id = b.trajectory_id AND a.id <> b.id
  AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 1e0 GROUP BY a.id""")
def neighbours(spark, sf):
    a = _at(spark, sf)
    d = S.radius_join(a, S.suffixed(a, "_2", keep=["trajectory_id"]), 1.0, by=["trajectory_id"], where=F.col("id") != F.col("id_2"), deal=True)
    return d.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("dist"), 6).alias("total"))


KNN = """nn AS (SELECT p.id, s.sid, sqrt((x - sx) * (x - sx) + (y - sy) * (y - sy)) AS dist,
  row_number() OVER (PARTITION BY p.id ORDER BY (x - sx) * (x - sx) + (y - sy) * (y - sy), sid) AS rank FROM poses p, sites s)"""


@query("knn_join_j11", POSES, SITES, KNN, "SELECT id, sid AS ref_id, round(dist, 6) AS dist, rank FROM nn WHERE rank <= 3")
def knn_join(spark, sf):
    d = S.knn_join(_at(spark, sf), _sites(spark, sf), 3, ref_at=("sx", "sy"), ref_id="sid", base=0.5, levels=7)
    return d.select("id", "ref_id", F.round("dist", 6).alias("dist"), "rank")


@query("diverse_knn_j12", POSES, SITES, KNN, """/*RECURSIVE*/
SELECT id, pick, ref_id, round(dist, 6) AS dist FROM (
  SELECT id, unnest(kept) AS m, generate_subscripts(kept, 1) AS pick FROM (
    SELECT id, list_reduce(list_prepend([]::STRUCT(sid BIGINT, dist DOUBLE)[], list_transform(l, lambda e: [e])),
       lambda a, e: CASE WHEN len(a) < 3 AND len(list_filter(a, lambda m: abs(m.sid - e[1].sid) < 4)) = 0 THEN list_concat(a, e) ELSE a END) AS kept
    FROM (SELECT id, list(struct_pack(sid := sid, dist := dist) ORDER BY rank) AS l FROM nn WHERE rank <= 8 GROUP BY id))), LATERAL (SELECT m.sid AS ref_id, m.dist AS dist)""")
def diverse_knn(spark, sf):
    ref = _sites(spark, sf).select(F.col("sid").alias("id"), F.col("sx").alias("x"), F.col("sy").alias("y"), F.col("sid").alias("order_id"))
    d = S.diverse_knn(_at(spark, sf), ref, 8, 4, 3, base=0.5, levels=7)
    return d.select("id", "pick", "ref_id", F.round("dist", 6).alias("dist"))


@query("loop_pairs_j13", POSES, """
SELECT id_1, id_2, round(dist, 6) AS dist, round(cos(a1) * (x2 - x1) + sin(a1) * (y2 - y1), 6) + 0e0 AS rel_x FROM (
  SELECT *, row_number() OVER (PARTITION BY tr1, tr2, id_1 // 20, id_2 // 20 ORDER BY d2, id_1, id_2) AS rn, sqrt(d2) AS dist FROM (
    SELECT a.id AS id_1, b.id AS id_2, a.trajectory_id AS tr1, b.trajectory_id AS tr2, a.x AS x1, b.x AS x2, a.y AS y1, b.y AS y2, radians(a.k * 0.9e0) AS a1,
           (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2
    FROM poses a JOIN poses b ON a.id < b.id AND (a.trajectory_id <> b.trajectory_id OR b.id - a.id >= 100)
      AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 0.5625e0 AND a.k > 50 AND b.k > 50))
WHERE rn = 1""")
def loop_pairs(spark, sf):
    d = S.loop_pairs(V.posed(spark, sf), 0.75, 100, 20, quality="k", min_quality=50)
    return d.select("id_1", "id_2", F.round("dist", 6).alias("dist"), r6(F.col("rel.x")).alias("rel_x"))


@query("endpoint_grid_j14", POSES, """
SELECT id_1, id_2, dx, dy, angle, round(sin(radians(angle) / 2), 6) + 0e0 AS qz FROM (
  SELECT a.id AS id_1, b.id AS id_2, g1.i * 2e0 - 4 AS dx, g2.i * 2e0 - 4 AS dy, g3.i * 45e0 AS angle
  FROM e a JOIN e b ON a.map_id = b.map_id AND a.id < b.id, range(4) g1(i), range(4) g2(i), range(8) g3(i))""".replace(
    "FROM e a JOIN e b", "FROM (SELECT trajectory_id // 4 AS map_id, unnest([min(id), max(id)]) AS id FROM poses GROUP BY trajectory_id) a "
    "JOIN (SELECT trajectory_id // 4 AS map_id, unnest([min(id), max(id)]) AS id FROM poses GROUP BY trajectory_id) b"))
def endpoint_grid(spark, sf):
    ends = V.steps(spark, sf).groupBy("trajectory_id").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    ends = ends.select(F.floor(F.col("trajectory_id") / 4).alias("map_id"), F.explode(F.array("a", "b")).alias("id"))
    d = S.endpoint_grid(ends, ends, 2.0, 4.0, 45.0)
    return d.select("id_1", "id_2", "dx", "dy", "angle", r6(F.col("rel.qz")).alias("qz"))


@query("local_submap_j15", """
SELECT k.id AS key_id, count(*) AS n, round(sum(x * cos(a) - y * sin(a) + f.fx), 4) + 0e0 AS sx, round(sum(z), 6) + 0e0 AS sz
FROM (SELECT s_suppkey AS id FROM supplier) k
JOIN (SELECT s_suppkey AS id, s_suppkey * 1e0 AS fx, radians(s_nationkey * 5e0) AS a FROM supplier) f ON f.id BETWEEN k.id - 6 AND k.id + 5 AND (f.id - k.id + 6) % 3 = 0
JOIN (SELECT l_suppkey AS frame_id, (l_partkey % 400) / 8e0 - 25e0 AS x, (l_orderkey % 400) / 8e0 - 25e0 AS y, l_quantity / 8e0 - 1e0 AS z FROM lineitem) p ON p.frame_id = f.id
GROUP BY k.id""")
def local_submap(spark, sf):
    from wayloom.functions import pose as P
    kf = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.lit(0).alias("trajectory_id"),
        P.from_yaw(F.col("s_suppkey") * 1.0, F.lit(0.0), F.lit(0.0), F.radians(F.col("s_nationkey") * 5.0)).alias("pose"))
    d = S.local_submap(kf, kf, V.points(spark, sf), 6, 3)
    return d.groupBy("key_id").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum("x"), 4) + 0.0).alias("sx"), r6(F.sum("z")).alias("sz"))


@query("fitness_j18", """
SELECT pair_id, round(avg(CASE WHEN d2 <= 4 THEN d2 END), 6) AS fitness, count(CASE WHEN d2 <= 4 THEN 1 END) AS n_close FROM (
  SELECT a.frame_id AS pair_id, a.rid, min((a.x + 0.25e0 - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS d2 FROM pts a JOIN pts b
  ON a.frame_id = b.frame_id AND a.odd AND NOT b.odd GROUP BY a.frame_id, a.rid) GROUP BY pair_id""".replace(
    "FROM pts a JOIN pts b", "FROM {p} a JOIN {p} b").format(p="""(SELECT l_suppkey AS frame_id, (l_partkey % 400) / 8e0 - 25e0 AS x, (l_orderkey % 400) / 8e0 - 25e0 AS y,
  l_quantity / 8e0 - 1e0 AS z, l_linenumber >= 5 AS odd, rowid AS rid FROM (SELECT *, row_number() OVER () AS rowid FROM lineitem))"""))
def fitness(spark, sf):
    from wayloom.functions import pose as P
    d = V.points(spark, sf).withColumnRenamed("frame_id", "pair_id")
    src = d.filter("ring >= 5")
    tgt = d.filter("ring < 5").withColumn("pt", F.xxhash64("x", "y", "z"))
    poses = d.select("pair_id").distinct().withColumn("pose", P.make(F.lit(0.25), F.lit(0.0), F.lit(0.0)))
    out = S.fitness(src, tgt, poses, 4.0, base=1.0, levels=6)
    return out.select("pair_id", F.round("fitness", 6).alias("fitness"), "n_close")


@query("compare_paths_j19", POSES, """
SELECT id, dx AS err_x, dy AS err_y, round(CASE WHEN h > 180 THEN h - 360 WHEN h < -180 THEN h + 360 ELSE h END, 6) + 0e0 AS err_heading,
  abs(dx) > 0.5e0 OR abs(dy) > 0.5e0 OR abs(CASE WHEN h > 180 THEN h - 360 WHEN h < -180 THEN h + 360 ELSE h END) > 60e0 AS large
FROM (SELECT *, k * 0.9e0 - (id % 9 - 4) * 20e0 AS h FROM poses)""")
def compare_paths(spark, sf):
    from wayloom.functions import pose as P
    d = V.posed(spark, sf)
    other = d.select("id", P.from_yaw(F.col("x") - F.col("dx"), F.col("y") - F.col("dy"), "z", F.radians((F.col("id") % 9 - 4) * 20.0)).alias("pose"))
    out = S.compare_paths(d.select("id", "pose"), other, 0.5, 60.0)
    return out.select("id", "err_x", "err_y", r6("err_heading").alias("err_heading"), "large")


@query("ground_raster_j22", POSES, """
SELECT row, col, arg_min(z, (d2, id)) AS ground FROM (
  SELECT r.i AS row, c.i AS col, p.z, p.id, ((c.i + 0.5e0) * b.res - p.x) ** 2 + ((r.i + 0.5e0) * b.res - p.y) ** 2 AS d2
  FROM (SELECT floor(min(x) / 2e0) AS x0, floor(max(x) / 2e0) AS x1, floor(min(y) / 2e0) AS y0, floor(max(y) / 2e0) AS y1, 2e0 AS res FROM poses) b,
       range(-400, 400) r(i), range(-400, 400) c(i), (SELECT x, y, arg_min(z, id) AS z, min(id) AS id FROM poses GROUP BY x, y) p
  WHERE r.i BETWEEN b.y0 AND b.y1 AND c.i BETWEEN b.x0 AND b.x1) GROUP BY row, col""")
def ground_raster(spark, sf):
    return S.ground_raster(V.posed(spark, sf), 2.0, base=0.5, levels=8).select("row", "col", "ground")


LEVEL = "EXISTS (SELECT 1 FROM poses b WHERE b.event_type = 'purchase' AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 0.25e0 AND abs(a.z - b.z) >= 0.4e0)"


@query("same_level_j23", POSES, f"SELECT id, trajectory_id FROM poses a WHERE event_type = 'click' AND NOT {LEVEL}")
def same_level(spark, sf):
    d = V.poses(spark, sf)
    members = d.filter("event_type = 'purchase'")
    return S.same_level(d.filter("event_type = 'click'"), members, 0.5, 0.4).select("id", "trajectory_id")


@query("revisits_j26", POSES, """
SELECT trajectory_id, id, arg_min(id2, (d2, id2)) AS earlier_id, round(sqrt(min(d2)), 6) AS dist FROM (
  SELECT a.trajectory_id, a.id, b.id AS id2, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM poses a JOIN poses b
  ON a.trajectory_id = b.trajectory_id AND a.t - b.t >= 172800 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 4e0) GROUP BY ALL""")
def revisits(spark, sf):
    return S.revisits(_at(spark, sf), 2.0, 172_800.0).withColumn("dist", F.round("dist", 6))


@query("pair_window_j28", POSES, """
SELECT DISTINCT n1.id AS n_1, n2.id AS n_2 FROM (SELECT id, trajectory_id, lead(id, 3) OVER (PARTITION BY trajectory_id ORDER BY id) AS id2 FROM poses) p
JOIN poses o ON o.id = p.id2
JOIN poses n1 ON n1.id BETWEEN p.id - 10 AND p.id + 10 AND n1.trajectory_id = p.trajectory_id
JOIN poses n2 ON n2.id BETWEEN p.id2 - 10 AND p.id2 + 10 AND n2.trajectory_id = o.trajectory_id""")
def pair_window(spark, sf):
    from wayloom.operators.ordered import blocked, near, tidy
    d = V.steps(spark, sf).select("id", "trajectory_id", F.col("id").cast("double").alias("o"))
    p = tidy(near(blocked(d, ["trajectory_id"], ["o"], 5000.0), ["trajectory_id"], 0, 3, {"id_2": lambda w: F.lead("id", 3).over(w)}))
    return S.pair_window(p.filter("id_2 IS NOT NULL").select(F.col("id").alias("id_1"), "id_2"), d, 10)


@query("topology_r12", POSES, """
SELECT map_1, map_2, id_1, id_2 FROM (
  SELECT lag(m) OVER w AS m0, m, lag(id) OVER w AS id0, id, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d
  FROM (SELECT *, CAST(floor(x / 2e0) AS BIGINT) AS m FROM poses) WINDOW w AS (PARTITION BY trajectory_id ORDER BY id)),
  LATERAL (SELECT m0 AS map_1, m AS map_2, id0 AS id_1, id AS id_2 UNION ALL SELECT m, m0, id, id0) u
WHERE m0 <> m AND d <= 3""")
def topology(spark, sf):
    d = _at(spark, sf).withColumn("map_id", F.floor(F.col("x") / 2))
    return submaps.topology(d, 3.0, width=5000.0)
