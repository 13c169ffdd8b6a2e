"""Time-aware joins: clicks ask, purchases answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import geodesy as G
from wayloom.functions import pose as P
from wayloom.operators import asof as A
from wayloom.operators import grid, place, sequence
from wayloom.plans import views as V
from wayloom.plans.queries_functions import flat
from wayloom.plans.registry import query
from wayloom.plans.views import FIXES, POSES, r6

BY = ["trajectory_id"]
GAP, NEAR = 172_800.0, 43_200.0  # the tables' events are hours apart, not tenths of a second


def _sides(spark, sf):
    d = V.posed(spark, sf)
    q = d.filter("event_type = 'click'").select("trajectory_id", "id", "t")
    s = d.filter("event_type = 'purchase'").select("trajectory_id", "t", "pose", F.col("id").alias("sid"), "k")
    return q, s


SIDES = POSES + """,
q AS (SELECT trajectory_id, id, t FROM poses WHERE event_type = 'click'),
s AS (SELECT trajectory_id, t, id AS sid, x, y, z, k, radians(k * 0.9e0) AS a FROM poses WHERE event_type = 'purchase'),
pv AS (SELECT q.*, s.t AS t1, s.sid AS sid1, s.x AS x1, s.y AS y1, s.z AS z1, s.a AS a1 FROM q ASOF LEFT JOIN s ON q.trajectory_id = s.trajectory_id AND q.t > s.t),
br AS (SELECT pv.*, s.t AS t2, s.sid AS sid2, s.x AS x2, s.y AS y2, s.z AS z2, s.a AS a2 FROM pv ASOF LEFT JOIN s ON pv.trajectory_id = s.trajectory_id AND pv.t <= s.t),
fr AS (SELECT *, CASE WHEN t1 IS NOT NULL AND t2 IS NOT NULL THEN (t - t1) / (t2 - t1) WHEN t2 = t THEN 1e0 END AS f FROM br)"""

INTERP = """SELECT id, trajectory_id, CASE WHEN f < 0.5 THEN sid1 WHEN f >= 0.5 THEN sid2 END AS sid,
  round(CASE WHEN t1 IS NULL THEN x2 ELSE x1 * (1 - f) + x2 * f END, 6) + 0e0 AS x,
  round(CASE WHEN t1 IS NULL THEN y2 ELSE y1 * (1 - f) + y2 * f END, 6) + 0e0 AS y,
  round(CASE WHEN t1 IS NULL THEN z2 ELSE z1 * (1 - f) + z2 * f END, 6) + 0e0 AS z,
  round(sin((CASE WHEN t1 IS NULL THEN a2 ELSE a1 + (a2 - a1) * f END) / 2), 6) + 0e0 AS qz FROM """


@query("asof_interpolate_j1", SIDES, INTERP + "(SELECT * REPLACE (CASE WHEN f IS NULL THEN NULL ELSE x2 END AS x2, CASE WHEN f IS NULL THEN NULL ELSE y2 END AS y2, CASE WHEN f IS NULL THEN NULL ELSE z2 END AS z2, CASE WHEN f IS NULL THEN NULL ELSE a2 END AS a2) FROM fr)")
def asof_interpolate(spark, sf):
    q, s = _sides(spark, sf)
    d = A.asof_interpolate(q, s, BY, width=V.WIDTH)
    return d.select("id", "trajectory_id", F.col("s_sid").alias("sid"), *[c for i, c in enumerate(flat("pose")) if i in (0, 1, 2, 5)])


@query("asof_interpolate_tolerance_j2", SIDES, f"""
SELECT id, trajectory_id, CASE WHEN ok THEN CASE WHEN f < 0.5 THEN sid1 ELSE sid2 END END AS sid,
  CASE WHEN ok THEN round(CASE WHEN t1 IS NULL THEN x2 ELSE x1 * (1 - f) + x2 * f END, 6) + 0e0 END AS x
FROM (SELECT *, coalesce(f IS NOT NULL AND (t1 IS NULL OR t2 - t1 <= {GAP}) AND abs(CASE WHEN f < 0.5 THEN t1 ELSE t2 END - t) <= {NEAR}, false) AS ok FROM fr)""")
def asof_interpolate_tolerance(spark, sf):
    q, s = _sides(spark, sf)
    d = A.asof_interpolate(q, s, BY, max_gap=GAP, max_dist=NEAR, width=V.WIDTH)
    return d.select("id", "trajectory_id", F.col("s_sid").alias("sid"), r6(F.col("pose.x")).alias("x"))


NEAREST = """nr AS (SELECT *, CASE WHEN t2 IS NULL THEN sid1 WHEN t1 IS NULL THEN sid2 WHEN t - t1 <= t2 - t THEN sid1 ELSE sid2 END AS sid,
  CASE WHEN t2 IS NULL THEN t1 WHEN t1 IS NULL THEN t2 WHEN t - t1 <= t2 - t THEN t1 ELSE t2 END AS st FROM br)"""


@query("asof_nearest_j3", SIDES, NEAREST, f"""
SELECT id, CASE WHEN abs(st - t) <= {NEAR} THEN sid END AS sid, CASE WHEN abs(st - t) <= {NEAR} THEN round(st, 6) END AS s_t FROM nr""")
def asof_nearest(spark, sf):
    q, s = _sides(spark, sf)
    d = A.asof_nearest(q, s, BY, tol=NEAR, width=V.WIDTH)
    return d.select("id", F.col("s_sid").alias("sid"), F.round("s_t", 6).alias("s_t"))


@query("asof_backward_j4", SIDES, """
SELECT q.id, s.sid, round(s.t, 6) AS s_t FROM q ASOF LEFT JOIN s ON q.trajectory_id = s.trajectory_id AND q.t >= s.t""")
def asof_backward(spark, sf):
    q, s = _sides(spark, sf)
    d = A.asof_backward(q, s, BY, width=V.WIDTH)
    return d.select("id", F.col("s_sid").alias("sid"), F.round("s_t", 6).alias("s_t"))


@query("asof_triplet_j5", SIDES, NEAREST, """
SELECT nr.id, nr.sid, round(st, 6) AS s_t, round(b.bt, 6) AS before_t, round(b.at, 6) AS after_t FROM nr
LEFT JOIN (SELECT sid, lag(t) OVER w AS bt, lead(t) OVER w AS at FROM s WINDOW w AS (PARTITION BY trajectory_id ORDER BY t)) b ON b.sid = nr.sid""")
def asof_triplet(spark, sf):
    q, s = _sides(spark, sf)
    d = A.asof_triplet(q, s.drop("pose"), BY, width=V.WIDTH)
    return d.select("id", F.col("s_sid").alias("sid"), F.round("s_t", 6).alias("s_t"),
                    F.round("s_before_t", 6).alias("before_t"), F.round("s_after_t", 6).alias("after_t"))


@query("attach_scans_j6", SIDES, NEAREST, f"""
SELECT nr.id, nr.sid, s.k AS n_points FROM nr JOIN s ON s.sid = nr.sid WHERE abs(st - nr.t) <= {NEAR} AND s.k > 10""")
def attach_scans(spark, sf):
    q, s = _sides(spark, sf)
    scans = s.drop("pose").withColumn("n_points", F.when(F.col("k") > 10, F.col("k")).otherwise(0)).drop("k")
    d = A.attach_scans(q, scans, BY, tol=NEAR, width=V.WIDTH)
    return d.select("id", F.col("scan_sid").alias("sid"), F.col("scan_n_points").alias("n_points"))


@query("restamp_j7", POSES, f"""
SELECT q.id, d.id AS dr_id, g.gap AS gps_gap FROM (SELECT id, trajectory_id, t + 1800 AS t FROM poses WHERE event_type = 'click') q
LEFT JOIN LATERAL (SELECT max(s.t) AS t1 FROM poses s WHERE s.event_type = 'purchase' AND s.trajectory_id = q.trajectory_id AND s.t < q.t) p ON true
LEFT JOIN LATERAL (SELECT min(s.t) AS t2 FROM poses s WHERE s.event_type = 'purchase' AND s.trajectory_id = q.trajectory_id AND s.t >= q.t) n ON true
LEFT JOIN LATERAL (SELECT CASE WHEN n.t2 - p.t1 <= {GAP} AND least(q.t - p.t1, n.t2 - q.t) <= {NEAR} THEN round(n.t2 - p.t1, 3) END AS gap) g ON true
LEFT JOIN (SELECT qid, arg_min(id, (abs(dt), dt)) AS id FROM (SELECT q2.id AS qid, s.id, s.t - q2.t - 1800 AS dt FROM poses q2 JOIN poses s
   ON q2.event_type = 'click' AND s.event_type = 'view' AND s.trajectory_id = q2.trajectory_id) GROUP BY qid) d ON d.qid = q.id""")
def restamp(spark, sf):
    d = V.posed(spark, sf)
    frames = d.filter("event_type = 'click'").select("trajectory_id", "id", (F.col("t") + 1800).alias("scan_t"))
    gps = d.filter("event_type = 'purchase'").select("trajectory_id", "t", "pose", F.col("t").alias("at"))
    dr = d.filter("event_type = 'view'").select("trajectory_id", "t", F.col("id").alias("of"))
    b = A.bracket(frames.withColumnRenamed("scan_t", "t"), gps.select("trajectory_id", "t"), BY, width=V.WIDTH)
    gap = b.select("id", F.round(F.col("_next.t") - F.col("_prev.t"), 3).alias("gap"))
    out = A.restamp(frames, gps, dr, BY, max_gap=GAP, max_dist=NEAR, width=V.WIDTH)
    out = out.join(gap, "id")
    return out.select("id", F.col("dr_of").alias("dr_id"), F.when(F.col("gps_at").isNotNull(), F.col("gap")).alias("gps_gap"))


@query("scan_window_poses_j8", POSES, f"""
SELECT w.id, a.id AS start_id, b.id AS end_id FROM (SELECT id, trajectory_id, t AS t0, t + k * 1000 AS t1 FROM poses WHERE event_type = 'click' AND k * 1000 BETWEEN 20000 AND 80000) w
JOIN (SELECT qid, arg_min(id, (abs(dt), dt)) AS id, min(abs(dt)) AS m FROM (SELECT q.id AS qid, s.id, s.t - q.t AS dt FROM poses q JOIN poses s ON q.event_type = 'click' AND s.event_type = 'purchase' AND s.trajectory_id = q.trajectory_id) GROUP BY qid) a ON a.qid = w.id AND a.m <= {NEAR}
JOIN (SELECT qid, arg_min(id, (abs(dt), dt)) AS id, min(abs(dt)) AS m FROM (SELECT q.id AS qid, s.id, s.t - q.t - q.k * 1000 AS dt FROM poses q JOIN poses s ON q.event_type = 'click' AND s.event_type = 'purchase' AND s.trajectory_id = q.trajectory_id) GROUP BY qid) b ON b.qid = w.id AND b.m <= {NEAR}""")
def scan_window_poses(spark, sf):
    d = V.posed(spark, sf)
    scans = d.filter("event_type = 'click'").select("trajectory_id", "id", F.col("t").alias("t_start"), (F.col("t") + F.col("k") * 1000).alias("t_end"))
    s = d.filter("event_type = 'purchase'").select("trajectory_id", "t", F.col("id").alias("of"))
    out = A.scan_window_poses(scans, s, BY, shortest=20_000.0, longest=80_000.0, tol=NEAR, width=V.WIDTH)
    return out.select("id", F.col("start_of").alias("start_id"), F.col("end_of").alias("end_id"))


@query("suggest_id_j29", POSES, """
SELECT w.trajectory_id, w.id, min(p.id) AS suggested_id FROM (SELECT trajectory_id, id + 1 AS id FROM poses) w
LEFT JOIN poses p ON p.trajectory_id = w.trajectory_id AND p.id >= w.id GROUP BY w.trajectory_id, w.id""")
def suggest_id(spark, sf):
    d = V.steps(spark, sf)
    return A.suggest_id(d.select("trajectory_id", (F.col("id") + 1).alias("id")), d.select("trajectory_id", "id"), BY, 5000.0)


@query("place_marks_j20", SIDES, """
SELECT id, round(x, 6) + 0e0 AS x, round(degrees(a), 6) + 0e0 AS heading, row_number() OVER (PARTITION BY mark ORDER BY t, id) AS number
FROM (SELECT *, id % 7 AS mark, CASE WHEN t1 IS NULL THEN x2 ELSE x1 * (1 - f) + x2 * f END AS x, CASE WHEN t1 IS NULL THEN a2 ELSE a1 + (a2 - a1) * f END AS a FROM fr WHERE f IS NOT NULL)""")
def place_marks(spark, sf):
    q, s = _sides(spark, sf)
    marks = q.withColumn("mark_id", F.col("id") % 7)
    d = place.place_marks(marks, s, (500000.0, 4400000.0), 50, False, BY, width=V.WIDTH, order=["t", "id"])
    return d.select("id", r6("x").alias("x"), r6("heading").alias("heading"), "number")


@query("place_images_j21", SIDES, """
SELECT sid AS frame_id, arg_min(id, (t, id)) AS image_id FROM (SELECT *, CASE WHEN f < 0.5 THEN sid1 ELSE sid2 END AS sid FROM fr WHERE f IS NOT NULL) GROUP BY sid""")
def place_images(spark, sf):
    q, s = _sides(spark, sf)
    frames = s.withColumnRenamed("sid", "frame_id")
    return place.place_images(q.withColumnRenamed("id", "image_id"), frames, BY, width=V.WIDTH).select("frame_id", "image_id")


@query("messages_of_trajectory_j24", """
SELECT e.user_id AS trajectory_id, e.event_type AS topic, count(*) AS n, min(epoch_us(e.ts)) AS first_us FROM events e
WHERE e.event_type IN ('click', 'view') AND EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.value > 20)
GROUP BY ALL""")
def messages_of_trajectory(spark, sf):
    e = V.table(spark, sf, "events").withColumnRenamed("event_type", "topic")
    files = e.filter("topic = 'purchase' AND value > 20").select("user_id")
    d = place.messages_of(e, files, ["user_id"], ["click", "view"])
    return d.groupBy(F.col("user_id").alias("trajectory_id"), "topic").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("first_us"))


CHAIN = """ord AS (SELECT *, row_number() OVER (PARTITION BY trajectory_id ORDER BY t) AS rn FROM poses),
chain AS (SELECT trajectory_id, rn, id, t, x, y, t AS lt, x AS lx, y AS ly, k AS lk, true AS keep FROM ord WHERE rn = 1
  UNION ALL SELECT trajectory_id, rn, id, t, x, y, CASE WHEN far THEN t ELSE lt END, CASE WHEN far THEN x ELSE lx END, CASE WHEN far THEN y ELSE ly END, CASE WHEN far THEN k ELSE lk END, far
  FROM (SELECT o.*, c.lt, c.lx, c.ly, c.lk, sqrt(pow(o.x - c.lx, 2) + pow(o.y - c.ly, 2)) > {d} OR abs(o.k - c.lk) * 0.9e0 > {a} OR abs(o.t - c.lt) > {t} AS far
        FROM chain c JOIN ord o ON o.trajectory_id = c.trajectory_id AND o.rn = c.rn + 1))"""


@query("trajectory_summary", POSES, CHAIN.format(d="0.5e0", a="360e0", t="86400e0"), f"""/*RECURSIVE*/
SELECT trajectory_id, count(*) AS frames, round(sum(step), 6) AS length, round(8.5e0 * sum(step), 6) AS area,
       min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, count(fix) AS with_fix
FROM (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS step,
        CASE WHEN (t2 = t AND t1 IS NULL) OR (t2 - t1 <= {GAP} AND least(t - t1, t2 - t) <= {NEAR}) THEN 1 END AS fix
      FROM (SELECT a.*, n.t AS t2 FROM (SELECT c.*, p.t AS t1 FROM (SELECT * FROM chain WHERE keep) c ASOF LEFT JOIN (SELECT trajectory_id, t FROM poses WHERE event_type = 'purchase') p
              ON p.trajectory_id = c.trajectory_id AND c.t > p.t) a
            ASOF LEFT JOIN (SELECT trajectory_id, t FROM poses WHERE event_type = 'purchase') n ON n.trajectory_id = a.trajectory_id AND a.t <= n.t)
      WINDOW w AS (PARTITION BY trajectory_id ORDER BY t)) GROUP BY trajectory_id""")
def trajectory_summary(spark, sf):
    d = V.posed(spark, sf)
    kf = sequence.extract_keyframes(d.select("trajectory_id", "id", "t", "x", "y", "pose"), 0.5, 360.0, 86_400.0, width=V.WIDTH)
    fixes = d.filter("event_type = 'purchase'").select("trajectory_id", "t", "pose", F.lit(1).alias("fix"))
    kf = A.asof_interpolate(kf.drop("pose"), fixes, BY, max_gap=GAP, max_dist=NEAR, width=V.WIDTH)
    length = sequence.path_length(kf, BY, ["t"], width=V.WIDTH)
    box = kf.groupBy("trajectory_id").agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"),
                                          F.max("y").alias("max_y"), F.count("s_fix").alias("with_fix"))
    return length.join(box, "trajectory_id").select(
        "trajectory_id", "frames", F.round("length", 6).alias("length"), F.round("area", 6).alias("area"),
        "min_x", "max_x", "min_y", "max_y", "with_fix")
