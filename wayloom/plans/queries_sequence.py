"""Ordered operators along trajectories."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import reports as R
from wayloom.operators import scores as SC
from wayloom.operators import sequence as Q
from wayloom.operators import submaps
from wayloom.operators.ordered import blocked
from wayloom.plans import views as V
from wayloom.plans.queries_functions import flat
from wayloom.plans.queries_time import CHAIN
from wayloom.plans.registry import query
from wayloom.plans.views import FIXES, POSES, SCORES, r6

BY = ["trajectory_id"]
T = ["t"]

STABLE = """runs AS (
  SELECT trajectory_id, {cols} FROM (SELECT *, lag(id, 1) OVER o AS back, {held} FROM fixes
     WINDOW o AS (PARTITION BY trajectory_id ORDER BY t), w AS (PARTITION BY trajectory_id ORDER BY t ROWS 2 PRECEDING))
  GROUP BY trajectory_id)""".format(
    held=", ".join(f"sum(CASE WHEN {c} THEN 1 ELSE 0 END) OVER w = 3 AS h_{n}" for n, c in (
        ("sync", "status = 4 AND heading_valid"), ("fixed", "status = 4"), ("heading", "heading_valid"), ("anyfix", "status <> 0"))),
    cols=", ".join(f"arg_min(back, t) FILTER (h_{n}) AS {n}, bool_or(h_{n}) AS has_{n}" for n in ("sync", "fixed", "heading", "anyfix")))


@query("stable_runs_w1", FIXES, STABLE, """
SELECT trajectory_id, CASE WHEN has_sync THEN 3 WHEN has_fixed AND has_heading THEN 2 WHEN has_fixed OR has_anyfix THEN 0 ELSE -1 END AS quality,
  CASE WHEN has_sync THEN sync WHEN has_fixed THEN fixed ELSE anyfix END AS settled_id FROM runs""")
def stable_runs(spark, sf):
    d = Q.gnss_quality(V.fixes(spark, sf, False), BY, T, 3, ["id"], V.WIDTH)
    return d.select("trajectory_id", "quality", F.col("settled.id").alias("settled_id"))


@query("trimmed_mean_w2", SCORES, """
SELECT id, round(CASE WHEN rows <= 7 THEN score WHEN rn = 1 THEN lead(mid, 3) OVER o WHEN rn = 2 THEN lead(mid, 3) OVER o WHEN rn = 3 THEN lead(mid, 2) OVER o WHEN rn = 4 THEN lead(mid, 1) OVER o
  WHEN rn = rows THEN lag(mid, 3) OVER o WHEN rn = rows - 1 THEN lag(mid, 2) OVER o WHEN rn = rows - 2 THEN lag(mid, 1) OVER o ELSE mid END, 6) AS smooth
FROM (SELECT *, count(*) OVER (PARTITION BY trajectory_id) AS rows, row_number() OVER o2 AS rn,
   CASE WHEN count(*) OVER w = 7 THEN (sum(score) OVER w - min(score) OVER w - max(score) OVER w) / 5 END AS mid FROM scores
   WINDOW w AS (PARTITION BY trajectory_id ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), o2 AS (PARTITION BY trajectory_id ORDER BY t))
WINDOW o AS (PARTITION BY trajectory_id ORDER BY t)""")
def trimmed_mean(spark, sf):
    d = Q.trimmed_mean(V.scores(spark, sf), "score", BY, T, 7, V.WIDTH)
    return d.select("id", F.round("smooth", 6).alias("smooth"))


BUCKET = """bk AS (SELECT *, CAST(CASE WHEN score < 1.8e0 THEN 1 WHEN score >= 4.2e0 THEN 10 ELSE floor((score - 1.8e0) / 0.3e0 + 2) END AS INT) AS bucket FROM scores),
bd AS (SELECT *, row_number() OVER w AS rn, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS step,
   CASE WHEN bucket IS DISTINCT FROM lag(bucket) OVER w THEN 1 ELSE 0 END AS chg FROM bk WINDOW w AS (PARTITION BY trajectory_id ORDER BY t)),
br AS (SELECT *, sum(chg) OVER (PARTITION BY trajectory_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run_id FROM bd),
seg AS (SELECT *, run_id < max(run_id) OVER (PARTITION BY trajectory_id) AS closed FROM (
   SELECT trajectory_id, run_id, min(rn) AS first_rn, max(rn) AS last_rn, min(bucket) AS bucket, CASE WHEN count(*) = 1 THEN 0e0 ELSE sum(step) - arg_max(step, rn) END AS dist FROM br GROUP BY trajectory_id, run_id))"""


def _buckets(spark, sf):
    return V.scores(spark, sf).withColumn("bucket", SC.threshold_index("score"))


def _segs(spark, sf):
    return SC.segments(_buckets(spark, sf), BY, T, width=V.WIDTH)


@query("threshold_index_w4", SCORES, BUCKET, "SELECT id, bucket FROM bk")
def threshold_index(spark, sf):
    return _buckets(spark, sf).select("id", "bucket")


@query("segments_w5", SCORES, BUCKET, "SELECT trajectory_id, run_id, first_rn, last_rn, bucket, round(dist, 6) AS dist, closed FROM seg")
def segments(spark, sf):
    return _segs(spark, sf).withColumn("dist", F.round("dist", 6))


MERGED = """mg AS (SELECT *, CASE
    WHEN closed AND run_id = 1 AND n1 IS NOT NULL AND dist < 8 THEN n1
    WHEN closed AND run_id > 1 AND n1 IS NOT NULL AND dist < 12 THEN least(p1, n1)
    WHEN closed AND run_id > 1 AND n1 IS NULL AND dist < 8 THEN p1
    WHEN NOT closed AND p2 IS NOT NULL AND pd < 8 THEN p2 ELSE bucket END AS merged
  FROM (SELECT *, lag(bucket) OVER w AS p1, lag(bucket, 2) OVER w AS p2, lag(dist) OVER w AS pd, CASE WHEN lead(closed) OVER w THEN lead(bucket) OVER w END AS n1
        FROM seg WINDOW w AS (PARTITION BY trajectory_id ORDER BY run_id)))"""


@query("merge_short_w6", SCORES, BUCKET, MERGED, "SELECT trajectory_id, run_id, bucket, merged FROM mg")
def merge_short(spark, sf):
    return SC.merge_short(_segs(spark, sf), BY).select("trajectory_id", "run_id", "bucket", "merged")


@query("merge_between_long_w6", SCORES, BUCKET, """
SELECT trajectory_id, run_id, bucket, CASE WHEN lng THEN bucket
  WHEN head THEN coalesce(CASE WHEN max(last_rn) FILTER (head) OVER p <= 5 THEN min(nxt) FILTER (head) OVER p
    ELSE coalesce(min(bucket) FILTER (head AND before IS NOT NULL AND dist > 0.5 AND bucket - before > 10) OVER p, min(bucket) FILTER (head AND before IS NOT NULL) OVER p) END, bucket)
  WHEN tail THEN coalesce(min(bucket) FILTER (tail AND closed AND NOT lng AND dist > 0.5 AND bucket - before > 5) OVER p, min(bucket) FILTER (tail AND closed AND NOT lng) OVER p, bucket)
  WHEN prv IS NOT NULL THEN least(prv, nxt) ELSE bucket END AS merged
FROM (SELECT *, prv IS NULL AND nxt IS NOT NULL AS head, nxt IS NULL AND prv IS NOT NULL AS tail FROM (
   SELECT *, lag(bucket) OVER (PARTITION BY trajectory_id ORDER BY run_id) AS before,
   last_value(CASE WHEN lng THEN bucket END IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY run_id ROWS UNBOUNDED PRECEDING) AS prv,
   first_value(CASE WHEN lng THEN bucket END IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY run_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt
   FROM (SELECT *, closed AND dist > 3 AS lng FROM seg))) WINDOW p AS (PARTITION BY trajectory_id)""")
def merge_between_long(spark, sf):
    return SC.merge_between_long(_segs(spark, sf), BY, 3.0).select("trajectory_id", "run_id", "bucket", "merged")


@query("cap_to_dominant_w7", SCORES, BUCKET, """
SELECT trajectory_id, run_id, CASE WHEN top IS NULL THEN bucket ELSE least(bucket, top) END AS capped
FROM seg LEFT JOIN (SELECT trajectory_id, arg_max(bucket, (dist, -run_id)) AS top FROM seg WHERE closed AND dist > 0 GROUP BY trajectory_id) USING (trajectory_id)""")
def cap_to_dominant(spark, sf):
    return SC.cap_to_dominant(_segs(spark, sf), BY).select("trajectory_id", "run_id", "capped")


@query("spatial_min_w8", SCORES, BUCKET, """
SELECT a.id, m.b AS spatial_min FROM bk a JOIN (SELECT p.x, p.y, min(q.b) AS b FROM (SELECT DISTINCT x, y FROM bk) p
  JOIN (SELECT x, y, min(bucket) AS b FROM bk GROUP BY x, y) q ON pow(p.x - q.x, 2) + pow(p.y - q.y, 2) < 2.25e0 GROUP BY p.x, p.y) m ON m.x = a.x AND m.y = a.y""")
def spatial_min(spark, sf):
    return SC.spatial_min(_buckets(spark, sf), 1.5).select("id", "spatial_min")


@query("suggest_threshold_w9", SCORES, BUCKET, """
SELECT id, round(CASE WHEN m >= 2.7e0 THEN CASE WHEN m - 0.6e0 >= 2.7e0 AND m - 0.6e0 < 3.2e0 THEN 2.7e0 WHEN m - 0.6e0 <= 2.2e0 THEN 2.2e0 ELSE m - 0.6e0 END
  WHEN m >= 2.5e0 THEN 2.2e0 WHEN m >= 2.2e0 THEN 1.9e0 ELSE m - 0.3e0 END, 6) AS threshold FROM (SELECT id, 1.8e0 + (bucket - 1.5e0) * 0.3e0 AS m FROM bk)""")
def suggest_threshold(spark, sf):
    return _buckets(spark, sf).select("id", F.round(SC.suggest_threshold("bucket"), 6).alias("threshold"))


@query("score_buckets_w6", SCORES, BUCKET, MERGED, """
SELECT id, CASE WHEN CASE WHEN m.closed THEN m.bucket ELSE coalesce(final, m.bucket) END > top THEN top ELSE m.merged END AS capped FROM br JOIN (
  SELECT mg.*, s.closed FROM mg JOIN seg s USING (trajectory_id, run_id)) m USING (trajectory_id, run_id)
LEFT JOIN (SELECT trajectory_id, arg_max(bucket, (dist, -run_id)) FILTER (closed AND dist > 0) AS top, arg_max(bucket, run_id) FILTER (closed) AS final FROM seg GROUP BY trajectory_id) USING (trajectory_id)""")
def score_buckets(spark, sf):
    return SC.score_buckets(_buckets(spark, sf), BY, T, width=V.WIDTH).select("id", "capped")


@query("path_curvature_w10", POSES, """
SELECT id, round(coalesce(mid, last_value(mid IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY t ROWS BETWEEN 10 PRECEDING AND CURRENT ROW),
   first_value(mid IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY t ROWS BETWEEN CURRENT ROW AND 10 FOLLOWING)), 6) AS curvature
FROM (SELECT *, CASE WHEN count(*) OVER w = 21 THEN sqrt(pow(sum(x) OVER w - 21 * x, 2) + pow(sum(y) OVER w - 21 * y, 2)) END AS mid FROM poses
  WINDOW w AS (PARTITION BY trajectory_id ORDER BY t ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING))""")
def path_curvature(spark, sf):
    return Q.path_curvature(V.poses(spark, sf), 10, BY, T, V.WIDTH).select("id", F.round("curvature", 6).alias("curvature"))


@query("extract_keyframes_w11", POSES, CHAIN.format(d="2.5e0", a="60e0", t="250000e0"), """/*RECURSIVE*/ SELECT trajectory_id, id FROM chain WHERE keep""")
def extract_keyframes(spark, sf):
    d = V.posed(spark, sf).select("trajectory_id", "id", "t", "pose")
    return Q.extract_keyframes(d, 2.5, 60.0, 250_000.0, width=V.WIDTH, block=32).select("trajectory_id", "id")


@query("context_window_w12", POSES, """
SELECT id, len(l) AS n, l[1] AS first_id, l[len(l)] AS last_id FROM (SELECT id, list(id) OVER (PARTITION BY trajectory_id ORDER BY t ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) AS l FROM poses)""")
def context_window(spark, sf):
    d = Q.context_window(V.steps(spark, sf).withColumnRenamed("id", "fid"), 10, BY, T, ["fid"], V.WIDTH)
    return d.select(F.col("fid").alias("id"), F.size("context").cast("long").alias("n"), F.col("context")[0].alias("first_id"),
                    F.element_at("context", -1).alias("last_id"))


@query("interleave_w13", POSES, """
SELECT trajectory_id, source, id, row_number() OVER (PARTITION BY trajectory_id ORDER BY t, source DESC) AS seq FROM (
  SELECT trajectory_id, id, t, 1 AS source FROM poses WHERE event_type IN ('click', 'view') UNION ALL
  SELECT trajectory_id, id, t, 2 AS source FROM poses WHERE event_type IN ('view', 'purchase'))""")
def interleave(spark, sf):
    d = V.steps(spark, sf).select("trajectory_id", "id", "t", "event_type")
    a = d.filter(F.col("event_type").isin("click", "view")).drop("event_type")
    b = d.filter(F.col("event_type").isin("view", "purchase")).drop("event_type")
    out = Q.interleave(a, b, BY, "t", V.WIDTH)
    return out.select("trajectory_id", F.col("source").cast("int").alias("source"), "id", "seq")


@query("fix_dt_w14", POSES, """
SELECT id, round(CASE WHEN ms < 0.001e0 OR ms > 0.05e0 THEN 0.01e0 ELSE ms END, 6) AS dt_tag, round(CASE WHEN dt < 1e-5 OR dt > 0.05e0 THEN 0.01e0 ELSE dt END, 6) AS dt
FROM (SELECT id, (CASE WHEN tag - p < 0 THEN tag - p + 655360 ELSE tag - p END) / 1000e0 AS ms, tt - ptt AS dt FROM (
  SELECT id, tag, coalesce(lag(tag) OVER w, 0) AS p, tt, coalesce(lag(tt) OVER w, 0e0) AS ptt FROM (SELECT *, k * 6600 % 655360 AS tag, floor(t) + k / 1024e0 AS tt FROM poses)
  WINDOW w AS (PARTITION BY trajectory_id ORDER BY tt)))""")
def fix_dt(spark, sf):
    d = V.steps(spark, sf).withColumn("tag_ms", F.col("k") * 6600 % 655360).withColumn("t", F.floor("t") + F.col("k") / 1024.0)
    return Q.fix_dt(d, BY, "t", width=V.WIDTH).select("id", F.round("dt_tag", 6).alias("dt_tag"), F.round("dt", 6).alias("dt"))


@query("propagate_from_fix_w15", FIXES, """
SELECT id, CASE WHEN status = 4 THEN 'fix' WHEN f IS NOT NULL THEN 'carried' ELSE 'odometry' END AS init_from,
  CASE WHEN status = 4 THEN x + 100 WHEN f IS NOT NULL THEN f.x + 100 + (x - f.x) ELSE x END AS x,
  round(sin(radians(CASE WHEN status = 4 AND heading_valid THEN 30e0 WHEN status = 4 AND f IS NULL THEN 0e0 WHEN f IS NOT NULL THEN 30e0 ELSE 0e0 END) / 2), 6) + 0e0 AS qz
FROM (SELECT *, last_value(CASE WHEN status = 4 THEN {'x': x} END IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM fixes)""".replace(
    "f.x + 100 + (x - f.x)", "f.x + 100 + cos(radians(30e0)) * (x - f.x) - sin(radians(30e0)) * (y - f.y)").replace("{'x': x}", "{'x': x, 'y': y}")
    .replace("CASE WHEN status = 4 THEN x + 100", "round(CASE WHEN status = 4 THEN x + 100").replace("ELSE x END AS x", "ELSE x END, 6) + 0e0 AS x"))
def propagate_from_fix(spark, sf):
    d = V.fixes(spark, sf)
    kf = d.select("trajectory_id", "id", (F.col("status") == 4).alias("usable"), "heading_valid",
                  P.from_yaw(F.col("x") + 100, "y", "z", F.lit(30.0 * P.RAD)).alias("gps_pose"), P.make("x", "y", "z").alias("matching_pose"))
    out = Q.propagate_from_fix(kf, BY, ["id"], 5000.0)
    return out.select("id", "init_from", r6(F.col("init_pose.x")).alias("x"), r6(F.col("init_pose.qz")).alias("qz"))


@query("dead_reckon_2d_w20", POSES, """
SELECT id, round(h, 6) + 0e0 AS heading, round(sum(v * cos(h) * 0.01e0) OVER w, 5) + 0e0 AS x, round(sum(v * sin(h) * 0.01e0) OVER w, 5) + 0e0 AS y FROM (
  SELECT q.*, coalesce(s.v, 0e0) AS v FROM (SELECT id, trajectory_id, t, sum(dx * 0.01e0) OVER (PARTITION BY trajectory_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS h FROM poses WHERE event_type <> 'purchase') q
  ASOF LEFT JOIN (SELECT trajectory_id, t, value AS v FROM poses WHERE event_type = 'purchase') s ON s.trajectory_id = q.trajectory_id AND q.t >= s.t)
WINDOW w AS (PARTITION BY trajectory_id ORDER BY t ROWS UNBOUNDED PRECEDING)""")
def dead_reckon_2d(spark, sf):
    d = V.steps(spark, sf)
    imu = d.filter("event_type <> 'purchase'").select("trajectory_id", "id", "t", F.col("dx").alias("wz"), F.lit(0.01).alias("dt"))
    odom = d.filter("event_type = 'purchase'").select("trajectory_id", "t", F.col("value").alias("v"))
    out = Q.dead_reckon_2d(imu, odom, BY, "t", V.WIDTH)
    return out.select("id", r6("heading").alias("heading"), (F.round("x", 5) + 0.0).alias("x"), (F.round("y", 5) + 0.0).alias("y"))


@query("endpoints_w22", POSES, "SELECT trajectory_id, arg_min(id, t) AS first_id, arg_max(id, t) AS last_id, arg_min(x, t) AS x0, arg_max(y, t) AS y1 FROM poses GROUP BY trajectory_id")
def endpoints(spark, sf):
    d = Q.endpoints(V.poses(spark, sf), BY, "t")
    return d.select("trajectory_id", F.col("first.id").alias("first_id"), F.col("last.id").alias("last_id"), F.col("first.x").alias("x0"), F.col("last.y").alias("y1"))


@query("back_to_start_w23", POSES, """
SELECT id, sqrt(pow(x - first_value(x) OVER w, 2) + pow(y - first_value(y) OVER w, 2)) < 2 AND row_number() OVER w > 10 AS at_start FROM poses WINDOW w AS (PARTITION BY trajectory_id ORDER BY t)""")
def back_to_start(spark, sf):
    return Q.back_to_start(V.poses(spark, sf), BY, "t", 2.0, 10, V.WIDTH).select("id", "at_start")


@query("recentre_r13", POSES, "SELECT id, x - first_value(x) OVER w AS x, y - first_value(y) OVER w AS y FROM poses WINDOW w AS (PARTITION BY trajectory_id ORDER BY t)")
def recentre(spark, sf):
    return submaps.recentre(V.poses(spark, sf), BY, "t").select("id", "x", "y")


@query("imu_static_stats_a16", POSES, """
SELECT id, round(CASE WHEN n >= 10 THEN sqrt(pow(a, 2) + pow(b, 2) + pow(c, 2)) END, 5) AS gyro_var_norm, round(CASE WHEN n >= 10 THEN sqrt(pow(c, 2) + pow(b, 2) + pow(a, 2)) END, 5) AS acce_var_norm
FROM (SELECT id, count(*) OVER w AS n, var_samp(dx) OVER w AS a, var_samp(dy) OVER w AS b, var_samp(k / 8e0) OVER w AS c FROM poses WINDOW w AS (PARTITION BY trajectory_id ORDER BY t ROWS 19 PRECEDING))""")
def imu_static_stats(spark, sf):
    k8 = F.col("k") / 8.0
    d = V.steps(spark, sf).select("trajectory_id", "id", "t", F.col("dx").alias("wx"), F.col("dy").alias("wy"), k8.alias("wz"),
                                  k8.alias("ax"), F.col("dy").alias("ay"), F.col("dx").alias("az"))
    out = Q.imu_static_stats(d, 20, 10, BY, T, V.WIDTH)
    return out.select("id", F.round("gyro_var_norm", 5).alias("gyro_var_norm"), F.round("acce_var_norm", 5).alias("acce_var_norm"))


@query("path_length_a17", POSES, """
SELECT trajectory_id, round(sum(s), 6) AS length, count(*) AS frames, round(8.5e0 * sum(s), 6) AS area FROM (
  SELECT trajectory_id, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS s FROM poses WINDOW w AS (PARTITION BY trajectory_id ORDER BY t)) GROUP BY trajectory_id""")
def path_length(spark, sf):
    d = Q.path_length(V.poses(spark, sf), BY, T, width=V.WIDTH)
    return d.select("trajectory_id", F.round("length", 6).alias("length"), "frames", F.round("area", 6).alias("area"))


@query("number_marks_a32", POSES, "SELECT id, row_number() OVER (PARTITION BY id % 5 ORDER BY t, id) AS number FROM poses")
def number_marks(spark, sf):
    d = V.steps(spark, sf).select("id", "t", (F.col("id") % 5).alias("mark_id"))
    return Q.number_marks(d, ["mark_id"], ["t", "id"], V.WIDTH).select("id", "number")


@query("chi2_summary_a12", SCORES, """
SELECT status, n, round(mean, 6) AS mean, mx AS max, l[n // 2 + 1] AS median, l[CAST(floor(n * 0.1e0) AS BIGINT) + 1] AS p10, l[CAST(floor(n * 0.9e0) AS BIGINT) + 1] AS p90
FROM (SELECT event_type AS status, count(*) AS n, avg(value) AS mean, max(value) AS mx, list(value ORDER BY value) AS l FROM scores WHERE k > 5 GROUP BY event_type)""")
def chi2_summary(spark, sf):
    e = V.steps(spark, sf).select(F.col("event_type").alias("status"), F.col("value").alias("chi2"), (F.col("k") > 5).alias("active"))
    d = R.chi2_summary(e, ["status"])
    return d.select("status", "n", F.round("mean", 6).alias("mean"), "max", "median", "p10", "p90")


@query("adaptive_threshold_a13", SCORES, """
SELECT trajectory_id, n, t AS threshold, i AS inliers, i / n AS inlier_ratio FROM (SELECT trajectory_id, n, CASE WHEN i0 > 0.1e0 * n THEN 1e0 WHEN i1 > 0.1e0 * n THEN 2e0 WHEN i2 > 0.1e0 * n THEN 4e0 ELSE 8e0 END AS t,
  CASE WHEN i0 > 0.1e0 * n THEN i0 WHEN i1 > 0.1e0 * n THEN i1 ELSE i2 END AS i FROM (
  SELECT trajectory_id, count(*) AS n, count(*) FILTER (value <= 1) AS i0, count(*) FILTER (value <= 2) AS i1, count(*) FILTER (value <= 4) AS i2 FROM scores GROUP BY trajectory_id))""")
def adaptive_threshold(spark, sf):
    e = V.steps(spark, sf).withColumnRenamed("value", "chi2")
    return R.adaptive_threshold(e, 1.0, by=BY)


@query("gps_inlier_stats_a37", FIXES, """
SELECT trajectory_id, count(*) FILTER (value <= 10) AS inliers, count(*) FILTER (value > 10) AS outliers, count(*) FILTER (value <= 10) / count(*) AS inlier_ratio,
  count(*) FILTER (status = 4) AS good_fixes FROM fixes GROUP BY trajectory_id""")
def gps_inlier_stats(spark, sf):
    return R.gps_inlier_stats(V.fixes(spark, sf, False).withColumnRenamed("value", "chi2"), 10.0, BY)


@query("flag_outliers_p11", SCORES, "SELECT id, value AS chi2, value <= 12.5e0 AS active FROM scores")
def flag_outliers(spark, sf):
    return R.flag_outliers(V.steps(spark, sf).select("id", F.col("value").alias("chi2")), 12.5)


@query("error_histogram_a35", SCORES, """
SELECT bin, n, round(n / sum(n) OVER () / 0.04e0, 6) AS density FROM (SELECT least(CAST(floor(value / (8e0 / 200)) AS BIGINT), 199) AS bin, count(*) AS n FROM scores WHERE value BETWEEN 0 AND 8 GROUP BY 1)""")
def error_histogram(spark, sf):
    d = R.error_histogram(V.steps(spark, sf), "value")
    return d.select("bin", "n", F.round("density", 6).alias("density"))


@query("build_tracks_j25", SCORES, """
SELECT t.id, t.seg, 1.8e0 + seg * 0.25e0 AS threshold FROM (SELECT *, least(passed + 1, 4) AS seg FROM (
  SELECT p.id, sum(CASE WHEN EXISTS (SELECT 1 FROM ends e WHERE e.trajectory_id = p.trajectory_id AND pow(e.x - p.x, 2) + pow(e.y - p.y, 2) < 0.001e0) THEN 1 ELSE 0 END)
    OVER (PARTITION BY p.trajectory_id ORDER BY p.id ROWS UNBOUNDED PRECEDING) AS passed FROM scores p)) t""".replace("FROM ends e", "FROM (SELECT trajectory_id, x, y FROM (SELECT *, row_number() OVER (PARTITION BY trajectory_id ORDER BY id) AS rn FROM scores) WHERE rn IN (5, 10, 15, 20)) e").replace("t.seg, ", ""))
def build_tracks(spark, sf):
    d = V.poses(spark, sf).withColumn("o", F.col("id").cast("double"))
    ends = blocked(d, BY, ["o"], 5000.0).filter(F.col("_rn").isin(5, 10, 15, 20))
    segs = ends.select("trajectory_id", (F.col("_rn") / 5).cast("int").alias("seg"), F.col("x").alias("end_x"), F.col("y").alias("end_y"))
    segs = segs.withColumn("threshold", 1.8 + F.col("seg") * 0.25)
    out = SC.build_tracks(d.drop("o"), segs, 50, False, (500000.0, 4400000.0), BY, width=5000.0)
    return out.select("id", "threshold")
