"""The streaming operators, run to completion over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import graph as G
from wayloom.plans import views as V
from wayloom.plans.registry import query
from wayloom.plans.views import POSES, r6
from wayloom.session import cut
from wayloom.streaming import streams as ST


def events_stream(spark, sf):
    """The event table as a stream of frames: ``vehicle_id, t, ts, frame_id, x, y, yaw``.

    All rows come in one trigger and none later, so the watermark needs no delay.
    """
    schema = V.table(spark, sf, "events").schema
    d = ST.read_stream(spark, sf, schema, watermark="0 seconds", glob="events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    return d.select(F.col("user_id").alias("vehicle_id"), "ts", (F.unix_micros("ts") / 1e6).alias("t"), F.col("event_id").alias("frame_id"),
                    "event_type", "value", (k / 8.0).alias("x"), ((F.col("event_id") % 9 - 4) / 4.0).alias("y"), F.radians(k * 0.9).alias("yaw"))


@query("stream_source_s24", "SELECT user_id AS vehicle_id, event_id AS frame_id, round(epoch_us(ts) / 1e6, 6) AS t FROM events WHERE event_type = 'view'")
def stream_source(spark, sf):
    schema = V.table(spark, sf, "events").schema
    d = ST.read_stream(spark, sf, schema, "view", "event_type", watermark="1 hour", glob="events.parquet")
    return ST.drain(d.select(F.col("user_id").alias("vehicle_id"), F.col("event_id").alias("frame_id"), F.round(F.unix_micros("ts") / 1e6, 6).alias("t")))


@query("stream_preintegrate_t1")
def stream_preintegrate(spark, sf):
    d = events_stream(spark, sf).withColumn("vehicle_id", F.col("vehicle_id") % 2)
    wheel = F.col("event_type") == "purchase"
    s = d.select("vehicle_id", "t", "ts", F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"), F.col("y").alias("wz"),
                 F.when(wheel, F.col("value") / 500).alias("v"))
    return ST.drain(ST.stream_preintegrate(s)).select("vehicle_id", "t", "x", "y", "qz")


@query("stream_keyframes_t2", POSES, """
ord AS (SELECT *, k / 8e0 AS px, (id % 9 - 4) / 4e0 AS py, row_number() OVER (PARTITION BY trajectory_id ORDER BY t) AS rn FROM poses),
chain AS (SELECT trajectory_id, rn, id, 1 AS n, px AS lx, py AS ly, k AS lk, true AS keep FROM ord WHERE rn = 1
  UNION ALL SELECT trajectory_id, rn, id, CASE WHEN far THEN n + 1 ELSE n END, CASE WHEN far THEN px ELSE lx END, CASE WHEN far THEN py ELSE ly END, CASE WHEN far THEN k ELSE lk END, far
  FROM (SELECT o.*, c.n, c.lx, c.ly, c.lk, c.n < 3 OR sqrt(pow(o.px - c.lx, 2) + pow(o.py - c.ly, 2)) > 2e0 OR abs(o.k - c.lk) * 0.9e0 > 30e0 AS far
        FROM chain c JOIN ord o ON o.trajectory_id = c.trajectory_id AND o.rn = c.rn + 1))""", """/*RECURSIVE*/
SELECT trajectory_id AS vehicle_id, id AS frame_id, n - 1 AS keyframe_no FROM chain WHERE keep""")
def stream_keyframes(spark, sf):
    d = ST.stream_keyframes(events_stream(spark, sf).select("vehicle_id", "t", "ts", "frame_id", "x", "y", "yaw"), dist=2.0, angle=30 * P.RAD)
    return ST.drain(d).select("vehicle_id", "frame_id", "keyframe_no")


SUBMAPS = """sm AS (SELECT *, k / 8e0 AS px, (id % 9 - 4) / 4e0 AS py, radians(k * 0.9e0) AS a, (row_number() OVER (PARTITION BY trajectory_id ORDER BY t) - 1) // 11 AS submap_no FROM poses)"""


@query("stream_submaps_t3", POSES, SUBMAPS, """
SELECT trajectory_id AS vehicle_id, id AS frame_id, submap_no, round(cos(ba) * (px - bx) + sin(ba) * (py - by_), 6) + 0e0 AS local_x, round(-sin(ba) * (px - bx) + cos(ba) * (py - by_), 6) + 0e0 AS local_y
FROM (SELECT *, first_value(px) OVER w AS bx, first_value(py) OVER w AS by_, first_value(a) OVER w AS ba FROM sm WINDOW w AS (PARTITION BY trajectory_id, submap_no ORDER BY t))""")
def stream_submaps(spark, sf):
    d = ST.stream_submaps(events_stream(spark, sf).select("vehicle_id", "t", "ts", "frame_id", "x", "y", "yaw"), size=11)
    return ST.drain(d).select("vehicle_id", "frame_id", "submap_no", r6("local_x").alias("local_x"), r6("local_y").alias("local_y"))


@query("submaps_batch_t3", POSES, SUBMAPS, "SELECT id, submap_no FROM sm")
def submaps_batch(spark, sf):
    return ST.submaps_batch(V.steps(spark, sf), size=11, width=V.WIDTH).select("id", "submap_no")


RECENT = "SELECT id AS frame_id, len(l) AS n, l[1] AS oldest FROM (SELECT id, list(id) OVER (PARTITION BY trajectory_id ORDER BY t ROWS 29 PRECEDING) AS l FROM poses)"


@query("recent_frames_t4", POSES, RECENT)
def recent_frames(spark, sf):
    d = ST.drain(ST.recent_frames(events_stream(spark, sf).select("vehicle_id", "t", "ts", "frame_id"), 30))
    return d.select("frame_id", F.size("recent").cast("long").alias("n"), F.col("recent")[0].alias("oldest"))


@query("recent_frames_batch_t4", POSES, RECENT)
def recent_frames_batch(spark, sf):
    d = ST.recent_frames_batch(V.steps(spark, sf).withColumnRenamed("id", "frame_id"), 30, width=V.WIDTH)
    return d.select("frame_id", F.size("recent").cast("long").alias("n"), F.col("recent")[0].alias("oldest"))


@query("loop_candidates_t5", POSES, """sm AS (SELECT *, (row_number() OVER (PARTITION BY trajectory_id ORDER BY t) - 1) // 7 AS submap_no FROM poses),
heads AS (SELECT trajectory_id, submap_no, arg_min(x, t) AS hx, arg_min(y, t) AS hy FROM sm GROUP BY 1, 2)""", """
SELECT map_id, frame_id, submap_no, older_no, dist FROM (SELECT s.trajectory_id AS map_id, s.id AS frame_id, s.submap_no, h.submap_no AS older_no, round(sqrt(pow(s.x - h.hx, 2) + pow(s.y - h.hy, 2)), 6) AS dist,
  row_number() OVER (PARTITION BY s.id ORDER BY h.submap_no DESC) AS rn FROM sm s JOIN heads h ON h.trajectory_id = s.trajectory_id AND s.submap_no > h.submap_no AND pow(s.x - h.hx, 2) + pow(s.y - h.hy, 2) < 16) WHERE rn <= 4""")
def loop_candidates(spark, sf):
    d = ST.submaps_batch(V.poses(spark, sf), size=7, width=V.WIDTH)
    d = d.select(F.col("trajectory_id").alias("map_id"), F.col("id").alias("frame_id"), "t", "submap_no", "x", "y")
    heads = d.groupBy("map_id", "submap_no").agg(F.min_by("x", "t").alias("x"), F.min_by("y", "t").alias("y"))
    return ST.loop_candidates(d.drop("t"), heads, 4.0, 4).withColumn("dist", F.round("dist", 6))


@query("correct_submaps_t6", POSES, """
SELECT id, round(x, 2) + 0e0 AS x, round(y, 2) + 0e0 AS y, true AS converged FROM (
  SELECT *, row_number() OVER (PARTITION BY trajectory_id, floor(t / 864000) ORDER BY id) AS rn FROM poses) WHERE rn = 1""")
def correct_submaps(spark, sf):
    """Sub-map poses that have drifted, but for each map's first; chain edges that say otherwise bring them back."""
    d = V.posed(spark, sf).groupBy("trajectory_id", F.floor(F.col("t") / V.WIDTH).alias("_s")).agg(F.min("id").alias("id"), F.min_by("pose", "id").alias("pose"))
    d = cut(d.drop("_s"))
    first = d.groupBy("trajectory_id").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("first"))
    u = (F.col("id") % 1000) / 1000.0
    off = P.compose("pose", P.from_yaw(u * 3, u * -2, F.lit(0.0), u * 0.1))
    at = d.join(first, "id", "left").select(F.col("trajectory_id").alias("map_id"), "id", F.when(F.col("first"), F.col("pose")).otherwise(off).alias("pose"))
    e = G.relative_edges(d, 3, "pose", weight=4.0, width=5000.0)
    r = ST.correct_submaps(cut(at), e)
    return r.select("id", (F.round("pose.x", 2) + 0.0).alias("x"), (F.round("pose.y", 2) + 0.0).alias("y"), "converged")


@query("marks_batch_t7", POSES, """
SELECT q.id AS mark_id, f.id AS frame_id FROM (SELECT * FROM poses WHERE event_type = 'click') q ASOF LEFT JOIN (SELECT * FROM poses WHERE event_type <> 'click') f ON f.trajectory_id = q.trajectory_id AND q.t <= f.t""")
def marks_batch(spark, sf):
    d = V.steps(spark, sf)
    m = d.filter("event_type = 'click'").select("trajectory_id", "t", F.col("id").alias("mark_id"))
    f = d.filter("event_type <> 'click'").select("trajectory_id", "t", F.col("id").alias("frame_id"))
    return ST.marks_batch(f, m, width=V.WIDTH).select("mark_id", F.col("next_frame_id").alias("frame_id"))


@query("stream_marks_t7", POSES, """
SELECT q.trajectory_id AS vehicle_id, q.id AS mark_id, arg_min(f.id, f.t) AS frame_id FROM poses q LEFT JOIN poses f ON f.event_type <> 'click' AND f.trajectory_id = q.trajectory_id AND f.t >= q.t AND f.t <= q.t + 172800 WHERE q.event_type = 'click' GROUP BY 1, 2""")
def stream_marks(spark, sf):
    frames = events_stream(spark, sf).filter("event_type <> 'click'").select("vehicle_id", "ts", "frame_id")
    marks = events_stream(spark, sf).filter("event_type = 'click'").select("vehicle_id", F.col("ts").alias("mark_ts"), F.col("frame_id").alias("mark_id"))
    found = ST.next_frame(ST.drain(ST.stream_marks(frames, marks, "48 hours")))
    # marks whose horizon the stream has not reached yet are still waiting; they have no frame so far
    known = V.table(spark, sf, "events").filter("event_type = 'click'").select(F.col("user_id").alias("vehicle_id"), F.col("event_id").alias("mark_id"))
    return known.join(found, ["vehicle_id", "mark_id"], "left")


@query("stream_health_t9", """
SELECT epoch_us(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01')) // 1000000 AS start_s, event_type AS topic, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM events GROUP BY 1, 2""")
def stream_health(spark, sf):
    d = V.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("topic"), "value")
    h = ST.stream_health(d, "6 hours", by=["topic"])
    return h.select(F.unix_seconds("start").alias("start_s"), "topic", "n", F.round("mean", 6).alias("mean"), "low", "high")


@query("stream_sessions_t9", """
SELECT user_id AS vehicle_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM (SELECT *, sum(g) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 10 HOURS THEN 0 ELSE 1 END AS g FROM events)) GROUP BY user_id, s""")
def stream_sessions(spark, sf):
    d = V.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("vehicle_id"))
    s = ST.stream_sessions(d, "10 hours")
    return s.select("vehicle_id", F.unix_micros("start").alias("start_us"), "n")
