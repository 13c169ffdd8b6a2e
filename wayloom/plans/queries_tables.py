"""Stored tables, logs, reports and map maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import graph as GR
from wayloom.operators import maps as M
from wayloom.operators import reports as R
from wayloom.plans import views as V
from wayloom.plans.queries_functions import LEVER, utm_sql
from wayloom.plans.registry import query
from wayloom.plans.views import FIXES, POINTS, POSES, SCORES, r6
from wayloom.sources import clouds, logs
from wayloom.sources import text_tables as TT
from wayloom.streaming.streams import shared_folder

BY = ["trajectory_id"]


def keyframes(spark, sf):
    """Every event as a key frame with all its pose columns."""
    d = V.fixes(spark, sf)
    at = [P.from_yaw(F.col("x") + i, F.col("y") - i, "z", F.radians(F.col("k") * 0.9)) for i in range(5)]
    six = F.array(*[F.lit(v) for v in (0.1, 0.1, 0.2, 0.01, 0.01, 0.02)])
    return d.select("id", "trajectory_id", "t", F.col("status").alias("gps_status"), (F.col("trajectory_id") % 2).cast("int").alias("bag_type"),
                    "heading_valid", (F.col("value") <= 20).alias("gps_inlier"), at[0].alias("matching_pose"), six.alias("matching_noise"),
                    at[1].alias("dr_pose"), six.alias("dr_noise"), at[2].alias("gps_pose"), six.alias("gps_noise"),
                    at[3].alias("stage1_pose"), at[4].alias("stage2_pose"), F.col("value").alias("degeneracy"))


@query("keyframe_table_s1", FIXES, """
SELECT id, trajectory_id, t, status AS gps_status, heading_valid, value <= 20 AS gps_inlier, x AS mx, y - 4 AS y2, 0.02e0 AS noise6, value AS degeneracy, 61 AS columns FROM fixes""")
def keyframe_table(spark, sf):
    text = TT.lines(keyframes(spark, sf), TT.KEYFRAMES)
    n = text.select("value", F.size(F.split("value", " ")).alias("columns"))
    d = TT.parse(n, TT.KEYFRAMES)
    return d.select("id", "trajectory_id", "t", "gps_status", "heading_valid", "gps_inlier", F.col("matching_pose.x").alias("mx"),
                    F.col("stage2_pose.y").alias("y2"), F.col("gps_noise")[5].alias("noise6"), "degeneracy", F.lit(TT.width(TT.KEYFRAMES)).alias("columns"))


@query("path_table_s2", FIXES, "SELECT id, t, x + 2 AS x, y - 2 AS y, z, trajectory_id, status = 4 AND value <= 20 AS gps_ok FROM fixes")
def path_table(spark, sf):
    d = TT.path_table(keyframes(spark, sf), "gps")
    return d.select("id", "t", "pose.x", "pose.y", "pose.z", "trajectory_id", "gps_ok")


PAIRSQL = """prs AS (SELECT id AS id_first, id_second, dx, dy FROM (SELECT *, lead(id, 5) OVER (PARTITION BY trajectory_id ORDER BY id) AS id_second FROM poses) WHERE id_second IS NOT NULL)"""


def pairs(spark, sf):
    from wayloom.operators.ordered import blocked, near, tidy
    d = V.steps(spark, sf).withColumn("o", F.col("id").cast("double"))
    d = tidy(near(blocked(d, BY, ["o"], 5000.0), BY, 0, 5, {"id_second": lambda w: F.lead("id", 5).over(w)}))
    return d.filter("id_second IS NOT NULL").select(F.col("id").alias("id_first"), "id_second", P.make("dx", "dy", F.lit(0.0)).alias("pose"), "value", "trajectory_id")


@query("pair_table_s3", POSES, PAIRSQL, "SELECT id_first, id_second, dx AS x, dy AS y, 1e0 AS qw FROM prs")
def pair_table(spark, sf):
    d = TT.parse(TT.lines(pairs(spark, sf), TT.PAIRS), TT.PAIRS)
    return d.select("id_first", "id_second", "pose.x", "pose.y", "pose.qw")


@query("score_table_s4", FIXES, PAIRSQL, """
SELECT p.x + 4 AS x, p.y - 4 AS y, prs.dx AS score FROM prs JOIN poses p ON p.id = prs.id_first""")
def score_table(spark, sf):
    d = pairs(spark, sf).withColumn("score", F.col("pose.x"))
    out = TT.score_table(d, keyframes(spark, sf))
    return TT.parse(TT.lines(out, TT.SCORES), TT.SCORES)


@query("trajectory_table_s5", """
SELECT o_custkey AS trajectory_id, count(*) AS parts, max(f) AS last_file, bool_and(m) AS is_mapping FROM (
  SELECT o_custkey, o_orderkey % 50 AS part, min('d' || o_orderkey || '.bag') AS f, min(o_orderstatus = 'F') AS m FROM orders GROUP BY 1, 2) GROUP BY o_custkey""")
def trajectory_table(spark, sf):
    o = V.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("trajectory_id"), (F.col("o_orderkey") % 50).cast("int").alias("part"),
        F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".bag")).alias("file"), (F.col("o_orderstatus") == "F").alias("is_mapping"))
    g = TT.group_trajectories(TT.parse(TT.lines(o, TT.TRAJECTORIES), TT.TRAJECTORIES))
    return g.select("trajectory_id", F.size("files").cast("long").alias("parts"), F.array_max(F.map_values("files")).alias("last_file"), "is_mapping")


@query("merge_info_s6", "SELECT DISTINCT user_id AS trajectory_id, CAST(user_id % 2 AS INT) AS vertex_type FROM events")
def merge_info(spark, sf):
    d = V.table(spark, sf, "events").select(F.col("user_id").alias("trajectory_id"), (F.col("user_id") % 2).cast("int").alias("vertex_type")).distinct()
    return TT.parse(TT.lines(d, TT.MERGE_INFO), TT.MERGE_INFO)


@query("degeneracy_table_s7", FIXES, "SELECT id, value AS degeneracy, value < 15 AS is_degenerate FROM fixes")
def degeneracy_table(spark, sf):
    d = V.steps(spark, sf).withColumnRenamed("value", "degeneracy")
    return TT.parse(TT.lines(TT.degeneracy_table(d, 15.0), TT.DEGENERACY), TT.DEGENERACY)


@query("residual_table_s8", POSES, "SELECT dx AS r0, dy AS r1, z AS r2, value AS r3, 0e0 AS r4, k * 1e0 AS r5 FROM poses")
def residual_table(spark, sf):
    d = V.steps(spark, sf).select(F.col("dx").alias("r0"), F.col("dy").alias("r1"), (F.col("value") / 100.0).alias("r2"),
                                  F.col("value").alias("r3"), F.lit(0.0).alias("r4"), (F.col("k") * 1.0).alias("r5"))
    return TT.parse(TT.lines(d, TT.RESIDUALS), TT.RESIDUALS)


@query("upsert_s9", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal > 5000 THEN c_acctbal + 2 WHEN c_acctbal > 4000 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer
UNION ALL SELECT c_custkey + 1000000, 'new', c_acctbal + 1 FROM customer WHERE c_acctbal > 9000""")
def upsert(spark, sf):
    c = V.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.lit(0).alias("v"))
    one = c.filter("c_acctbal > 4000").withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("v", F.lit(1))
    two = c.filter("c_acctbal > 5000").withColumn("c_acctbal", F.col("c_acctbal") + 2).withColumn("v", F.lit(2))
    new = c.filter("c_acctbal > 9000").select((F.col("c_custkey") + 1000000).alias("c_custkey"), F.lit("new").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"), F.lit(1).alias("v"))
    return M.upsert(c, one.unionByName(two).unionByName(new), ["c_custkey"], "v").drop("v")


@query("update_poses_s10", POSES, "SELECT id, CASE WHEN k > 50 THEN x + 10 ELSE x END AS x, y FROM poses")
def update_poses(spark, sf):
    d = V.posed(spark, sf).select("id", "k", "pose")
    new = d.filter("k > 50").select("id", P.make(F.col("pose.x") + 10, F.col("pose.y"), F.col("pose.z")).alias("pose"))
    return M.update_poses(d, new).select("id", "pose.x", "pose.y")


@query("shift_ids_s11", "SELECT c_custkey + 500 AS c_custkey, c_name FROM customer")
def shift_ids(spark, sf):
    return M.shift_ids(V.table(spark, sf, "customer"), 500, "c_custkey").select("c_custkey", "c_name")


@query("delete_ids_s12", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
def delete_ids(spark, sf):
    gone = V.table(spark, sf, "orders").filter("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return M.delete_ids(V.table(spark, sf, "customer"), gone, "c_custkey").select("c_custkey", "c_name")


def _blobs(spark, sf):
    p = V.points(spark, sf).select("frame_id", F.pmod(F.xxhash64("x", "y", "z", "ring"), F.lit(1000)).alias("pt"), *[F.col(c).cast("float").alias(c) for c in "xyz"],
                                   F.lit(0.0).cast("float").alias("height"), F.hypot("x", "y").cast("float").alias("range"), "intensity",
                                   F.lit(0).alias("intensity_vi"), "ring", F.lit(1).alias("type"))
    return clouds.pack_clouds(p)


@query("split_failed_frames_s13", "SELECT l_suppkey AS frame_id, l_suppkey % 10 = 3 AS failed FROM lineitem GROUP BY l_suppkey")
def split_failed_frames(spark, sf):
    b = _blobs(spark, sf).withColumn("pcd", F.when(F.col("frame_id") % 10 == 3, F.expr("substring(pcd, 1, length(pcd) - 5)")).otherwise(F.col("pcd")))
    ok, bad = clouds.split_failed(b)
    return ok.select("frame_id", F.lit(False).alias("failed")).unionByName(bad.select("frame_id", F.lit(True).alias("failed")))


@query("dump_u5", POINTS, "SELECT frame_id, count(*) AS n, round(sum(x), 6) AS sx FROM points GROUP BY 1")
def dump_frames(spark, sf):
    """Every frame's points written in bucket folders and read back."""
    folder = shared_folder(spark) + "/dump"
    M.dump(V.points(spark, sf), folder, buckets=16)
    return spark.read.parquet(folder).groupBy("frame_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 6).alias("sx"))


@query("explode_clouds_s14", POINTS, "SELECT frame_id, ring, intensity, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(z) AS sz FROM points GROUP BY ALL".replace("GROUP BY ALL", "GROUP BY 1, 2, 3"))
def explode_clouds(spark, sf):
    d = clouds.explode_clouds(_blobs(spark, sf))
    return d.groupBy("frame_id", "ring", "intensity").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{c}") for c in "xyz"])


@query("normalise_messages_s15", """
SELECT 'gps' AS topic, CAST(o_orderkey AS BIGINT) AS id, 315964782e0 + (o_orderkey % 2000) * 604800e0 + o_custkey + 0e0 AS t, NULL::BIGINT AS lr FROM orders
UNION ALL SELECT 'odom', l_orderkey, l_partkey * 1e0 + 0.05e0, CAST(trunc(l_quantity * 0.1e0 * 1024 / (2 * pi() * 0.155e0)) AS BIGINT) FROM lineitem""")
def normalise_messages(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 2000).alias("week"), F.col("o_custkey").cast("double").alias("sec"))
    li = V.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").cast("double").alias("stamp"), F.col("l_quantity").alias("speed"))
    a = logs.normalise(o, {"id": "o_orderkey", "t": "sec"}, "week", "sec", topic="gps")
    b = logs.normalise(li, {"id": "l_orderkey", "t": "stamp", "lr": "speed"}, speeds=["lr"], shift=logs.SCAN_SHIFT, topic="odom")
    return logs.union_messages(a, b)


@query("parse_app_mark_s16", """
SELECT c_custkey, CASE WHEN r IS NULL THEN 255 WHEN save = 255 THEN r ELSE 4 + 2 * r + CASE WHEN save = 0 THEN 0 ELSE 1 END END AS type,
  CASE WHEN r IS NULL OR save = 255 THEN 255 ELSE num END AS number
FROM (SELECT c_custkey, CASE c_nationkey % 5 WHEN 4 THEN NULL ELSE c_nationkey % 5 END AS r, [0, 1, 255][CAST(c_custkey % 3 AS INT) + 1] AS save, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey % 100 END AS num FROM customer)""")
def parse_app_mark(spark, sf):
    c = V.table(spark, sf, "customer")
    letter = F.substring(F.lit("abcdx"), (F.col("c_nationkey") % 5 + 1).cast("int"), F.lit(1))
    num = F.when(F.col("c_custkey") % 7 == 0, "q").otherwise((F.col("c_custkey") % 100).cast("string"))
    save = F.element_at(F.array(F.lit(0), F.lit(1), F.lit(255)), (F.col("c_custkey") % 3 + 1).cast("int"))
    d = c.select("c_custkey", logs.parse_app_mark(F.concat(letter, num), save).alias("m"))
    return d.select("c_custkey", "m.type", "m.number")


@query("merge_logs_s17", """
SELECT 'order' AS topic, epoch_us(o_orderdate) / 1e6 AS t, o_totalprice AS v FROM orders
UNION ALL SELECT l_returnflag, epoch_us(l_shipdate) / 1e6 - (SELECT min(epoch_us(l_shipdate)) / 1e6 FROM lineitem) + (SELECT min(epoch_us(o_orderdate)) / 1e6 FROM orders), l_extendedprice
FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def merge_logs(spark, sf):
    o = V.table(spark, sf, "orders").select(F.lit("order").alias("topic"), (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1e6).alias("t"), F.col("o_totalprice").alias("v"))
    li = V.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("topic"), (F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1e6).alias("t"), F.col("l_extendedprice").alias("v"))
    return logs.merge_logs(o, li, ["A", "R"])


@query("remap_topics_s18", """
SELECT CASE l_returnflag WHEN 'A' THEN '/ivsensorimu' WHEN 'R' THEN '/ivwheelspeed' END AS topic, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1""")
def remap_topics(spark, sf):
    f = F.col("l_returnflag")
    topic = F.concat(F.lit("/car/"), F.when(f == "A", "ivsensorimu").when(f == "R", "tpcansensor").otherwise("tplocalization"))
    d = logs.remap_topics(V.table(spark, sf, "lineitem").select(topic.alias("topic"), "l_quantity"))
    return d.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))


PATHS = """paths AS (SELECT o_orderkey AS seq, '/data/' || o_custkey || '/' || CASE o_orderkey % 6 WHEN 0 THEN 'd' || o_custkey || '.bag' WHEN 1 THEN 'z' || o_custkey || '_V.bag' WHEN 2 THEN 'x' || o_custkey || '.bag.active'
  WHEN 3 THEN 'm' || o_custkey || '.db' WHEN 4 THEN 'calibration.launch' ELSE 'c' || o_custkey || '.pcd' END AS path FROM orders)"""


def _paths(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    name = (F.when(k % 6 == 0, F.concat(F.lit("d"), c, F.lit(".bag"))).when(k % 6 == 1, F.concat(F.lit("z"), c, F.lit("_V.bag")))
            .when(k % 6 == 2, F.concat(F.lit("x"), c, F.lit(".bag.active"))).when(k % 6 == 3, F.concat(F.lit("m"), c, F.lit(".db")))
            .when(k % 6 == 4, "calibration.launch").otherwise(F.concat(F.lit("c"), c, F.lit(".pcd"))))
    return V.table(spark, sf, "orders").select(k.alias("seq"), F.concat(F.lit("/data/"), c, F.lit("/"), name).alias("path"))


@query("classify_files_s19", PATHS, """
SELECT name, arg_min(path, (seq, path)) AS path, CASE WHEN name LIKE '%_V.bag%' THEN 'converted' WHEN name LIKE '%.bag%' THEN 'log' WHEN name LIKE '%.db%' THEN 'db' WHEN name LIKE '%.pcd%' THEN 'pcd' ELSE 'calibration' END AS class
FROM (SELECT *, list_last(string_split(path, '/')) AS name FROM paths) WHERE name NOT LIKE '%.active%' GROUP BY name""")
def classify_files(spark, sf):
    d = _paths(spark, sf).groupBy("seq").agg(F.min("path").alias("path"))
    return logs.classify_files(d).select("name", "path", "class")


LOGS = """lg AS (SELECT '/x/ConvertData/' || CASE WHEN o_orderstatus = 'F' THEN 'z' ELSE 'd' END || 'site' || (o_custkey % 20) || '_' || o_orderkey || '_' || CASE WHEN o_orderkey % 3 = 0 THEN 'part' || (o_orderkey % 4) || '_' ELSE '' END || 'V.bag' AS path,
  min(o_orderkey) AS k, min(o_custkey) AS c, min(o_orderstatus) AS s FROM orders GROUP BY 1)"""


def _logs(spark, sf):
    k = F.col("o_orderkey")
    part = F.when(k % 3 == 0, F.concat(F.lit("part"), (k % 4).cast("string"), F.lit("_"))).otherwise("")
    path = F.concat(F.lit("/x/ConvertData/"), F.when(F.col("o_orderstatus") == "F", "z").otherwise("d"), F.lit("site"),
                    (F.col("o_custkey") % 20).cast("string"), F.lit("_"), k.cast("string"), F.lit("_"), part, F.lit("V.bag"))
    return V.table(spark, sf, "orders").select(path.alias("path"), (F.col("o_custkey") % 20).alias("site"), k.alias("seq")).distinct()


@query("parse_log_name_s20", LOGS, """
SELECT path, CASE WHEN s = 'F' THEN 'z' ELSE 'd' END || 'site' || (c % 20) AS name, k % 3 = 0 AS has_part, CASE WHEN k % 3 = 0 THEN CAST(k % 4 AS INT) ELSE 0 END AS part, k * 1e0 AS time FROM lg""")
def parse_log_name(spark, sf):
    d = _logs(spark, sf).select("path", logs.parse_log_name("path").alias("p"))
    return d.select("path", "p.name", "p.has_part", "p.part", "p.time").distinct()


@query("assign_trajectories_s21", LOGS, """
SELECT site, time, has_part, sum(CASE WHEN has_part AND rn > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY site ORDER BY time ROWS UNBOUNDED PRECEDING) - 1 AS trajectory_id, CASE WHEN has_part THEN k % 4 + 1 ELSE 0 END AS part_no
FROM (SELECT c % 20 AS site, k * 1e0 AS time, k, k % 3 = 0 AS has_part, row_number() OVER (PARTITION BY c % 20 ORDER BY k) AS rn FROM lg)""")
def assign_trajectories(spark, sf):
    d = _logs(spark, sf).withColumn("p", logs.parse_log_name("path"))
    d = d.select("site", "path", "p.time", "p.has_part", "p.part")
    return logs.assign_trajectories(d, ["site"], 5000.0).select("site", "time", "has_part", "trajectory_id", "part_no")


@query("assign_by_name_s22", """
SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY first) - 1 AS trajectory_id FROM (SELECT c_custkey, c_mktsegment, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS first FROM customer)""")
def assign_by_name(spark, sf):
    c = V.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return logs.assign_by_name(c, "c_custkey", "c_mktsegment", 5000.0)


@query("admission_report_s23", PATHS, """
SELECT r.class, r.required, count(f.name) AS found, count(f.name) >= r.required AS ok FROM (VALUES ('log', 1), ('converted', 5), ('db', 1), ('vehicle', 1), ('calibration', 1)) r(class, required)
LEFT JOIN (SELECT DISTINCT name, CASE WHEN name LIKE '%_V.bag%' THEN 'converted' WHEN name LIKE '%.bag%' THEN 'log' WHEN name LIKE '%.db%' THEN 'db' WHEN name LIKE '%.pcd%' THEN 'pcd' ELSE 'calibration' END AS class
  FROM (SELECT list_last(string_split(path, '/')) AS name FROM paths) WHERE name NOT LIKE '%.active%') f ON f.class = r.class GROUP BY 1, 2""")
def admission_report(spark, sf):
    rules = spark.createDataFrame([("log", 1), ("converted", 5), ("db", 1), ("vehicle", 1), ("calibration", 1)], "class string, required int")
    return logs.admission_report(logs.classify_files(_paths(spark, sf)), rules).select("class", "required", "found", "ok")


@query("assignment_table_s25", POSES, "SELECT CAST(floor(x) AS BIGINT) AS map_id, x, y, z, id FROM poses")
def assignment_table(spark, sf):
    d = V.posed(spark, sf)
    out = TT.assignment_table(d.select("id", F.floor("x").alias("map_id")), d)
    return TT.parse(TT.lines(out, TT.ASSIGNMENT), TT.ASSIGNMENT)


@query("gps_flags_s26", FIXES, "SELECT id, status = 4 AND value <= 20 AS fixed_inlier FROM fixes")
def gps_flags(spark, sf):
    text = TT.lines(TT.path_table(keyframes(spark, sf), "stage2"), TT.PATH)
    return TT.parse(text, TT.PATH).select("id", F.col("gps_ok").alias("fixed_inlier"))


@query("list_keys_s27", "SELECT vec_id, label FROM embeddings")
def list_keys(spark, sf):
    return logs.list_keys(V.table(spark, sf, "embeddings"), ["vec_id", "label"])


@query("bounded_p8", POSES, "SELECT id FROM poses WHERE abs(x) <= 5 AND abs(y) <= 5 AND abs(z) <= 5")
def bounded(spark, sf):
    return R.bounded(V.poses(spark, sf), 5.0).select("id")


@query("drop_degenerate_p9", "SELECT event_id AS id FROM events WHERE value > 12")
def drop_degenerate(spark, sf):
    return R.drop_degenerate(V.steps(spark, sf), 12.0, "value").select("id")


@query("valid_path_p12", POSES, "SELECT id FROM poses WHERE abs(x) > 1e-6 OR abs(y) > 1e-6")
def valid_path(spark, sf):
    return R.valid_path(V.poses(spark, sf)).select("id")


@query("first_per_key_p13", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def first_per_key(spark, sf):
    e = V.table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return M.first_per_key(e, ["user_id", "event_type"], ["event_id"])


BAGS = """bags AS (SELECT trajectory_id // 8 AS site, trajectory_id, CASE WHEN trajectory_id % 3 = 0 THEN 'z' ELSE 'd' END || trajectory_id AS name,
  CASE WHEN avg(status) > 2.6e0 THEN 3 WHEN avg(status) > 2.2e0 THEN 2 WHEN avg(status) > 1.2e0 THEN 0 ELSE -1 END AS quality FROM fixes GROUP BY ALL)""".replace("GROUP BY ALL", "GROUP BY trajectory_id")


def _bags(spark, sf):
    a = F.col("a")
    d = V.fixes(spark, sf, False).groupBy("trajectory_id").agg(F.avg("status").alias("a"))
    return d.select(F.floor(F.col("trajectory_id") / 8).alias("site"), "trajectory_id",
                    F.concat(F.when(F.col("trajectory_id") % 3 == 0, "z").otherwise("d"), F.col("trajectory_id").cast("string")).alias("name"),
                    F.when(a > 2.6, 3).when(a > 2.2, 2).when(a > 1.2, 0).otherwise(-1).alias("quality"))


@query("scene_type_a14", FIXES, BAGS, """
SELECT site, d_n, d_good, d_bad, z_n, z_good, z_bad, no_gps, best, CASE WHEN no_gps > 0 THEN 'Indoor' WHEN (d_bad > 0 OR z_bad > 0) AND d_good = 0 THEN 'Half Indoor'
  WHEN (d_good = 0 AND d_bad = 0) OR (z_good = 0 AND z_bad = 0) THEN 'Indoor' WHEN (d_good + d_bad = d_n AND d_good <> 0) OR (z_good + z_bad = z_n AND z_good <> 0) OR d_good = d_n OR z_good = z_n THEN 'Outdoor' ELSE 'Half Indoor' END AS scene
FROM (SELECT site, count(*) FILTER (name[1] = 'd') AS d_n, count(*) FILTER (name[1] = 'd' AND quality > 0) AS d_good, count(*) FILTER (name[1] = 'd' AND quality = 0) AS d_bad,
  count(*) FILTER (name[1] = 'z') AS z_n, count(*) FILTER (name[1] = 'z' AND quality > 0) AS z_good, count(*) FILTER (name[1] = 'z' AND quality = 0) AS z_bad, count(*) FILTER (quality <= -1) AS no_gps,
  max(quality) FILTER (name[1] = 'd') AS best FROM bags GROUP BY site)""")
def scene_type(spark, sf):
    return R.scene_type(_bags(spark, sf), ["site"])


@query("choose_origin_a40", FIXES, BAGS, """
SELECT arg_min(trajectory_id * 1e0, trajectory_id) FILTER (quality > -1) AS x, 2e0 AS y, 3e0 AS z, 50 AS zone, 'first log' AS source FROM bags""")
def choose_origin(spark, sf):
    b = _bags(spark, sf).select("name", "quality", F.col("trajectory_id").alias("seq"), F.col("trajectory_id").cast("double").alias("x"),
                                F.lit(2.0).alias("y"), F.lit(3.0).alias("z"), F.lit(50).alias("zone"))
    return R.choose_origin(b, b.filter("seq < 0"))


@query("choose_origin_cases_a40", FIXES, BAGS, f"""
SELECT 'stored' AS kind, max(trajectory_id) * 1e0 AS x, 2e0 AS y, 3e0 AS z, 50 AS zone, 'stored' AS source FROM bags
UNION ALL SELECT 'none', {R.NO_FIX_ORIGIN[0]}, {R.NO_FIX_ORIGIN[1]}, {R.NO_FIX_ORIGIN[2]}, {R.NO_FIX_ORIGIN[3]}, 'no fix'
UNION ALL SELECT 'some', arg_min(trajectory_id * 1e0, trajectory_id) FILTER (quality > -1), 2e0, 3e0, 50, 'first log' FROM bags""")
def choose_origin_cases(spark, sf):
    b = _bags(spark, sf).select("name", "quality", F.col("trajectory_id").alias("seq"), F.col("trajectory_id").cast("double").alias("x"),
                                F.lit(2.0).alias("y"), F.lit(3.0).alias("z"), F.lit(50).alias("zone"))
    last = b.join(b.agg(F.max("seq").alias("seq")), "seq", "left_semi").select(b.columns)
    none = b.limit(0)
    cases = (("stored", b, last), ("none", b.withColumn("quality", F.lit(-1)), none), ("some", b, none))
    out = None
    for kind, bags, kept in cases:
        one = R.choose_origin(bags, kept).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


@query("checked_ratio_a31", POSES, """
SELECT trajectory_id, frames, checked, checked / frames AS ratio FROM (SELECT trajectory_id, count(*) AS frames, count(CASE WHEN EXISTS (SELECT 1 FROM events e WHERE e.event_id = p.id AND e.value > 15 AND e.event_type = 'view') THEN 1 END) AS checked
FROM poses p GROUP BY GROUPING SETS ((trajectory_id), ()))""")
def checked_ratio(spark, sf):
    d = V.steps(spark, sf)
    pr = d.filter("value > 15 AND event_type = 'view'").select(F.col("id").alias("id_first"))
    return R.checked_ratio(pr.unionByName(pr), d)


@query("run_report_a33", """
SELECT count(*) AS runs, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1e0 ELSE 0e0 END), 6) AS success_rate, round(regr_slope(sec, size), 6) AS size_slope, round(regr_intercept(sec, size), 4) AS size_intercept,
  round(regr_slope(sec, area), 6) AS area_slope, round(regr_intercept(sec, area), 4) AS area_intercept
FROM (SELECT o_orderstatus, o_totalprice / 1000 AS size, o_custkey * 1e0 AS area, CASE WHEN o_orderstatus = 'F' THEN (epoch_us(o_orderdate) // 86400000000) % 1000 * 1e0 END AS sec FROM orders)""")
def run_report(spark, sf):
    o = V.table(spark, sf, "orders")
    sec = (F.floor(F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 86400000000) % 1000).cast("double")
    d = o.select(F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), (F.col("o_totalprice") / 1000).alias("size"), F.col("o_custkey").cast("double").alias("area"), sec.alias("seconds"))
    r = R.run_report(d)
    return r.select("runs", F.round("success_rate", 6).alias("success_rate"), F.round("size_slope", 6).alias("size_slope"), F.round("size_intercept", 4).alias("size_intercept"),
                    F.round("area_slope", 6).alias("area_slope"), F.round("area_intercept", 4).alias("area_intercept"))


@query("status_counts_a33", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf):
    return R.status_counts(V.table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "status"))


@query("poly_fit_a34", POINTS, "SELECT ring, 40e0 AS at_10 FROM points GROUP BY ring")
def poly_fit(spark, sf):
    d = V.points(spark, sf)
    fit = R.poly_fit(d.withColumn("f", 0.5 * F.col("x") * F.col("x") - F.col("x")), "x", "f", 3, ["ring"])
    return fit.select("ring", R.poly_eval(F.col("coef"), F.col("shift"), F.col("scale"), F.lit(10.0)).alias("at_10")).withColumn("at_10", F.round("at_10", 6))


@query("shift_height_a36", POSES, """
SELECT id, round(z - CASE WHEN abs(m) > 10 AND n > 2 THEN m ELSE 0 END, 6) + 0e0 AS z FROM (SELECT id, value AS z, avg(CASE WHEN k < 40 THEN value END) OVER () AS m, count(CASE WHEN k < 40 THEN 1 END) OVER () AS n FROM poses)""")
def shift_height(spark, sf):
    d = V.steps(spark, sf).select("id", P.make(F.lit(0.0), F.lit(0.0), "value").alias("pose"), F.when(F.col("k") < 40, 0.0).otherwise(1.0).alias("gps_noise0"))
    return R.shift_height(d, ["pose"]).select("id", r6(F.col("pose.z")).alias("z"))


@query("matching_quality_a41", POSES, """
SELECT id, round(0.3e0 / (k + 1) * 0.05e0, 8) AS n0, round(0.3e0 / (k + 1) * 0.008e0, 8) AS n5, CASE WHEN value + 1 > 10 THEN 100e0 ELSE 200e0 END AS degeneracy FROM poses""")
def matching_quality(spark, sf):
    d = V.steps(spark, sf).select("id", (F.col("k") + 1.0).alias("score"), (F.col("value") + 1).alias("lambda_max"), F.lit(1.0).alias("lambda_min"))
    q = R.matching_quality(d, 10.0)
    return q.select("id", F.round(F.col("noise")[0], 8).alias("n0"), F.round(F.col("noise")[5], 8).alias("n5"), "degeneracy")


@query("align_paths_j27", LEVER, utm_sql("fixes", "lon", "lat", "a"), utm_sql("shifted", "slon", "slat", "b"), """
SELECT 'fused' AS source, id, round(ux - 756000, 3) + 0e0 AS x, round(uy - 4432000, 3) + 0e0 AS y FROM utma
UNION ALL SELECT 'gps', id, round(ux - 756000, 3) + 0e0, round(uy - 4432000, 3) + 0e0 FROM utmb UNION ALL SELECT 'optimised', id, x, y FROM fixes""")
def align_paths(spark, sf):
    d = V.fixes(spark, sf)
    out = R.align_paths(d, d, d.select("id", "x", "y"), (0.3, -0.2, 1.5), (756000.0, 4432000.0))
    return out.select("source", "id", (F.round("x", 3) + 0.0).alias("x"), (F.round("y", 3) + 0.0).alias("y"))


@query("union_points_u1", POINTS, "SELECT frame_id, sum(n) AS n, sum(sx) AS sx FROM (SELECT frame_id, count(*) AS n, sum(x) AS sx FROM points GROUP BY 1 UNION ALL SELECT s_suppkey, 1, 0 FROM supplier) GROUP BY 1")
def union_points(spark, sf):
    extra = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("frame_id"), F.lit(0.0).alias("x"))
    d = M.union_points(V.points(spark, sf).select("frame_id", "x"), extra)
    return d.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"))


MERGE = """cur AS (SELECT p.id + m.i AS id, p.trajectory_id + m.t AS trajectory_id, x FROM poses p, (SELECT max(id) + 1 AS i, max(trajectory_id) + 1 AS t FROM poses) m WHERE p.k > 60)"""


def _merged(spark, sf):
    d = V.posed(spark, sf).select("id", "trajectory_id", "k", F.col("pose").alias("stage1_pose"), P.make(F.col("x") + 1, "y", "z").alias("stage2_pose"))
    return M.merge_maps(d, d.filter("k > 60"))


@query("merge_maps_u2", POSES, MERGE, "SELECT id, trajectory_id, x + 1 AS stage1_x FROM poses UNION ALL SELECT id, trajectory_id, x FROM cur")
def merge_maps(spark, sf):
    return _merged(spark, sf)[0].select("id", "trajectory_id", F.col("stage1_pose.x").alias("stage1_x"))


@query("merge_maps_info_u2", POSES, MERGE, "SELECT DISTINCT trajectory_id, 'FIXED' AS vertex_type FROM poses UNION ALL SELECT DISTINCT trajectory_id, 'UNFIXED' FROM cur")
def merge_maps_info(spark, sf):
    return _merged(spark, sf)[1]


@query("merge_stores_u3", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'b' ELSE 'a' END AS src FROM customer")
def merge_stores(spark, sf):
    c = V.table(spark, sf, "customer")
    return M.merge_stores([c.select("c_custkey", F.lit("a").alias("src")), c.filter("c_acctbal > 0").select("c_custkey", F.lit("b").alias("src"))], ["c_custkey"])


@query("split_store_u4", POSES, "SELECT CAST(floor(x) AS BIGINT) AS map_id, count(*) AS n, sum(y) AS sy FROM poses GROUP BY 1")
def split_store(spark, sf):
    d = V.poses(spark, sf)
    s = M.split_store(d.select("id", "y"), d.select("id", F.floor("x").alias("map_id")))
    return s.groupBy("map_id").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"))


@query("fix_frames_r16", POSES, "SELECT id, k < 10 OR trajectory_id IN (SELECT trajectory_id FROM poses WHERE value > 60) AS fixed FROM poses")
def fix_frames(spark, sf):
    d = V.steps(spark, sf)
    return M.fix(d.select("id", "trajectory_id"), d.filter("k < 10"), d.filter("value > 60")).select("id", "fixed")


@query("apply_correction_r15", POSES, """
SELECT p.id, round(CASE WHEN b.v IS NULL THEN x ELSE b.v + cos(radians(30)) * x - sin(radians(30)) * y END, 6) + 0e0 AS x FROM poses p
LEFT JOIN (SELECT trajectory_id, max(value) AS v FROM poses WHERE value > 40 GROUP BY 1) b USING (trajectory_id)""")
def apply_correction(spark, sf):
    d = V.poses(spark, sf).withColumn("pose", P.make("x", "y", "z"))
    m = V.steps(spark, sf).filter("value > 40").select("trajectory_id", F.col("value").alias("score"), P.from_yaw("value", F.lit(0.0), F.lit(0.0), F.lit(30 * P.RAD)).alias("correction"))
    return M.apply_correction(d, m).select("id", r6(F.col("pose.x")).alias("x"))


@query("loop_edges_j30", POSES, PAIRSQL, "SELECT id_first, id_second, dx, round(1 / (0.2e0 * 0.2e0) * 2e0, 6) AS info0, round(1 / (radians(2.5e0) * radians(2.5e0)) * 2e0, 4) AS info5 FROM prs")
def loop_edges(spark, sf):
    d = GR.loop_edges(pairs(spark, sf).select("id_first", "id_second", "pose"), 2.0)
    return d.select(F.col("i").alias("id_first"), F.col("j").alias("id_second"), F.col("meas.x").alias("dx"), F.round(F.col("info")[0], 6).alias("info0"), F.round(F.col("info")[5], 4).alias("info5"))
