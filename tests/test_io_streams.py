"""Files there and back, and streams against their batch twins."""

import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayloom.functions import pose as P
from wayloom.operators import grid, maps
from wayloom.plans.queries_tables import keyframes
from wayloom.sources import clouds
from wayloom.sources import text_tables as TT
from wayloom.streaming import streams as ST

SF = "/root/testdata/sf0.001"


def test_keyframe_file(spark, tmp_path):
    d = keyframes(spark, SF)
    TT.write_keyframes(d, str(tmp_path / "kf"))
    back = TT.read_keyframes(spark, str(tmp_path / "kf"))
    assert back.columns == d.columns
    assert back.exceptAll(d).count() == 0 and back.count() == d.count()


def test_pair_file_append_and_trajectories(spark, tmp_path):
    p = spark.createDataFrame([(1, 2)], "id_first long, id_second long").withColumn("pose", P.make(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    for mode in ("overwrite", "append"):
        TT.write_pairs(p, str(tmp_path / "p"), mode)
    assert TT.read_pairs(spark, str(tmp_path / "p")).count() == 2
    t = spark.createDataFrame([(0, {0: "d1.bag", 2: "d1_part1.bag"}, True), (1, {0: "z.bag"}, False)], "trajectory_id long, files map<int,string>, is_mapping boolean")
    TT.write_trajectories(t, str(tmp_path / "t"))
    got = {r["trajectory_id"]: (r["files"], r["is_mapping"]) for r in TT.read_trajectories(spark, str(tmp_path / "t")).collect()}
    assert got == {0: ({0: "d1.bag", 2: "d1_part1.bag"}, True), 1: ({0: "z.bag"}, False)}
    assert [r["trajectory_id"] for r in TT.read_trajectories(spark, str(tmp_path / "t"), True).collect()] == [1]


def test_bad_lines_give_null(spark):
    d = TT.parse(spark.createDataFrame([("1 x 3",), ("7",)], "value string"), TT.SCORES)
    assert [tuple(r) for r in d.collect()] == [(1.0, None, 3.0), (7.0, None, None)]


def test_blobs(spark):
    big, tiny = 3.4028234663852886e38, 1.1754943508222875e-38
    recs = [(1.0, 2.0, 3.0, 0.5, 4.0, 9, 8, 7, 1), (1.0, 0.0, 0.0, 0.0, big, 0, 0, 0, 0), (1.0, 0.0, 0.0, 0.0, tiny, 0, 0, 0, 0)]
    raw = b"".join(struct.pack("<5f4B", *r) for r in recs)
    d = spark.createDataFrame([(1, raw), (2, raw[:-3]), (3, None)], "frame_id long, pcd binary")
    got = clouds.explode_clouds(d).orderBy("pt").collect()
    assert [(r["range"], r["hit"]) for r in got] == [(4.0, "hit"), (None, "none"), (None, "free")]
    assert sorted(r["frame_id"] for r in clouds.split_failed(d)[1].collect()) == [2, 3]


def test_sinks(spark, tmp_path):
    pts = spark.createDataFrame([(1, 0.5, 0.5, 0.0, 5), (2, 20.5, 0.5, 0.0, 5)], "frame_id long, x double, y double, z double, intensity int")
    grid.write_tiles(grid.tiles(pts, 10.0, 1.0, 1), str(tmp_path / "tiles"))
    assert spark.read.parquet(str(tmp_path / "tiles")).select("tile").distinct().count() == 2
    maps.dump(pts, str(tmp_path / "dump"), buckets=4)
    assert spark.read.parquet(str(tmp_path / "dump")).filter("bucket = 1").first()["frame_id"] == 1
    maps.write_split(pts.withColumn("map_id", F.col("frame_id")), str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split")).filter("map_id = 2").count() == 1


SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("vehicle_id", T.LongType()), ("topic", T.StringType()), ("ts", T.TimestampType()), ("frame_id", T.LongType()),
    ("x", T.DoubleType()), ("y", T.DoubleType()), ("yaw", T.DoubleType()), ("value", T.DoubleType()))])
T0 = dt.datetime(2024, 1, 1)


def feed(spark, folder, batches):
    """One file per batch, in name order, read one per trigger."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    import os
    os.makedirs(folder)
    for i, rows in enumerate(batches):
        cols = {n: [r[k] for r in rows] for k, n in enumerate(SCHEMA.names)}
        tab = pa.table({n: pa.array(v, type=pa.timestamp("us", tz="UTC") if n == "ts" else None) for n, v in cols.items()})
        f = f"{folder}/{i:03d}.parquet"
        pq.write_table(tab, f)
        os.utime(f, (1e9 + i, 1e9 + i))
    d = ST.read_stream(spark, folder, SCHEMA, "pose", watermark="1 minute", files_per_trigger=1)
    return d.withColumn("t", F.unix_micros("ts") / 1e6)


def row(v, s, i, x, yaw=0.0, topic="pose"):
    return (v, topic, T0 + dt.timedelta(seconds=s), i, float(x), 0.0, yaw, 1.0)


LATER = [row(9, 10_000, 1000, 0)]  # moves the watermark past all other rows


def test_keyframes_over_triggers_in_time_order(spark, tmp_path):
    """Rows that come late inside the watermark, and rows of equal time, are used in time order."""
    batches = [[row(1, 0, 0, 0), row(1, 2, 2, 0.1), row(1, 1, 1, 0.0), row(1, 3, 3, 0.2)],
               [row(1, 2.5, 99, 50.0), row(1, 4, 4, 0.3), row(1, 5, 5, 0.9), row(1, 6, 6, 0.9, topic="other")],
               [row(1, 5, 55, 9.0), row(1, 7, 7, 9.1, 0.5), row(2, 8, 8, 1.0)], LATER]
    d = ST.stream_keyframes(feed(spark, str(tmp_path / "in"), batches).select("vehicle_id", "t", "ts", "frame_id", "x", "y", "yaw"))
    got = [(r["vehicle_id"], r["frame_id"], r["keyframe_no"]) for r in ST.drain(d).where("vehicle_id < 9").orderBy("vehicle_id", "keyframe_no").collect()]
    # 0, 1, 2 always; 99 and 3 moved; 4 is near 3; 5 and 55 moved; 7 turned
    assert got == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 99, 3), (1, 3, 4), (1, 5, 5), (1, 55, 6), (1, 7, 7), (2, 8, 0)]


def test_recent_and_submaps_over_triggers(spark, tmp_path):
    batches = [[row(1, i, i, i) for i in (0, 1, 4, 3)], [row(1, i, i, i) for i in (2, 5, 6)], [row(1, i, i, i) for i in (8, 7)], LATER]
    src = feed(spark, str(tmp_path / "in"), batches)
    r = {x["frame_id"]: x["recent"] for x in ST.drain(ST.recent_frames(src.select("vehicle_id", "t", "ts", "frame_id"), 4)).collect()}
    assert r[2] == [0, 1, 2] and r[6] == [3, 4, 5, 6] and r[8] == [5, 6, 7, 8]
    s = {x["frame_id"]: (x["submap_no"], x["local_x"]) for x in ST.drain(ST.stream_submaps(src.select("vehicle_id", "t", "ts", "frame_id", "x", "y", "yaw"), size=3)).collect()}
    assert s[4] == (1, 1.0) and s[5] == (1, 2.0) and s[8] == (2, 2.0)


def test_windows_close_behind_the_watermark(spark, tmp_path):
    """Append mode emits closed windows only; rows beyond the watermark are not counted."""
    batches = [[row(1, 10, 0, 0), row(1, 50, 1, 0)], [row(1, 400, 2, 0)], [row(1, 900, 4, 0)], [row(1, 20, 3, 0), row(1, 1500, 5, 0)]]
    h = ST.stream_health(feed(spark, str(tmp_path / "in"), batches), "1 minute", by=["vehicle_id"])
    got = {r["start"]: r["n"] for r in ST.drain(h).collect()}
    assert got[T0] == 2 and sum(got.values()) <= 4


def test_preintegration_turns(spark, tmp_path):
    imu = [(i * 0.01, 0.0 if i < 250 else 0.5) for i in range(500)]
    d = spark.createDataFrame([(1, T0 + dt.timedelta(seconds=t), w, None) for t, w in imu] + [(1, T0 + dt.timedelta(seconds=2.455), None, 2.0)],
                              "vehicle_id long, ts timestamp, wz double, v double")
    d.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = ST.read_stream(spark, str(tmp_path / "in"), d.schema, watermark="0 seconds")
    s = s.select("vehicle_id", "ts", (F.unix_micros("ts") / 1e6).alias("t"), F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"), "wz", "v")
    last = ST.drain(ST.stream_preintegrate(s)).orderBy(F.desc("t")).first()
    assert 2 * __import__("math").atan2(last["qz"], last["qw"]) == pytest.approx(0.5 * 2.5, abs=0.01)
    assert last["x"] > 3.5


def test_ring_buffer():
    assert ST.ring_buffer([1, 2, 3], [4], 3)[-3:] == [2, 3, 4] and ST.ring_buffer([1], [2, 3, 4, 5], 3) == [3, 4, 5]


def test_loop_check_per_trigger(spark, tmp_path):
    src = feed(spark, str(tmp_path / "in"), [[row(1, i, i, i) for i in range(6)]])
    frames = src.select(F.lit(1).alias("map_id"), "frame_id", (F.col("frame_id") / 2).cast("int").alias("submap_no"), "x", "y")
    subs = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 2.0, 0.0), (1, 2, 4.0, 0.0)], "map_id int, submap_no int, x double, y double")
    seen = []
    q = ST.stream_loop_candidates(frames, lambda: subs, lambda df, e: seen.extend(map(tuple, df.collect())), str(tmp_path / "cp"), 60.0, 4)
    q.trigger(availableNow=True).start().awaitTermination()
    assert {(s[1], s[3]) for s in seen} == {(2, 0), (3, 0), (4, 0), (4, 1), (5, 0), (5, 1)}
