"""Iterative operators: known answers, monotone costs, brute-force twins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayloom.functions import geodesy as G
from wayloom.functions import pose as P
from wayloom.functions import rigid as N
from wayloom.operators import calib, graph, grid, maps, mixture, occupancy, register, reports, scans, submaps
from wayloom.session import cut


def room(rng, n=400):
    pts = []
    for _ in range(n):
        u, v, h = rng.uniform(-10, 10), rng.uniform(-10, 10), rng.uniform(0, 5)
        pts.append(rng.choice([(u, v, 0.0), (10.0, v, h), (u, -10.0, h)]))
    return pts


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(2)
    true = {1: (0.3, -0.2, 0.0, 0.03), 2: (-0.4, 0.1, 0.0, -0.04)}
    src, tgt = [], []
    for k, (dx, dy, _, yaw) in true.items():
        pts = room(rng)
        inv = N.between(np.array([[dx, dy, 0, 0, 0, math.sin(yaw / 2), math.cos(yaw / 2)]]), np.array([[0, 0, 0, 0, 0, 0, 1.0]]))
        for i, p in enumerate(pts):
            tgt.append((k, i, *p))
            m = N.rotate(inv[:, 3:], np.array([p]))[0] + inv[0, :3]
            src.append((k, i, *map(float, m)))
    cols = "pair_id long, pt long, x double, y double, z double"
    first = spark.createDataFrame([(k,) for k in true], "pair_id long").withColumn("pose", P.make(F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    return true, first, spark.createDataFrame(src, cols).cache(), spark.createDataFrame(tgt, cols).cache()


def close(rows, true, tol):
    assert len(rows) == len(true)
    for r in rows:
        dx, dy, dz, yaw = true[r["pair_id"]]
        p = r["pose"]
        assert abs(p["x"] - dx) < tol and abs(p["y"] - dy) < tol and abs(p["z"] - dz) < tol
        assert abs(2 * math.atan2(p["qz"], p["qw"]) - yaw) < tol / 4


def test_ndt_recovers_pose(pairs):
    true, first, src, tgt = pairs
    close(register.register_ndt(first, src, tgt, size=4.0, iters=10).collect(), true, 0.08)


def test_icp_recovers_pose(pairs):
    true, first, src, tgt = pairs
    rows = register.register_icp(first, src, tgt, max_d=2.0, iters=20, tol=1e-6).collect()
    close(rows, true, 0.01)
    assert all(r["accepted"] for r in rows)


def test_features_recover_pose(pairs):
    true, first, src, tgt = pairs
    kind = F.lit("plane").alias("kind")
    close(register.align_features(first, src.select("pair_id", "x", "y", "z", kind), tgt.select("pair_id", "x", "y", "z", kind), iters=6, base=1.0).collect(), true, 0.05)


def test_grid_search_finds_shift(spark, pairs):
    true, first, src, tgt = pairs
    i = F.lit(10).alias("intensity")
    rows = register.match_multires(first, src.select("pair_id", "x", "y", "z", i), tgt.select("pair_id", "x", "y", "z", i), 0.5, 3, 1.0, linear=2, angular=2, reach=20.0).collect()
    for r in rows:
        dx, dy, _, _ = true[r["pair_id"]]
        assert math.hypot(r["pose"]["x"] - dx, r["pose"]["y"] - dy) < 0.8 and r["score"] > 0


def test_chain_blocks(spark):
    rng = np.random.default_rng(1)
    n = 57
    steps = np.concatenate([rng.normal(size=(n, 3)), N.exp_rotation(rng.normal(size=(n, 3)) * 0.3)], 1)
    want = [steps[0]]
    for s in steps[1:]:
        want.append(N.compose(want[-1][None], s[None])[0])
    d = spark.createDataFrame([(1, i, *map(float, s)) for i, s in enumerate(steps)], "k long, id long, " + ", ".join(f"{f} double" for f in P.FIELDS))
    d = d.select("k", "id", P.from_columns().alias("pose"))
    got = register.compose_chain(d, ["k"], "id", block=4, width=10.0).orderBy("id").collect()
    assert np.allclose([[r["pose"][f] for f in P.FIELDS] for r in got], want, atol=1e-9)


def test_pose_graph_cost_falls_and_outliers_go(spark):
    """A square loop with drift, closing edges, and one wrong edge."""
    n = 40
    truth = []
    for i in range(n):
        side, s = divmod(i, 10)
        x, y = [(s, 0), (10, s), (10 - s, 10), (0, 10 - s)][side]
        truth.append((float(x), float(y), side * math.pi / 2))
    kf = spark.createDataFrame([(i, 0, *t) for i, t in enumerate(truth)], "id long, trajectory_id long, x double, y double, yaw double")
    kf = kf.withColumn("true", P.from_yaw("x", "y", F.lit(0.0), "yaw"))
    drift = P.from_yaw(F.col("x") + F.col("id") * 0.02, F.col("y") - F.col("id") * 0.015, F.lit(0.0), F.col("yaw") + F.col("id") * 0.002)
    kf = cut(kf.withColumn("pose", drift).withColumn("fixed", F.col("id") == 0).coalesce(1))
    e = graph.relative_edges(kf, 3, "true", weight=100.0, delta=10.0)
    loop = kf.filter("id = 0").select(F.col("true").alias("a")).crossJoin(kf.filter("id = 39").select(F.col("true").alias("b")))
    info = F.array(*[F.lit(100.0)] * 6)
    loop = loop.select(F.lit("rel").alias("kind"), F.lit(0).cast("long").alias("i"), F.lit(39).cast("long").alias("j"), P.between("a", "b").alias("meas"), info.alias("info"), F.lit(10.0).alias("delta"))
    bad = loop.withColumn("j", F.lit(20).cast("long"))
    edges = cut(e.unionByName(loop).unionByName(bad).coalesce(1))

    def cost(p):
        r = graph.edge_residuals(edges, p)
        return r.agg(F.sum(100 * F.log1p(F.col("chi2") / 100))).first()[0]

    new = graph.optimise_poses(kf, edges, iters=6)
    assert cost(new.select("id", "pose")) < cost(kf.select("id", "pose"))
    fixed = new.filter("id = 0").first()["pose"]
    assert (fixed["x"], fixed["y"]) == (0.0, 0.0)
    flagged = reports.flag_outliers(graph.edge_residuals(edges, kf.select("id", F.col("true").alias("pose"))), 5.0)
    assert [(r["i"], r["j"]) for r in flagged.filter("not active").collect()] == [(0, 20)]


def test_em_likelihood_grows_and_modes_found(spark):
    rng = random.Random(4)
    d = spark.createDataFrame([(0.5, 0.5, rng.choice([rng.gauss(0, 0.2), rng.gauss(4, 0.3)]), 10 + 40 * (i % 2)) for i in range(400)], "x double, y double, z double, intensity int")
    seen = [mixture.em_value(d, 1.0, "z", iters=k).first()["loglik"] for k in (1, 3, 8)]
    assert seen[0] <= seen[1] + 1e-9 <= seen[2] + 2e-9
    m = mixture.em_value(d, 1.0, "z", iters=12).first()
    assert abs(m["u1"]) < 0.1 and abs(m["u2"] - 4) < 0.1
    k = mixture.gmm_kmeans(d, 1.0).first()
    assert (k["ru1"], k["ru2"], k["rw1"]) == (10, 50, 50) and abs(k["au2"] - 400) < 12


def test_voxel_gaussian_matches_numpy(spark):
    rng = np.random.default_rng(0)
    pts = rng.normal([1e5 + 0.5, 2e5 + 0.5, 0.5], 0.1, size=(50, 3)).clip([1e5, 2e5, 0], [1e5 + 0.99, 2e5 + 0.99, 0.99])
    r = grid.voxel_gaussians(spark.createDataFrame(pts.tolist(), "x double, y double, z double"), 1.0).first()
    assert np.allclose(r["mean"], pts.mean(0)) and np.allclose(np.array(r["cov"]).reshape(3, 3), np.cov(pts.T), atol=1e-9)
    assert np.allclose(np.array(r["cov"]).reshape(3, 3) @ np.array(r["icov"]).reshape(3, 3), np.eye(3), atol=1e-6)


def test_occupancy_is_the_ordered_fold(spark):
    rng = random.Random(9)
    obs = [(0, rng.randint(0, 2), 0, rng.randint(0, 60), rng.random() < 0.5) for _ in range(900)]
    got = {r["px"]: r["v"] for r in occupancy.occupancy(spark.createDataFrame(obs, "submap_id int, px int, py int, seq long, hit boolean"), 7).collect()}
    for px in range(3):
        v = 127
        for *_, hit in sorted((o for o in obs if o[1] == px), key=lambda o: (o[3], not o[4])):
            v = max(117, v - 1) if hit else min(137, v + 1)
        assert got[px] == v


def test_segments_match_flood_fill(spark):
    rng = random.Random(6)
    cells = {(r, c): rng.choice([5.0, 5.0, 5.0, 9.0]) for r in range(6) for c in list(range(0, 30)) + list(range(1780, 1800)) if rng.random() < 0.8}
    d = spark.createDataFrame([(1, r, c, v, False) for (r, c), v in cells.items()], "frame_id long, row int, col int, range double, ground boolean")
    got = {(r["row"], r["col"]): r["label"] for r in scans.segment_scan(d, 0.05, 0.05, 0.6, big=6, small=6, lines=99).collect()}

    def joined(a, b):
        hi, lo = max(a, b), min(a, b)
        return math.atan2(lo * math.sin(0.05), hi - lo * math.cos(0.05)) > 0.6

    left, groups = set(cells), []
    while left:
        todo, comp = [left.pop()], set()
        while todo:
            r, c = todo.pop()
            comp.add((r, c))
            for n in ((r + 1, c), (r - 1, c), (r, (c + 1) % 1800), (r, (c - 1) % 1800)):
                if n in left and joined(cells[r, c], cells[n]):
                    left.discard(n)
                    todo.append(n)
        groups.append(comp)
    for g in groups:
        labels = {got[x] for x in g}
        assert len(labels) == 1 and (labels == {0}) == (len(g) < 6)
    big = [got[next(iter(g))] for g in groups if len(g) >= 6]
    assert len(set(big)) == len(big)


def test_beam_calibration_finds_shift(spark):
    rng = random.Random(8)
    rows = []
    for v in range(300):
        level = rng.randint(10, 60)
        for ring in range(6):
            rows.append((v * 1.0 + 0.5, 0.5, 0.5, ring, level + (2 if ring == 3 else 0)))
    d = spark.createDataFrame(rows, "x double, y double, z double, ring int, intensity int")
    m = calib.beam_map(calib.calibrate_intensity(d, 1.0, iters=4))
    got = {(r["b"], r["a"]): r["best"] for r in m.collect()}
    hits = sum(got[3, a] == a - 2 for a in range(15, 60))
    assert hits >= 38 and sum(got[0, a] == a for a in range(15, 60)) >= 40


def test_floor_plane(spark):
    rng = random.Random(3)
    pts = [(1, x, y, 0.01 * x - 1.5 + rng.gauss(0, 0.01)) for x, y in ((rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(300))]
    pts += [(1, rng.uniform(-9, 9), rng.uniform(-9, 9), rng.uniform(-1.2, 0.2)) for _ in range(60)]
    pts += [(2, 1.0, float(i), -1.0) for i in range(50)]
    r = occupancy.floor_plane(spark.createDataFrame(pts, "frame_id long, x double, y double, z double")).collect()
    assert len(r) == 1 and r[0]["frame_id"] == 1
    assert abs(r[0]["c"] - 1) < 1e-2 and abs(r[0]["d"] - 1.5) < 0.05


def test_dead_reckoning_blocks_agree(spark):
    """Constant turn; splitting the drive into blocks changes nothing."""
    imu = spark.createDataFrame([(1, i * 0.01, 0.0, 0.0, 0.1, 0.0, 0.0, 9.80665) for i in range(400)], "trajectory_id long, t double, wx double, wy double, wz double, ax double, ay double, az double")
    odom = spark.createDataFrame([(1, i * 0.1 + 0.005, 2.0) for i in range(40)], "trajectory_id long, t double, v double")
    a = scans.dead_reckon(imu, odom, static_rows=1, block=50_000).orderBy("t").collect()
    b = scans.dead_reckon(imu, odom, static_rows=1, block=37).orderBy("t").collect()
    assert len(a) == len(b) == 440
    assert max(abs(x["pose"]["x"] - y["pose"]["x"]) for x, y in zip(a, b)) < 1e-9
    assert 6.0 < math.hypot(a[-1]["pose"]["x"], a[-1]["pose"]["y"]) < 8.2


def test_submaps_every_frame_once_and_small(spark):
    rows = [(0, i, float(i), 0.0, 0.0) for i in range(60)] + [(1, 100 + i, float(i), 1.0, 8.0) for i in range(30)]
    d = spark.createDataFrame(rows, "trajectory_id long, id long, x double, y double, z double")
    r = submaps.split_submaps(d, 25, 50.0, 5.0, 4.0)
    assert r.count() == 90 and r.select("id").distinct().count() == 90
    assert r.groupBy("map_id").count().agg(F.max("count")).first()[0] <= 25
    assert r.groupBy("map_id").agg(F.countDistinct("trajectory_id").alias("n")).filter("n > 1").count() == 0  # different levels
    short = d.withColumn("map_id", F.when(F.col("id").between(20, 22), 7).otherwise(1)).filter("trajectory_id = 0")
    assert {r["map_id"] for r in submaps.refine_submaps(short, 5, rounds=1).collect()} == {1}


def test_offset_calibration_rejects_large(spark):
    kf = spark.createDataFrame([(0, i, float(i), math.sin(i), 0.3 * i) for i in range(30)], "trajectory_id long, id long, x double, y double, yaw double")
    kf = kf.withColumn("gps_pose", P.from_yaw("x", "y", F.lit(0.0), "yaw")).withColumn("usable", F.lit(True))
    off = P.from_yaw(F.lit(0.9), F.lit(0.0), F.lit(0.0), F.lit(0.0))
    r = calib.calibrate_offset(kf.withColumn("o", off).withColumn("matching_pose", P.compose("gps_pose", "o"))).first()
    assert abs(r["offset"]["x"] - 0.9) < 1e-3 and not r["accepted"]


def test_bounds_of_negative_coordinates(spark):
    b = grid.bounds(spark.createDataFrame([(-5.0, -9.0), (-2.0, -3.0)], "x double, y double"), 0.0, 1.0).first()
    assert (b["max_x"], b["max_y"], b["cols"]) == (-2.0, -3.0, 4)


def test_truncating_and_clamping(spark):
    from wayloom.functions import cells as C
    r = spark.range(1).select(C.voxel_key(F.lit(-0.4), F.lit(0.4), F.lit(-1.2), 1.0).alias("v"), C.to_u8(F.lit(-3.0)).alias("a"), C.to_u8(F.lit(300.0)).alias("b"),
                              C.to_i16(F.lit(1e9)).alias("c"), G.heading_to_angle(F.lit(300.0)).alias("h"), G.angle_to_heading(F.lit(-150.0)).alias("i")).first()
    assert tuple(r["v"]) == (0, 0, -1) and (r["a"], r["b"], r["c"], r["h"], r["i"]) == (0, 255, 30000, 150.0, 240.0)


def test_poly_fit(spark):
    d = spark.createDataFrame([(float(x), 2.0 - x + 0.5 * x**3) for x in range(-5, 6)], "x double, y double")
    v = reports.poly_fit(d, "x", "y").select(reports.poly_eval(F.col("coef"), F.col("shift"), F.col("scale"), F.lit(7.0)).alias("v")).first()["v"]
    assert abs(v - (2 - 7 + 0.5 * 343)) < 1e-6


def test_best_match_is_the_highest_score(spark):
    kf = spark.createDataFrame([(1, 5, 0.0)], "trajectory_id long, id long, x double").withColumn("pose", P.make("x", F.lit(0.0), F.lit(0.0)))
    m = spark.createDataFrame([(1, 1.0, 10.0), (1, 3.0, 20.0)], "trajectory_id long, score double, dx double").withColumn("correction", P.make("dx", F.lit(0.0), F.lit(0.0)))
    assert maps.apply_correction(kf, m).first()["pose"]["x"] == 20.0
