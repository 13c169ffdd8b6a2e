"""Steps rewritten to send less: same results as the plain way, which they no longer take."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import grid, place, register, spatial, submaps
from wayloom.session import cut


@pytest.mark.parametrize("key", ["pair_id", "node"])
def test_grid_scores_without_the_exploded_join(spark, key):
    g = np.random.default_rng(5)
    big = 2**60
    pts = [(big + p, p, *map(float, g.uniform(-5, 5, 2)), float(g.uniform(0, 3)) if k % 9 else None, int(g.integers(0, 90))) for p in range(3) for k in range(40)]
    pts = spark.createDataFrame(pts, "pair_id long, node long, x double, y double, z double, intensity int")
    tgt = pts.withColumn("x", F.when(F.col("intensity") % 7 > 0, F.col("x") + 0.3))
    tgt = tgt.unionByName(tgt)
    tried = pts.select("pair_id", "node").distinct().select("*", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(2))).alias("a"))
    tried = tried.withColumn("pose", P.from_yaw(F.lit(0.2), F.lit(-0.1), F.lit(0.0), F.col("a") * 0.1))
    cells = cut(grid.cell_stats(tgt, 0.5, 1.0, [key]))
    d = pts.join(tried.drop("node"), "pair_id")
    x, y, z = P.transform("pose", "x", "y", "z")
    d = d.select("pair_id", "node", "a", x.alias("x"), y.alias("y"), z.alias("z"), "intensity")
    plain = grid.scan_logp(d, cells, 2, 0.5, 1.0, ["pair_id", "a"], [key])
    got = register._scored_bundled(pts, tried, cells, 2, 0.5, 1.0, key, 2)
    flat = lambda t: {tuple(r)[:-1]: r["logp"] for r in t.select("pair_id", "a", "d_row", "d_col", "logp").collect()}
    got, plain = flat(got), flat(plain)
    assert got.keys() == plain.keys() and len(got) == 3 * 3 * 25
    assert all(abs(got[k] - v) < 1e-9 for k, v in plain.items())


def test_lowest_near_map_without_all_pairs(spark, monkeypatch):
    g = np.random.default_rng(6)
    rows = [(i, *map(float, g.uniform(-8, 8, 2)), float(g.uniform(0, 2))) for i in range(400)]
    spots = spark.createDataFrame(rows, "map_id long, x double, y double, z double")
    near = lambda a, b: (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 9 and abs(a[3] - b[3]) < 0.5
    want = {a[0]: min(b[0] for b in rows if near(a, b)) for a in rows}
    want = {a: b for a, b in want.items() if b < a}
    asked = []
    join = submaps.radius_join
    monkeypatch.setattr(submaps, "radius_join", lambda a, *more, **how: asked.append(a.count()) or join(a, *more, **how))
    for takes in ((16, 1024), (1, 2)):  # the second leaves spots to the last step
        assert {r["map_id"]: r["_to"] for r in submaps._lowest_near(spots, 3.0, 0.5, takes).collect()} == want
    assert len(asked) == 1 and asked[0] < 400


def test_pair_window_sends_no_windows(spark):
    rows = [(i, i % 3) for i in range(0, 90, 2)] + [(4, 1), (4, 1)]  # an id of two trajectories
    kf = spark.createDataFrame(rows, "id long, trajectory_id long")
    pairs = [(4, 40), (4, 40), (30, 88), (31, 4), (0, 0)]
    got = spatial.pair_window(spark.createDataFrame(pairs, "id_1 long, id_2 long"), kf, 7)
    around = lambda i: {n for a, t in rows if a == i for n, u in rows if u == t and abs(n - i) <= 7}
    want = {p for a, b in pairs for p in itertools.product(around(a), around(b))}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "LeftSemi" not in got._jdf.queryExecution().toString()


def test_descriptor_arrays_without_look_ups(spark):
    rows = [(1, 0, 0, 3.0), (1, 59, 19, 4.0), (1, 7, 3, None), (2, 10, 5, 1.5), (2, 70, 5, 9.0)]
    d = place.descriptor_arrays(spark.createDataFrame(rows, "frame_id long, col long, row long, h double"))
    assert "map_from_entries" not in d._jdf.queryExecution().toString()
    got = {r["frame_id"]: r["descriptor"] for r in d.collect()}
    want = {f: [0.0] * 1200 for f in (1, 2)}
    for f, c, r, h in rows:
        if c * 20 + r < 1200 and h is not None:
            want[f][c * 20 + r] = h
    assert got == want
