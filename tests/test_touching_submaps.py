"""Seeds touch by any of their frames, and many seeds may want one target."""

import numpy as np
from pyspark.sql import functions as F

from wayloom.operators import submaps


def test_maps_touch_by_any_frame_of_a_cell(spark):
    # the first frame of the first map's cell is out of reach of the other map, the second one is not
    rows = [(0, 0, 0.0, 0.0, 0.0), (0, 1, 9.9, 0.0, 0.0), (1, 100, 19.0, 0.0, 0.0), (2, 200, 45.0, 0.0, 0.0)]
    d = spark.createDataFrame(rows, "trajectory_id long, id long, x double, y double, z double")
    got = {r.id: r.map_id for r in submaps.split_submaps(d, 10, 50.0, 10.0, 4.0).collect()}
    assert got == {0: 0, 1: 0, 100: 0, 200: 200}


def test_lowest_map_near_any_frame(spark, monkeypatch):
    monkeypatch.setattr(submaps, "SHARE", 20)
    g = np.random.default_rng(8)
    rows = [(int(g.integers(0, 60)), *map(float, g.uniform(-8, 8, 2).round(1)), float(g.uniform(0, 2).__round__(1))) for _ in range(500)]
    near = lambda a, b: (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 4 and abs(a[3] - b[3]) < 0.5
    want = {}
    for a in rows:
        low = min(b[0] for b in rows if near(a, b))
        if low < a[0]:
            want[a[0]] = min(low, want.get(a[0], low))
    d = spark.createDataFrame([*rows, *rows[:9], (70, None, 0.0, 0.0)], "map_id long, x double, y double, z double")
    for takes in ((1, 2), (3, 2000)):
        assert {r["map_id"]: r["_to"] for r in submaps._lowest_near(d, 2.0, 0.5, takes).collect()} == want


def test_a_target_takes_the_lowest_that_fit(spark):
    d = spark.range(9).select(F.col("id").alias("trajectory_id"), "id", *[F.lit(0.0).alias(c) for c in "xyz"])
    got = {r.id: r.map_id for r in submaps.split_submaps(d, 4, 50.0, 5.0, 4.0, rounds=1).collect()}
    assert got == {i: 0 if i < 4 else i for i in range(9)}
