"""Feature picks and streams by key: bounded work per group, same rows as the plain way."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wayloom.operators import scans
from wayloom.streaming import streams as ST


def plain_picks(rows):
    """Labels of one ring, every pick searched anew; rows are (seq, col, curvature, occluded, ground)."""
    n, label = len(rows), ["less_flat"] * len(rows)
    taken = [bool(r[3]) for r in rows]
    cur = [r[2] or 0.0 for r in rows]

    def silence(i):
        taken[i] = True
        for step in (1, -1):
            for m in range(1, 6):
                j = i + step * m
                if j < 0 or j >= n or abs(rows[j][1] - rows[j - step][1]) > 10:
                    break
                taken[j] = True

    for s in range(6):
        sp, ep = (4 * (6 - s) + (n - 6) * s) // 6, (4 * (5 - s) + (n - 6) * (s + 1)) // 6 - 1
        if sp >= ep:
            continue
        rank = sorted(range(sp, ep), key=lambda i: cur[i]) + [ep]
        for order, ground, most in ((rank[::-1], False, 20), (rank, True, 4)):
            for k in range(1, most + 1):
                fits = lambda i: rows[i][2] is not None and bool(rows[i][4]) == ground and (cur[i] < 0.1 if ground else cur[i] > 0.1)
                i = next((i for i in order if fits(i) and not taken[i]), None)
                if i is None:
                    break
                label[i] = "flat" if ground else "sharp" if k <= 2 else "less_sharp"
                silence(i)
    return label


def test_features_of_a_sweep_in_one_group(spark):
    g = np.random.default_rng(8)
    rows, want = [], {}
    for frame in (1, 2, None):
        for ring in (0, 3, None):
            cols = np.sort(g.choice(400, int(g.integers(5, 150)), replace=False))
            ring_rows = [(int(c) + 1800 * (ring or 0), int(c), float(g.choice([0.05, 0.1, g.uniform(0, 1)])) if g.random() > 0.1 else None,
                          bool(g.random() < 0.1), bool(g.random() < 0.4) if g.random() > 0.05 else None) for c in cols]
            rows += [(frame, ring, *r) for r in ring_rows]
            want |= {(frame, ring, r[0]): x for r, x in zip(ring_rows, plain_picks(ring_rows))}
    d = spark.createDataFrame(rows, "frame_id long, ring int, seq long, col long, curvature double, occluded boolean, ground boolean").orderBy(F.rand(1))
    got = scans.select_features(d)
    assert {(r["frame_id"], r["ring"], r["seq"]): r["feature"] for r in got.collect()} == want
    assert {"sharp", "less_sharp", "flat"} <= set(want.values())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" in plan and "InPandas" not in plan  # a group is a sweep, not a ring


def test_waiting_rows_come_back_in_bounded_parts(monkeypatch):
    """In time order, equal times as they came, over several marks; a part is some RUN rows, not the whole wait."""
    for name, rows in (("RUN", 500), ("CHUNK", 40), ("SMALL", 16)):
        monkeypatch.setattr(ST, name, rows)
    g = np.random.default_rng(3)
    t = np.sort(g.integers(0, 4000, 6000)) / 4.0  # many equal times
    t = t[np.argsort(np.arange(6000) + g.integers(0, 700, 6000), kind="stable")]
    t[::997] = np.nan
    d = pd.DataFrame({"t": t, "id": np.arange(6000), "v": np.where(g.random(6000) < 0.5, np.nan, g.random(6000)), "s": [str(i) for i in range(6000)]})
    pieces = [*ST._pieces(iter([d[:2500], d[2500:2510]]), ["t", "id", "v", "s"])]
    got, sizes = [], []
    for mark in (0, 250_000, 700_125, 10_000_000):
        for cols in ST._due(pieces, mark):
            assert (np.floor(cols[0] * 1000) <= mark).all()
            got.append(pd.DataFrame(dict(zip(d.columns, cols))))
            sizes.append(len(cols[0]))
        pieces = [p for p in pieces if p is not None]
        if mark == 0:
            pieces += ST._pieces(iter([d[2510:]]), ["t", "id", "v", "s"])
    want = d[d["t"].notna()].sort_values("t", kind="stable").reset_index(drop=True)
    pd.testing.assert_frame_equal(pd.concat(got).reset_index(drop=True), want, check_dtype=False)
    assert not pieces and max(sizes) < 2000


def frames(spark, path, triggers):
    for i, rows in enumerate(triggers):
        spark.createDataFrame(rows, "vehicle_id long, s long, frame_id long, v double").coalesce(1).write.parquet(f"{path}/{i}")
    names = "vehicle_id long, s long, frame_id long, v double"
    d = spark.readStream.schema(names).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    d = d.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)).withWatermark("ts", "0 seconds")
    return d.withColumn("t", F.unix_micros("ts") / 1e6)


def test_vehicles_of_one_state_group_stay_apart(spark, tmp_path):
    """More vehicles than state groups, one of them null: frames are numbered by vehicle, state is kept by group."""
    many = ST.BUCKETS + 300
    trigger = lambda a: [(v, s, 10 * (v or 0) + s, 0.0) for v in [None, *range(many)] for s in range(a, a + 3)]
    d = frames(spark, str(tmp_path / "in"), [trigger(0), trigger(3)])
    d = d.select("vehicle_id", "t", "ts", "frame_id", F.col("s").cast("double").alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("yaw"))
    out = ST.stream_submaps(d, size=4)
    q = out.writeStream.format("memory").queryName("submaps_of_many").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]) <= ST.BUCKETS + 1
    got = {(r["vehicle_id"], r["t"] - 1_700_000_000): (r["submap_no"], r["local_x"]) for r in spark.table("submaps_of_many").collect()}
    assert got == {(v, float(s)): (s // 4, float(s % 4)) for v in [None, *range(many)] for s in range(6)}


def test_motion_of_a_trigger(spark, tmp_path):
    """Poses, and what a trigger adds up (moved along the attitude before each turn), against a plain fold."""
    rows = [(1, s, s, 2.0 if s % 5 == 4 else None) for s in range(700)]
    d = frames(spark, str(tmp_path / "in"), [rows])
    s = d.select("vehicle_id", "t", "ts", F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"), ((F.col("frame_id") % 7) / 10.0).alias("wz"), "v")
    got = ST.drain(ST.stream_preintegrate(s)).orderBy("t").toPandas()
    wz = [(s % 7) / 10 for s, v in [(r[1], r[3]) for r in rows] if v is None]
    bias, yaw, x, y, dx, dy = np.mean(wz[:201]), 0.0, 0.0, 0.0, 0.0, 0.0
    want = []
    for a, b in zip(wz[200:], wz[201:]):
        dx, dy = dx + 2 * ST.STEP * np.cos(yaw), dy + 2 * ST.STEP * np.sin(yaw)
        yaw += (0.5 * (a + b) - bias) * ST.STEP
        x, y = x + 2 * ST.STEP * np.cos(yaw), y + 2 * ST.STEP * np.sin(yaw)
        want.append((x, y, np.sin(yaw / 2), dx, dy, np.sin(yaw / 2)))
    assert len(got) == len(want) == len(wz) - 201
    assert np.allclose(got[["x", "y", "qz", "dx", "dy", "dqz"]], want, atol=1e-9)
