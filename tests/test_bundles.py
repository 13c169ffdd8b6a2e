"""Groups worked on in bundles: same answers as the joins, without their rows."""

import functools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayloom.operators import bundles as B
from wayloom.operators import register as R
from wayloom.operators import spatial as S

AT = ("x", "y", "z")


def clouds(spark, seed=0):
    g = np.random.default_rng(seed)
    parts = []
    for p, n, wide in ((1, 300, 20.0), (2, 40, 60.0), (3, 500, 1.0), (4, 3, 500.0)):
        at = np.round(g.uniform(-wide, wide, (n, 3)) * 4) / 4  # on a raster: copies and ties
        parts.append(pd.DataFrame(at, columns=list(AT)).assign(pair_id=p))
    d = pd.concat(parts, ignore_index=True)
    d["id"] = np.arange(len(d))
    d.loc[[5, 6], "x"] = np.nan
    d = spark.createDataFrame(d).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return d.where("id % 3 = 0").drop("id"), d.where("id % 3 > 0")


def answers(d):
    return sorted(map(tuple, d.select("pair_id", *[(F.col(c) + 0.0).alias(c) for c in AT], "count", "ref_id", F.round("dist", 9), "rank").collect()), key=str)


@pytest.mark.parametrize("k, max_d", [(1, None), (5, None), (1, 2.0), (5, 2.0)])
def test_bundled_search_equals_joins(spark, monkeypatch, k, max_d):
    q, ref = clouds(spark)
    how = dict(q_at=AT, ref_at=AT, by=["pair_id"], base=0.5, levels=6, max_d=max_d, places=True)
    index = S.knn_index(ref, k, AT, "id", ["pair_id"], 0.5, 6, max_d)
    joined = answers(S.knn_join(q, None, k, index=index, **how))
    assert joined and answers(S.knn_join(q, ref, k, **how)) == joined
    monkeypatch.setattr(S, "bundles", functools.partial(B.bundles, most=100))  # two groups keep their joins
    assert answers(S.knn_join(q, ref, k, **how)) == joined


def test_fitness_sends_a_point_once(spark):
    """Every point went to 27 cells before, and to every level."""
    q, ref = clouds(spark)
    poses = ref.select("pair_id").distinct().select("pair_id", S.P.make(F.lit(0.25), F.lit(0.0), F.lit(0.0)).alias("pose"))
    out = S.fitness(q, ref.withColumnRenamed("id", "pt"), poses, 4.0)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 4


def rooms(spark, seed=1):
    """Two rooms seen from a shifted place; a third pair has no points."""
    g = np.random.default_rng(seed)
    n = 240
    u, v, side = g.uniform(-5, 5, n), g.uniform(-5, 5, n), np.arange(n) % 3
    d = pd.DataFrame({"x": np.where(side == 1, 5.0, u), "y": np.where(side == 2, -5.0, v), "z": np.where(side == 0, 0.0, g.uniform(0, 4, n))})
    tgt = pd.concat([d.assign(pair_id=p) for p in (1, 2)])
    src = tgt.assign(x=tgt.x - 0.2 * tgt.pair_id, y=tgt.y + 0.1)
    zero = S.P.make(F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("pose")
    pairs = spark.createDataFrame([(1,), (2,), (3,)], "pair_id long").select("pair_id", zero)
    cloud = lambda t: spark.createDataFrame(t).withColumn("intensity", (F.col("z") * 10).cast("int")).withColumn("kind", F.lit("plane"))
    return pairs, cloud(src), cloud(tgt)


def both_ways(monkeypatch, run, columns):
    """The result in bundles and by joins only."""
    out = []
    for most in (B.MOST, 0):
        monkeypatch.setattr(R, "bundles", functools.partial(B.bundles, most=most))
        d = run().toPandas().sort_values("pair_id").reset_index(drop=True)
        pose = np.array([[p[f] for f in S.P.FIELDS] for p in d["pose"]])
        out.append((pose, d[columns].astype(float).to_numpy(), list(d.columns)))
    (a, x, c), (b, y, e) = out
    assert sorted(c) == sorted(e) and len(a) == len(b)
    np.testing.assert_allclose(a, b, atol=1e-6)
    np.testing.assert_allclose(x, y, atol=1e-6, rtol=1e-5)
    return a


def rounds_shuffle_nothing(spark, run):
    """Jobs do not grow with the rounds."""
    jobs = []
    for iters in (2, 6):
        group = f"rounds-{id(run)}-{iters}"
        spark.sparkContext.setJobGroup(group, "test")
        run(iters).count()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_closest_points_in_bundles(spark, monkeypatch):
    pairs, src, tgt = rooms(spark)
    pose = both_ways(monkeypatch, lambda: R.register_icp(pairs, src, tgt, iters=6), ["fitness", "n_close"])
    assert len(pose) == 3
    monkeypatch.undo()
    rounds_shuffle_nothing(spark, lambda k: R.register_icp(pairs, src, tgt, iters=k, tol=0.0))


def test_features_in_bundles(spark, monkeypatch):
    pairs, src, tgt = rooms(spark)
    both_ways(monkeypatch, lambda: R.align_features(pairs, src, tgt, iters=4), ["lambda_min", "lambda_max", "converged", "degenerate"])
    monkeypatch.undo()
    rounds_shuffle_nothing(spark, lambda k: R.align_features(pairs, src, tgt, iters=k, tol=0.0))


def test_likelihood_in_bundles(spark, monkeypatch):
    pairs, src, tgt = rooms(spark)
    run = lambda k=5, tol=1e-4: R.register_ndt(pairs, src, tgt, size=3.0, iters=k, tol=tol)
    both_ways(monkeypatch, run, ["score", "n_points", "lambda_min", "lambda_max", "converged", "accepted"])
    monkeypatch.undo()
    rounds_shuffle_nothing(spark, lambda k: run(k, 0.0))


def test_loop_pairs_exchange_only_shared_buckets(spark):
    """Every pair was exchanged for the choice in its buckets; a frame alone in its bucket has no choice."""
    g = np.random.default_rng(2)
    d = pd.DataFrame({"id": np.arange(400), "trajectory_id": g.integers(0, 60, 400), "x": g.integers(0, 12, 400) / 4, "y": g.integers(0, 12, 400) / 4})
    kf = spark.createDataFrame(d).withColumn("pose", S.P.make("x", "y", F.lit(0.0)))
    out = S.loop_pairs(kf, 0.75, 100, 20)
    got = sorted(map(tuple, out.select("id_1", "id_2").collect()))
    best = {}
    for a in d.itertuples():
        for b in d[d["id"] > a.id].itertuples():
            sq = (a.x - b.x) ** 2 + (a.y - b.y) ** 2
            if sq < 0.75**2 and (a.trajectory_id != b.trajectory_id or b.id - a.id >= 100):
                k = (a.trajectory_id, b.trajectory_id, a.id // 20, b.id // 20)
                best[k] = min(best.get(k, (np.inf,)), (sq, a.id, b.id))
    assert got == sorted(v[1:] for v in best.values())
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()


def test_hypotheses_are_made_once(spark):
    ends = spark.createDataFrame([(0, i) for i in range(4)], "map_id long, id long")
    out = S.endpoint_grid(ends, ends, 2.0, 4.0, 45.0)
    assert out.count() == 6 * 4 * 4 * 8 == out.distinct().count()
    plan = out.select("rel")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Cross") < plan.index("SIN") or "sin" not in plan.lower()[:plan.lower().index("join cross")]
