"""Nearest-neighbour and radius joins against brute force: copies, crowds, far outliers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayloom.operators import spatial as S


@pytest.fixture(scope="module")
def clouds():
    rng = random.Random(11)
    ref = [(i, rng.gauss(0, 0.05), rng.gauss(0, 0.05)) for i in range(60)]          # a crowd
    ref += [(100 + i, 2.0, 2.0) for i in range(30)]                                    # copies of one place
    ref += [(200 + i, rng.uniform(-40, 40), rng.uniform(-40, 40)) for i in range(40)]  # thin field
    q = [(i, rng.uniform(-45, 45), rng.uniform(-45, 45)) for i in range(40)]
    q += [(100, 2.0, 2.0), (101, 2.0, 2.0), (102, 0.0, 0.0), (103, 5000.0, -9000.0)]
    return q, ref


@pytest.mark.parametrize("k", [1, 4, 45, 500])
@pytest.mark.parametrize("levels", [2, 7])
def test_knn_is_exact(spark, clouds, k, levels):
    q, ref = clouds
    dq, dr = (spark.createDataFrame(x, "id long, x double, y double") for x in clouds)
    got = {}
    for r in S.knn_join(dq, dr, k, base=0.25, levels=levels).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["ref_id"]))
    for i, x, y in q:
        want = [j for _, j in sorted(((x - a) * (x - a) + (y - b) * (y - b), j) for j, a, b in ref)[:k]]
        assert [j for _, j in sorted(got[i])] == want


def test_knn_bounded(spark, clouds):
    q, ref = clouds
    dq, dr = (spark.createDataFrame(x, "id long, x double, y double") for x in clouds)
    got = {r["id"]: r["ref_id"] for r in S.knn_join(dq, dr, 1, base=0.25, max_d=3.0).collect()}
    for i, x, y in q:
        d, j = min(((x - a) * (x - a) + (y - b) * (y - b), j) for j, a, b in ref)
        assert got.get(i) == (j if d <= 9.0 else None)


@pytest.mark.parametrize("strict", [True, False])
def test_radius(spark, clouds, strict):
    q, ref = clouds
    dq = spark.createDataFrame(q, "id long, x double, y double")
    dr = spark.createDataFrame(ref, "rid long, x_2 double, y_2 double")
    got = {(r["id"], r["rid"]) for r in S.radius_join(dq, dr, 2.5, strict=strict).collect()}
    want = {(i, j) for i, x, y in q for j, a, b in ref if (math.hypot(x - a, y - b) < 2.5 if strict else math.hypot(x - a, y - b) <= 2.5)}
    assert got == want


def test_level_rule(spark):
    f = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 5.0), (3, 90.0, 0.0, 5.0)], "id long, x double, y double, z double")
    m = spark.createDataFrame([(0.5, 0.0, 0.0)], "x double, y double, z double")
    assert {r["id"] for r in S.same_level(f, m, 10.0, 4.0).collect()} == {1, 3}
    assert {r["id"] for r in S.level_conflicts(f, m, 10.0, 4.0).collect()} == {2}


def test_endpoint_grid_size(spark):
    e = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 9)], "map_id int, id long")
    assert S.endpoint_grid(e, e, 1.0, 3.0, 15.0).count() == 3 * 6 * 6 * 24
    assert S.endpoint_grid(e, e, 1.0, 3.0, 15.0).filter(F.col("id_1") >= F.col("id_2")).count() == 0
