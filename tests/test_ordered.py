"""Blocked windows against plain ones, with a key that holds most rows and tiny blocks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators import asof as A
from wayloom.operators import ordered as O
from wayloom.operators import sequence as Q


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data, i = [], 0
    for key, n in ((1, 300), (2, 7), (3, 1), (4, 60)):
        t = 0.0
        for _ in range(n):
            t += rng.choice([0.5, 1.0, 40.0])
            data.append((key, i, t, float(rng.randint(-8, 8)) / 4, rng.random() < 0.3))
            i += 1
    rng.shuffle(data)
    return spark.createDataFrame(data, "k long, id long, t double, v double, gap boolean").cache()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def plain():
    return Window.partitionBy("k").orderBy("t")


@pytest.mark.parametrize("block", [3, 16, 1000])
def test_near_running_carried(rows, block):
    W = plain()
    b = O.blocked(rows, ["k"], ["t"], 30.0, block)
    n = O.near(b, ["k"], 2, 2, {"s": lambda w: F.sum("v").over(w.rowsBetween(-2, 2)), "p": lambda w: F.lag("id", 2).over(w)}, block)
    want = rows.select("k", "id", F.row_number().over(W).alias("_rn"), F.sum("v").over(W.rowsBetween(-2, 2)).alias("s"), F.lag("id", 2).over(W).alias("p"))
    same(n.select("k", "id", "_rn", "s", "p"), want)
    run = W.rowsBetween(Window.unboundedPreceding, 0)
    r = O.running(b, ["k"], {"c": F.col("v")})
    same(r.select("id", "c"), rows.select("id", F.sum("v").over(run).alias("c")))
    last = F.when(~F.col("gap"), F.col("id"))
    c = O.carried(b, ["k"], {"c": last})
    same(c.select("id", "c"), rows.select("id", F.last(last, True).over(run).alias("c")))


def test_runs(rows):
    W = plain()
    b = O.runs(O.blocked(rows, ["k"], ["t"], 30.0, 4), ["k"], F.col("gap"), block=4)
    got = b.groupBy("k", "run_id").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("g"), F.max("gap").alias("h"))
    assert got.filter("g != h").count() == 0
    assert got.agg(F.sum("n")).first()[0] == rows.count()
    flips = rows.select("k", (F.lag("gap").over(W).isNull() | (F.lag("gap").over(W) != F.col("gap"))).cast("int").alias("f"))
    assert got.count() == flips.agg(F.sum("f")).first()[0]


def test_order_statistics(spark):
    rng = random.Random(3)
    data = [(1, float(rng.choice([0.0, 0.0, -2.5, 7.25, rng.uniform(-50, 900)]))) for _ in range(501)] + [(2, 4.0)] * 9
    d = spark.createDataFrame(data, "k int, v double")
    got = {r["k"]: r for r in O.order_statistics(d, ["k"], "v", {"a": lambda n: F.floor(n * 0.1), "m": lambda n: F.floor(n / 2), "z": lambda n: n - 1}).collect()}
    for k in (1, 2):
        s = sorted(v for i, v in data if i == k)
        assert (got[k]["a"], got[k]["m"], got[k]["z"]) == (s[int(len(s) * 0.1)], s[len(s) // 2], s[-1])


@pytest.mark.parametrize("block", [3, 10, 500])
def test_keyframes_do_not_depend_on_blocks(spark, rows, block):
    """The block fold equals the plain sequential rule for any block length."""
    d = rows.withColumn("pose", P.make("v", F.col("v") * 2, F.lit(0.0)))
    got = {r["id"] for r in Q.extract_keyframes(d, 2.0, 5.0, 100.0, ["k"], "t", width=30.0, block=block).collect()}
    want, last = set(), {}
    for r in sorted(rows.collect(), key=lambda r: (r["k"], r["t"])):
        p = last.get(r["k"])
        far = p is None or ((r["v"] - p["v"]) ** 2 * 5) ** 0.5 > 2.0 or abs(r["t"] - p["t"]) > 100
        if far:
            want.add(r["id"])
            last[r["k"]] = r
    assert got == want


def test_asof_edges(spark):
    s = spark.createDataFrame([(1, 10.0, 0.0), (1, 20.0, 10.0), (1, 30.0, 0.0)], "k int, t double, x double").withColumn("pose", P.make("x", F.lit(0.0), F.lit(0.0)))
    q = spark.createDataFrame([(1, 5.0), (1, 10.0), (1, 14.0), (1, 20.0), (1, 30.0), (1, 31.0), (2, 10.0)], "k int, t double")
    got = {(r["k"], r["t"]): r["pose"] and r["pose"]["x"] for r in A.asof_interpolate(q, s, ["k"], width=7.0).collect()}
    assert got == {(1, 5.0): None, (1, 10.0): 0.0, (1, 14.0): 4.0, (1, 20.0): 10.0, (1, 30.0): 0.0, (1, 31.0): None, (2, 10.0): None}
    ex = {r["t"]: r["pose"]["x"] for r in A.asof_interpolate(q.filter("t = 5"), s, ["k"], width=7.0, extrapolate=True).collect()}
    assert ex == {5.0: -5.0}
    back = {r["t"]: r["s_x"] for r in A.asof_backward(q.filter("k = 1"), s.drop("pose"), ["k"], width=7.0).collect()}
    assert back == {5.0: None, 10.0: 0.0, 14.0: 0.0, 20.0: 10.0, 30.0: 0.0, 31.0: 0.0}
    near = {r["t"]: r["s_t"] for r in A.asof_nearest(q.filter("k = 1"), s.drop("pose"), ["k"], tol=4.5, width=7.0).collect()}
    assert near == {5.0: None, 10.0: 10.0, 14.0: 10.0, 20.0: 20.0, 30.0: 30.0, 31.0: 30.0}


def test_trimmed_mean_keeps_equal_values(spark):
    """One minimum and one maximum go, even among equal values."""
    d = spark.createDataFrame([(1, float(i), v) for i, v in enumerate([1.0, 1.0, 1.0, 5.0, 5.0, 9.0, 9.0, 2.0, 2.0])], "k int, t double, v double")
    got = [r["smooth"] for r in Q.trimmed_mean(d, "v", ["k"], ["t"]).orderBy("t").collect()]
    mid3, mid4, mid5 = (1 + 1 + 5 + 5 + 9) / 5, (1 + 1 + 5 + 5 + 9 + 9 + 2 - 1 - 9) / 5, (1 + 5 + 5 + 9 + 9 + 2 + 2 - 1 - 9) / 5
    assert got == pytest.approx([mid3, mid4, mid4, mid4, mid4, mid5, mid5, mid5, mid5])
