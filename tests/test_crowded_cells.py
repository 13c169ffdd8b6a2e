"""Rows of a crowded cell are dealt over shares; no pair is lost or made twice."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wayloom.operators import spatial as S


def test_a_crowded_cell_is_dealt_out_and_keeps_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(S, "DEALT", 7)
    monkeypatch.setattr(S, "CROWDED", 50)
    r = np.random.default_rng(3)
    a, b = r.uniform(0, 4, (60, 2)).round(2), r.uniform(0, 4, (45, 2)).round(2)
    a[:30], b[:20] = 1.25, 1.5  # copies
    da = spark.createDataFrame(pd.DataFrame({"id": [*range(59), 58], "g": [1] * 50 + [2] * 10, "x": a[:, 0], "y": a[:, 1]}))
    db = spark.createDataFrame(pd.DataFrame({"id_2": range(45), "g": [1] * 40 + [2] * 5, "x_2": b[:, 0], "y_2": b[:, 1]}))
    da = da.withColumn("x", F.when(F.col("id") == 3, None).otherwise(F.col("x")))
    key = lambda d: sorted((x.id, x.id_2, round(x.dist, 9)) for x in d.collect())
    want = key(da.withColumnRenamed("g", "h").join(db, (F.col("h") == F.col("g")) & (F.hypot(F.col("x") - F.col("x_2"), F.col("y") - F.col("y_2")) <= 1)).withColumn(
        "dist", F.hypot(F.col("x") - F.col("x_2"), F.col("y") - F.col("y_2"))))
    plain, dealt = (S.radius_join(da, db, 1.0, by=["g"], deal=deal) for deal in (False, True))
    assert key(dealt) == want and dealt.columns == plain.columns and len(want) > 500
    left, right, shares = S._dealt(*[d.select("g", F.floor(x).alias("_c"), i) for d, x, i in ((da, "x", "id"), (db, "x_2", "id_2"))], ["g", "_c"])
    assert shares and all(d.groupBy("g", "_c", *shares).count().agg(F.max("count")).first()[0] <= 21 for d in (left, right))


def test_copies_of_a_crowded_cell_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "DEALT", 5)
    monkeypatch.setattr(S, "CROWDED", 50)
    for n, m in ((600, 600), (900, 60)):
        left, right = spark.range(n).select(F.lit(0).alias("_c"), "id"), spark.range(m).select(F.lit(0).alias("_c"), F.col("id").alias("id_2"))
        a, b, shares = S._dealt(left, right, ["_c"])
        assert shares and a.count() + b.count() <= 4 * (n + m)
        assert a.join(b, ["_c", *shares]).select("id", "id_2").distinct().count() == a.join(b, ["_c", *shares]).count() == n * m
