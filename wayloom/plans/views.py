"""The given tables seen as trajectories, points, fixes and messages.

Each view comes twice: as a DataFrame and as the SQL the check runs.
Coordinates are eighths and quarters, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.operators.ordered import running_by_slice

WIDTH = 864_000.0  # ten days: events of one user are about eleven hours apart


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("frame_id"),
        ((F.col("l_partkey") % 400) / 8.0 - 25.0).alias("x"),
        ((F.col("l_orderkey") % 400) / 8.0 - 25.0).alias("y"),
        (F.col("l_quantity") / 8.0 - 1.0).alias("z"),
        F.round(F.col("l_discount") * 1000).cast("int").alias("intensity"),
        F.col("l_linenumber").alias("ring"))


POINTS = """points AS (
  SELECT l_suppkey AS frame_id, (l_partkey % 400) / 8e0 - 25e0 AS x, (l_orderkey % 400) / 8e0 - 25e0 AS y,
         l_quantity / 8e0 - 1e0 AS z, CAST(round(l_discount * 1000) AS INT) AS intensity, l_linenumber AS ring
  FROM lineitem)"""


def steps(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("trajectory_id"), F.col("event_id").alias("id"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"), "event_type", "value", k.alias("k"),
        ((F.col("event_id") % 9 - 4) / 4.0).alias("dx"), ((k % 9 - 4) / 4.0).alias("dy"))


def poses(spark: SparkSession, sf: str) -> DataFrame:
    d = running_by_slice(steps(spark, sf), ["trajectory_id"], ["t", "id"],
                         {"x": F.col("dx"), "y": F.col("dy")}, WIDTH)
    return d.withColumn("z", F.col("value") / 100.0)


POSES = """steps AS (
  SELECT user_id AS trajectory_id, event_id AS id, epoch_us(ts) / 1e6 AS t, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         (event_id % 9 - 4) / 4e0 AS dx, (CAST(json_extract_string(props, '$.k') AS INT) % 9 - 4) / 4e0 AS dy
  FROM events),
poses AS (
  SELECT *, sum(dx) OVER w AS x, sum(dy) OVER w AS y, value / 100e0 AS z
  FROM steps WINDOW w AS (PARTITION BY trajectory_id ORDER BY t, id ROWS UNBOUNDED PRECEDING))"""

YAW_OF_K = "radians(k * 0.9e0)"


def posed(spark: SparkSession, sf: str) -> DataFrame:
    """Poses with a ``pose`` column; yaw comes from ``k``."""
    return poses(spark, sf).withColumn("pose", P.from_yaw("x", "y", "z", F.radians(F.col("k") * 0.9)))


def fixes(spark: SparkSession, sf: str, with_path: bool = True) -> DataFrame:
    d = poses(spark, sf) if with_path else steps(spark, sf)
    e = F.col("event_type")
    d = (d.withColumn("status", F.when(e == "purchase", 4).when(e == "view", 5).when(e == "signup", 2)
                      .when(e == "click", 1).otherwise(0))
         .withColumn("heading_valid", F.col("k") % 2 == 1).withColumn("heading", F.col("k") * 3.6))
    if with_path:
        d = (d.withColumn("lon", 116.0 + F.col("x") / 1000).withColumn("lat", 40.0 + F.col("y") / 1000)
             .withColumn("height", F.col("z")))
    return d


FIXES = POSES + """,
fixes AS (
  SELECT *, CASE event_type WHEN 'purchase' THEN 4 WHEN 'view' THEN 5 WHEN 'signup' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS status,
         k % 2 = 1 AS heading_valid, k * 3.6e0 AS heading, 116e0 + x / 1000e0 AS lon, 40e0 + y / 1000e0 AS lat, z AS height
  FROM poses)"""


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return poses(spark, sf).withColumn("score", 1.5 + (F.col("k") % 32) / 10.0)


SCORES = POSES + """,
scores AS (SELECT *, 1.5e0 + (k % 32) / 10e0 AS score FROM poses)"""


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and order lines as one log: ``topic, t, v``."""
    o = table(spark, sf, "orders").select(
        F.lit("/orders/raw").alias("topic"), (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1e6).alias("t"),
        F.col("o_totalprice").alias("v"))
    li = table(spark, sf, "lineitem").select(
        F.lit("/lines/raw").alias("topic"), (F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1e6).alias("t"),
        F.col("l_extendedprice").alias("v"))
    return o.unionByName(li)


def r6(c):
    """Round to six decimals, without negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)
