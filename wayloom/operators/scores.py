"""From registration scores along a route to threshold segments and tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.functions import geodesy as G
from wayloom.operators.ordered import SLICE, blocked, carried, near, running, runs, tidy
from wayloom.operators.sequence import TRAJ, step_distance
from wayloom.operators.spatial import radius_join
from wayloom.session import cut

# Score bucket range and step, and the segment length rule in metres.
LOW, HIGH, STEP = 1.8, 4.2, 0.3
SHORT_END, SHORT_INNER = 8.0, 12.0


def threshold_index(score) -> Column:
    """Bucket 1 below 1.8, then one per 0.3 up to 10 at 4.2 and above."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s < LOW, 1).when(s >= HIGH, int((HIGH - LOW) / STEP + 2))
            .otherwise(F.floor((s - LOW) / STEP + 2))).cast("int")


def suggest_threshold(bucket) -> Column:
    """Score threshold suggested for a bucket."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    mid = LOW + (b - 1.5) * STEP
    less = mid - 0.6
    high = F.when((less >= 2.7) & (less < 3.2), 2.7).when(less <= 2.2, 2.2).otherwise(less)
    return F.when(mid >= 2.7, high).when(mid >= 2.5, 2.2).when(mid >= 2.2, 1.9).otherwise(mid - 0.3)


def bucket_runs(df: DataFrame, by: Sequence[str] = TRAJ, order: Sequence[str] = ("t",), bucket: str = "bucket",
                width: float = SLICE) -> DataFrame:
    """Rows with their step length and the number ``run_id`` of their equal-bucket run."""
    d = step_distance(df, by, order, width, keep_blocks=True)
    return runs(d, by, F.col(bucket))


def segments(df: DataFrame, by: Sequence[str] = TRAJ, order: Sequence[str] = ("t",), bucket: str = "bucket",
             width: float = SLICE) -> DataFrame:
    """Equal-bucket runs: first and last row number, bucket, summed step length.

    As in the original, a run's length leaves out its last row, and the open run
    at the end of the route is not ``closed``.
    """
    return _segments_of(bucket_runs(df, by, order, bucket, width), by, bucket)


def _segments_of(rows: DataFrame, by: Sequence[str], bucket: str = "bucket") -> DataFrame:
    g = rows.groupBy(*by, "run_id").agg(
        F.min("_rn").alias("first_rn"), F.max("_rn").alias("last_rn"), F.first(bucket).alias("bucket"),
        F.sum("step").alias("_all"), F.max_by("step", "_rn").alias("_end"))
    g = cut(g)  # one row per run: cheap to keep, dear to compute twice
    last = g.groupBy(*by).agg(F.max("run_id").alias("_last"))
    g = g.join(last, list(by))
    return g.select(*by, "run_id", "first_rn", "last_rn", "bucket",
                    F.when(F.col("first_rn") == F.col("last_rn"), F.lit(0.0)).otherwise(F.col("_all") - F.col("_end"))
                    .alias("dist"), (F.col("run_id") < F.col("_last")).alias("closed"))


def merge_short(segs: DataFrame, by: Sequence[str] = TRAJ) -> DataFrame:
    """New bucket per segment: short ones take the lower neighbour, short ends their neighbour.

    Neighbours are the closed segments; the open tail follows the last closed
    segment when that one is short.
    """
    d = segs.withColumn("_at", F.col("run_id").cast("double"))
    d = blocked(d, by, ["_at"], 100_000.0)
    d = near(d, by, 2, 2, {
        "_p1": lambda w: F.lag("bucket", 1).over(w), "_p2": lambda w: F.lag("bucket", 2).over(w),
        "_pd": lambda w: F.lag("dist", 1).over(w),
        "_n1": lambda w: F.when(F.lead("closed", 1).over(w), F.lead("bucket", 1).over(w))})
    first, closed = F.col("run_id") == 1, F.col("closed")
    several = ~(first & F.col("_n1").isNull())
    new = (F.when(closed & first & several & (F.col("dist") < SHORT_END), F.col("_n1"))
           .when(closed & ~first & F.col("_n1").isNotNull() & (F.col("dist") < SHORT_INNER),
                 F.least("_p1", "_n1"))
           .when(closed & ~first & F.col("_n1").isNull() & (F.col("dist") < SHORT_END), F.col("_p1"))
           .when(~closed & F.col("_p2").isNotNull() & (F.col("_pd") < SHORT_END), F.col("_p2"))
           .otherwise(F.col("bucket")))
    return cut(tidy(d.withColumn("merged", new)).drop("_p1", "_p2", "_pd", "_n1", "_at"))


HEAD_ROWS, HEAD_RISE, TAIL_RISE = 5, 10, 5  # fixed values of the second merge


def merge_between_long(segs: DataFrame, by: Sequence[str] = TRAJ, long: float = SHORT_END) -> DataFrame:
    """Segments between two long ones take the lower of their buckets.

    Before the first long segment: its bucket if they end within the first five
    rows; else the lowest bucket of a segment over 0.5 long that rises by more
    than 10 from the one before, else the lowest bucket; the very first segment is
    left out of both.  After the last long segment likewise, with a rise of more
    than 5 and no exception for few rows.  Without a candidate, and for keys
    without a long segment, buckets stay.
    """
    d = segs.withColumn("_at", F.col("run_id").cast("double"))
    is_long = F.col("closed") & (F.col("dist") > long)
    ahead = blocked(d.withColumn("_neg", -F.col("_at")), by, ["_neg"], 100_000.0)
    ahead = tidy(carried(ahead, by, {"_next": F.when(is_long, F.col("bucket"))})).drop("_neg")
    back = blocked(cut(ahead), by, ["_at"], 100_000.0)
    back = near(back, by, 1, 0, {"_before": lambda w: F.lag("bucket", 1).over(w)})
    d = cut(tidy(carried(back, by, {"_prev": F.when(is_long, F.col("bucket"))})))
    head = F.col("_prev").isNull() & F.col("_next").isNotNull()
    tail = F.col("_next").isNull() & F.col("_prev").isNotNull()
    rise = F.col("bucket") - F.col("_before")
    inner = head & F.col("_before").isNotNull()
    last = tail & F.col("closed") & ~is_long
    ends = d.groupBy(*by).agg(
        F.when(F.max(F.when(head, F.col("last_rn"))) <= HEAD_ROWS, F.min(F.when(head, F.col("_next")))).otherwise(F.coalesce(
            F.min(F.when(inner & (F.col("dist") > 0.5) & (rise > HEAD_RISE), F.col("bucket"))),
            F.min(F.when(inner, F.col("bucket"))))).alias("_head"),
        F.coalesce(F.min(F.when(last & (F.col("dist") > 0.5) & (rise > TAIL_RISE), F.col("bucket"))),
                   F.min(F.when(last, F.col("bucket")))).alias("_tail"))
    d = d.join(ends, list(by))
    new = (F.when(is_long, F.col("bucket")).when(head, F.coalesce("_head", "bucket"))
           .when(tail, F.coalesce("_tail", "bucket"))
           .when(F.col("_prev").isNotNull(), F.least("_prev", "_next")).otherwise(F.col("bucket")))
    return d.withColumn("merged", new).drop("_at", "_next", "_prev", "_before", "_head", "_tail")


def cap_to_dominant(segs: DataFrame, by: Sequence[str] = TRAJ, bucket: str = "bucket") -> DataFrame:
    """No bucket above that of the longest closed segment (the earliest one on a tie)."""
    closed = F.when(F.col("closed") & (F.col("dist") > 0), F.struct(F.col("dist"), -F.col("run_id")))
    top = segs.groupBy(*by).agg(F.max_by(bucket, closed).alias("_top"))
    d = segs.join(top, list(by))
    return d.withColumn("capped", F.when(F.col("_top").isNull(), F.col(bucket))
                        .otherwise(F.least(F.col(bucket), F.col("_top")))).drop("_top")


def spatial_min(df: DataFrame, r: float = 15.0, bucket: str = "bucket", by: Sequence[str] = ()) -> DataFrame:
    """Smallest bucket within ``r`` of every row.

    Rows at one place are folded to their minimum first, so only distinct places
    are paired.
    """
    places = df.groupBy(*by, "x", "y").agg(F.min(bucket).alias("_b"))
    other = places.select(*by, F.col("x").alias("x_2"), F.col("y").alias("y_2"), F.col("_b").alias("_b2"))
    pairs = radius_join(places.drop("_b"), other, r, by=by, strict=True)
    low = pairs.groupBy(*by, "x", "y").agg(F.min("_b2").alias("spatial_min"))
    return df.join(low, [*by, "x", "y"])


def score_buckets(df: DataFrame, by: Sequence[str] = TRAJ, order: Sequence[str] = ("t",), bucket: str = "bucket",
                  width: float = SLICE) -> DataFrame:
    """Rows with the final bucket after merging short segments and capping.

    The cap looks at buckets before merging: a segment that was above the longest
    one takes that one's bucket, others keep what merging gave them.  The open tail
    goes with the last closed segment.
    """
    rows = cut(bucket_runs(df, by, order, bucket, width))
    segs = merge_short(_segments_of(rows, by, bucket), by)
    closed = F.when(F.col("closed") & (F.col("dist") > 0), F.struct(F.col("dist"), -F.col("run_id")))
    top = segs.groupBy(*by).agg(F.max_by("bucket", closed).alias("_top"),
                                F.max_by("bucket", F.when(F.col("closed"), F.col("run_id"))).alias("_last"))
    d = segs.join(top, list(by))
    own = F.when(F.col("closed"), F.col("bucket")).otherwise(F.coalesce("_last", "bucket"))
    d = d.withColumn("capped", F.when(own > F.col("_top"), F.col("_top")).otherwise(F.col("merged")))
    out = rows.join(d.select(*by, "run_id", "capped"), [*by, "run_id"])
    return tidy(out).drop("run_id", "step")


def build_tracks(keyframes: DataFrame, segs: DataFrame, zone: int, south: bool, origin: tuple[float, float],
                 by: Sequence[str] = TRAJ, eps: float = 0.001, width: float = 1_000_000.0) -> DataFrame:
    """Validation frames with lon/lat and the threshold of the score segment they are on.

    ``segs`` gives, per key, ``seg`` (1, 2, …), its end point and ``threshold``.
    The segment number grows by one at every frame within √eps m of a segment
    end, and stays at the last segment.
    """
    d = blocked(keyframes, by, ["id"], width)
    ends = segs.select(*by, F.col("end_x").alias("x_2"), F.col("end_y").alias("y_2"))
    reach = eps ** 0.5
    hit = radius_join(keyframes.select(*by, "id", "x", "y"), ends, max(reach, 1.0), by=by, how="left_semi",
                      where=((F.col("x") - F.col("x_2")) * (F.col("x") - F.col("x_2"))
                             + (F.col("y") - F.col("y_2")) * (F.col("y") - F.col("y_2"))) < eps)
    d = d.join(hit.select(*by, "id", F.lit(1).alias("_hit")), [*by, "id"], "left")
    d = running(d, by, {"_passed": F.coalesce("_hit", F.lit(0)).cast("long")})
    count = segs.groupBy(*by).agg(F.max("seg").alias("_segs"))
    d = d.join(count, list(by)).withColumn("seg", F.least(F.col("_passed") + 1, F.col("_segs")))
    d = d.join(segs.select(*by, "seg", "threshold"), [*by, "seg"])
    d = G.add_lonlat(d, F.col("x") + origin[0], F.col("y") + origin[1], F.lit(zone), F.lit(south))
    return d.select(*by, "id", "lon", "lat", "z", "threshold")
