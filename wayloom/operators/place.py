"""Place descriptors, and marks, images and messages put on a trajectory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.functions import geodesy as G
from wayloom.functions import pose as P
from wayloom.functions.cells import polar_bin
from wayloom.operators.asof import asof_interpolate
from wayloom.operators.ordered import SLICE
from wayloom.operators.sequence import TRAJ, number_marks

SECTORS, RINGS = 60, 20


def place_descriptor(points: DataFrame) -> DataFrame:
    """Greatest ``z + 10`` per frame and polar bin, long form; empty bins are absent (zero)."""
    d = points.select("frame_id", polar_bin("x", "y").alias("_b"), (F.col("z") + 10).alias("h"))
    d = d.filter((F.col("h") > 0) & (F.col("h") < 100) & (F.col("_b.col") < SECTORS) & (F.col("_b.row") < RINGS))
    return d.groupBy("frame_id", F.col("_b.col").alias("col"), F.col("_b.row").alias("row")).agg(F.max("h").alias("h"))


def descriptor_arrays(long: DataFrame) -> DataFrame:
    """One 1200-element array per frame (at most one row per bin goes in)."""
    n = SECTORS * RINGS
    at = (F.col("col") * RINGS + F.col("row")).cast("int")
    m = long.groupBy("frame_id").agg(F.sort_array(F.collect_list(F.struct(at.alias("at"), F.coalesce("h", F.lit(0.0)).alias("h")))).alias("_e"))
    m = m.withColumn("_e", F.filter("_e", lambda e: e["at"].between(0, n - 1)))
    zeros = lambda k: F.when(k >= 0, F.array_repeat(F.lit(0.0), k)).otherwise(F.raise_error(F.lit("a bin of a frame comes twice")))
    # each bin after the empty ones before it: one pass, where a look-up per bin would search the bins every time
    filled = F.transform("_e", lambda e, i: F.concat(zeros(e["at"] - F.coalesce(F.get("_e", i - 1)["at"], F.lit(-1)) - 1), F.array(e["h"])))
    rest = zeros(n - 1 - F.coalesce(F.element_at(F.transform("_e", lambda e: e["at"]), -1), F.lit(-1)))
    full = F.concat(F.flatten(filled), rest)
    return m.select("frame_id", full.alias("descriptor"))


def place_marks(marks: DataFrame, keyframes: DataFrame, origin: tuple[float, float], zone: int, south: bool,
                by: Sequence[str] = TRAJ, width: float = SLICE, order: Sequence[str] = ("t",)) -> DataFrame:
    """Marks at their interpolated pose: local position, lon/lat, heading, running number per mark id."""
    d = asof_interpolate(marks, keyframes, by, "t", "pose", width=width).filter(F.col("pose").isNotNull())
    d = G.add_lonlat(d, F.col("pose.x") + origin[0], F.col("pose.y") + origin[1], F.lit(zone), F.lit(south))
    d = d.select(*marks.columns, F.col("pose.x").alias("x"), F.col("pose.y").alias("y"), F.col("pose.z").alias("z"),
                 "lon", "lat", P.yaw_deg("pose").alias("heading"))
    return number_marks(d, ["mark_id"], order, width)


def place_images(images: DataFrame, keyframes: DataFrame, by: Sequence[str] = TRAJ, width: float = SLICE) -> DataFrame:
    """The earliest image of every key frame that is the nearer end of its bracket."""
    d = asof_interpolate(images, keyframes, by, "t", "pose", width=width).filter(F.col("s_frame_id").isNotNull())
    row = F.struct(*images.columns)
    g = d.groupBy(F.col("s_frame_id").alias("frame_id")).agg(F.min_by(row, F.struct("t", "image_id")).alias("_i"))
    return g.select("frame_id", "_i.*")


def messages_of(messages: DataFrame, files: DataFrame, keys: Sequence[str], topics: Sequence[str]) -> DataFrame:
    """Messages on the given topics whose log belongs to a trajectory's files."""
    return messages.filter(F.col("topic").isin(*topics)).join(files.select(*keys), list(keys), "left_semi")
