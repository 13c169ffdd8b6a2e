"""Packed point blobs to rows.

A blob is a run of 24-byte records: five little-endian float32 (x, y, z, height,
range) and four uint8 (intensity, intensity_vi, ring, type).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("height", "<f4"), ("range", "<f4"),
                   ("intensity", "u1"), ("intensity_vi", "u1"), ("ring", "u1"), ("type", "u1")])
NO_RETURN = np.float32(np.finfo(np.float32).max)  # fixed value: marks a beam without return
FREE = np.float32(np.finfo(np.float32).tiny)  # fixed value: marks a free beam

POINTS = ("frame_id long, pt long, x double, y double, z double, height double, range double, "
          "intensity int, intensity_vi int, ring int, type int, hit string")


def split_failed(blobs: DataFrame, blob: str = "pcd") -> tuple[DataFrame, DataFrame]:
    """Frames with a readable blob, and the ids of those without one."""
    size = F.length(F.col(blob))
    bad = F.col(blob).isNull() | (size == 0) | (size % RECORD.itemsize != 0)
    return blobs.filter(~bad), blobs.filter(bad).select("frame_id")


def read_frames(spark: SparkSession, path: str, blob: str = "pcd") -> tuple[DataFrame, DataFrame]:
    """Readable frames and failed ids of a stored table."""
    return split_failed(spark.read.parquet(path), blob)


def explode_clouds(blobs: DataFrame, blob: str = "pcd") -> DataFrame:
    """One row per point of every frame (``frame_id``, blob); sentinels become NULL plus ``hit``.

    Each batch holds a few frames; a frame's cloud is bounded by one sensor sweep.
    """
    def run(batches):
        for pdf in batches:
            for frame, raw in zip(pdf["frame_id"], pdf["_b"]):
                rec = np.frombuffer(raw, dtype=RECORD)
                rng = rec["range"].astype("f8")
                gone, free = rec["range"] >= NO_RETURN, rec["range"] == FREE
                rng[gone | free] = np.nan
                out = {"frame_id": np.full(len(rec), frame, "i8"), "pt": np.arange(len(rec), dtype="i8")}
                out |= {c: rec[c].astype("f8") for c in ("x", "y", "z", "height")}
                out["range"] = rng
                out |= {c: rec[c].astype("i4") for c in ("intensity", "intensity_vi", "ring", "type")}
                out["hit"] = np.where(gone, "none", np.where(free, "free", "hit"))
                yield pd.DataFrame(out)

    ok, _ = split_failed(blobs, blob)
    d = ok.select("frame_id", F.col(blob).alias("_b")).mapInPandas(run, POINTS)
    return d.withColumn("range", F.when(F.isnan("range"), F.lit(None)).otherwise(F.col("range")))


def pack_clouds(points: DataFrame, max_points: int = 1_000_000) -> DataFrame:
    """Rows back to one blob per frame, for sinks that want blobs.

    A frame is one sensor sweep; a frame with more than ``max_points`` points is
    split into numbered parts instead of growing one group.
    """
    part = F.floor(F.col("pt") / max_points)
    schema = T.StructType([T.StructField("frame_id", T.LongType()), T.StructField("part", T.LongType()),
                           T.StructField("pcd", T.BinaryType())])

    def run(key, pdf):
        pdf = pdf.sort_values("pt")
        rec = np.zeros(len(pdf), dtype=RECORD)
        for c in RECORD.names:
            rec[c] = pdf[c].to_numpy()
        return pd.DataFrame({"frame_id": [key[0]], "part": [key[1]], "pcd": [rec.tobytes()]})

    return points.withColumn("part", part).groupBy("frame_id", "part").applyInPandas(run, schema)
