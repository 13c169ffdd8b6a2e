"""Map tables: upsert, pose updates, deletes, merges, splits, dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Insert or replace by key; of several updates the greatest ``order`` wins.

    ``max_by`` folds equal keys before the shuffle, so a key with many copies is
    no burden.
    """
    rank = F.col(order) if order else F.lit(0)
    both = (base.withColumn("_from", F.lit(0)).withColumn("_rank", rank.cast("double"))
            .unionByName(updates.withColumn("_from", F.lit(1)).withColumn("_rank", rank.cast("double"))))
    row = F.struct(*[c for c in base.columns])
    g = both.groupBy(*keys).agg(F.max_by(row, F.struct("_from", "_rank")).alias("_r"))
    return g.select("_r.*")


def update_poses(base: DataFrame, poses: DataFrame, key: str = "id", pose: str = "pose") -> DataFrame:
    """Replace the pose of the rows that have a new one."""
    new = poses.select(key, F.col(pose).alias("_new"))
    return base.join(new, key, "left").withColumn(pose, F.coalesce("_new", pose)).drop("_new").select(*base.columns)


def shift_ids(df: DataFrame, inc: int, key: str = "id") -> DataFrame:
    return df.withColumn(key, F.col(key) + inc)


def delete_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key, folded before the shuffle."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_r")).select("_r.*")


def union_points(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def merge_maps(target: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add a current map to a fixed target map: key frames, and merge info per trajectory.

    The target's stage-2 pose becomes its stage-1 pose; the current map's ids and
    trajectory ids move past the target's.  The offsets are one row.
    """
    off = target.agg((F.max("id") + 1).alias("_di"), (F.max("trajectory_id") + 1).alias("_dt"))
    old = target.withColumn("stage1_pose", F.col("stage2_pose"))
    new = (current.crossJoin(F.broadcast(off)).withColumn("id", F.col("id") + F.col("_di"))
           .withColumn("trajectory_id", F.col("trajectory_id") + F.col("_dt")).drop("_di", "_dt"))
    info = (old.select("trajectory_id").distinct().withColumn("vertex_type", F.lit("FIXED"))
            .unionByName(new.select("trajectory_id").distinct().withColumn("vertex_type", F.lit("UNFIXED"))))
    return old.unionByName(new.select(*old.columns)), info


def merge_stores(stores: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Several stores as one; on equal keys the later store wins."""
    both = None
    for i, d in enumerate(stores):
        d = d.withColumn("_store", F.lit(i))
        both = d if both is None else both.unionByName(d, allowMissingColumns=True)
    row = F.struct(*[c for c in both.columns if c != "_store"])
    return both.groupBy(*keys).agg(F.max_by(row, "_store").alias("_r")).select("_r.*")


def split_store(df: DataFrame, assignment: DataFrame, key: str = "id") -> DataFrame:
    """Rows with the sub-map they belong to."""
    return df.join(assignment.select(key, "map_id"), key)


def write_split(df: DataFrame, path: str, column: str = "map_id", mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(column).parquet(path)


def dump(df: DataFrame, path: str, column: str = "frame_id", buckets: int = 1000, mode: str = "overwrite") -> None:
    """Write every frame's points; frames are grouped in ``buckets`` folders.

    A folder per frame would mean millions of tiny files on a large map.
    """
    df.withColumn("bucket", F.pmod(F.col(column), F.lit(buckets))).write.mode(mode).partitionBy("bucket").parquet(path)


def fix(keyframes: DataFrame, ids: DataFrame | None = None, trajectories: DataFrame | None = None) -> DataFrame:
    """Flag the frames (by id or trajectory) that an optimisation must not move."""
    d = keyframes.withColumn("fixed", F.lit(False))
    for side, key in ((ids, "id"), (trajectories, "trajectory_id")):
        if side is not None:
            mark = side.select(key).distinct().withColumn("_f", F.lit(True))
            d = d.join(mark, key, "left").withColumn("fixed", F.col("fixed") | F.coalesce("_f", F.lit(False))).drop("_f")
    return d


def apply_correction(keyframes: DataFrame, match: DataFrame, pose: str = "pose") -> DataFrame:
    """Move whole trajectories by the rigid correction of their best match.

    ``match`` carries ``trajectory_id, score, correction``; the highest score counts.
    """
    from wayloom.functions import pose as P

    best = match.groupBy("trajectory_id").agg(F.max_by("correction", "score").alias("_c"))
    d = keyframes.join(best, "trajectory_id", "left")
    moved = P.compose(F.col("_c"), F.col(pose))
    return d.withColumn(pose, F.when(F.col("_c").isNull(), F.col(pose)).otherwise(moved)).drop("_c")
