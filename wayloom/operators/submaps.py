"""Splitting a map into sub-maps, refining the split, and its topology."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayloom.operators.ordered import blocked, near, runs, running, tidy
from wayloom.operators.sequence import TRAJ
from wayloom.operators.spatial import _around, radius_join, suffixed
from wayloom.session import cut


def topology(assignment: DataFrame, reach: float = 3.0, by: Sequence[str] = TRAJ,
             width: float = 1_000_000.0) -> DataFrame:
    """Edges, both ways, where consecutive frames lie in different maps and close together."""
    d = near(blocked(assignment, by, ["id"], width), by, 1, 0,
             {f"_{c}": (lambda w, c=c: F.lag(c).over(w)) for c in ("id", "map_id", "x", "y")})
    dx, dy = F.col("x") - F.col("_x"), F.col("y") - F.col("_y")
    d = d.filter((F.col("_map_id") != F.col("map_id")) & (F.sqrt(dx * dx + dy * dy) <= reach))
    there = F.struct(F.col("_map_id").alias("map_1"), F.col("map_id").alias("map_2"),
                     F.col("_id").alias("id_1"), F.col("id").alias("id_2"))
    back = F.struct(F.col("map_id").alias("map_1"), F.col("_map_id").alias("map_2"),
                    F.col("id").alias("id_1"), F.col("_id").alias("id_2"))
    return d.select(F.explode(F.array(there, back)).alias("_e")).select("_e.*")


def recentre(keyframes: DataFrame, by: Sequence[str] = TRAJ, order: str = "id") -> DataFrame:
    """Move every trajectory so that its first frame lies at the origin."""
    first = keyframes.groupBy(*by).agg(*[F.min_by(c, order).alias(f"_{c}0") for c in "xyz"])
    d = keyframes.join(first, list(by))
    for c in "xyz":
        d = d.withColumn(c, F.col(c) - F.col(f"_{c}0"))
    return d.drop(*[f"_{c}0" for c in "xyz"])


def split_submaps(keyframes: DataFrame, max_frames: int = 5000, gap: float = 50.0, reach: float = 50.0,
                  level: float = 4.0, rounds: int = 2, by: Sequence[str] = TRAJ,
                  width: float = 1_000_000.0) -> DataFrame:
    """Give every frame a ``map_id``: seeds along the trajectory, then absorption of near frames.

    Seeds are runs without a step over ``gap`` or a height step over ``level``,
    cut every ``max_frames`` rows.  Then, ``rounds`` times, a whole seed that
    touches an earlier seed's frames within ``reach`` on the same level joins the
    lowest such seed as long as both together respect ``max_frames``.
    """
    exprs = {f"_{c}": (lambda w, c=c: F.lag(c).over(w)) for c in "xyz"}
    d = near(blocked(keyframes, by, ["id"], width), by, 1, 0, exprs)
    dx, dy = F.col("x") - F.col("_x"), F.col("y") - F.col("_y")
    jump = F.coalesce((F.sqrt(dx * dx + dy * dy) >= gap) | (F.abs(F.col("z") - F.col("_z")) >= level), F.lit(True))
    d = running(d.withColumn("_j", jump.cast("long")), by, {"_run": F.col("_j")})
    d = d.withColumn("_part", F.floor((F.col("_rn") - 1) / max_frames))
    seed = d.groupBy(*by, "_run", "_part").agg(F.min("id").alias("map_id"))
    d = cut(d.join(seed, [*by, "_run", "_part"]).select(*by, "id", "x", "y", "z", "map_id"))
    for _ in range(rounds):
        sizes = d.groupBy("map_id").agg(F.count(F.lit(1)).alias("_n"))
        want = _lowest_near(d.select("map_id", "x", "y", "z"), reach, level)
        # only seeds that are not themselves moved this round can take others in
        want = want.join(want.select(F.col("map_id").alias("_to")), "_to", "left_anti")
        want = want.join(sizes, "map_id").join(sizes.select(F.col("map_id").alias("_to"), F.col("_n").alias("_m")), "_to")
        # every seed has a frame: of those that want one target, no more than max_frames can fit
        want = want.withColumn("_rk", F.row_number().over(Window.partitionBy("_to").orderBy("map_id"))).where(F.col("_rk") <= max_frames)
        free = F.sum("_n").over(_by_target())
        want = want.withColumn("_sum", free).filter(F.col("_sum") + F.col("_m") <= max_frames)
        d = cut(d.join(want.select("map_id", "_to"), "map_id", "left")
                .withColumn("map_id", F.coalesce("_to", "map_id")).drop("_to"))
    return d


SHARE = 100_000  # frames of a cell that are worked on in one go


def _first_near(r: float, level: float):
    """The lowest map near each frame of a cell, out of the lowest frames around it; ``_next``: the lowest map that was held back."""
    def run(asked: pd.DataFrame, shown: pd.DataFrame) -> pd.DataFrame:
        held = shown["held"].to_numpy(bool)
        last = shown["ref"].to_numpy(np.int64)[held].min() if held.any() else None
        shown = shown[~held].sort_values("ref")
        ref, at = shown["ref"].to_numpy(np.int64), shown[["rx", "ry", "rz"]].to_numpy(float)
        own, q = asked["map_id"].to_numpy(np.int64), asked[["x", "y", "z"]].to_numpy(float)
        to, open_, begin, size = np.full(len(own), -1), np.arange(len(own)), 0, 16
        hit = np.zeros(len(own), bool)
        while begin < len(ref):  # in the order of maps: the first one near is the lowest
            open_ = open_[own[open_] > ref[begin]]
            if not len(open_):
                break
            m, a = ref[begin: begin + size], at[begin: begin + size]
            for part in np.array_split(open_, len(open_) * size // 2_000_000 + 1):
                dx, dy = q[part, 0, None] - a[:, 0], q[part, 1, None] - a[:, 1]
                near = (dx * dx + dy * dy <= r * r) & (np.abs(q[part, 2, None] - a[:, 2]) < level) & (m < own[part, None])
                ok = near.any(axis=1)
                to[part[ok]] = m[near[ok].argmax(axis=1)]
                hit[part[ok]] = True
            open_ = open_[~hit[open_]]
            begin, size = begin + size, min(2 * size, 1024)
        left = np.zeros(len(own), bool) if last is None else last < np.where(hit, to, own)
        out = asked[["map_id", "x", "y", "z"]].assign(_to=pd.array(to, dtype="Int64"), _next=pd.array(np.full(len(own), last or 0), dtype="Int64"))
        out.loc[~hit, "_to"] = pd.NA
        out.loc[~left, "_next"] = pd.NA
        best = out[hit & ~left].groupby("map_id", as_index=False)["_to"].min()  # a row per map of those that are settled
        return pd.concat([out[left], best])[["map_id", "x", "y", "z", "_to", "_next"]] if left.any() else best.assign(
            x=np.nan, y=np.nan, z=np.nan, _next=pd.array([pd.NA] * len(best), dtype="Int64"))[["map_id", "x", "y", "z", "_to", "_next"]]

    return run


def _lowest_near(frames: DataFrame, r: float, level: float, takes: Sequence[int] = (8, 128, 2048, 32768)) -> DataFrame:
    """map_id, _to: the lowest map with a frame within ``r`` of one of the map's, less than ``level`` above or below, where that is lower than the map itself.

    Cells show their lowest frames first.  A frame is settled once no cell around it holds back a map lower
    than the best so far, of its own or of its map; more are shown to the others, and all to those that ``takes`` leaves.
    """
    names = ["_c0", "_c1", "_c2"]
    cells = [F.floor(F.col(c) / s).alias(n) for c, s, n in zip("xyz", (r, r, level), names)]
    every = cut(frames.dropna().select("map_id", *[F.col(c).cast("double").alias(c) for c in "xyz"]).distinct().select("*", *cells))
    asked, found = every, None
    rank = Window.partitionBy(*names).orderBy("map_id")
    ranked = every.select(*names, F.col("map_id").alias("ref"), *[F.col(c).alias(f"r{c}") for c in "xyz"], F.row_number().over(rank).alias("_k"))
    for take in takes:
        shares = asked.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("_n"))
        shares = cut(shares)
        first = ranked.where(F.col("_k") <= take + 1).select(F.explode(_around([F.col(n) for n in names], names)).alias("_cell"), "ref", "rx", "ry", "rz",
                                                             (F.col("_k") > take).alias("held"))
        first = first.select("_cell.*", "ref", "rx", "ry", "rz", "held").join(shares, names)
        first = first.withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
        mine = asked.join(shares.withColumnRenamed("_n", "_of"), names).withColumn("_p", F.pmod(F.xxhash64("map_id", "x", "y", "z"), F.col("_of")).cast("int")).drop("_of")
        keys = [*names, "_p"]
        got = mine.groupBy(*keys).cogroup(first.groupBy(*keys)).applyInPandas(_first_near(r, level), "map_id long, x double, y double, z double, _to long, _next long")
        got = cut(got)
        best = got.groupBy("map_id").agg(F.min("_to").alias("_to")).where("_to is not null")
        found = cut(best if found is None else found.unionByName(best).groupBy("map_id").agg(F.min("_to").alias("_to")))
        asked = got.where("_next is not null").select("map_id", "x", "y", "z", "_next").join(found, "map_id", "left")
        asked = cut(asked.where(F.col("_next") < F.coalesce("_to", "map_id")).select("map_id", "x", "y", "z", *cells))
        if asked.isEmpty():
            return found
    lower = F.col("map_id_2") < F.coalesce("_to", "map_id")
    touch = radius_join(asked.drop(*names).join(found, "map_id", "left"), suffixed(every.drop(*names), "_2"), r, where=lower & (F.abs(F.col("z") - F.col("z_2")) < level))
    more = touch.groupBy("map_id").agg(F.min("map_id_2").alias("_to"))
    return found.unionByName(more).groupBy("map_id").agg(F.min("_to").alias("_to"))


def _by_target():
    return Window.partitionBy("_to").orderBy("map_id").rowsBetween(Window.unboundedPreceding, 0)


def refine_submaps(assignment: DataFrame, short: int = 100, reach: float = 50.0, level: float = 4.0, rounds: int = 3,
                   by: Sequence[str] = TRAJ, width: float = 1_000_000.0) -> DataFrame:
    """Hand short runs at a map's border to the map before or after them, if the level fits.

    A run goes to the previous run's map, else to the next one's, when the step
    across the border is within ``reach`` and ``level``.
    """
    d = assignment
    for _ in range(rounds):
        b = runs(blocked(d, by, ["id"], width), by, F.col("map_id"))
        r = b.groupBy(*by, "run_id").agg(
            F.count(F.lit(1)).alias("_n"), F.first("map_id").alias("_map"),
            F.min_by(F.struct("x", "y", "z"), "_rn").alias("_first"), F.max_by(F.struct("x", "y", "z"), "_rn").alias("_last"))
        r = blocked(r.withColumn("_o", F.col("run_id").cast("double")), by, ["_o"], 100_000.0)
        r = near(r, by, 1, 1, {"_pm": lambda w: F.lag("_map").over(w), "_pl": lambda w: F.lag("_last").over(w),
                               "_pn": lambda w: F.lag("_n").over(w), "_nn": lambda w: F.lead("_n").over(w),
                               "_nm": lambda w: F.lead("_map").over(w), "_nf": lambda w: F.lead("_first").over(w)})

        def fits(a, c):
            flat = F.hypot(F.col(f"{a}.x") - F.col(f"{c}.x"), F.col(f"{a}.y") - F.col(f"{c}.y")) <= reach
            return flat & (F.abs(F.col(f"{a}.z") - F.col(f"{c}.z")) < level)

        # a run only moves into a run that itself stays
        to = (F.when(F.col("_n") >= short, F.col("_map"))
              .when((F.col("_pn") >= short) & fits("_pl", "_first"), F.col("_pm"))
              .when((F.col("_nn") >= short) & fits("_last", "_nf"), F.col("_nm")).otherwise(F.col("_map")))
        moves = r.select(*by, "run_id", to.alias("_to"))
        d = cut(tidy(b.join(moves, [*by, "run_id"]).withColumn("map_id", F.col("_to"))).drop("_to", "run_id"))
    return d
