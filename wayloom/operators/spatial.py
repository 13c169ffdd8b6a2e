"""Spatial joins as equi-joins on grid cells.

Radius joins copy one side to the 3×3 cells around it and leave uneven cells to
adaptive skew-join handling.  Nearest-neighbour joins choose, per query place,
the smallest cell of a doubling grid that surely holds the answer, so dense
places are searched in small cells and sparse ones in large cells; copies of a
place are folded into one before any pair is formed.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.functions import pose as P
from wayloom.functions.geodesy import wrap180
from wayloom.operators.bundles import Cells, Places, bundles, small
from wayloom.session import cut


def suffixed(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in df.columns])


def _around(cols: Sequence[Column], names: Sequence[str]) -> Column:
    """Array of the 3^d cells around a cell."""
    return F.array(*[F.struct(*[(c + o).alias(n) for c, o, n in zip(cols, off, names)])
                     for off in itertools.product((-1, 0, 1), repeat=len(cols))])


DEALT = 4000  # rows of one side of a crowded cell that meet in one share
CROWDED = 50_000_000  # pairs looked at in a cell that is not dealt out
COPIES = 2  # rows of one side that are sent for a crowded cell, as a multiple of the rows of both


def _dealt(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with shares as further keys: each pair of rows of a crowded cell meets in one share, and a share has few rows.

    A share has two numbers; a row has one of its own and is copied for all of the other side's.  There are no more shares
    than keep the copies of a side to ``COPIES`` times the cell's rows: what is sent grows with the rows, not with their pairs.
    """
    left, right = (cut(d.withColumn("_row", F.monotonically_increasing_id())) for d in (left, right))
    n = [d.groupBy(*keys).agg(F.count(F.lit(1)).alias(c)) for d, c in ((left, "_nl"), (right, "_nr"))]
    crowded = cut(n[0].join(n[1], list(keys)).where(F.col("_nl").cast("double") * F.col("_nr") > CROWDED).select(
        *keys, *[F.greatest(F.lit(1), F.least(F.ceil(F.col(c) / DEALT), F.floor((F.col("_nl") + F.col("_nr")) * F.lit(COPIES) / F.col(o)))).cast("int").alias(s)
                 for c, o, s in (("_nl", "_nr", "_sl"), ("_nr", "_nl", "_sr"))]))
    if crowded.isEmpty():
        return left.drop("_row"), right.drop("_row"), []
    out = []
    for d, own, other in ((left, "l", "r"), (right, "r", "l")):
        kept = [c for c in d.columns if c != "_row"]
        d = d.join(crowded, list(keys), "left")
        mine = F.coalesce(F.pmod("_row", F.col(f"_s{own}")), F.lit(0)).cast("long").alias(f"_p{own}")
        all_ = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"_s{other}"), F.lit(1)) - 1)).alias(f"_p{other}")
        d = d.select(*kept, mine, all_)
        out.append(d.withColumn(f"_p{other}", F.col(f"_p{other}").cast("long")))
    return *out, ["_pl", "_pr"]


def radius_join(a: DataFrame, b: DataFrame, r: float, a_at: Sequence[str] = ("x", "y"),
                b_at: Sequence[str] = ("x_2", "y_2"), by: Sequence[str] = (), strict: bool = False,
                how: str = "inner", where: Column | None = None, deal: bool = False) -> DataFrame:
    """Pairs closer than ``r`` (or at ``r``, unless ``strict``), with ``dist``.

    Column names of the two sides must differ except for ``by``.  ``how`` may be
    ``left_semi``/``left_anti``; then only ``a``'s columns come back.  With ``deal`` the rows of crowded cells are dealt
    over many tasks, each of which holds a few thousand of them (inner joins only; both sides are written once more).
    """
    names = [f"_c{i}" for i in range(len(a_at))]
    left = a.select("*", *[F.floor(F.col(c) / r).alias(n) for c, n in zip(a_at, names)])
    cells = _around([F.floor(F.col(c) / r) for c in b_at], names)
    right = b.select("*", F.explode(cells).alias("_cell")).select("*", "_cell.*").drop("_cell")
    sq = sum(((F.col(p) - F.col(q)) * (F.col(p) - F.col(q)) for p, q in zip(a_at[1:], b_at[1:])),
             (F.col(a_at[0]) - F.col(b_at[0])) * (F.col(a_at[0]) - F.col(b_at[0])))
    keys = [*by, *names]
    if deal and how == "inner":
        left, right, shares = _dealt(left, right, keys)
        keys += shares
        names += shares
    right = right.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    close = sq < r * r if strict else sq <= r * r
    on = close
    for c in keys:
        on = on & (left[c] == right[f"_k_{c}"])
    if where is not None:
        on = on & where
    out = left.join(right, on, how)
    if how in ("left_semi", "left_anti"):
        return out.drop(*names)
    return out.withColumn("dist", F.sqrt(sq)).drop(*names, *[f"_k_{c}" for c in keys])


def _cells(at: Sequence[str], level: Column, base: float, levels: int) -> list[Column]:
    size = F.element_at(F.array(*[F.lit(base * 2.0**i) for i in range(levels)]), F.least(level + 1, F.lit(levels)))
    return [F.when(level >= levels, F.lit(0)).otherwise(F.floor(F.col(c) / size)).cast("long") for c in at]


def _levels_for(base: float, levels: int, max_d: float | None) -> tuple[int, int]:
    """Number of sized levels and the last level in use (the sized ones only, if ``max_d`` bounds the search)."""
    if max_d is None:
        return levels, levels
    sized = max(1, math.ceil(math.log2(max(max_d / base, 1.0))) + 1)
    return sized, sized - 1


def knn_index(ref: DataFrame, k: int, ref_at: Sequence[str] = ("x", "y"), ref_id: str = "id",
              by: Sequence[str] = (), base: float = 1.0, levels: int = 8,
              max_d: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Reference places in every grid level, and the cells that hold at least ``k`` references.

    A place keeps its ``k`` lowest ids: further copies can never be in an answer.
    """
    by, names, at = list(by), [f"_c{i}" for i in range(len(ref_at))], [f"_a{i}" for i in range(len(ref_at))]
    places = ref.select(*by, *[F.col(c).cast("double").alias(n) for c, n in zip(ref_at, at)],
                        F.col(ref_id).alias("_rid"))
    if k == 1:
        places = places.groupBy(*by, *at).agg(F.array(F.min("_rid")).alias("_ids"))
    else:
        first_k = Window.partitionBy(*by, *at).orderBy("_rid")
        places = (places.withColumn("_rk", F.row_number().over(first_k)).filter(F.col("_rk") <= k)
                  .groupBy(*by, *at).agg(F.sort_array(F.collect_list("_rid")).alias("_ids")))
    levels, top = _levels_for(base, levels, max_d)
    gridded = _gridded(places, at, names, base, levels, top)
    held = (gridded.groupBy(*by, "_level", *names).agg(F.sum(F.size("_ids")).alias("_held"))
            .filter(F.col("_held") >= k).drop("_held"))
    return gridded, held


def _gridded(d: DataFrame, at, names, base, levels, top) -> DataFrame:
    d = d.select("*", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("_level"))
    return d.select("*", *[c.alias(n) for c, n in zip(_cells(at, F.col("_level"), base, levels), names)])


def knn_join(q: DataFrame, ref: DataFrame | None, k: int, q_at: Sequence[str] = ("x", "y"),
             ref_at: Sequence[str] = ("x", "y"), ref_id: str = "id", by: Sequence[str] = (),
             base: float = 1.0, levels: int = 8, index: tuple[DataFrame, DataFrame] | None = None,
             keep_place: bool = False, max_d: float | None = None, places: bool = False) -> DataFrame:
    """The ``k`` nearest reference ids of every query row, exact, ties by id.

    Returns the query columns plus ``ref_id``, ``dist`` and ``rank`` (and the
    reference's coordinates ``ref_0 …`` with ``keep_place``).  Cell sizes run over
    ``base·2^0 … base·2^(levels-1)``; one further level holds everything.  A query
    place takes the smallest cell of its own that holds at least ``k``
    references; then all of the answer lies within one cell of twice that size.
    With ``max_d`` only references within that distance count, and cells stop
    growing there; give :func:`knn_index` the same bound.  With ``places`` the
    result has one set of rows per distinct query place (``by``, ``q_at``) with
    its ``count`` of query rows instead of the query columns.
    """
    by, dims = list(by), len(q_at)
    if by and index is None:
        bundle, large = bundles([q, ref], by)
        best = _bundled_knn(small(q, by, large), small(ref, by, large), k, q_at, ref_at, ref_id, by, base, levels, max_d, bundle)
        if large is not None:
            best = best.unionByName(_gridded_knn(q.join(large, by, "left_semi"), ref.join(large, by, "left_semi"), k, q_at, ref_at,
                                                 ref_id, by, base, levels, None, max_d))
    else:
        best = _gridded_knn(q, ref, k, q_at, ref_at, ref_id, by, base, levels, index, max_d)
    qa = [f"_q_a{i}" for i in range(dims)]
    kept = ["_spot.*"] if keep_place else []
    if places:
        return best.select(*by, *[F.col(m).alias(c) for c, m in zip(q_at, qa)], F.col("_w").alias("count"),
                           F.col("_rid").alias("ref_id"), F.sqrt("_sq").alias("dist"), "rank", *kept)
    back = q.select("*", *[F.col(c).cast("double").alias(m) for c, m in zip(q_at, qa)])
    return (back.join(best, [*by, *qa])
            .select(*q.columns, F.col("_rid").alias("ref_id"), F.sqrt("_sq").alias("dist"), "rank", *kept))


def _bundled_knn(q, ref, k, q_at, ref_at, ref_id, by, base, levels, max_d, bundle) -> DataFrame:
    """Answers per query place, groups of ``by`` searched inside their bundle.

    Without ``max_d`` a query or a reference without a coordinate is at distance null, before all others.
    """
    dims = len(q_at)
    at, qa = [f"_a{i}" for i in range(dims)], [f"_q_a{i}" for i in range(dims)]
    double = lambda cols, to: [F.col(c).cast("double").alias(n) for c, n in zip(cols, to)]
    keys = [f"_k_{c}" for c in by]
    asked = q.select(bundle.alias("_b"), *by, *double(q_at, qa))
    if max_d is not None:
        asked = asked.dropna(subset=qa)
    places = ref.select(bundle.alias("_b"), *[F.col(c).alias(n) for c, n in zip(by, keys)], *double(ref_at, at), F.col(ref_id).alias("_rid"))
    if max_d is not None:
        places = places.dropna(subset=at)
    types = dict(places.dtypes)
    schema = ", ".join([*[f"{c} {types[n]}" for c, n in zip(by, keys)], *[f"{c} double" for c in qa], "_w long", "_sq double", f"_rid {types['_rid']}",
                        "rank int", *[f"ref_{i} double" for i in range(dims)]])
    sized, _ = _levels_for(base, levels, max_d)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a = a.groupby([*by, *qa], sort=False, dropna=False).size().rename("_w").reset_index()
        group = pd.concat([a[by], b[keys].set_axis(by, axis=1)]).groupby(by, sort=False).ngroup().to_numpy()
        spot, ids, asked, own, of = b[at].to_numpy(float), b["_rid"].to_numpy(), a[qa].to_numpy(float), group[:len(a)], group[len(a):]
        there = ~np.isnan(spot).any(1)
        i, j, sq, rank = Places(of[there], spot[there], ids[there], k, base, sized, max_d).nearest(own, asked)
        j = np.flatnonzero(there)[j]
        far = np.isin(own, of[~there])  # as in the joins, a reference without a place is met at the last level only
        for n in range(sized - 1 if far.any() else 0):
            cells = Cells(of[there], Places.cells(spot[there], base * 2.0**n))
            far &= (cells.spans(own, Places.cells(asked, base * 2.0**n), [((0,) * (dims - 1), 0, 0)])[1][:, 0] < k) | np.isnan(asked).any(1)
        if far.any():
            more = Places(of, spot, ids, k, base, 0, None).nearest(own[far], asked[far])
            old = ~far[i]
            i, j, sq, rank = (np.concatenate([x[old], y]) for x, y in zip((i, j, sq, rank), (np.flatnonzero(far)[more[0]], *more[1:])))
        out = a.iloc[i].reset_index(drop=True)
        sq = pd.Series(sq).astype("Float64")
        return out.assign(_sq=sq, _rid=ids[j], rank=rank.astype(np.int32),
                          **{f"ref_{n}": spot[j, n] for n in range(dims)})[[*by, *qa, "_w", "_sq", "_rid", "rank", *[f"ref_{n}" for n in range(dims)]]]

    best = asked.groupBy("_b").cogroup(places.groupBy("_b")).applyInPandas(run, schema)
    return best.select(*by, *qa, "_w", "_sq", "_rid", F.struct(*[f"ref_{i}" for i in range(dims)]).alias("_spot"), "rank")


def _gridded_knn(q, ref, k, q_at, ref_at, ref_id, by, base, levels, index, max_d) -> DataFrame:
    """Answers per query place by joins on grid cells."""
    dims = len(q_at)
    names = [f"_c{i}" for i in range(dims)]
    at = [f"_a{i}" for i in range(dims)]
    gridded, held = index or knn_index(ref, k, ref_at, ref_id, by, base, levels, max_d)
    levels, top = _levels_for(base, levels, max_d)
    level = F.col("_level")
    asked = q.select(*by, *[F.col(c).cast("double").alias(n) for c, n in zip(q_at, at)])
    asked = asked.groupBy(*by, *at).agg(F.count(F.lit(1)).alias("_w"))
    own = _gridded(asked, at, names, base, levels, top)
    pick = (own.join(held.withColumn("_ok", F.lit(1)), [*by, "_level", *names], "left")
            .groupBy(*by, *at).agg(F.min(F.when(F.col("_ok").isNotNull(), level)).alias("_fit"), F.max("_w").alias("_w")))
    pick = pick.select(*by, *at, "_w", F.least(F.coalesce(F.col("_fit") + 1, F.lit(top)), F.lit(top)).alias("_level"))
    qa = [f"_q{n}" for n in at]
    home = [f"_h{i}" for i in range(dims)]
    probe = pick.select(*by, *[F.col(n).alias(m) for n, m in zip(at, qa)], "_w", "_level",
                        *[c.alias(n) for c, n in zip(_cells(at, level, base, levels), home)])
    here = F.array(F.lit(0).cast("long"))
    beside = F.when(level >= levels, here).otherwise(F.array(*[F.lit(o).cast("long") for o in (-1, 0, 1)]))
    for h, n in zip(home, names):
        probe = probe.withColumn("_o", F.explode(beside)).withColumn(n, F.col(h) + F.col("_o")).drop("_o", h)
    pairs = probe.join(gridded, [*by, "_level", *names])
    sq = sum(((F.col(m) - F.col(n)) * (F.col(m) - F.col(n)) for m, n in zip(qa[1:], at[1:])),
             (F.col(qa[0]) - F.col(at[0])) * (F.col(qa[0]) - F.col(at[0])))
    if max_d is not None:
        pairs = pairs.filter(sq <= max_d * max_d)
    spot = F.struct(*[F.col(n).alias(f"ref_{i}") for i, n in enumerate(at)])
    if k == 1:  # a running minimum folds before the shuffle
        first = F.col("_ids")[0]
        best = pairs.groupBy(*by, *qa).agg(F.min(F.struct(sq.alias("_sq"), first.alias("_rid"), spot.alias("_spot"))).alias("_m"),
                                            F.max("_w").alias("_w"))
        best = best.select(*by, *qa, "_w", "_m.*", F.lit(1).alias("rank"))
    else:
        pairs = pairs.select(*by, *qa, "_w", sq.alias("_sq"), spot.alias("_spot"), F.explode("_ids").alias("_rid"))
        w = Window.partitionBy(*by, *qa).orderBy("_sq", "_rid")
        best = pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select(*by, *qa, "_w", "_sq", "_rid", "_spot", "rank")


def diverse_knn(q: DataFrame, ref: DataFrame, k: int = 40, min_gap: int = 20, take: int = 3,
                order: str = "order_id", q_id: str = "id", ref_id: str = "id", base: float = 1.0,
                levels: int = 8) -> DataFrame:
    """Nearest references, kept greedily while their order numbers differ by ``min_gap``.

    The fold runs over at most ``k`` neighbours per query.
    """
    found = knn_join(q, ref, k, ref_id=ref_id, base=base, levels=levels)
    orders = ref.select(F.col(ref_id).alias("ref_id"), F.col(order).cast("long").alias("_o"))
    found = found.join(orders, "ref_id")
    lists = found.groupBy(q_id).agg(F.sort_array(F.collect_list(F.struct("rank", "ref_id", "_o", "dist"))).alias("_l"))
    kept = F.aggregate(
        "_l", F.slice(F.col("_l"), 1, 0),
        lambda acc, e: F.when((F.size(acc) < take) & ~F.exists(acc, lambda m: F.abs(m["_o"] - e["_o"]) < min_gap),
                              F.concat(acc, F.array(e))).otherwise(acc))
    out = lists.select(q_id, F.posexplode(kept).alias("_p", "_m"))
    return out.select(q_id, (F.col("_p") + 1).alias("pick"), F.col("_m.ref_id").alias("ref_id"),
                      F.col("_m.dist").alias("dist"))


def loop_pairs(keyframes: DataFrame, r: float, min_id_gap: int, stride: int, pose: str = "pose",
               quality: str | None = None, min_quality: float = 150.0) -> DataFrame:
    """Frame pairs that may close a loop.

    Same-map frames closer than ``r`` in the plane and, on one trajectory, at
    least ``min_id_gap`` ids apart.  Thinning is a set rule: of all pairs whose
    ids fall in the same two ``stride``-wide buckets the closest one stays.
    """
    d = keyframes if quality is None else keyframes.filter(F.col(quality) > min_quality)
    a = d.select(F.col("id").alias("id_1"), F.col("trajectory_id").alias("trajectory_1"),
                 F.col(pose).alias("pose_1"), F.col(f"{pose}.x").alias("x"), F.col(f"{pose}.y").alias("y"))
    bucket = Window.partitionBy("trajectory_1", F.floor(F.col("id_1") / stride))
    a = a.withColumn("alone_1", F.count(F.lit(1)).over(bucket) == 1)
    b = suffixed(a.select(F.col("id_1").alias("id"), F.col("trajectory_1").alias("trajectory"),
                          F.col("pose_1").alias("pose"), "x", "y", F.col("alone_1").alias("alone")), "_2")
    apart = (F.col("trajectory_1") != F.col("trajectory_2")) | (F.col("id_2") - F.col("id_1") >= min_id_gap)
    # frames that are alone in their buckets make the only pair of these: nothing to choose, nothing to exchange
    close = lambda a, b: radius_join(a, b, r, strict=True, where=(F.col("id_1") < F.col("id_2")) & apart)
    only = close(a.filter("alone_1"), b.filter("alone_2"))
    pairs = close(a.filter("not alone_1"), b).unionByName(close(a.filter("alone_1"), b.filter("not alone_2")))
    buckets = ["trajectory_1", "trajectory_2", "_b1", "_b2"]
    pairs = (pairs.withColumn("_b1", F.floor(F.col("id_1") / stride))
             .withColumn("_b2", F.floor(F.col("id_2") / stride)))
    best = pairs.groupBy(*buckets).agg(
        F.min_by(F.struct("id_1", "id_2", "pose_1", "pose_2", "dist"),
                 F.struct("dist", "id_1", "id_2")).alias("_m"))
    cols = ["id_1", "id_2", "trajectory_1", "trajectory_2", "dist", "pose_1", "pose_2"]
    kept = only.select(*cols).unionByName(
        best.select("_m.id_1", "_m.id_2", "trajectory_1", "trajectory_2", "_m.dist", "_m.pose_1", "_m.pose_2"))
    return kept.select(*cols[:5], P.between(F.col("pose_1"), F.col("pose_2")).alias("rel"))


def endpoint_grid(a: DataFrame, b: DataFrame, step: float, reach: float, angle_step: float) -> DataFrame:
    """Hypotheses (dx, dy, angle) for every pair of trajectory endpoints ``a.id < b.id``.

    Endpoints are matched through a shared ``map_id``: two per trajectory, and
    every pair of them is a hypothesis the matcher must try.
    """
    n = int(round(2 * reach / step))
    offs = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: -reach + i * step)
    turns = F.transform(F.sequence(F.lit(0), F.lit(int(math.ceil(360 / angle_step)) - 1)), lambda i: i * angle_step)
    pairs = (a.select("map_id", F.col("id").alias("id_1")).join(b.select("map_id", F.col("id").alias("id_2")), "map_id")
             .filter(F.col("id_1") < F.col("id_2")))
    # hypotheses are the same for every pair and few: their poses are made once
    one = a.sparkSession.range(1).select(F.explode(offs).alias("dx")).withColumn("dy", F.explode(offs)).withColumn("angle", F.explode(turns))
    one = one.withColumn("rel", P.from_yaw(F.col("dx"), F.col("dy"), F.lit(0.0), F.radians("angle")))
    return pairs.crossJoin(F.broadcast(one))


def local_submap(keys: DataFrame, keyframes: DataFrame, points: DataFrame, half: int = 40, step: int = 3,
                 pose: str = "pose") -> DataFrame:
    """World points of the frames around each key frame (``id ± half`` by ``step``, same trajectory)."""
    around = keys.select(F.col("id").alias("key_id"), "trajectory_id",
                         F.explode(F.sequence(F.col("id") - half, F.col("id") + half - 1, F.lit(step))).alias("id"))
    frames = around.join(keyframes.select("id", "trajectory_id", F.col(pose).alias("_pose")), ["id", "trajectory_id"])
    d = frames.join(points, frames["id"] == points["frame_id"])
    wx, wy, wz = P.transform(F.col("_pose"), "x", "y", "z")
    return d.select("key_id", "frame_id", wx.alias("x"), wy.alias("y"), wz.alias("z"),
                    *[c for c in points.columns if c not in ("frame_id", "x", "y", "z")])


def fitness(src: DataFrame, tgt: DataFrame, poses: DataFrame, max_d: float, base: float = 0.5,
            levels: int = 8) -> DataFrame:
    """Mean squared nearest distance per pair, over source points that have one within ``max_d``.

    ``src``/``tgt`` carry ``pair_id, x, y, z`` (``tgt`` also ``pt``); ``poses``
    gives ``pair_id, pose`` moving source into target.
    """
    moved = src.join(poses.select("pair_id", "pose"), "pair_id")
    mx, my, mz = P.transform(F.col("pose"), "x", "y", "z")
    moved = moved.select("pair_id", mx.alias("x"), my.alias("y"), mz.alias("z"))
    at = ("x", "y", "z")
    # nearest squared distance is compared with max_d itself, as the original does
    hits = knn_join(moved, tgt, 1, at, at, "pt", ["pair_id"], base, levels, places=True)
    sq = F.col("dist") * F.col("dist")
    n = F.coalesce(F.sum(F.when(sq <= max_d, F.col("count"))), F.lit(0))
    total = F.sum(F.when(sq <= max_d, sq * F.col("count")))
    return hits.groupBy("pair_id").agg((total / n).alias("fitness"), n.alias("n_close"))


def compare_paths(a: DataFrame, b: DataFrame, large: float = 0.5, large_heading: float = 5.0) -> DataFrame:
    """Position and heading error by frame id (``id, pose`` on both sides)."""
    d = a.select("id", F.col("pose").alias("pa")).join(b.select("id", F.col("pose").alias("pb")), "id")
    ex, ey = F.col("pa.x") - F.col("pb.x"), F.col("pa.y") - F.col("pb.y")
    head = wrap180(P.yaw_deg("pa") - P.yaw_deg("pb"))
    d = d.select("id", ex.alias("err_x"), ey.alias("err_y"), head.alias("err_heading"))
    big = (F.abs("err_x") > large) | (F.abs("err_y") > large) | (F.abs("err_heading") > large_heading)
    return d.withColumn("large", big)


def ground_raster(keyframes: DataFrame, res: float, margin: float = 0.0, pose: str = "pose", base: float = 1.0,
                  levels: int = 8) -> DataFrame:
    """Height of the nearest trajectory point at the centre of every raster cell.

    The raster spans the trajectory's bounds; cells are generated row by row.
    """
    at = keyframes.select("id", F.col(f"{pose}.x").alias("x"), F.col(f"{pose}.y").alias("y"),
                          F.col(f"{pose}.z").alias("z"))
    box = at.agg(*[F.floor((F.min(c) - margin) / res).alias(f"{c}0") for c in "xy"],
                 *[F.floor((F.max(c) + margin) / res).alias(f"{c}1") for c in "xy"])
    rows = box.select("x0", "x1", F.explode(F.sequence("y0", "y1")).alias("row")).repartition("row")
    cells = rows.select("row", F.explode(F.sequence("x0", "x1")).alias("col"))
    cells = cells.select("row", "col", ((F.col("col") + 0.5) * res).alias("x"), ((F.col("row") + 0.5) * res).alias("y"))
    found = knn_join(cells, at, 1, base=base, levels=levels)
    heights = at.select(F.col("id").alias("ref_id"), F.col("z").alias("ground"))
    return found.join(heights, "ref_id").select("row", "col", "ref_id", "ground")


def level_conflicts(frames: DataFrame, members: DataFrame, r: float, dh: float) -> DataFrame:
    """Frames with some near member whose height differs by ``dh`` or more."""
    m = suffixed(members.select("x", "y", "z"), "_2")
    return radius_join(frames, m, r, how="left_semi", where=F.abs(F.col("z") - F.col("z_2")) >= dh)


def same_level(frames: DataFrame, members: DataFrame, r: float, dh: float) -> DataFrame:
    """Frames with no such member."""
    m = suffixed(members.select("x", "y", "z"), "_2")
    return radius_join(frames, m, r, how="left_anti", where=F.abs(F.col("z") - F.col("z_2")) >= dh)


def revisits(keyframes: DataFrame, r: float, min_dt: float) -> DataFrame:
    """Nearest earlier frame of the same trajectory within ``r`` and at least ``min_dt`` older."""
    a = keyframes.select("trajectory_id", "id", "t", "x", "y")
    b = suffixed(a, "_2", keep=["trajectory_id"])
    pairs = radius_join(a, b, r, by=["trajectory_id"], where=F.col("t") - F.col("t_2") >= min_dt)
    best = pairs.groupBy("trajectory_id", "id").agg(
        F.min_by(F.struct("id_2", "dist"), F.struct("dist", "id_2")).alias("_m"))
    return best.select("trajectory_id", "id", F.col("_m.id_2").alias("earlier_id"), F.col("_m.dist").alias("dist"))


def pair_window(pairs: DataFrame, keyframes: DataFrame, k: int = 10) -> DataFrame:
    """Existing ids in ``id_1 ± k`` against existing ids in ``id_2 ± k``, same trajectory as the picked frame."""
    # ids around a frame once per frame, not once per pair and place in the window
    have = keyframes.select("id", "trajectory_id").distinct()
    of = lambda o: F.floor((F.col("id") + o) / (2 * k + 1))
    near = have.select(F.col("id").alias("n"), "trajectory_id", F.explode(F.array_distinct(F.array(of(-k), of(k)))).alias("_b"))
    near = have.withColumn("_b", of(0)).join(near, ["trajectory_id", "_b"]).where(F.abs(F.col("id") - F.col("n")) <= k)
    near = cut(near.groupBy("id").agg(F.collect_set("n").alias("ns")))
    p = pairs.select("id_1", "id_2").distinct()
    for side in ("1", "2"):
        p = p.join(near.select(F.col("id").alias(f"id_{side}"), F.col("ns").alias(f"_n{side}")), f"id_{side}")
    p = p.select(F.explode("_n1").alias("n_1"), "_n2").select("n_1", F.explode("_n2").alias("n_2"))
    return p.select("n_1", "n_2").distinct()
