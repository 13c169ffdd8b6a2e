"""The online steps as Structured Streaming jobs with event time.

State is kept per vehicle, several to a group of Spark's: a count, a pose, a short list, and the rows that the
watermark has not passed yet.  Those wait, so rows that come out of order inside
the watermark are used in time order (rows of equal time all count); a stream gives
its last rows when its watermark moves beyond them.  ``read_stream(watermark=…)``
bounds both the wait and what is held.
"""

from __future__ import annotations

import itertools
import math
import os
import pickle
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wayloom.functions import rigid as N
from wayloom.operators.asof import asof_forward
from wayloom.operators.graph import optimise_poses
from wayloom.operators.ordered import SLICE, blocked, near, tidy
from wayloom.operators.sequence import TRAJ
from wayloom.operators.spatial import radius_join


def read_stream(spark: SparkSession, path: str, schema: T.StructType, topic: str | Sequence[str] | None = None,
                topic_col: str = "topic", time_col: str = "ts", watermark: str = "10 minutes",
                glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Messages of one topic (or several) as a stream with a watermark."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    d = r.parquet(path)
    if topic is not None:
        d = d.filter(F.col(topic_col).isin(*([topic] if isinstance(topic, str) else topic)))
    return d.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder beside the session's checkpoints (a local one only without that setting)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="wayloom-stream-")
    return os.path.join(base, f"stream-{uuid.uuid4().hex}")


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all data present, and read back what it wrote."""
    spark, folder = stream.sparkSession, shared_folder(stream.sparkSession)
    q = (stream.writeStream.outputMode(mode).format("parquet").option("path", folder + "/out")
         .option("checkpointLocation", folder + "/state").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder + "/out")


BUCKETS = 1 << 10  # fixed value: a stream's state is kept by it
RUN, CHUNK, SMALL = 1 << 18, 1 << 13, 1 << 10  # rows: sorted at a time, in one packed piece, in a piece left as it is


def _pack(cols: list[np.ndarray]) -> bytes:
    """Columns of one piece; those of a long one byte by byte, which zlib packs well."""
    if len(cols[0]) <= SMALL:
        return pickle.dumps((False, cols))
    flat = [c if c.dtype == object else (c.dtype.str, np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes()) for c in cols]
    return pickle.dumps((True, zlib.compress(pickle.dumps(flat), 1)))


def _unpack(piece: bytes) -> list[np.ndarray]:
    packed, cols = pickle.loads(piece)
    if not packed:
        return cols
    back = lambda t, b: np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(np.dtype(t).itemsize, -1).T).view(t)[:, 0]
    return [back(*c) if isinstance(c, tuple) else c for c in pickle.loads(zlib.decompress(cols))]


def _pieces(batches: Iterator[pd.DataFrame], names: Sequence[str]) -> Iterator[tuple[float, bytes]]:
    """Rows as they come, in pieces sorted by their first column, each with its first time."""
    def out(parts):
        cols = [np.concatenate(c) if len(parts) > 1 else c[0] for c in zip(*parts, strict=True)]
        t = cols[0].astype(float)
        at = np.argsort(t, kind="stable")
        at = at[: len(at) - int(np.isnan(t).sum())]  # they sort last; rows without a time never become due
        for k in range(0, len(at), CHUNK):
            here = at[k: k + CHUNK]
            yield float(t[here[0]]), _pack([c[here] for c in cols])

    parts, n = [], 0
    for b in batches:
        parts.append([b[c].to_numpy() for c in names])
        n += len(b)
        if n >= RUN:
            yield from out(parts)
            parts, n = [], 0
    if n:
        yield from out(parts)


def _due(pieces: list[tuple[float, bytes] | None], mark: int) -> Iterator[list[np.ndarray]]:
    """Rows up to the watermark in time order, rows of equal time as they came, some ``RUN`` at once; ``pieces`` keeps the others."""
    ms = lambda t: np.floor(t * 1000)
    todo = sorted((p[0], i) for i, p in enumerate(pieces) if ms(p[0]) <= mark)
    held, fresh = [], 0
    for n, (_, i) in enumerate(todo):
        cols = _unpack(pieces[i][1])
        t = cols[0].astype(float)
        cut = int((ms(t) <= mark).sum())
        pieces[i] = (float(t[cut]), _pack([c[cut:] for c in cols])) if cut < len(t) else None
        held.append([t[:cut], np.full(cut, i), *(c[:cut] for c in cols)])
        fresh += cut
        last = n == len(todo) - 1
        if fresh < RUN and not last:
            continue
        if len(held) > 1:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            at = np.lexsort((cols[1], cols[0]))
            cols = [c[at] for c in cols]
        else:
            cols = held[0]
        done = len(cols[0]) if last else int(np.searchsorted(cols[0], todo[n + 1][0]))  # later pieces begin there
        held, fresh = [[c[done:] for c in cols]], 0
        if done:
            yield [c[:done] for c in cols[2:]]


def _stateful(stream: DataFrame, key: str, out: str, state: str, fn: Callable, names: Sequence[str], time_col: str = "t") -> DataFrame:
    """Apply ``fn(columns, state values or None, begin) -> (columns out or None, new state)`` per key as the watermark passes rows.

    ``columns`` are arrays by name, in time order; a long release comes in parts, ``begin`` marks a key's first.  Rows that
    wait are kept packed, in sorted pieces, so neither the wait nor the release needs them all at once.  The keys are
    dealt over ``BUCKETS``, which Spark keeps as its groups: a group costs milliseconds in every trigger, a key in it microseconds.
    ``stream`` needs its watermarked time column beside ``time_col`` (seconds).
    """
    n = len(T._parse_datatype_string(state).fields)
    names = [time_col, key, *(c for c in names if c != time_col)]

    def run(bucket, batches: Iterator[pd.DataFrame], st: GroupState):
        states, pieces = pickle.loads(st.get[0]) if st.exists else ({}, [])
        if not st.hasTimedOut:
            pieces += _pieces(batches, names)
        mark = st.getCurrentWatermarkMs()
        seen = set()
        for cols in _due(pieces, mark):
            keys = cols[1] if bucket[0] >= 0 else np.zeros(len(cols[0]), np.int64)
            at = np.argsort(keys, kind="stable")
            keys, cols = keys[at], [c[at] for c in cols]
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            got = []
            for i, j in itertools.pairwise(cuts):
                k = int(keys[i]) if bucket[0] >= 0 else None
                res, new = fn(dict(zip(names, [c[i:j] for c in cols], strict=True)), states.get(k), k not in seen)
                assert len(new) == n
                states[k] = new
                seen.add(k)
                if res is not None and len(res["t"]):
                    got.append({key: [k] * len(res["t"]) if k is None else np.full(len(res["t"]), k), **res})
            if got:
                whole = {c: [r[c] for r in got] for c in got[0]}
                yield pd.DataFrame({c: np.concatenate(v) if isinstance(v[0], np.ndarray) else list(itertools.chain(*v)) for c, v in whole.items()}, copy=False)
        pieces = [p for p in pieces if p is not None]
        st.update((pickle.dumps((states, pieces)),))
        if pieces:
            st.setTimeoutTimestamp(int(max(mark + 1, math.floor(min(p[0] for p in pieces) * 1000) - 1)))

    bucket = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(BUCKETS))).cast("int")
    rest = [c for c in stream.columns if c not in names]  # the watermarked time among them
    d = stream.select(bucket.alias("_bucket"), F.col(key).cast("long").alias(key), *[c for c in names if c != key], *rest)
    return d.groupBy("_bucket").applyInPandasWithState(run, f"{key} long, {out}", "held binary", "append", GroupStateTimeout.EventTimeTimeout)


# --- motion ---------------------------------------------------------------------------

IMU_STATIC = 200  # fixed value: samples that set the gyro bias
STEP = 0.01  # fixed value: seconds per sample


def stream_preintegrate(stream: DataFrame, key: str = "vehicle_id", wheel_move: float = 3.0) -> DataFrame:
    """Pose of each vehicle after every inertial sample, and the motion since its last output.

    Rows carry ``t, wx, wy, wz`` (rad/s) or ``v`` (wheel speed, m/s).  The first
    200 samples at rest give the gyro bias; motion starts the count anew.  Per
    trigger and vehicle one motion delta (``dx … dqw``) accumulates and is reset
    on output.
    """
    out = ("t double, x double, y double, z double, qx double, qy double, qz double, qw double, "
           "dx double, dy double, dz double, dqz double")
    state = ("last double, ready boolean, n long, sx double, sy double, sz double, bx double, by double, bz double, "
             "wx double, wy double, wz double, v double, x double, y double, z double, qx double, qy double, qz double, qw double, "
             "dx double, dy double, dz double, dqx double, dqy double, dqz double, dqw double")

    def fn(rows, old, begin):
        s = list(old) if old else [0.0, False, 0] + [0.0] * 9 + [0.0] + [0.0] * 6 + [1.0] + [0.0] * 6 + [1.0]
        if begin:
            s[20:27] = [0.0] * 6 + [1.0]
        t, wx, wy, wz, v = (rows[c].astype(float) for c in ("t", "wx", "wy", "wz", "v"))
        wheel = ~np.isnan(v)
        i = 0
        while not s[1] and i < len(t):
            if wheel[i]:
                s[12] = float(v[i])
                if s[12] > wheel_move:
                    s[2:6] = [0, 0.0, 0.0, 0.0]
            else:
                w = [float(wx[i]), float(wy[i]), float(wz[i])]
                s[2] += 1
                s[3:6] = [a + b for a, b in zip(s[3:6], w)]
                s[9:12] = w
                if s[2] > IMU_STATIC:
                    s[6:9] = [a / s[2] for a in s[3:6]]
                    s[1] = True
            i += 1
        s[0] = float(t[-1])
        t, v, wheel = t[i:], v[i:], wheel[i:]
        w = np.stack([wx[i:], wy[i:], wz[i:]], 1)[~wheel]
        at = np.maximum.accumulate(np.where(wheel, np.arange(len(v)), -1))  # the wheel speed that holds
        speed = np.where(at >= 0, v[np.maximum(at, 0)], s[12])[~wheel] if len(v) else v
        if wheel.any():
            s[12] = float(v[at[-1]])
        if not len(w):
            return None, tuple(s)
        turn = 0.5 * (np.concatenate([[s[9:12]], w[:-1]]) + w) - np.array(s[6:9])
        s[9:12] = w[-1].tolist()
        steps = _running_turns(np.concatenate([np.zeros((len(w), 3)), N.exp_rotation(turn * STEP)], 1))
        again = lambda q: np.repeat(np.array(q)[None], len(w), 0)
        rel = N.mul(again(s[23:27]), steps)  # attitude change since the trigger's start
        rel /= np.linalg.norm(rel, axis=1, keepdims=True)
        q = N.mul(again(s[16:20]), steps)
        ahead = np.stack([speed * STEP, np.zeros(len(w)), np.zeros(len(w))], 1)
        pos = np.array(s[13:16]) + np.cumsum(N.rotate(q, ahead), 0)
        before = np.concatenate([np.array([s[23:27]]), rel[:-1]])
        delta = np.array(s[20:23]) + np.cumsum(N.rotate(before, ahead), 0)
        s[13:16], s[16:20], s[20:23], s[23:27] = pos[-1].tolist(), q[-1].tolist(), delta[-1].tolist(), rel[-1].tolist()
        return {"t": t[~wheel], "x": pos[:, 0], "y": pos[:, 1], "z": pos[:, 2], "qx": q[:, 0], "qy": q[:, 1], "qz": q[:, 2], "qw": q[:, 3],
                "dx": delta[:, 0], "dy": delta[:, 1], "dz": delta[:, 2], "dqz": rel[:, 2]}, tuple(s)

    return _stateful(stream, key, out, state, fn, ["t", "wx", "wy", "wz", "v"])


def _running_turns(turns: np.ndarray) -> np.ndarray:
    out, gap = turns[:, 3:].copy(), 1
    while gap < len(out):
        out[gap:] = N.mul(out[:-gap], out[gap:])
        gap *= 2
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def stream_keyframes(stream: DataFrame, key: str = "vehicle_id", dist: float = 0.3, angle: float = math.radians(10),
                     always: int = 3) -> DataFrame:
    """Key frames of each vehicle: the first three, then those that moved or turned enough.

    Rows carry ``t, frame_id, x, y, yaw``.
    """
    out = "t double, frame_id long, x double, y double, yaw double, keyframe_no long"
    state = "last double, n long, x double, y double, yaw double"

    def fn(rows, old, begin):
        last, n, lx, ly, lw = old or (0.0, 0, 0.0, 0.0, 0.0)
        kept = []
        for i, (x, y, w) in enumerate(zip(*(rows[c].astype(float).tolist() for c in ("x", "y", "yaw")), strict=True)):
            turn = math.fmod(lw - w, 2 * math.pi)
            if n < always or math.hypot(lx - x, ly - y) > dist or abs(turn) > angle:
                kept.append((i, n))
                n, lx, ly, lw = n + 1, x, y, w
        at = np.array([i for i, _ in kept], dtype="int64")
        res = {c: rows[c][at] for c in ("t", "frame_id", "x", "y", "yaw")} | {"keyframe_no": np.array([k for _, k in kept], dtype="int64")}
        return res, (float(rows["t"][-1]), int(n), float(lx), float(ly), float(lw))

    return _stateful(stream, key, out, state, fn, ["t", "frame_id", "x", "y", "yaw"])


def stream_submaps(stream: DataFrame, key: str = "vehicle_id", size: int = 101) -> DataFrame:
    """Sub-map of every key frame; a new one starts when the last holds ``size`` frames.

    Also gives each frame's position seen from its sub-map's first frame.
    """
    out = "t double, frame_id long, submap_no long, local_x double, local_y double"
    state = "last double, n long, ox double, oy double, oyaw double"

    def fn(rows, old, begin):
        _, n, ox, oy, ow = old or (0.0, 0, 0.0, 0.0, 0.0)
        x, y, w = (rows[c].astype(float) for c in ("x", "y", "yaw"))
        no = n + np.arange(len(x))
        first = np.maximum.accumulate(np.where(no % size == 0, np.arange(len(x)), -1))
        use = first >= 0
        bx, by, bw = (np.where(use, v[first], o) for v, o in ((x, ox), (y, oy), (w, ow)))
        dx, dy = x - bx, y - by
        res = {"t": rows["t"], "frame_id": rows["frame_id"], "submap_no": no // size,
               "local_x": np.cos(bw) * dx + np.sin(bw) * dy, "local_y": -np.sin(bw) * dx + np.cos(bw) * dy}
        return res, (float(rows["t"][-1]), int(no[-1] + 1), float(bx[-1]), float(by[-1]), float(bw[-1]))

    return _stateful(stream, key, out, state, fn, ["t", "frame_id", "x", "y", "yaw"])


def submaps_batch(frames: DataFrame, by: Sequence[str] = TRAJ, order: str = "t", size: int = 101,
                  width: float = SLICE) -> DataFrame:
    """Batch twin of :func:`stream_submaps`."""
    d = blocked(frames, by, [order], width)
    return tidy(d.withColumn("submap_no", F.floor((F.col("_rn") - 1) / size)))


def ring_buffer(old: Sequence, new: Sequence, n: int) -> list:
    """The last ``n`` entries of a list state after new ones."""
    return list(old)[-n:] + list(new) if len(new) < n else list(new)[-n:]


def recent_frames(stream: DataFrame, n: int = 30, key: str = "vehicle_id") -> DataFrame:
    """For every frame the ids of the last ``n`` frames, itself included."""
    out = "t double, frame_id long, recent array<long>"
    state = "last double, ids array<long>"

    def fn(rows, old, begin):
        held = list(old[1]) if old else []
        ids = held + [int(i) for i in rows["frame_id"]]
        at = range(len(held) + 1, len(ids) + 1)
        res = {"t": rows["t"], "frame_id": rows["frame_id"], "recent": [ids[max(0, i - n):i] for i in at]}
        return res, (float(rows["t"][-1]), ring_buffer(held, ids[len(held):], n)[-n:])

    return _stateful(stream, key, out, state, fn, ["t", "frame_id"])


def recent_frames_batch(frames: DataFrame, n: int = 30, by: Sequence[str] = TRAJ, order: str = "t",
                        width: float = SLICE) -> DataFrame:
    """Batch twin of :func:`recent_frames`."""
    d = near(blocked(frames, by, [order], width), by, n - 1, 0,
             {"recent": lambda w: F.collect_list("frame_id").over(w.rowsBetween(-(n - 1), 0))})
    return tidy(d)


# --- loops -------------------------------------------------------------------------------

def loop_candidates(frames: DataFrame, submaps: DataFrame, r: float = 60.0, keep: int = 4) -> DataFrame:
    """For each frame the latest ``keep`` older sub-maps within ``r``.

    ``frames``: ``map_id, frame_id, submap_no, x, y``; ``submaps``: ``map_id,
    submap_no, x, y``.
    """
    s = submaps.select("map_id", F.col("submap_no").alias("older_no"), F.col("x").alias("x_2"), F.col("y").alias("y_2"))
    d = radius_join(frames, s, r, by=["map_id"], strict=True, where=F.col("submap_no") - F.col("older_no") >= 1)
    w = Window.partitionBy("map_id", "frame_id").orderBy(F.desc("older_no"))
    return (d.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= keep)
            .select("map_id", "frame_id", "submap_no", "older_no", "dist"))


def stream_loop_candidates(frames: DataFrame, submaps: Callable[[], DataFrame], sink: Callable[[DataFrame, int], None],
                           checkpoint: str, r: float = 60.0, keep: int = 4):
    """Check each trigger's frames against the sub-maps known by then."""
    def each(batch: DataFrame, epoch: int) -> None:
        sink(loop_candidates(batch, submaps(), r, keep), epoch)

    return frames.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def correct_submaps(submaps: DataFrame, edges: DataFrame, iters: int = 15) -> DataFrame:
    """New sub-map poses from chain and loop edges; the first sub-map of each map (column ``map_id``, if there) stays."""
    by = ["map_id"] if "map_id" in submaps.columns else []
    first = submaps.groupBy(*by).agg(F.min("id").alias("id")).select("id", F.lit(True).alias("fixed"))
    d = submaps.join(first, "id", "left").withColumn("fixed", F.coalesce("fixed", F.lit(False)))
    return optimise_poses(d, edges, iters)


def stream_correct_submaps(pairs: DataFrame, submaps: Callable[[], DataFrame], chain: Callable[[], DataFrame],
                           sink: Callable[[DataFrame, int], None], checkpoint: str, iters: int = 15):
    """Re-solve the sub-map graph whenever accepted pairs (edge rows) arrive."""
    def each(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            sink(correct_submaps(submaps(), chain().unionByName(batch), iters), epoch)

    return pairs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


# --- marks and health ---------------------------------------------------------------------

def stream_marks(frames: DataFrame, marks: DataFrame, horizon: str = "10 seconds", key: str = "vehicle_id") -> DataFrame:
    """Each mark with every frame of its vehicle that follows within ``horizon`` (both sides watermarked).

    ``frames``: key, ``ts, frame_id``; ``marks``: key, ``mark_ts, mark_id``.  The
    join keeps only rows inside the horizon as state; :func:`next_frame` picks
    the first frame per mark.  A mark without a frame comes with NULL once the
    watermark is past its horizon.
    """
    f = frames.select(F.col(key).alias("_k"), F.col("ts").alias("frame_ts"), "frame_id")
    on = (F.col(key) == F.col("_k")) & (F.col("frame_ts") >= F.col("mark_ts")) & (
        F.col("frame_ts") <= F.col("mark_ts") + F.expr(f"interval {horizon}"))
    return marks.join(f, on, "leftOuter").drop("_k")


def next_frame(joined: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """First following frame of every mark."""
    return joined.groupBy(key, "mark_id").agg(F.min_by("frame_id", "frame_ts").alias("frame_id"))


def marks_batch(frames: DataFrame, marks: DataFrame, by: Sequence[str] = TRAJ, width: float = SLICE) -> DataFrame:
    """Batch twin: the next frame at or after every mark."""
    return asof_forward(marks, frames, by, "t", width, "next_")


def stream_health(df: DataFrame, window: str = "10 minutes", slide: str | None = None, watermark: str | None = None,
                  by: Sequence[str] = ("vehicle_id", "topic"), ts: str = "ts", value: str = "value") -> DataFrame:
    """Counts and value range per tumbling or sliding event-time window; works on streams and tables."""
    d = df.withWatermark(ts, watermark) if watermark and df.isStreaming else df
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (d.groupBy(w.alias("_w"), *by).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"),
                                              F.min(value).alias("low"), F.max(value).alias("high"))
            .select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *by, "n", "mean", "low", "high"))


def stream_sessions(df: DataFrame, gap: str = "30 minutes", watermark: str | None = None,
                    by: Sequence[str] = ("vehicle_id",), ts: str = "ts") -> DataFrame:
    """Sessions per key: messages closer than ``gap`` belong together."""
    d = df.withWatermark(ts, watermark) if watermark and df.isStreaming else df
    return (d.groupBy(F.session_window(ts, gap).alias("_w"), *by).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *by, "n"))
