"""Recorded logs: message variants, app marks, file inventory, log names."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.operators.ordered import SLICE, blocked, running, row_numbers, tidy

# GPS epoch minus leap seconds, scan shift, wheel pulses per turn and wheel radius.
GPS_EPOCH = 315964800 - 18
WEEK = 7 * 24 * 3600
SCAN_SHIFT = 0.050
PULSES = 1024
WHEEL_RADIUS = 0.155


def gps_week_to_unix(week, seconds) -> Column:
    """Unix time of a GPS week and second of week."""
    return F.lit(float(GPS_EPOCH)) + F.floor(week) * float(WEEK) + seconds


def speed_to_pulses(speed) -> Column:
    """Wheel pulses per 0.1 s at a given wheel speed (m/s)."""
    return (speed * 0.1 * PULSES / (2 * math.pi * WHEEL_RADIUS)).cast("double").cast("long")


def normalise(df: DataFrame, rename: Mapping[str, str], week: str | None = None, seconds: str | None = None,
              speeds: Sequence[str] = (), shift: float = 0.0, topic: str | None = None) -> DataFrame:
    """One vendor's messages in the common schema.

    ``rename`` maps common names to the vendor's columns.  ``week``/``seconds``
    replace the stamp by GPS time, ``speeds`` (common names) are turned into
    pulses, ``shift`` is added to the stamp.
    """
    cols = []
    for out, src in rename.items():
        c = F.col(src)
        if out == "t" and week:
            c = gps_week_to_unix(F.col(week), F.col(seconds))
        if out == "t" and shift:
            c = c + shift
        if out in speeds:
            c = speed_to_pulses(c)
        cols.append(c.alias(out))
    if topic:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)


def union_messages(*dfs: DataFrame) -> DataFrame:
    """Variants together; fields a variant lacks are NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def parse_app_mark(code, is_save) -> Column:
    """``STRUCT<type, number>`` of a mark code such as ``b12``.

    A save flag of 255 marks an area of types 0–3 by letter a–d; otherwise the
    types are 4–11, two per letter, the even one for flag 0.
    """
    code, is_save = (F.col(c) if isinstance(c, str) else c for c in (code, is_save))
    letter = F.substring(code, 1, 1)
    rank = F.when(letter.isin("a", "b", "c", "d"), F.ascii(letter) - F.ascii(F.lit("a")))
    # leading digits of the rest, 0 if there are none
    number = F.coalesce(F.regexp_extract(code, r"^.\s*([+-]?\d+)", 1).try_cast("int"), F.lit(0))
    single = is_save == 255
    kind = (F.when(rank.isNull(), 255).when(single, rank)
            .otherwise(4 + 2 * rank + F.when(is_save == 0, 0).otherwise(1)))
    num = F.when(single | rank.isNull(), F.lit(255)).otherwise(number)
    return F.when((code != " ") & (F.length(code) > 0),
                  F.struct(kind.cast("int").alias("type"), num.cast("int").alias("number")))


def merge_logs(main: DataFrame, other: DataFrame, topics: Sequence[str] | None = None, reindex: bool = True,
               by: Sequence[str] = ()) -> DataFrame:
    """Two message logs as one, the other filtered by topic and moved to the main log's start.

    Start times are one aggregate row per key; the log's own start counts all
    its topics.
    """
    d = other if topics is None else other.filter(F.col("topic").isin(*topics))
    if reindex:
        starts = main.groupBy(*by).agg(F.min("t").alias("_m0"))
        own = other.groupBy(*by).agg(F.min("t").alias("_o0"))
        base = starts.join(own, list(by)) if by else starts.crossJoin(F.broadcast(own))  # one row each
        d = d.join(base, list(by)) if by else d.crossJoin(F.broadcast(base))
        d = d.withColumn("t", F.col("t") - F.col("_o0") + F.col("_m0")).drop("_m0", "_o0")
    return main.unionByName(d, allowMissingColumns=True)


# Topic endings and the topic each becomes.
TOPIC_RULES = {"ivsensorimu": "/ivsensorimu", "ivsensorgps": "/ivsensorgps",
               "velodyne_packets_1": "/velodyne_packets_1", "tpcansensor": "/ivwheelspeed"}


def remap_topics(df: DataFrame, rules: Mapping[str, str] = TOPIC_RULES) -> DataFrame:
    """Rename topics by ending; messages on other topics drop out."""
    new = None
    for end, name in rules.items():
        hit = F.col("topic").endswith(end)
        new = F.when(hit, F.lit(name)) if new is None else new.when(hit, F.lit(name))
    return df.withColumn("topic", new).filter(F.col("topic").isNotNull())


# File classes by part of the name.
FILE_CLASSES = {"db": ".db", "pcd": ".pcd", "calibration": "calibration.launch",
                "vehicle": "vehicleparams.launch", "velodyne": "velodyne.launch", "conf": ".conf"}


def classify_files(paths: DataFrame, col: str = "path", order: str = "seq",
                   classes: Mapping[str, str] = FILE_CLASSES) -> DataFrame:
    """Classes of each listed file; of equal base names only the first path counts.

    A name may belong to several classes.  Logs still being written are left out.
    """
    base = F.element_at(F.split(F.col(col), "/"), -1)
    first = paths.withColumn("name", base).groupBy("name").agg(F.min_by(col, order).alias(col), F.min(order).alias(order))
    name = F.col("name")
    log = F.when(name.contains(".bag") & ~name.contains(".active"),
                 F.when(name.contains("_V.bag"), "converted").otherwise("log"))
    tags = F.array(log, *[F.when(name.contains(part), F.lit(k)) for k, part in classes.items()])
    return first.select("name", col, order, F.explode(F.filter(tags, lambda c: c.isNotNull())).alias("class"))


def parse_log_name(path) -> Column:
    """``STRUCT<ok, name, has_part, part, time>`` of a converted log's path.

    ``…/ConvertData/NAME[_ENFORCE][_DIGITS…][_partN…]_V.bag``, NAME starting with
    ``d``, ``z`` or a comma.  The name is split at ``_`` once, and its end is read
    token by token: parts, digits, the flag; what is left is NAME.
    """
    c = F.col(path) if isinstance(path, str) else path
    base = F.regexp_replace(F.element_at(F.split(c, "/ConvertData/"), -1), "^/+", "")
    toks = F.split(base, "_")
    back = F.reverse(F.slice(toks, 1, F.greatest(F.size(toks) - 1, F.lit(0))))
    start = F.struct(F.lit(0).alias("phase"), F.lit(0).alias("parts"), F.lit(0).alias("digits"), F.lit(0).alias("flag"))

    def step(a, tok):
        part = (a["phase"] == 0) & tok.rlike(r"^part\d*$")
        digit = (a["phase"] <= 1) & tok.rlike(r"^\d*$")
        flag = (a["phase"] <= 2) & (tok == "ENFORCE")
        return F.struct(F.when(part, 0).when(digit, 1).when(flag, 3).otherwise(4).alias("phase"),
                        (a["parts"] + part.cast("int")).alias("parts"), (a["digits"] + digit.cast("int")).alias("digits"),
                        (a["flag"] + flag.cast("int")).alias("flag"))

    end = F.aggregate(back, start, step)
    used = end["parts"] + end["digits"] + end["flag"]
    ok = (c.contains("/ConvertData/") & base.rlike("^[d,z]") & F.element_at(toks, -1).rlike("^V.bag$") & (F.size(back) > used))
    numbered = F.filter(F.slice(back, 1, end["parts"]), lambda x: x != "part")
    stamp = F.when(end["digits"] > 0, F.get(back, end["parts"]))
    return F.when(ok, F.struct(
        F.lit(True).alias("ok"), F.array_join(F.slice(toks, 1, F.greatest(F.size(back) - used, F.lit(0))), "_").alias("name"),
        (end["parts"] > 0).alias("has_part"),
        F.coalesce(F.substring(F.get(numbered, F.lit(0)), 5, 1000).try_cast("int"), F.lit(0)).alias("part"),
        F.when(stamp.rlike(r"^\d+$"), stamp.cast("double")).otherwise(F.lit(-1.0)).alias("time")))


def assign_trajectories(files: DataFrame, by: Sequence[str] = (), width: float = SLICE * 24) -> DataFrame:
    """Trajectory number per file: in time order, a part file joins the trajectory before it.

    Of files with equal time the first by path counts.
    """
    keys = list(by) or ["_site"]
    d = files if by else files.withColumn("_site", F.lit(0))
    one = d.filter(F.col("time") >= 0).groupBy(*keys, "time").agg(F.min_by(F.struct("path", "has_part", "part"), "path").alias("_f"))
    one = one.select(*keys, "time", "_f.*")
    d = blocked(one, keys, ["time"], width)
    starts = F.when(F.col("has_part") & (F.col("_rn") > 1), 0).otherwise(1)
    d = running(d, keys, {"_n": starts.cast("long")})
    part = F.when(F.col("has_part"), F.col("part") + 1).otherwise(0)
    return tidy(d.select("*", (F.col("_n") - 1).alias("trajectory_id"), part.alias("part_no"))).drop("_n", "_site", "part")


def assign_by_name(files: DataFrame, order: str = "seq", name: str = "name", width: float = 1e6) -> DataFrame:
    """Trajectory number per base name, in order of first appearance."""
    first = files.groupBy(name).agg(F.min(order).cast("double").alias("_first")).withColumn("_site", F.lit(0))
    nums = row_numbers(first, ["_site"], ["_first"], width, "_rn")
    return files.join(nums.select(name, (F.col("_rn") - 1).alias("trajectory_id")), name)


def admission_report(files: DataFrame, rules: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Found and required counts per file class, and whether the rule holds.

    ``rules`` lists ``class, required``; a class without files counts zero.
    """
    n = files.groupBy(*by, "class").agg(F.count(F.lit(1)).alias("found"))
    if by:
        sites = files.select(*by).distinct()
        rules = sites.crossJoin(rules)  # every site has to meet every rule
    d = rules.join(n, [*by, "class"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return d.withColumn("ok", F.col("found") >= F.col("required"))


def list_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only the key columns, so that column pruning skips the payload."""
    return df.select(*cols)
