"""White-space separated text tables without a header, by field list.

A field is ``(name, type)``; the types ``pose`` and ``vec6`` span 7 and 6
columns.  Reading never infers a schema and never fails on a bad line: fields
that do not parse are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.functions import pose as P

Fields = Sequence[tuple[str, str]]
SPAN = {"pose": 7, "vec6": 6}

# The column orders of the exchanged files.
KEYFRAMES: Fields = (
    ("id", "long"), ("trajectory_id", "long"), ("t", "double"), ("gps_status", "int"), ("bag_type", "int"),
    ("heading_valid", "flag"), ("gps_inlier", "flag"), ("matching_pose", "pose"), ("matching_noise", "vec6"),
    ("dr_pose", "pose"), ("dr_noise", "vec6"), ("gps_pose", "pose"), ("gps_noise", "vec6"),
    ("stage1_pose", "pose"), ("stage2_pose", "pose"), ("degeneracy", "double"))
PATH: Fields = (("id", "long"), ("t", "double"), ("pose", "pose"), ("trajectory_id", "long"), ("gps_ok", "flag"))
PAIRS: Fields = (("id_first", "long"), ("id_second", "long"), ("pose", "pose"))
SCORES: Fields = (("x", "double"), ("y", "double"), ("score", "double"))
TRAJECTORIES: Fields = (("trajectory_id", "long"), ("part", "int"), ("file", "string"), ("is_mapping", "flag"))
MERGE_INFO: Fields = (("trajectory_id", "long"), ("vertex_type", "int"))
DEGENERACY: Fields = (("id", "long"), ("degeneracy", "double"), ("is_degenerate", "flag"))
ASSIGNMENT: Fields = (("map_id", "long"), ("x", "double"), ("y", "double"), ("z", "double"), ("id", "long"))
CHI2: Fields = (("chi2", "double"),)
RESIDUALS: Fields = tuple((f"r{i}", "double") for i in range(6))


def width(fields: Fields) -> int:
    return sum(SPAN.get(t, 1) for _, t in fields)


def lines(df: DataFrame, fields: Fields, sep: str = " ") -> DataFrame:
    """One text line per row, in column ``value``."""
    parts: list[Column] = []
    for name, kind in fields:
        c = F.col(name)
        if kind == "pose":
            parts += [c[f].cast("string") for f in P.FIELDS]
        elif kind == "vec6":
            parts += [c[i].cast("string") for i in range(6)]
        elif kind == "flag":
            parts.append(F.when(c, "1").otherwise("0"))
        else:
            parts.append(c.cast("string"))
    return df.select(F.concat_ws(sep, *[F.coalesce(p, F.lit("nan")) for p in parts]).alias("value"))


def parse(text: DataFrame, fields: Fields, col: str = "value") -> DataFrame:
    """Columns of a text table from its lines."""
    d = text.select(F.split(F.trim(F.col(col)), r"\s+").alias("_p"))
    out, at = [], 0

    def num(i, t):
        return F.get(F.col("_p"), F.lit(i)).try_cast(t)

    for name, kind in fields:
        if kind == "pose":
            c = P.make(*[num(at + i, "double") for i in range(7)])
        elif kind == "vec6":
            c = F.array(*[num(at + i, "double") for i in range(6)])
        elif kind == "flag":
            c = num(at, "int") == 1
        elif kind == "string":
            c = F.get(F.col("_p"), F.lit(at))
        else:
            c = num(at, kind)
        out.append(c.alias(name))
        at += SPAN.get(kind, 1)
    return d.select(*out)


def read(spark: SparkSession, path: str, fields: Fields) -> DataFrame:
    return parse(spark.read.text(path).filter(F.length(F.trim("value")) > 0), fields)


def write(df: DataFrame, path: str, fields: Fields, mode: str = "overwrite") -> None:
    lines(df, fields).write.mode(mode).text(path)


def read_keyframes(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, KEYFRAMES)


def write_keyframes(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write(df, path, KEYFRAMES, mode)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, PAIRS)


def write_pairs(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``mode`` is ``overwrite`` or ``append``."""
    write(df, path, PAIRS, mode)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, SCORES)


def write_scores(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write(df, path, SCORES, mode)


def read_merge_info(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, MERGE_INFO)


def write_merge_info(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write(df, path, MERGE_INFO, mode)


def read_gps_flags(spark: SparkSession, path: str) -> DataFrame:
    """Frame ids of a path file with the fixed-and-inlier flag."""
    return read(spark, path, PATH).select("id", F.col("gps_ok").alias("fixed_inlier"))


def group_trajectories(rows: DataFrame, only_validation: bool = False) -> DataFrame:
    """Trajectories with their part → file map (the first file of a part wins)."""
    d = rows.filter(~F.col("is_mapping")) if only_validation else rows
    one = d.groupBy("trajectory_id", "part").agg(F.min("file").alias("file"), F.min("is_mapping").alias("is_mapping"))
    return one.groupBy("trajectory_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("part", "file")))).alias("files"),
        F.min("is_mapping").alias("is_mapping"))


def read_trajectories(spark: SparkSession, path: str, only_validation: bool = False) -> DataFrame:
    return group_trajectories(read(spark, path, TRAJECTORIES), only_validation)


def write_trajectories(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows = df.select("trajectory_id", F.explode("files").alias("part", "file"), "is_mapping")
    write(rows, path, TRAJECTORIES, mode)


# --- derived tables that are only written ---------------------------------------

POSE_KINDS = {"matching": "matching_pose", "dr": "dr_pose", "gps": "gps_pose", "stage1": "stage1_pose",
              "stage2": "stage2_pose"}


def path_table(keyframes: DataFrame, kind: str) -> DataFrame:
    """One pose kind per frame; the flag says the fix is fixed, an inlier and, for GNSS, usable."""
    ok = (F.col("gps_status") == 4) & F.col("gps_inlier")
    return keyframes.select("id", "t", F.col(POSE_KINDS[kind]).alias("pose"), "trajectory_id", ok.alias("gps_ok"))


def score_table(pairs: DataFrame, keyframes: DataFrame, pose: str = "stage2_pose") -> DataFrame:
    """Position of each pair's first frame with the pair's score."""
    at = keyframes.select(F.col("id").alias("id_first"), F.col(f"{pose}.x").alias("x"), F.col(f"{pose}.y").alias("y"))
    return pairs.select("id_first", "score").join(at, "id_first").select("x", "y", "score")


def degeneracy_table(keyframes: DataFrame, th: float = 100.0, value: str = "degeneracy") -> DataFrame:
    return keyframes.select("id", F.col(value).alias("degeneracy"), (F.col(value) < th).alias("is_degenerate"))


def assignment_table(assignment: DataFrame, keyframes: DataFrame, pose: str = "pose") -> DataFrame:
    """Map, frame position and frame id."""
    at = keyframes.select("id", *[F.col(f"{pose}.{c}").alias(c) for c in "xyz"])
    return assignment.select("id", "map_id").join(at, "id").select("map_id", "x", "y", "z", "id")


def write_residuals(edges: DataFrame, path: str, form: str = "chi2", mode: str = "overwrite") -> None:
    """Scalar chi² or six residuals per edge."""
    if form == "chi2":
        write(edges, path, CHI2, mode)
    else:
        write(edges.select(*[F.col("residual")[i].alias(f"r{i}") for i in range(6)]), path, RESIDUALS, mode)
