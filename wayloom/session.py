"""Session settings and lineage cutting shared by the whole library."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wayloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small tables, many cores: keep one task per core instead of merging small partitions
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        # call-site capture costs a stack walk per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WAYLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without that setting gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = "file://" + tempfile.mkdtemp(prefix="wayloom-tables-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there.

    A checkpoint would hand on the estimated size of its plan, and that estimate multiplies at every join: after
    some rounds of an iteration planning takes longer than the work.  A written table has its true size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._wayloom_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the table behind the result of :func:`cut`; whoever cut it knows that nothing reads it any more."""
    path = getattr(df, "_wayloom_path", None)
    if path is None:
        return
    jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(jsc.hadoopConfiguration()).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Workers import it wherever they run; nothing needs to be installed there.
    """
    sc = spark.sparkContext
    if getattr(sc, "_wayloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="wayloom-package-")) / "wayloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path("wayloom") / f.relative_to(root))
    sc.addPyFile(str(archive))
    sc._wayloom_shipped = True
