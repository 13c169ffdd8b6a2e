"""What the operators of this package share: words, shared tables, plain readers."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.session import ship

SPACE = r"\x20\x09-\x0D"  # the only characters that part words


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; a session without that setting gets a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = "file://" + tempfile.mkdtemp(prefix="wayloom-llm-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(key: str, n: int) -> Column:
    """Remainder of crc32 over the key written as text; a null key counts as 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n, F.lit(0))


def words(text: bytes | None) -> list[bytes]:
    """Words between blanks of ``SPACE``, A-Z in lower case (``bytes`` methods know just these)."""
    return text.lower().split() if text else []


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()
