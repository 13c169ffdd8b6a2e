"""Exact deduplication against a minimal perfect hash of known digests.

A text's digest is SHA-256 of its UTF-8 bytes without blanks (space, tab to carriage return).
Of equal texts the row with the most code points stays, then the smallest key (null
last), then, among rows alike in both, one of them.

Rows are *historical* or *arriving*. Historical rows fold to one per digest, and every part of the
digest space gets a minimal perfect hash over its digests: per level a bit table in which a
digest keeps a bit that no other wants, the rest going on to the next level; a
digest's slot is the number of set bits before its own. Slots hold the full digest and
the locator of the winner. Arriving rows fold per digest too, meet the index of their part
and are compared with the digest in their slot byte by byte, since a hash of this kind sends unknown
digests to some slot as well. Members are repeats of that slot's text, the others are
groups among themselves.

A part holds about ``part_size`` digests whatever the table's size. Copies fold in the tasks that read
them, so a group of copies is one row per task. Answers go back to all rows by a join on the
digest; groups of at least a ``hot``-th of all rows, of which there can be no more than ``hot``,
are answered from a broadcast, so no shuffled key has more than a ``hot``-th of the rows.

Null texts count as empty (one group with all blank texts); repeated rows are rows of their own, of which
at most one stays; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import crc_mod, documents, stored

BLANKS = " \t\n\x0b\x0c\r"
_LEVELS = 40


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = a ^ (b * np.uint64(2 * level + 1)) ^ np.uint64((level * 0x9E3779B97F4A7C15) % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class MinimalHash:
    """Numbers ``n`` distinct 32-byte digests from 0 to n - 1; about 3 bits each besides the digests."""

    def __init__(self, tables: list[np.ndarray], left: list[bytes]):
        self.tables = tables  # True where one digest alone wants a place
        self.base = np.cumsum([0] + [int(t.sum()) for t in tables])
        self.rank = [np.cumsum(t, dtype=np.int64) - t for t in tables]
        self.left = {d: int(self.base[-1]) + i for i, d in enumerate(left)}

    @staticmethod
    def words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.ascontiguousarray(digests).view("<u8")
        return w[:, 1], w[:, 2]

    @classmethod
    def build(cls, digests: np.ndarray, gamma: float = 1.5) -> MinimalHash:
        a, b = cls.words(digests)
        rest, tables = np.arange(len(digests)), []
        while len(rest) and len(tables) < _LEVELS:
            m = int(gamma * len(rest)) + 1
            at = (_mixed(a[rest], b[rest], len(tables)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            tables.append(alone)
            rest = rest[~alone[at]]
        return cls(tables, sorted(digests[i].tobytes() for i in rest))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of every known digest; an unknown one gets any slot, or -1."""
        a, b = self.words(digests)
        out, rest = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for k, t in enumerate(self.tables):
            at = (_mixed(a[rest], b[rest], k) % np.uint64(len(t))).astype(np.int64)
            hit = t[at]
            out[rest[hit]] = self.base[k] + self.rank[k][at[hit]]
            rest = rest[~hit]
        if self.left:
            out[rest] = [self.left.get(digests[i].tobytes(), -1) for i in rest]
        return out

    def packed(self) -> bytes:
        buf = io.BytesIO()
        left = np.frombuffer(b"".join(self.left), np.uint8)
        np.savez(buf, left=left, sizes=np.array([len(t) for t in self.tables], np.int64),
                 bits=np.concatenate([np.packbits(t) for t in self.tables] or [np.zeros(0, np.uint8)]))
        return buf.getvalue()

    @classmethod
    def opened(cls, data: bytes) -> MinimalHash:
        z = np.load(io.BytesIO(data))
        tables, at, left = [], 0, z["left"].tobytes()
        for n in z["sizes"].tolist():
            k = -(-n // 8)
            tables.append(np.unpackbits(z["bits"][at: at + k], count=n).astype(bool))
            at += k
        return cls(tables, [left[i: i + 32] for i in range(0, len(left), 32)])


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def digested(docs: DataFrame, historic: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, row number, digest, order of preference, and whether it is historical."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), F.unhex(F.sha2(F.translate(t, BLANKS, "").cast("binary"), 256)).alias("digest"),
                       (-F.length(t)).cast("long").alias("short"), F.col(key).isNull().alias("last"), historic.alias("old"),
                       F.monotonically_increasing_id().alias("row"))


def folded(rows: DataFrame, parts: int) -> DataFrame:
    """One row per digest: part, locator of the row that stays (first in this order), number of rows."""
    return rows.groupBy("digest").agg(F.min(F.struct("short", "last", "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("size")).withColumn(
        "part", F.pmod(F.crc32("digest"), F.lit(parts)).cast("int"))


def index(known: DataFrame, parts: int) -> DataFrame:
    """part, hash (packed tables), digests (by slot), locators (a packed table by slot)."""
    def build(t: pa.Table) -> pa.Table:
        d = _digests(t["digest"])
        h = MinimalHash.build(d)
        order = np.argsort(h.slots(d))
        sink = pa.BufferOutputStream()
        at = t.select(["best", "size"]).take(pa.array(order)).combine_chunks()
        with pa.ipc.new_stream(sink, at.schema) as w:
            w.write_table(at)
        return pa.table({"part": t["part"].slice(0, 1), "hash": pa.array([h.packed()], pa.binary()),
                         "digests": pa.array([d[order].tobytes()], pa.binary()), "locators": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return known.groupBy("part").applyInArrow(build, "part int, hash binary, digests binary, locators binary")


def looked_up(found: DataFrame, arriving: DataFrame) -> DataFrame:
    """One row per digest of either side: what the index has (old_best, old_size) and what arrives (best, size)."""
    best = arriving.schema["best"].dataType.simpleString()
    kind = f"digest binary, old_best {best}, old_size long, best {best}, size long"

    def look(known: pa.Table, new: pa.Table) -> pa.Table:
        k, here, d = len(new), len(known) > 0, _digests(new["digest"])
        own = new.select(["best", "size"]).combine_chunks()
        if not here:
            none = own.slice(0, 0)
            at, rest, slots = np.full(k, -1), np.zeros(0, np.int64), np.zeros((0, 32), np.uint8)
        else:
            slots = np.frombuffer(known["digests"][0].as_py(), np.uint8).reshape(-1, 32)
            none = pa.ipc.open_stream(known["locators"][0].as_py()).read_all().combine_chunks()
            at = MinimalHash.opened(known["hash"][0].as_py()).slots(d)
            at[(at < 0) | (slots[at] != d).any(axis=1)] = -1  # byte by byte
            rest = np.setdiff1d(np.arange(len(slots)), at)
        pick = pa.array(np.r_[at, rest], mask=np.r_[at < 0, np.zeros(len(rest), bool)])
        mine = pa.array(np.arange(k + len(rest)), mask=np.arange(k + len(rest)) >= k)
        every = np.concatenate([d, slots[rest]])
        return pa.table({"digest": pa.array([r.tobytes() for r in every], pa.binary()), "old_best": none["best"].take(pick),
                         "old_size": none["size"].take(pick), "best": own["best"].take(mine), "size": own["size"].take(mine)})

    return found.groupBy("part").cogroup(arriving.groupBy("part")).applyInArrow(look, kind)


def deduplicate(docs: DataFrame, historic: Column, part_size: int = 1 << 18, hot: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, known (the text is in the historical rows): one row per row of ``docs``."""
    rows = stored(digested(docs, historic, key, text))
    total = rows.count()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // part_size)
    old = stored(index(folded(rows.where("old"), parts), parts))
    met = looked_up(old, folded(rows.where("not coalesce(old, false)"), parts))
    size = F.coalesce("size", F.lit(0)) + F.coalesce("old_size", F.lit(0))
    answers = stored(met.withColumn("b", F.least("best", "old_best")).select(
        "digest", F.col("b.doc_id").alias("keep_id"), F.col("b.row").alias("keep_row"), size.alias("group_size"), F.col("old_size").isNotNull().alias("known")))
    large = F.col("group_size") * hot >= total
    few = F.broadcast(answers.where(large))  # at most ``hot`` rows
    out = rows.join(few, "digest").unionByName(
        rows.join(few.select("digest"), "digest", "left_anti").join(answers.where(~large), "digest"))
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"), "known")


def op13_perfect_hash(spark, sf_dir):
    """Half the documents, by a hash of the key, stand for the historical ones."""
    return deduplicate(documents(spark, sf_dir), crc_mod("doc_id", 2) == 0).drop("known")


OP13_SQL = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
w AS (SELECT *, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS place, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d
      WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM w"""
