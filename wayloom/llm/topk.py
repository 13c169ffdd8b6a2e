"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are floored to integers, grouped by length (Euclidean norm) and packed
into blocks of at most ``block_rows`` vectors of one norm bucket. Queries are packed
into blocks as well. A first pass scores the queries against the ``probe`` longest
vectors (a bounded table) and gives each query a lower bound for its k-th score.
Then every query block meets every vector block. Within a pair of blocks the bound
becomes a local cosine threshold, ``bound / (|query| * longest vector)``:

* above 1, the whole block is skipped for that query;
* otherwise a vector must be at least ``bound / |query|`` long (length pruning, a
  binary search as blocks are sorted by length), and
* where the threshold is high, the coordinate of the query with most weight must lie
  in the interval that the threshold allows (coordinate pruning);
* surviving pairs are verified by exact products in whole numbers.

All bounds are rounded towards keeping a pair, so pruning loses nothing. Products
run in float64 where every sum stays below 2**53, else in Python integers; scores
beyond the range of long are cut to it.

Null vectors and vectors with null or non-finite components take no part. Vectors of
different dimension are not compared. Repeated rows are candidates of their own; a
query's own row is left out by id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayloom.session import ship

BLOCK = "dim int, n int, ids binary, data binary"
_LONG = (-(2**63), 2**63 - 1)


def usable(table: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """id, v (whole numbers as doubles), norm, dim of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    ok = (F.col(vector).isNotNull() & F.col(key).isNotNull()
          & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    v = F.transform(x, lambda c: _floor(c * float(scale)))
    rows = table.where(ok).select(F.col(key).cast("long").alias("id"), v.alias("v"))
    return rows.where(F.forall("v", lambda c: F.abs(c) < float("inf"))).select(
        "id", "v", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("norm"), F.size("v").alias("dim"))


def _floor(c):
    """Floor as a double; values this large are whole already."""
    return F.when(F.abs(c) < 2.0**52, F.floor(c).cast("double")).otherwise(c)


def packed(rows: DataFrame, block_rows: int = 1024, buckets_per_e: int = 8) -> DataFrame:
    """Blocks of vectors of one dimension and norm bucket, longest first inside a block.

    Each task packs the rows it holds; a norm that most rows share fills many blocks.
    """
    spread = rows.withColumn("bucket", F.when(F.col("norm") > 0, F.floor(F.log("norm") * buckets_per_e)).otherwise(-10**6))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lists = b.column(1)
            flat, off = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
            off = off - off[0]
            bucket = b.column(2).to_numpy(zero_copy_only=False)
            size = np.diff(off)
            for key in set(zip(bucket.tolist(), size.tolist(), strict=True)):
                at = np.flatnonzero((bucket == key[0]) & (size == key[1]))
                m = flat[off[at][:, None] + np.arange(key[1])] if key[1] else np.zeros((len(at), 0))
                mine = held.setdefault(key, [0, []])
                mine[0] += len(at)
                mine[1].append((ids[at], m))
                while mine[0] >= block_rows:
                    i, v = (np.concatenate(x) for x in zip(*mine[1], strict=True))
                    yield _block(key[1], i[:block_rows], v[:block_rows])
                    mine[0], mine[1] = mine[0] - block_rows, [(i[block_rows:], v[block_rows:])]
        for (_, dim), (n, parts) in held.items():
            if n:
                yield _block(dim, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    return spread.select("id", "v", "bucket").mapInArrow(pack, BLOCK)


def _block(dim: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((ids, -np.sqrt((v * v).sum(axis=1))))
    return pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
         pa.array([v[order].astype("<f8").tobytes()], pa.binary())], names=["dim", "n", "ids", "data"])


def _open(dim: int, n: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, "<f8").reshape(n, dim)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products as int64."""
    top = max(np.abs(q).max(initial=0), 1) * max(np.abs(v).max(initial=0), 1) * max(q.shape[1], 1)
    if top < 2.0**53:
        return (q @ v.T).astype(np.int64)
    a, b = [[int(c) for c in r] for r in q], [[int(c) for c in r] for r in v]
    s = [[min(max(sum(x * y for x, y in zip(r, t, strict=True)), _LONG[0]), _LONG[1]) for t in b] for r in a]
    return np.array(s, np.int64).reshape(len(a), len(b))


def search_block(qid: np.ndarray, q: np.ndarray, bound: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int,
                 coordinate_from: float = 0.8) -> list[tuple[int, int, int]]:
    """Each query's best k of one block that reach its bound, as (query, vector, score)."""
    out = []
    length = np.sqrt((v * v).sum(axis=1))  # falling
    for i in range(len(qid)):
        norm, need = float(np.sqrt(q[i] @ q[i])), bound[i]
        n, rows = len(v), None
        if need > 0:
            reach = norm * length[0] * (1 + 1e-9)
            if need > reach:
                continue  # local cosine threshold above 1
            n = int(np.searchsorted(-length, -(need / norm) * (1 - 1e-9), side="right"))
            local = need / reach
            if local >= coordinate_from and n:
                u = q[i] / norm
                f = int(np.abs(u).argmax())
                c = v[:n, f] / np.maximum(length[:n], 1e-300)
                slack = np.sqrt(max(0.0, 1 - local * local)) * np.sqrt(max(0.0, 1 - u[f] * u[f])) + 1e-9
                rows = np.flatnonzero((c >= u[f] * local - slack) & (c <= u[f] * local + slack + abs(u[f]) * (1 - local)
                                                                    + 1e-9) if u[f] >= 0 else
                                      (c <= u[f] * local + slack) & (c >= u[f] * local - slack - abs(u[f]) * (1 - local) - 1e-9))
        pick = v[:n] if rows is None else v[rows]
        if not len(pick):
            continue
        s = products(q[i: i + 1], pick)[0]
        ids = vid[:n] if rows is None else vid[rows]
        keep = np.flatnonzero((s >= need) & (ids != qid[i]))
        if len(keep) > k:
            edge = np.partition(s[keep], len(keep) - k)[len(keep) - k]
            keep = keep[s[keep] >= edge]
            keep = keep[np.lexsort((ids[keep], -s[keep]))][:k]
        out += [(int(qid[i]), int(ids[j]), int(s[j])) for j in keep]
    return out


def top_k(table: DataFrame, queries: DataFrame, k: int = 5, probe: int = 2048, block_rows: int = 1024,
          query_rows: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score. Both inputs as ``usable`` gives them."""
    spark = table.sparkSession
    longest = table.orderBy(F.desc("norm"), "id").limit(probe).collect()
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {r["dim"] for r in longest}:
        mine = [r for r in longest if r["dim"] == d]
        by_dim[d] = np.array([r["id"] for r in mine]), np.array([r["v"] for r in mine], float).reshape(len(mine), d)
    shared = spark.sparkContext.broadcast(by_dim)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Query blocks with a lower bound of each query's k-th best score."""
        for b in batches:
            rows = []
            for r in b.to_pylist():
                qid, q = _open(r["dim"], r["n"], r["ids"], r["data"])
                low = np.full(len(qid), -np.inf)
                vid, v = shared.value.get(r["dim"], (np.zeros(0), None))
                if len(vid) > k:
                    s = products(q, v).astype(float)
                    s[vid[None] == qid[:, None]] = -np.inf
                    low = np.sort(s, axis=1)[:, -k]
                    low = np.where(np.abs(low) < 2**53, low, np.nextafter(low, -np.inf))
                rows.append(r | {"low": low.astype("<f8").tobytes()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("low", pa.binary())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for r in b.to_pylist():
                qid, q = _open(r["dim"], r["qn"], r["qids"], r["qdata"])
                vid, v = _open(r["dim"], r["n"], r["ids"], r["data"])
                found += search_block(qid, q, np.frombuffer(r["low"], "<f8"), vid, v, k)
            cols = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    deals = 4 * spark.sparkContext.defaultParallelism
    blocks = packed(table, block_rows).withColumn("deal", F.pmod(F.xxhash64("ids"), F.lit(deals)))
    asked = packed(queries, query_rows).mapInArrow(bounded, BLOCK + ", low binary").select(
        "dim", F.col("n").alias("qn"), F.col("ids").alias("qids"), F.col("data").alias("qdata"), "low",
        F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"))
    # blocks against blocks: the stated query set against all rows, dealt over tasks
    hits = blocks.join(asked, ["dim", "deal"]).select(
        "dim", "n", "ids", "data", "qn", "qids", "qdata", "low").mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op7_norm_buckets(spark, sf_dir):
    ship(spark)
    table = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(table, table.where("id % 50 = 0"))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.e) = len(v.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""
