"""Mixing sources to target weights by a low-discrepancy source schedule.

Slot ``i`` of the mix holds one block of ``block`` words and goes to the source
whose share of [0, 1) holds the ``i``-th golden-ratio point. Those points fill
every interval evenly, so each source gets its share of slots to within a few
blocks, at every length of the mix. Slots of a source are ranked, and the
``r``-th slot takes the ``r``-th block of the source's words, its documents laid
end to end in hash order and repeated ``max_repeats`` times at most.

Positions come from two-level sums (per source and hash bucket, then inside a
bucket), so a source that holds most rows spreads over all tasks. A block is at most
``MOST_BLOCK`` words and at most a ``LEAST_BLOCKS``-th of the smallest positive target (one
word at least), so the number of slots grows with the corpus and a small source is
met as closely in a large mix as in a small one. What a document gives follows from
the number of its source's slots.

Null texts count as empty, null sources form one source of their own (sorted
last), repeated rows are separate documents, an empty table gives no rows. Columns
beyond key, text and source are ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.llm.common import SPACE, documents, stored

GOLDEN = 0.6180339887498949
CELLS = 1024
MOST_BLOCK, LEAST_BLOCKS = 64, 256
CHUNK = 1 << 18  # slots whose points come from one product; ranks are counted per chunk


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: key, ``skey`` (source, null last), ``h`` (shuffle order), ``size``."""
    return docs.select(
        F.col(key).alias("doc_id"),
        F.when(F.col(source).isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), F.col(source))).alias("skey"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("h"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("t"),
        word_count(F.col(text)).alias("size"),
    )


def source_targets(sizes: DataFrame, max_repeats: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets per source: shares by weight of all words, at most ``max_repeats`` times the source's size.

    Sources sorted by cap over weight are capped from the front; the level of the
    rest follows from sums before and after, so no rounds are needed. Input has a
    row per source (``skey``, ``source_size``), so the global windows are small.
    """
    by_name, by_cap = Window.orderBy("skey"), Window.orderBy("ratio", "skey")
    n = len(weights)
    rank = F.row_number().over(by_name) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % n + 1).cast("int"))
    cap = (F.col("source_size") * max_repeats).cast("double")
    s = sizes.select("skey", "source_size", w.alias("w"), cap.alias("cap")).withColumn("ratio", F.col("cap") / F.col("w"))
    total = F.sum(F.col("source_size").cast("double")).over(Window.partitionBy())
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level_here", (total - before) / left)
    level = F.min(F.when(F.col("level_here") <= F.col("ratio"), F.struct("ratio", "skey", "level_here"))).over(
        Window.partitionBy())["level_here"]
    s = s.withColumn("level", level)
    return s.select("skey", "source_size",
                    F.when(F.col("ratio") < F.col("level"), F.col("cap")).otherwise(F.col("level") * F.col("w"))
                    .alias("target"), total.cast("long").alias("total"))


def resolution(targets: DataFrame, slots: int = 1 << 18) -> tuple[int, int]:
    """Words of a block, and the number of slots; ``slots`` is what a small corpus is cut into."""
    r = targets.agg(F.max("total"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    total, least = r[0] or 0, r[1] or 0.0
    block = max(1, min(-(-total // slots), MOST_BLOCK, int(least // LEAST_BLOCKS)))
    return block, -(-total // block)


def placed(targets: DataFrame, n: int) -> DataFrame:
    """``slot`` and ``skey`` of ``n`` slots: an equi-join on a cell of [0, 1) and a test inside the cell."""
    spark = targets.sparkSession
    total = F.sum("target").over(Window.partitionBy())
    upto = F.sum("target").over(Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shares = targets.where("target > 0").select(
        "skey", ((upto - F.col("target")) / total).alias("lo"), (upto / total).alias("hi"))
    shares = shares.select("*", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    # a product of all of a large slot number would round off what tells small shares apart
    far = float(Decimal(CHUNK) * ((Decimal(5).sqrt() - 1) / 2) % 1)
    point = (F.col("id") % CHUNK + 0.5) * GOLDEN
    ahead = F.floor(F.col("id") / CHUNK) * far
    point = point - F.floor(point) + ahead - F.floor(ahead)
    points = spark.range(n).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * CELLS))
    return points.join(shares, "cell").where("lo <= u and u < hi").select("slot", "skey")


def schedule(targets: DataFrame, slots: int = 1 << 18) -> DataFrame:
    """Slots in order: ``slot``, ``skey``, ``rank`` among the source's slots, ``block`` (words)."""
    block, n = resolution(targets, slots)
    s = placed(targets, n).withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    base = s.groupBy("skey", "chunk").agg(F.count(F.lit(1)).alias("n"))
    base = base.select("skey", "chunk", (F.sum("n").over(Window.partitionBy("skey").orderBy("chunk")) - F.col("n")).alias("base"))
    inside = F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("slot")) - 1
    return s.withColumn("inside", inside).join(base, ["skey", "chunk"]).select(
        "slot", "skey", F.lit(block).cast("long").alias("block"), (F.col("inside") + F.col("base")).cast("long").alias("rank"))


def mix(docs: DataFrame, max_repeats: int = 3, weights: tuple[int, ...] = (1, 2, 3), slots: int = 1 << 18,
        bucket_digits: int = 3, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Words the mix takes of every document: doc_id, size, source_size, target, taken.

    The scheduled slots of a source, by rank, meet the blocks of its laid words by an equi-join: what a document gives is
    the part of its words in the blocks that slots take, summed over the repeats.
    """
    rows = sized(docs, key, text, source).withColumn("bucket", F.substring("h", 1, bucket_digits))
    parts = stored(rows.groupBy("skey", "bucket").agg(F.sum("size").alias("part")))
    targets = stored(source_targets(parts.groupBy("skey").agg(F.sum("part").alias("source_size")), max_repeats, weights))
    plan = schedule(targets, slots)
    block, _ = resolution(targets, slots)
    inside = Window.partitionBy("skey", "bucket").orderBy("h", "size", "t")
    parts = parts.select("skey", "bucket", (F.sum("part").over(Window.partitionBy("skey").orderBy("bucket")) -
                                            F.col("part")).alias("base"))
    laid = rows.select("doc_id", "skey", "bucket", "size",
                       (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) -
                        F.col("size")).alias("at"))
    # what a source has goes to its buckets first, so no source meets in one task
    laid = laid.join(parts.join(targets, "skey"), ["skey", "bucket"])
    laid = stored(laid.select(F.monotonically_increasing_id().alias("row"), "doc_id", "skey", "size", "source_size", "target",
                              (F.col("at") + F.col("base")).alias("begin")))
    # first and one past the last word in every repeat, then a row per block that these words reach into
    lap = laid.where("size > 0").select("row", "skey", "size", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda k: F.col("begin") + k * F.col("source_size"))).alias("lo"))
    held = lap.select("row", "skey", "lo", (F.col("lo") + F.col("size")).alias("hi"), F.explode(F.sequence(
        F.floor(F.col("lo") / block), F.floor((F.col("lo") + F.col("size") - 1) / block))).alias("rank"))
    met = held.join(plan.select("skey", "rank", "block"), ["skey", "rank"])
    words = F.least("hi", (F.col("rank") + 1) * F.col("block")) - F.greatest("lo", F.col("rank") * F.col("block"))
    taken = met.groupBy("row").agg(F.sum(words).alias("taken"))
    return laid.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op10_source_schedule(spark, sf_dir):
    return mix(documents(spark, sf_dir))


OP10_SQL = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS skey,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h, md5(coalesce(text, '')) AS t,
         CAST(coalesce(len(regexp_extract_all(text, '[^{SPACE}]+')), 0) AS BIGINT) AS size FROM documents),
s0 AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
s1 AS (SELECT *, CAST((row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS DOUBLE) AS w,
       CAST(source_size * 3 AS DOUBLE) AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s0),
s2 AS (SELECT *, cap / w AS ratio FROM s1),
s3 AS (SELECT *, (CAST(total AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY ratio, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       / sum(w) OVER (ORDER BY ratio, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here FROM s2),
s4 AS (SELECT *, (SELECT here FROM s3 WHERE here <= ratio ORDER BY ratio, skey LIMIT 1) AS level FROM s3),
s5 AS (SELECT skey, source_size, total, greatest(1, CAST(ceil(total / {1 << 18}) AS BIGINT)) AS block,
       CASE WHEN ratio < level THEN cap ELSE level * w END AS target FROM s4),
share AS (SELECT *, (upto - target) / whole AS lo, upto / whole AS hi FROM (
  SELECT *, sum(target) OVER () AS whole, sum(target) OVER (ORDER BY skey ROWS UNBOUNDED PRECEDING) AS upto
  FROM s5 WHERE target > 0)),
pts AS (SELECT i, (i + 0.5::DOUBLE) * {GOLDEN}::DOUBLE AS p FROM range({1 << 18}) r(i)),
plan AS (SELECT skey, row_number() OVER (PARTITION BY skey ORDER BY i) - 1 AS rank
  FROM pts, share WHERE lo <= p - floor(p) AND p - floor(p) < hi AND i * block < total),
n AS (SELECT skey, count(*) AS n FROM plan GROUP BY skey),
laid AS (SELECT doc_id, d.skey, size, source_size, target, block, coalesce(n, 0) AS n,
  sum(size) OVER (PARTITION BY d.skey ORDER BY h, size, t ROWS UNBOUNDED PRECEDING) - size AS pos
  FROM d JOIN s5 USING (skey) LEFT JOIN n USING (skey))
SELECT doc_id, size, source_size, target, CAST(
  greatest(0, least(size, n * block - pos)) + greatest(0, least(size, n * block - pos - source_size))
  + greatest(0, least(size, n * block - pos - 2 * source_size)) AS BIGINT) AS taken FROM laid
"""
