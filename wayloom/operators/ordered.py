"""Windows over long ordered sequences, without one task per sequence.

A trajectory may hold a large share of all rows, so no operator here lets one
task see a whole trajectory.  Rows are first cut into *slices* of the order
column (a stretch of time whose row count the sensor rate bounds), numbered in
two levels, and then regrouped in *blocks* of equal row count:

* ``blocked``      adds ``_rn`` (1-based row number) and ``_block``;
* ``near``         evaluates bounded row frames, with a halo of neighbour rows
                   copied into the adjoining blocks;
* ``running``      cumulative sums, block sums carried over block summaries;
* ``carried``      last non-null value so far, carried the same way.

Only block summaries (one row per block) are ever sorted per whole trajectory.
Partition keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 50_000
SLICE = 3600.0


def _before(by, order):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _so_far(by, order):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def slice_of(order: str | Column, width: float) -> Column:
    """Number of the order-column slice a row lies in."""
    c = F.col(order) if isinstance(order, str) else order
    return F.floor(c.cast("double") / F.lit(float(width)))


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], width: float = SLICE,
                name: str = "_rn") -> DataFrame:
    """Exact 1-based row number per key: local number plus rows in earlier slices."""
    by = list(by)
    d = df.withColumn("__slice", slice_of(order[0], width))
    keys = [*by, "__slice"]
    totals = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    starts = totals.select(
        *keys, F.coalesce(F.sum("__n").over(_before(by, ["__slice"])), F.lit(0)).alias("__start"))
    local = d.withColumn("__local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return (local.join(starts, keys)
            .withColumn(name, F.col("__local") + F.col("__start"))
            .drop("__slice", "__local", "__start"))


def blocked(df: DataFrame, by: Sequence[str], order: Sequence[str], width: float = SLICE,
            block: int = BLOCK) -> DataFrame:
    """Add ``_rn`` and ``_block`` (``block`` rows of one key per block)."""
    return row_numbers(df, by, order, width).withColumn(
        "_block", F.floor((F.col("_rn") - 1) / F.lit(block)))


def near(df: DataFrame, by: Sequence[str], before: int, after: int,
         exprs: Mapping[str, Callable[[Window], Column]], block: int = BLOCK) -> DataFrame:
    """Evaluate window expressions that look at most ``before``/``after`` rows away.

    ``df`` comes from :func:`blocked` (same ``block``).  Each callable gets the
    ordered window and may narrow it with ``rowsBetween``.
    """
    if max(before, after) >= block:
        raise ValueError("halo must be smaller than a block")
    at = F.col("_rn") - 1
    home = F.floor(at / F.lit(block))
    lo = F.greatest(F.lit(0), F.floor((at - after) / F.lit(block)))
    hi = F.floor((at + before) / F.lit(block))
    copies = df.withColumn("__home", home).withColumn("_block", F.explode(F.sequence(lo, hi)))
    w = Window.partitionBy(*by, "_block").orderBy("_rn")
    out = copies.select("*", *[fn(w).alias(name) for name, fn in exprs.items()])
    return out.filter(F.col("_block") == F.col("__home")).drop("__home")


def running(df: DataFrame, by: Sequence[str], sums: Mapping[str, Column],
            block_col: str = "_block", order: Sequence[str] = ("_rn",)) -> DataFrame:
    """Cumulative sums up to and including each row, exact across blocks."""
    by, keys = list(by), [*by, block_col]
    d = df.select("*", *[v.alias(f"_v_{k}") for k, v in sums.items()])
    totals = d.groupBy(*keys).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    starts = totals.select(*keys, *[
        F.sum(f"_t_{k}").over(_before(by, [block_col])).alias(f"_s_{k}") for k in sums])
    local = d.select("*", *[F.sum(f"_v_{k}").over(_so_far(keys, list(order))).alias(f"_l_{k}") for k in sums])
    out = local.join(starts, keys)
    for k in sums:
        out = out.withColumn(k, F.when(F.col(f"_s_{k}").isNull(), F.col(f"_l_{k}"))
                             .when(F.col(f"_l_{k}").isNull(), F.col(f"_s_{k}"))
                             .otherwise(F.col(f"_l_{k}") + F.col(f"_s_{k}")))
    return out.drop(*[f"_{p}_{k}" for k in sums for p in "vsl"])


def carried(df: DataFrame, by: Sequence[str], values: Mapping[str, Column],
            block_col: str = "_block", order: Sequence[str] = ("_rn",)) -> DataFrame:
    """Last non-null value at or before each row, exact across blocks."""
    by, keys = list(by), [*by, block_col]
    d = df.select("*", *[v.alias(f"_v_{k}") for k, v in values.items()])
    place = F.struct(*order)
    lasts = d.groupBy(*keys).agg(*[
        F.max_by(F.col(f"_v_{k}"), F.when(F.col(f"_v_{k}").isNotNull(), place)).alias(f"_t_{k}")
        for k in values])
    starts = lasts.select(*keys, *[
        F.last(f"_t_{k}", True).over(_before(by, [block_col])).alias(f"_s_{k}") for k in values])
    local = d.select("*", *[F.last(f"_v_{k}", True).over(_so_far(keys, list(order))).alias(f"_l_{k}")
                            for k in values])
    out = local.join(starts, keys)
    for k in values:
        out = out.withColumn(k, F.coalesce(f"_l_{k}", f"_s_{k}"))
    return out.drop(*[f"_{p}_{k}" for k in values for p in "vsl"])


def running_by_slice(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: Mapping[str, Column],
                     width: float = SLICE) -> DataFrame:
    """Cumulative sums straight on time slices (no row numbers needed)."""
    d = df.withColumn("_slice", slice_of(order[0], width))
    return running(d, by, sums, "_slice", order).drop("_slice")


def runs(df: DataFrame, by: Sequence[str], value: Column, name: str = "run_id",
         block: int = BLOCK) -> DataFrame:
    """Number maximal runs of equal ``value`` (gaps and islands) on a blocked frame."""
    d = df.withColumn("_rv", F.struct(value.alias("v")))
    d = near(d, by, 1, 0, {"_pv": lambda w: F.lag("_rv").over(w)}, block)
    changed = F.when(F.col("_pv").isNull() | ~F.col("_pv.v").eqNullSafe(F.col("_rv.v")), 1).otherwise(0)
    return running(d, by, {name: changed.cast("long")}).drop("_rv", "_pv")


def tidy(df: DataFrame) -> DataFrame:
    """Drop the block bookkeeping."""
    return df.drop("_rn", "_block")


def order_statistics(df: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, Column],
                     bins_per_octave: int = 64) -> DataFrame:
    """Elements of the sorted list at given 0-based positions, per key.

    ``shares[name]`` maps the row-count column ``n`` to the wanted position.  No
    group is sorted whole: equal values are counted first, value counts are
    summed into logarithmic bins, and only the bin that holds the position is
    looked into.
    """
    by = list(by)
    x = F.col(value).cast("double")
    mag = F.floor(F.log2(F.greatest(F.abs(x), F.lit(1e-12))) * bins_per_octave)
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*by, x.alias("_x")).agg(F.count(F.lit(1)).alias("_c")))
    x = F.col("_x")
    mag = F.floor(F.log2(F.greatest(F.abs(x), F.lit(1e-12))) * bins_per_octave)
    shift = 64 * bins_per_octave
    counts = counts.withColumn("_bin", F.when(x >= 0, mag + shift).otherwise(-(mag + shift)))
    bins = counts.groupBy(*by, "_bin").agg(F.sum("_c").alias("_bc"))
    upto = _so_far(by, ["_bin"])
    whole = Window.partitionBy(*by)
    bins = bins.select(*by, "_bin", "_bc", F.sum("_bc").over(upto).alias("_cum"),
                       F.sum("_bc").over(whole).alias("n"))
    want = bins.select(*by, "_bin", "n", (F.col("_cum") - F.col("_bc")).alias("_start"), "_cum",
                       F.explode(F.map_from_arrays(
                           F.array(*[F.lit(k) for k in shares]),
                           F.array(*[p(F.col("n")).cast("long") for p in shares.values()]))).alias("_name", "_pos"))
    want = want.filter((F.col("_start") <= F.col("_pos")) & (F.col("_pos") < F.col("_cum")))
    inside = counts.join(want.select(*by, "_bin", "_name", "_pos", "_start"), [*by, "_bin"])
    inside = inside.withColumn(
        "_upto", F.col("_start") + F.sum("_c").over(_so_far([*by, "_bin", "_name"], ["_x"])))
    hit = inside.filter((F.col("_upto") > F.col("_pos")) & (F.col("_upto") - F.col("_c") <= F.col("_pos")))
    picks = [F.max(F.when(F.col("_name") == k, F.col("_x"))).alias(k) for k in shares]
    return hit.groupBy(*by).agg(*picks)
