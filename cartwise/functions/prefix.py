"""Skew-safe running sums.

A window with no ``partitionBy`` (or one keyed by a hot user) puts every row in one task.
These helpers split the work in two levels instead:

* ``global_running_totals``: rows are cut into ``buckets`` ranges of the order key (equal-count
  by default); bucket totals (at most ``buckets`` rows, a proven bound) get the global prefix,
  the exact prefix inside each bucket runs in parallel, and the small offset table is broadcast.
* ``keyed_running_sum``: a per-key running sum by an integer position is split into chunks
  of ``chunk`` positions; chunk totals (``positions / chunk`` rows per key) carry the offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import cut_lineage



def global_running_totals(
    df: DataFrame,
    order_col: str,
    value_cols: Sequence[str],
    descending: bool = False,
    buckets: int = 4096,
    prefix: str = "cum_",
    value_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Add ``{prefix}{v}``: the sum of ``v`` over all rows whose order value comes at or
    before this row's (ties included), in ascending or descending order of ``order_col``.
    Rows with a null order value are dropped.

    Buckets are equal-count by default: approximate quantiles of the order value (MLlib's
    ``QuantileDiscretizer``, one pass) split the rows so that no bucket holds much more than
    ``rows / buckets`` of them even when the values cluster; pass ``df`` with one row per distinct
    value (group first) so that ties never pile into one bucket. With ``value_range`` the buckets
    are equal-width over that range instead (no extra pass; values outside fall into the edge
    buckets). Either way the bucket index is monotone in the value, which keeps the prefix exact.
    """
    key = F.col(order_col).cast("double")
    d = df.where(F.col(order_col).isNotNull()).withColumn("_rk", -key if descending else key)
    if value_range is None and d.isEmpty():
        d = d.withColumn("_bk", F.lit(0))  # nothing to split
    elif value_range is None:
        # NaN (ordered last by Spark) gets the extra top bucket
        disc = QuantileDiscretizer(
            inputCol="_rk", outputCol="_bkd", numBuckets=buckets, relativeError=1.0 / (4 * buckets), handleInvalid="keep"
        )
        d = disc.fit(d).transform(d).withColumn("_bk", F.col("_bkd").cast("int")).drop("_bkd")
    else:
        lo_v, hi_v = (-value_range[1], -value_range[0]) if descending else value_range
        lo, hi = F.lit(float(lo_v)), F.lit(float(hi_v))
        span = hi - lo
        raw = F.floor((F.col("_rk") - lo) / span * F.lit(buckets))
        bucket = F.when(span > 0, F.least(F.greatest(raw, F.lit(0)), F.lit(buckets - 1)))
        d = d.withColumn("_bk", F.coalesce(bucket, F.lit(0)).cast("int"))

    totals = d.groupBy("_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    before = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # <= buckets rows
    offsets = totals.select(
        "_bk", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in value_cols]
    )
    upto = Window.partitionBy("_bk").orderBy("_rk").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = d.select("*", *[F.sum(v).over(upto).alias(f"_i_{v}") for v in value_cols])
    out = inside.join(F.broadcast(offsets), "_bk")
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.col(f"_i_{v}"))
    drop = ["_rk", "_bk"] + [f"_o_{v}" for v in value_cols] + [f"_i_{v}" for v in value_cols]
    return out.drop(*drop)


def keyed_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    position_col: str,
    value: Column | str,
    out_col: str,
    chunk: int = 4096,
) -> DataFrame:
    """Running sum of ``value`` per ``keys`` ordered by an integer ``position_col`` (rows
    unbounded preceding to current). A key with millions of rows is split into chunks of
    ``chunk`` positions, so no task holds a whole hot key.
    """
    keys = list(keys)
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("_val", v).withColumn("_chunk", F.floor(F.col(position_col) / F.lit(chunk)).cast("bigint"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(position_col).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_in", F.sum("_val").over(within))
    chunk_totals = d.groupBy(*keys, "_chunk").agg(F.sum("_val").alias("_ct"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunk_offsets = chunk_totals.select(*keys, "_chunk", F.coalesce(F.sum("_ct").over(earlier), F.lit(0)).alias("_off"))
    out = d.join(chunk_offsets, [*keys, "_chunk"], "left")
    return out.withColumn(out_col, F.col("_off") + F.col("_in")).drop("_val", "_chunk", "_in", "_off")


def keyed_row_number(df: DataFrame, keys: Sequence[str], order_col: str, out_col: str, chunk: int = 1 << 20) -> DataFrame:
    """``row_number()`` per ``keys`` ordered by an integer column with distinct values per key,
    without a window over a whole key: rows are cut into chunks of ``chunk`` consecutive values,
    chunk row counts (one row per non-empty chunk) carry the offset, and the rank inside a chunk
    runs per (key, chunk), at most ``chunk`` rows.
    """
    keys = list(keys)
    d = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk)).cast("bigint"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(order_col)
    d = d.withColumn("_rn", F.row_number().over(within))
    counts = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_cn"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_chunk", F.coalesce(F.sum("_cn").over(earlier), F.lit(0)).alias("_off"))
    out = d.join(offsets, [*keys, "_chunk"])
    return out.withColumn(out_col, F.col("_off") + F.col("_rn")).drop("_chunk", "_rn", "_off")


def sorted_places(df: DataFrame, order_cols: Sequence[str], out_col: str) -> DataFrame:
    """``out_col``: each row's place (from 1) in the order of the columns, without one task that holds all rows.

    Rows are sorted by range and written once; a partition's places start after the rows of the partitions before it.
    Rows equal in all order columns stand in any order.
    """
    cols = list(df.columns)
    placed = cut_lineage(
        df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols).select("*", F.monotonically_increasing_id().alias("_at")).withColumn("_part", F.shiftright("_at", 33))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(starts, "_part").select(*[F.col(f"`{c}`") for c in cols], place.cast("bigint").alias(out_col))
