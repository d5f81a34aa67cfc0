"""Baskets from order lines.

Items are deduplicated per order (MLlib FP-Growth rejects repeated items), and baskets with fewer
than ``min_items`` distinct items are dropped *before* mining, so support is a share of baskets
with at least two items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.prefix import sorted_places
from cartwise.session import cut_lineage


def order_items(lines: DataFrame, order_col: str = "order_id", item_col: str = "product_id") -> DataFrame:
    """Distinct non-null ``(order_id, item)`` pairs (map-side deduplicated)."""
    require_columns(lines, [order_col, item_col], "lines")
    return (
        lines.select(F.col(order_col).alias("order_id"), F.col(item_col).alias("item"))
        .where(F.col("order_id").isNotNull() & F.col("item").isNotNull())
        .distinct()
    )


def limit_lines(lines: DataFrame, limit_rows: int | None, order_cols: tuple[str, ...] = ("order_id", "product_id")) -> DataFrame:
    """Cap the input at ``limit_rows`` lines (T2); ``None`` or 0 means all lines. The cap is taken
    over an explicit order, so the same lines are kept on every run (not an arbitrary LIMIT). Lines are counted off in
    sorted partitions, so a cap of any size is no single task's work."""
    if not limit_rows:
        return lines
    return sorted_places(lines, order_cols, "_place").where(F.col("_place") <= int(limit_rows)).drop("_place")


def baskets(lines: DataFrame, order_col: str = "order_id", item_col: str = "product_id", min_items: int = 2) -> DataFrame:
    """``order_id, items`` (sorted distinct array) for orders with at least ``min_items`` items."""
    pairs = order_items(lines, order_col, item_col)
    b = pairs.groupBy("order_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return b.where(F.size("items") >= min_items)


def mining_baskets(
    lines: DataFrame, min_support: float, order_col: str = "order_id", item_col: str = "product_id", min_items: int = 2
) -> DataFrame:
    """Baskets for rule mining with every item below the support threshold removed.

    The basket set (and so the support denominator) is exactly that of ``baskets``; only items
    that can never be frequent are dropped from the arrays, so each array is bounded by the number
    of frequent items (at most ``total items / min count``) even for a huge order. FP-Growth drops
    those items itself, so its itemsets and rules are unchanged.

    The distinct (order, item) pairs of kept orders are written once (they feed the basket count,
    the item counts and the arrays), and so is the result, which the miners read several times.
    """
    pairs = order_items(lines, order_col, item_col)
    sizes = pairs.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    kept_pairs = cut_lineage(pairs.join(sizes.where(F.col("n_items") >= min_items), "order_id", "left_semi"))
    n = kept_pairs.select(F.count_distinct("order_id")).scalar()
    min_count = F.ceil(F.lit(min_support) * n)
    frequent = kept_pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).select("item")
    # at most total items / min count rows: AQE broadcasts them when their measured bytes allow it
    trimmed = kept_pairs.join(frequent, "item", "left_semi").groupBy("order_id").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    empty = F.array().cast(trimmed.schema["items"].dataType)
    kept = kept_pairs.select("order_id").distinct()
    return cut_lineage(kept.join(trimmed, "order_id", "left").select("order_id", F.coalesce("items", empty).alias("items")))
