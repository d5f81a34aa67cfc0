"""Order timeline and per-user history features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.prefix import keyed_running_sum
from cartwise.functions.time import add_days

DEFAULT_ANCHOR = "2020-01-01 00:00:00"


def order_dates(orders: DataFrame, anchor: str = DEFAULT_ANCHOR) -> DataFrame:
    """``order_id, user_id, days_since_prior_order, transaction_date``: each order on the rebuilt timeline, at
    ``anchor + running sum of days_since_prior_order`` per user in ``order_number`` order (a missing gap counts 0)."""
    require_columns(orders, ["order_id", "user_id", "order_number", "days_since_prior_order"], "orders")
    gap = F.col("days_since_prior_order").cast("double")
    dated = keyed_running_sum(
        orders.where(F.col("user_id").isNotNull()).select("order_id", "user_id", "order_number", gap.alias("days_since_prior_order"), F.coalesce(gap, F.lit(0.0)).alias("gap")),
        keys=["user_id"],
        position_col="order_number",
        value="gap",
        out_col="cumulative_days",
    )
    return dated.select("order_id", "user_id", "days_since_prior_order", add_days(F.lit(anchor).cast("timestamp_ntz"), F.col("cumulative_days")).alias("transaction_date"))


def build_transactions(
    orders: DataFrame,
    prior: DataFrame,
    train: DataFrame | None = None,
    anchor: str = DEFAULT_ANCHOR,
    quantity_col: str | None = None,
) -> DataFrame:
    """Rebuild absolute dates from relative gaps.

    prior and train order lines are stacked (by name; without ``train``, ``prior`` holds all lines), joined to their order, and each order is
    dated ``anchor + running sum of days_since_prior_order`` per user in ``order_number`` order (a
    missing gap counts 0, so every user's first order sits on the anchor). ``quantity`` is 1
    unless ``quantity_col`` names a column of the lines.

    Output: ``transaction_date TIMESTAMP_NTZ, order_id, user_id, product_id, quantity DOUBLE``.
    """
    keep = ["order_id", "product_id"] + ([quantity_col] if quantity_col else [])
    lines = prior.select(*keep) if train is None else prior.select(*keep).unionByName(train.select(*keep))
    dated = order_dates(orders, anchor).select("order_id", "user_id", "transaction_date")
    quantity = F.col(quantity_col).cast("double") if quantity_col else F.lit(1.0)
    return lines.join(dated, "order_id").select(
        "transaction_date", "order_id", "user_id", "product_id", quantity.alias("quantity")
    )


def purchase_interval(orders: DataFrame) -> DataFrame:
    """Mean ``days_since_prior_order`` per user, missing gaps excluded (A6): ``user_id, avg_days_since_prior``."""
    require_columns(orders, ["user_id", "days_since_prior_order"], "orders")
    return (
        orders.where(F.col("user_id").isNotNull() & F.col("days_since_prior_order").isNotNull())
        .groupBy("user_id")
        .agg(F.avg(F.col("days_since_prior_order").cast("double")).alias("avg_days_since_prior"))
    )


def product_department(products: DataFrame) -> DataFrame:
    """Distinct ``(product_id, department_id)`` pairs."""
    require_columns(products, ["product_id", "department_id"], "products")
    return products.select("product_id", "department_id").distinct()


def department_frequency(transactions: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    """Purchases per (user, department) and their share of the user's total.

    Lines whose product has no department are dropped. Output:
    ``user_id, department_id, department, department_frequency BIGINT, department_frequency_ratio DOUBLE``.
    """
    require_columns(transactions, ["user_id", "product_id"], "transactions")
    require_columns(departments, ["department_id"], "departments")
    pd_pairs = product_department(products).where(F.col("department_id").isNotNull())
    lookup = departments.select("department_id", "department").distinct()
    counts = (
        transactions.where(F.col("user_id").isNotNull())
        .select("user_id", "product_id")
        .join(pd_pairs, "product_id")
        .groupBy("user_id", "department_id")
        .agg(F.count(F.lit(1)).alias("department_frequency"))
    )
    # one row per (user, department): a user's window holds at most #departments rows
    per_user = Window.partitionBy("user_id")
    counts = counts.withColumn(
        "department_frequency_ratio", F.col("department_frequency") / F.sum("department_frequency").over(per_user)
    )
    return counts.join(lookup, "department_id", "left").select(
        "user_id", "department_id", "department", "department_frequency", "department_frequency_ratio"
    )
