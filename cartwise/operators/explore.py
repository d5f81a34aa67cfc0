"""Order and product summaries behind the exploratory report.

``orders(order_id, user_id, order_number, order_dow[, order_hour_of_day])`` and
``lines(order_id, product_id[, add_to_cart_order, reordered])`` in the grocery layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.text import unknown_name
from cartwise.functions.time import floor_div
from cartwise.operators.catalog import id_names


def orders_per_user(orders: DataFrame) -> DataFrame:
    """``user_id, n_orders``."""
    return orders.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_orders"))


def orders_per_user_distribution(orders: DataFrame) -> DataFrame:
    """How many users placed n orders: ``n_orders, n_users``."""
    return orders_per_user(orders).groupBy("n_orders").agg(F.count(F.lit(1)).alias("n_users"))


def orders_by_dow(orders: DataFrame) -> DataFrame:
    """``order_dow (0 = Sunday), n_orders``."""
    require_columns(orders, ["order_dow"], "orders")
    return orders.groupBy("order_dow").agg(F.count(F.lit(1)).alias("n_orders"))


def orders_by_hour(orders: DataFrame, hour_col: str = "order_hour_of_day") -> DataFrame:
    """``order_hour_of_day, n_orders`` (D3); ``hour_col`` may be a timestamp, its hour is taken."""
    c = F.col(hour_col)
    dtype = orders.schema[hour_col].dataType.simpleString()
    hour = F.hour(c) if dtype.startswith("timestamp") else c
    return orders.groupBy(hour.alias("order_hour_of_day")).agg(F.count(F.lit(1)).alias("n_orders"))


def top_products(lines: DataFrame, products: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` most purchased products: ``rank, product_id, product_name, n_lines``."""
    counts = lines.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count(F.lit(1)).alias("n_lines"))
    top = counts.orderBy(F.col("n_lines").desc(), F.col("product_id")).limit(n)
    ranked = top.select(F.row_number().over(Window.orderBy(F.col("n_lines").desc(), "product_id")).cast("int").alias("rank"), "*")
    return ranked.join(id_names(products), "product_id", "left").select(
        "rank", "product_id", F.coalesce("product_name", unknown_name(F.col("product_id"))).alias("product_name"), "n_lines"
    )


def department_sales(lines: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    """Order lines per department: ``department_id, department, n_lines`` (D5); lines whose
    product has no department are counted under a null department."""
    pd_pairs = products.select("product_id", "department_id").distinct()
    counts = lines.join(pd_pairs, "product_id", "left").groupBy("department_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return counts.join(departments.select("department_id", "department").distinct(), "department_id", "left").select(
        "department_id", "department", "n_lines"
    )


def with_reordered(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines plus ``user_id, order_number, reordered`` (1 when the user bought the product in an
    earlier order)."""
    j = lines.join(orders.select("order_id", "user_id", "order_number"), "order_id")
    first = j.groupBy("user_id", "product_id").agg(F.min("order_number").alias("_first"))
    return j.join(first, ["user_id", "product_id"]).withColumn(
        "reordered", (F.col("order_number") > F.col("_first")).cast("int")
    ).drop("_first")


def product_stats(lines: DataFrame, orders: DataFrame, sequence: str = "order_number") -> DataFrame:
    """``product_id, n_lines, n_orders, n_users, reorder_rate`` in one join and two aggregations.

    A line is a reorder when its customer bought the product in an earlier order (by ``sequence``): per
    (customer, product) all lines but those of the first order.
    """
    j = lines.select("order_id", "product_id").join(orders.select("order_id", "user_id", F.col(sequence).alias("_seq")), "order_id")
    per_order = j.groupBy("user_id", "product_id", "_seq").agg(F.count(F.lit(1)).alias("_n"))
    per_user = per_order.groupBy("user_id", "product_id").agg(F.sum("_n").alias("_n"), F.min_by("_n", "_seq").alias("_first"), F.count(F.lit(1)).alias("_orders"))
    return per_user.groupBy("product_id").agg(
        F.sum("_n").alias("n_lines"),
        F.sum("_orders").alias("n_orders"),
        F.count("user_id").alias("n_users"),
        (F.sum(F.col("_n") - F.col("_first")) / F.sum("_n")).alias("reorder_rate"),
    )


def reorder_rate(lines: DataFrame, products: DataFrame, n: int = 20, min_lines: int = 1, orders: DataFrame | None = None, sequence: str = "order_number") -> DataFrame:
    """Top ``n`` products by reorder rate among products with at least ``min_lines`` lines (D6):
    ``rank, product_id, product_name, n_lines, reorder_rate``. ``lines`` carries ``reordered``, or the
    customers' ``orders`` say what was bought before."""
    if orders is not None:
        stats = product_stats(lines, orders, sequence).select("product_id", "n_lines", "reorder_rate")
    else:
        require_columns(lines, ["product_id", "reordered"], "lines")
        stats = lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_lines"), F.avg(F.col("reordered").cast("double")).alias("reorder_rate"))
    order = [F.col("reorder_rate").desc(), F.col("n_lines").desc(), F.col("product_id")]
    top = stats.where(F.col("n_lines") >= min_lines).orderBy(*order).limit(n)
    ranked = top.select(F.row_number().over(Window.orderBy(*order)).cast("int").alias("rank"), "*")
    return ranked.join(id_names(products), "product_id", "left").select(
        "rank", "product_id", F.coalesce("product_name", unknown_name(F.col("product_id"))).alias("product_name"), "n_lines", "reorder_rate"
    )


SEQUENCE_CHUNK = 4096  # cart positions assembled at a time


def order_sequence_chunks(lines: DataFrame, chunk: int = SEQUENCE_CHUNK) -> DataFrame:
    """``order_id, part, products ARRAY``: each order's products in cart order, by ranges of ``chunk`` positions.

    An order is never assembled whole: a row holds the products at positions ``part * chunk`` and on, so an order
    of any length is many rows of bounded size, spread over tasks (ascending ``part`` continues the sequence; ranges
    without a line have no row). Lines without a position come first, as part -1, in chunks by product.
    """
    require_columns(lines, ["order_id", "product_id", "add_to_cart_order"], "lines")
    place = F.col("add_to_cart_order").cast("bigint")
    part = F.coalesce(floor_div(place, chunk), F.lit(-1).cast("bigint"))
    item = F.array_sort(F.collect_list(F.struct("add_to_cart_order", "product_id")))
    return lines.groupBy("order_id", part.alias("part")).agg(F.transform(item, lambda s: s["product_id"]).alias("products"))


def order_sequences(lines: DataFrame, chunk: int = SEQUENCE_CHUNK) -> DataFrame:
    """Each order as its product sequence in cart order (D7): ``order_id, products ARRAY``.

    Two levels: position ranges are sorted first (``order_sequence_chunks``), then joined in order, so a long order's lines are
    sorted in many tasks and only its finished ranges meet. One array holds at most 2^31 - 1 products; for
    longer orders take the chunks themselves.
    """
    ranges = F.array_sort(F.collect_list(F.struct("part", "products")))
    return order_sequence_chunks(lines, chunk).groupBy("order_id").agg(F.flatten(F.transform(ranges, lambda r: r["products"])).alias("products"))


def sample_orders(orders: DataFrame, fraction: float, seed: int = 42, key: str = "order_id") -> DataFrame:
    """A deterministic hash sample of orders (D8): a row is kept when the first 8 hex digits of
    ``md5(seed|key)`` fall below ``fraction * 16^8``; the same orders on any engine or rerun."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    cut = int(fraction * 16**8)
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return orders.where(h < F.lit(cut))


def product_features(lines: DataFrame, orders: DataFrame, sequence: str = "order_number") -> DataFrame:
    """Per product (D13): ``product_id, n_lines, n_orders, n_users, reorder_rate``."""
    if "reordered" not in lines.columns:
        return product_stats(lines, orders, sequence)
    r = lines.join(orders.select("order_id", "user_id"), "order_id")
    return r.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("order_id").alias("n_orders"),
        F.count_distinct("user_id").alias("n_users"),
        F.avg(F.col("reordered").cast("double")).alias("reorder_rate"),
    )


def user_features(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per user (D13): ``user_id, n_orders, n_lines, n_products, mean_basket_size`` (lines per order,
    over orders with lines)."""
    j = lines.select("order_id", "product_id").join(orders.select("order_id", "user_id"), "order_id")
    # one join: lines per (user, order) and per (user, product) are two groupings of the same rows
    per = j.select("user_id", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("order_id").alias("x")), F.struct(F.lit(1).alias("k"), F.col("product_id").alias("x")))).alias("e"))
    per = per.groupBy("user_id", "e").agg(F.count(F.lit(1)).alias("_n"))
    order, product = F.col("e.k") == 0, (F.col("e.k") == 1) & F.col("e.x").isNotNull()
    return per.groupBy("user_id").agg(
        F.count_if(order).alias("n_orders"),
        F.sum(F.when(order, F.col("_n"))).alias("n_lines"),
        F.count_if(product).alias("n_products"),
        F.avg(F.when(order, F.col("_n"))).alias("mean_basket_size"),
    )
