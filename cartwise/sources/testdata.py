"""Adapter from the TPC-H-style test tables to the grocery data model.

Mapping (one row each):

- orders: ``order_id = o_orderkey``, ``user_id = o_custkey``, ``order_number`` = position of the
  order in the customer's history by (order date, order key), ``days_since_prior_order`` = calendar
  days to the customer's previous order (null on the first), ``order_dow = dayofweek - 1`` (Sunday 0),
  ``eval_set`` = ``train`` for each customer's last order, ``prior`` for the rest.
- order lines: ``order_id = l_orderkey``, ``product_id = l_partkey``,
  ``add_to_cart_order = l_linenumber``, ``quantity = l_quantity``.
- products: ``product_id = p_partkey``, ``product_name = p_name``; department = ``p_type`` and
  aisle = ``p_brand``, their ids the dense rank of the name (1-based).
- scored rows: ``events`` with ``label = event_type = 'purchase'`` and
  ``probability = least(value / 500, 1)``; ``prediction = probability > 0.5``.

Per-customer positions are computed without a window over a whole customer: orders are
counted per (customer, day) first, the prefix runs over that day table (at most one row per
calendar day per customer), and the rank inside a day is split again by order-id chunks
(``keyed_row_number``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.functions.prefix import keyed_row_number
from cartwise.sources.files import read_parquet

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


class TestTables:
    """Lazy DataFrames over ``{sf_dir}/{table}.parquet`` in the grocery data model."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        base = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.to_date("o_orderdate").alias("order_day"),
        ).where(F.col("user_id").isNotNull() & F.col("order_day").isNotNull())
        per_day = base.groupBy("user_id", "order_day").agg(F.count(F.lit(1)).alias("n_day"))
        by_day = Window.partitionBy("user_id").orderBy("order_day")
        per_day = per_day.select(
            "user_id",
            "order_day",
            "n_day",
            F.coalesce(F.sum("n_day").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("n_before"),
            F.lag("order_day").over(by_day).alias("prev_day"),
            F.lead("order_day").over(by_day).isNull().alias("last_day"),
        )
        # rank inside a day, itself split into order-id chunks (no single-task (customer, day) window)
        ranked = keyed_row_number(base, ["user_id", "order_day"], "order_id", "rank_in_day")
        j = ranked.join(per_day, ["user_id", "order_day"])
        return j.select(
            "order_id",
            "user_id",
            (F.col("n_before") + F.col("rank_in_day")).cast("int").alias("order_number"),
            F.when(F.col("rank_in_day") == 1, F.date_diff("order_day", "prev_day"))
            .otherwise(F.lit(0))
            .cast("double")
            .alias("days_since_prior_order"),
            (F.dayofweek("order_day") - 1).alias("order_dow"),
            "order_day",
            F.when(F.col("last_day") & (F.col("rank_in_day") == F.col("n_day")), F.lit("train"))
            .otherwise(F.lit("prior"))
            .alias("eval_set"),
        )

    @cached_property
    def plain_orders(self) -> DataFrame:
        """``order_id, user_id, order_day, order_dow, sequence``: a projection of the orders, no positions.

        ``sequence`` orders a customer's history as ``order_number`` does (day, then order id).
        """
        day = F.to_date("o_orderdate")
        return self.raw("orders").where(F.col("o_custkey").isNotNull() & day.isNotNull()).select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            day.alias("order_day"),
            (F.dayofweek(day) - 1).alias("order_dow"),
            F.struct(day.alias("day"), F.col("o_orderkey").alias("id")).alias("sequence"),
        )

    def materialize_orders(self) -> "TestTables":
        """Write the rebuilt orders once (they feed the line split, intervals and timelines)."""
        from cartwise.session import cut_lineage

        if not self.__dict__.get("_orders_written"):
            self.__dict__["orders"] = cut_lineage(self.orders)
            self.__dict__["_orders_written"] = True
        return self

    @cached_property
    def order_lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("add_to_cart_order"),
            F.col("l_quantity").alias("quantity"),
        )

    @cached_property
    def split_lines(self) -> DataFrame:
        """Order lines with the ``eval_set`` of their order."""
        return self.order_lines.join(self.orders.select("order_id", "eval_set"), "order_id")

    def lines_of(self, eval_set: str) -> DataFrame:
        return self.split_lines.where(F.col("eval_set") == eval_set).drop("eval_set")

    @property
    def prior_lines(self) -> DataFrame:
        return self.lines_of("prior")

    @property
    def train_lines(self) -> DataFrame:
        return self.lines_of("train")

    def _dimension(self, column: str, id_col: str, name_col: str) -> DataFrame:
        names = self.raw("part").select(F.col(column).alias(name_col)).where(F.col(name_col).isNotNull()).distinct()
        # one row per distinct category name: a small dimension, ranked in one pass
        return names.select(F.dense_rank().over(Window.orderBy(name_col)).cast("int").alias(id_col), name_col)

    @cached_property
    def departments(self) -> DataFrame:
        return self._dimension("p_type", "department_id", "department")

    @cached_property
    def aisles(self) -> DataFrame:
        return self._dimension("p_brand", "aisle_id", "aisle")

    @cached_property
    def products(self) -> DataFrame:
        part = self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("department"),
            F.col("p_brand").alias("aisle"),
        )
        return (
            part.join(self.departments, "department", "left")
            .join(self.aisles, "aisle", "left")
            .select("product_id", "product_name", "aisle_id", "department_id")
        )

    @cached_property
    def name_products(self) -> DataFrame:
        """The catalog collapsed to names: ``product_id`` (the id a lookup by name returns, the
        last part with that name), ``product_name``; used where items are product names."""
        from cartwise.operators.catalog import name_index

        return name_index(self.products).select("product_id", "product_name")

    def attribute_lines(self, attribute: str) -> DataFrame:
        """Order lines with ``product_id`` replaced by an id of a part attribute:
        ``name`` -> the name's product id, ``type`` -> department_id, ``brand`` -> aisle_id."""
        part = self.raw("part").select(F.col("p_partkey").alias("product_id"), "p_name", "p_type", "p_brand")
        lines = self.order_lines.join(part, "product_id")
        if attribute == "name":
            ids = self.name_products.select(F.col("product_name").alias("p_name"), F.col("product_id").alias("attr_id"))
            j = lines.join(ids, "p_name")
        elif attribute == "type":
            j = lines.join(self.departments.select(F.col("department").alias("p_type"), F.col("department_id").cast("bigint").alias("attr_id")), "p_type")
        elif attribute == "brand":
            j = lines.join(self.aisles.select(F.col("aisle").alias("p_brand"), F.col("aisle_id").cast("bigint").alias("attr_id")), "p_brand")
        else:
            raise ValueError("attribute must be name, type or brand")
        return j.select("order_id", F.col("attr_id").alias("product_id"), "add_to_cart_order", "quantity")

    def dated_lines(self, item: str = "p_brand") -> DataFrame:
        """Order lines with the order date, the customer and an item attribute of the part:
        ``transaction_date, order_id, user_id, item, quantity`` (the raw-date transaction table)."""
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("transaction_date")
        )
        part = self.raw("part").select(F.col("p_partkey").alias("product_id"), F.col(item).alias("item"))
        return (
            self.order_lines.join(orders, "order_id")
            .join(part, "product_id")
            .select("transaction_date", "order_id", "user_id", "item", "quantity")
        )

    @cached_property
    def lined_orders(self) -> DataFrame:
        """``order_id, transaction_date`` of the orders that have a line of a known part (keys of the fact table only)."""
        part = self.raw("part").select(F.col("p_partkey").alias("product_id"))
        lined = self.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")).join(part, "product_id", "left_semi")
        orders = self.raw("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("transaction_date"))
        return orders.join(lined, "order_id", "left_semi")

    @cached_property
    def scored_events(self) -> DataFrame:
        """``(label, probability, prediction)`` rows standing in for model output."""
        ev = self.raw("events")
        p = F.least(F.col("value") / F.lit(500.0), F.lit(1.0))
        return ev.select(
            (F.col("event_type") == "purchase").cast("int").alias("label"),
            p.alias("probability"),
            (p > F.lit(0.5)).cast("double").alias("prediction"),
        ).where(F.col("probability").isNotNull())
