"""Explicit schemas for the grocery tables (no inference pass over large CSVs)."""

from pyspark.sql import types as T

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("eval_set", T.StringType()),
        T.StructField("order_number", T.IntegerType()),
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
        T.StructField("days_since_prior_order", T.DoubleType()),
    ]
)

ORDER_PRODUCTS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("add_to_cart_order", T.IntegerType()),
        T.StructField("reordered", T.IntegerType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("aisle_id", T.IntegerType()),
        T.StructField("department_id", T.IntegerType()),
    ]
)

DEPARTMENTS = T.StructType([T.StructField("department_id", T.IntegerType()), T.StructField("department", T.StringType())])

AISLES = T.StructType([T.StructField("aisle_id", T.IntegerType()), T.StructField("aisle", T.StringType())])

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_date", T.TimestampNTZType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.DoubleType()),
    ]
)

SCORING_REQUESTS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("recency", T.IntegerType()),
        T.StructField("frequency", T.IntegerType()),
        T.StructField("monetary", T.DoubleType()),
    ]
)

BASKET_REQUESTS = T.StructType(
    [
        T.StructField("basket_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
    ]
)

SCORED = T.StructType(
    [
        T.StructField("label", T.IntegerType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("prediction", T.DoubleType()),
    ]
)

# the grocery CSV files and their schemas
CSV_TABLES = {
    "orders": ORDERS,
    "order_products__prior": ORDER_PRODUCTS,
    "order_products__train": ORDER_PRODUCTS,
    "products": PRODUCTS,
    "departments": DEPARTMENTS,
    "aisles": AISLES,
}
