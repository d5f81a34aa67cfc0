"""Exploratory summaries and user-product features on a hand-made order history."""

from cartwise.operators import explore
from cartwise.operators.features import user_product_features

ORDERS = [  # order_id, user_id, order_number, order_dow
    (1, 10, 1, 0), (2, 10, 2, 3), (3, 10, 3, 3),
    (4, 20, 1, 6),
]
LINES = [  # order_id, product_id, add_to_cart_order
    (1, 100, 2), (1, 200, 1),
    (2, 100, 1),
    (3, 300, 1), (3, 100, 2),
    (4, 200, 1),
]


def frames(spark):
    o = spark.createDataFrame(ORDERS, "order_id long, user_id long, order_number int, order_dow int")
    li = spark.createDataFrame(LINES, "order_id long, product_id long, add_to_cart_order int")
    p = spark.createDataFrame([(100, "milk"), (200, "bread"), (300, "eggs")], "product_id long, product_name string")
    return o, li, p


def test_counts_and_sequences(spark):
    o, li, p = frames(spark)
    assert {(r.user_id, r.n_orders) for r in explore.orders_per_user(o).collect()} == {(10, 3), (20, 1)}
    assert {(r.n_orders, r.n_users) for r in explore.orders_per_user_distribution(o).collect()} == {(3, 1), (1, 1)}
    assert {(r.order_dow, r.n_orders) for r in explore.orders_by_dow(o).collect()} == {(0, 1), (3, 2), (6, 1)}
    seq = {r.order_id: r.products for r in explore.order_sequences(li).collect()}
    assert seq == {1: [200, 100], 2: [100], 3: [300, 100], 4: [200]}
    top = [(r.rank, r.product_name, r.n_lines) for r in explore.top_products(li, p, 2).orderBy("rank").collect()]
    assert top == [(1, "milk", 3), (2, "bread", 2)]


def test_reorders_and_user_product_features(spark):
    o, li, p = frames(spark)
    r = explore.with_reordered(li, o)
    got = {(x.order_id, x.product_id, x.reordered) for x in r.collect()}
    assert (2, 100, 1) in got and (3, 100, 1) in got and (1, 100, 0) in got and (4, 200, 0) in got
    rate = {x.product_id: x.reorder_rate for x in explore.reorder_rate(r, p, 3).collect()}
    assert rate[100] == 2 / 3 and rate[200] == 0.0
    assert {x.product_id: x.reorder_rate for x in explore.reorder_rate(li, p, 3, orders=o).collect()} == rate
    flagged = {tuple(x) for x in explore.product_features(r.drop("user_id", "order_number"), o).collect()}
    assert {tuple(x) for x in explore.product_features(li, o).select("product_id", "n_lines", "n_orders", "n_users", "reorder_rate").collect()} == flagged
    up = {(x.user_id, x.product_id): x for x in user_product_features(li, o).collect()}
    milk = up[(10, 100)]
    assert (milk.up_orders, milk.up_orders_since_last_order) == (3, 0) and milk.up_order_rate == 1.0
    eggs = up[(10, 300)]
    assert eggs.up_order_rate == 1 / 3 and eggs.up_order_rate_since_first_order == 1.0
    bread = up[(10, 200)]
    assert bread.up_orders_since_last_order == 2 and bread.up_order_rate_since_first_order == 1 / 3


def test_sample_is_deterministic(spark):
    o = spark.range(2000).withColumnRenamed("id", "order_id")
    a = {r.order_id for r in explore.sample_orders(o, 0.1, 42).collect()}
    b = {r.order_id for r in explore.sample_orders(o, 0.1, 42).collect()}
    assert a == b and 120 < len(a) < 280
    assert explore.sample_orders(o, 0.0).count() == 0 and explore.sample_orders(o, 1.0).count() == 2000


def test_one_order_with_a_third_of_all_lines_is_assembled_in_ranges(spark):
    from pyspark.sql import functions as F

    from cartwise.operators.explore import order_sequence_chunks, order_sequences

    big = spark.range(30_000).select(F.lit(7).cast("bigint").alias("order_id"), (F.col("id") * 31 % 977).alias("product_id"), F.col("id").cast("int").alias("add_to_cart_order"))
    small = spark.range(60_000).select((100 + F.col("id") % 5000).alias("order_id"), F.col("id").alias("product_id"), (F.col("id") / 5000).cast("int").alias("add_to_cart_order"))
    odd = spark.createDataFrame([(1, 5, None), (1, 4, None), (1, 9, 3), (2, 8, -2), (2, 7, 0), (3, 1, 5000), (3, 2, 5000)], "order_id long, product_id long, add_to_cart_order int")
    lines = big.unionAll(small).unionAll(odd).repartition(6)
    parts = order_sequence_chunks(lines, chunk=1000)
    assert parts.agg(F.max(F.size("products"))).first()[0] <= 1000  # no row holds the order
    mine = [r.products for r in parts.where("order_id = 7").orderBy("part").collect()]
    assert len(mine) == 30 and [x for p in mine for x in p] == [i * 31 % 977 for i in range(30_000)]
    whole = {r.order_id: r.products for r in order_sequences(lines, chunk=1000).collect()}
    assert whole[7] == [i * 31 % 977 for i in range(30_000)] and whole[100] == [k * 5000 for k in range(12)]
    assert (whole[1], whole[2], whole[3]) == ([4, 5, 9], [8, 7], [1, 2])
    assert {r.order_id: r.products for r in order_sequences(lines, chunk=7).collect()} == whole
