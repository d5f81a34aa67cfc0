"""Two-level running sums, exact median, and the rebuilt order timeline."""

import random
from datetime import datetime

import pandas as pd
import pytest

from cartwise.functions.prefix import global_running_totals, keyed_running_sum
from cartwise.functions.selection import exact_median, exact_quantile
from cartwise.operators.transactions import build_transactions, department_frequency, purchase_interval


def test_global_running_totals_ascending_descending_ties(spark):
    rnd = random.Random(7)
    data = [(rnd.choice([0.0, 0.1, 0.25, 0.25, 0.5, 0.9, 1.0, 3.5]), rnd.randint(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(data, "s double, v long")
    for desc, rng in ((False, None), (True, None), (False, (0.0, 1.0)), (True, (0.0, 1.0))):
        got = {(r.s, r.cum_v) for r in global_running_totals(df, "s", ["v"], descending=desc, buckets=4, value_range=rng).collect()}
        exp = set()
        for s, _ in data:
            exp.add((s, sum(v for t, v in data if (t >= s if desc else t <= s))))
        assert got == exp


def test_global_running_totals_clustered_values(spark):
    # nearly all distinct values inside one narrow range: equal-count buckets still split them
    data = [(0.5 + i * 1e-9, 1) for i in range(500)] + [(0.0, 1), (1.0, 1)]
    df = spark.createDataFrame(data, "s double, v long")
    out = global_running_totals(df, "s", ["v"], buckets=8)
    got = sorted((r.s, r.cum_v) for r in out.collect())
    assert got == [(s, i + 1) for i, (s, _) in enumerate(sorted(data))]


def test_keyed_running_sum_small_chunks(spark):
    data = [(u, n, float(n % 3)) for u in (1, 2) for n in range(1, 40)]
    df = spark.createDataFrame(data, "u long, n int, g double")
    got = {(r.u, r.n, r.c) for r in keyed_running_sum(df, ["u"], "n", "g", "c", chunk=4).collect()}
    exp = {(u, n, float(sum(m % 3 for m in range(1, n + 1)))) for u, n, _ in data}
    assert got == exp


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0, 3.0, 10.0], [5.0, 1.0, 1.0, 2.0, 9.0], [2.5, 2.5, 7.0, None], [1.0, float("nan"), 4.0]])
def test_exact_median_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_median(df, "x").collect()[0]["median"]
    assert got == pytest.approx(pd.Series(values, dtype="float64").median())


def test_exact_median_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_median(df, "x").collect()[0]["median"] is None


def test_exact_quantiles_through_every_round(spark):
    import random

    from cartwise import session

    r = random.Random(2)
    columns = {
        "clustered": [r.gauss(0, 1) * 10 ** r.randint(-8, 8) for _ in range(6000)],
        "ties": [float(r.choice([1, 1, 1, 2, 5, 5, 9])) for _ in range(5000)] + [None, float("nan")] * 5,
        "two": [1.0] * 2500 + [2.0] * 2500,
        "far": [1e300, -1e300] + [0.0, -0.0] * 700 + [r.random() for _ in range(999)],
    }
    writes = []
    session.before_write.append(writes.append)
    try:
        for name, values in columns.items():
            df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
            real = pd.Series([v for v in values if v is not None]).dropna()
            for q in (0.0, 0.001, 0.25, 0.5, 0.731, 0.999, 1.0):
                want = real.quantile(q)
                assert exact_quantile(df, "x", q, gather=3) == want or exact_quantile(df, "x", q, gather=3) == pytest.approx(want, rel=1e-12), (name, q)
    finally:
        session.before_write.remove(writes.append)
    assert not writes  # nothing is written on the way
    assert exact_quantile(spark.range(7).selectExpr("id * 1000000000000 AS x"), "x") == 3e12
    with pytest.raises(ValueError):
        exact_quantile(df, "x", 1.5)


def test_timeline_fractional_and_missing_gaps(spark):
    orders = spark.createDataFrame(
        [(10, 1, 1, None), (11, 1, 2, 1.5), (12, 1, 3, None), (20, 2, 1, None), (21, 2, 2, 7.0)],
        "order_id long, user_id long, order_number int, days_since_prior_order double",
    )
    prior = spark.createDataFrame([(10, 100), (11, 100), (20, 300)], "order_id long, product_id long")
    train = spark.createDataFrame([(12, 101), (21, 300), (99, 1)], "order_id long, product_id long")
    tx = build_transactions(orders, prior, train)
    got = {(r.order_id, r.transaction_date) for r in tx.collect()}
    d0 = datetime(2020, 1, 1)
    assert got == {(10, d0), (11, datetime(2020, 1, 2, 12)), (12, datetime(2020, 1, 2, 12)), (20, d0), (21, datetime(2020, 1, 8))}
    assert {r.quantity for r in tx.collect()} == {1.0}
    pi = {r.user_id: r.avg_days_since_prior for r in purchase_interval(orders).collect()}
    assert pi == {1: 1.5, 2: 7.0}


def test_department_frequency_unmatched_product(spark):
    tx = spark.createDataFrame([(1, 100), (1, 100), (1, 101), (1, 999), (2, 101)], "user_id long, product_id long")
    products = spark.createDataFrame([(100, 1), (101, 2), (102, None)], "product_id long, department_id int")
    departments = spark.createDataFrame([(1, "produce"), (2, "dairy")], "department_id int, department string")
    got = {(r.user_id, r.department, r.department_frequency, round(r.department_frequency_ratio, 6)) for r in department_frequency(tx, products, departments).collect()}
    assert got == {(1, "produce", 2, round(2 / 3, 6)), (1, "dairy", 1, round(1 / 3, 6)), (2, "dairy", 1, 1.0)}


def test_keyed_row_number_small_chunks(spark):
    from cartwise.functions.prefix import keyed_row_number

    data = [(k, i) for k in (1, 2) for i in range(0, 60, 3)]
    df = spark.createDataFrame(data, "k long, o long")
    got = {(r.k, r.o, r.rn) for r in keyed_row_number(df, ["k"], "o", "rn", chunk=7).collect()}
    assert got == {(k, o, o // 3 + 1) for k, o in data}
