"""Features as of each cut, and the exact stratified split, against plain loops."""

import hashlib
import random
from datetime import datetime, timedelta
from fractions import Fraction
from math import ceil
from statistics import median

import pytest
from pyspark.sql import functions as F

from cartwise.operators import asof, split, transactions, windows
from cartwise.operators.split import key_hash, stratified_split
from cartwise.operators.split import test_sizes as sizes_of

START = datetime(2024, 1, 1)
LENGTHS = (20, 10, 5)


@pytest.fixture(scope="module")
def history(spark):
    r = random.Random(4)
    orders, lines = [], []
    for user in [*range(1, 9), 50]:
        days, n = 0, (1 if user == 50 else r.randint(2, 12))
        for k in range(1, n + 1):
            gap = None if k == 1 else float(r.randint(0, 15))
            days += gap or 0
            oid = user * 100 + k
            orders.append((oid, user, k, gap, days))
            lines += [(oid, user, r.choice([1, 2, 3, 4, 5]), days) for _ in range(r.randint(1, 4))]
    products = [(1, 10), (2, 10), (3, 20), (4, None), (5, 30)]
    o = spark.createDataFrame([x[:4] for x in orders], "order_id long, user_id long, order_number int, days_since_prior_order double")
    p = spark.createDataFrame(products, "product_id long, department_id int")
    lined = spark.createDataFrame([(x[0], x[2]) for x in lines], "order_id long, product_id long")
    return orders, lines, dict(products), o, lined, p


def test_as_of_features_equal_plain_loops(spark, history):
    orders, lines, dept, o, lined, p = history
    # user 3 has orders but no gaps
    dated = transactions.order_dates(o, "2024-01-01 00:00:00").withColumn("days_since_prior_order", F.expr("CASE WHEN user_id <> 3 THEN days_since_prior_order END"))
    tx = transactions.build_transactions(o, lined, anchor="2024-01-01 00:00:00")
    span = windows.date_span(tx, "transaction_date")
    samples = windows.sliding_window_rfm(tx, "transaction_date", "user_id", "product_id", "quantity", *LENGTHS, span)
    got = asof.as_of_features(samples, dated, tx, p, span, *LENGTHS).collect()
    plain = {(s.window_id, s.user_id, s.product_id): s for s in samples.collect()}
    assert len(got) == len(plain) > 100

    known = {}
    for k, user, item in plain:
        cut = (plain[k, user, item].cut_date - START).days
        gaps = [g for _, u, _, g, d in orders if u == user != 3 and d <= cut and g is not None]
        bought = [dept[i] for _, u, i, d in lines if u == user and d <= cut and dept[i] is not None]
        mine = sum(d == dept[item] for d in bought) if dept[item] is not None else 0
        known[k, user, item] = (sum(gaps) / len(gaps) if gaps else None, dept[item] or 0, mine, mine / len(bought) if dept[item] is not None and bought else 0)
    fill = median(v[0] for v in known.values() if v[0] is not None)
    assert any(v[0] is None for v in known.values())
    for f in got:
        interval, department, n, ratio = known[f.window_id, f.user_id, f.product_id]
        s = plain[f.window_id, f.user_id, f.product_id]
        assert (f.recency, f.frequency, f.label) == (s.recency, s.frequency, s.label)
        assert f.avg_days_since_prior == pytest.approx(fill if interval is None else interval)
        assert (f.department_id, f.department_frequency) == (department, n) and f.department_frequency_ratio == pytest.approx(ratio)


def test_carried_departments_give_the_same_and_samples_are_not_joined_to_products(spark, history):
    """A product of two departments and one of none; with the departments in the rows, no sample looks for its product."""
    from cartwise import session

    _, _, _, o, lined, _ = history
    p = spark.createDataFrame([(1, 10), (1, 20), (2, 10), (3, 20), (4, None)], "product_id long, department_id int")
    dated = transactions.order_dates(o, "2024-01-01 00:00:00")
    tx = transactions.build_transactions(o, lined, anchor="2024-01-01 00:00:00")
    span = windows.date_span(tx, "transaction_date")
    samples = windows.sliding_window_rfm(tx, "transaction_date", "user_id", "product_id", "quantity", *LENGTHS, span)
    want = sorted(tuple(r) for r in asof.as_of_features(samples, dated, tx, p, span, *LENGTHS).collect())

    carried = session.cut_lineage(tx.join(p, "product_id", "left"))
    items = carried.withColumn("item", F.struct("product_id", "department_id"))
    ours = session.cut_lineage(windows.sliding_window_rfm(items, "transaction_date", "user_id", "item", "quantity", *LENGTHS, span).select("*", "item.*").drop("item", "cut_date"))
    plans = []
    session.before_write.append(lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    try:
        got = asof.as_of_features(ours, dated, carried, p, span, *LENGTHS)
    finally:
        session.before_write.pop()
    session.discard(carried)  # the figures are written: nothing reads the lines any more
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100
    assert not any("Join [product_id" in x for x in plans) and len(plans) >= 3


def test_later_orders_change_nothing(spark, history):
    """The point of the operator: what happens after a cut does not reach its samples."""
    _, _, _, o, lined, p = history
    dated = transactions.order_dates(o, "2024-01-01 00:00:00")
    tx = transactions.build_transactions(o, lined, anchor="2024-01-01 00:00:00")
    span = windows.date_span(tx, "transaction_date")
    samples = windows.sliding_window_rfm(tx, "transaction_date", "user_id", "product_id", "quantity", *LENGTHS, span).where("window_id <= 2")
    late = START + timedelta(days=20 + 5 * 2)
    whole = asof.as_of_features(samples, dated, tx, p, span, *LENGTHS).collect()
    known = asof.as_of_features(samples, dated.where(dated.transaction_date <= late), tx.where(tx.transaction_date <= late), p, span, *LENGTHS).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, known)) and whole


def test_span_replaces_the_bounds(spark, history):
    tx = transactions.build_transactions(history[3], history[4], anchor="2024-01-01 00:00:00")
    args = ("transaction_date", "user_id", "product_id", "quantity", *LENGTHS)
    a, b = windows.sliding_window_rfm(tx, *args), windows.sliding_window_rfm(tx, *args, windows.date_span(tx, "transaction_date"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def hashed(*key):
    return int(hashlib.md5("|".join(["42", *["" if k is None else str(k) for k in key]]).encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("fraction", [0.2, 0.5, 0.013, 0.0, 1.0])
def test_stratified_split_is_exact(spark, fraction):
    rows = [(i, i % 7, None if i % 101 == 0 else (i % 13 == 0) + (i % 17 == 0)) for i in range(3000)] + [(-1, None, 9)]
    df = spark.createDataFrame(rows, "a long, b long, label int").repartition(4)
    got = {(r.a, r.b): (r.label, r.is_test) for r in stratified_split(df, "label", ["a", "b"], fraction).collect()}
    assert len(got) == len(rows)
    by = {}
    for a, b, y in rows:
        by.setdefault(y, []).append((hashed(a, b), (a, b)))
    sizes = sizes_of({y: len(v) for y, v in by.items()}, fraction)
    assert sum(sizes.values()) == ceil(Fraction(str(fraction)) * len(rows))
    for y, v in by.items():
        test = {key for key, (label, t) in got.items() if t and label == y}
        assert test == {key for _, key in sorted(v)[: sizes[y]]}
        assert abs(len(test) - sum(sizes.values()) * len(v) / len(rows)) < 1


def test_split_of_equal_keys_and_nothing(spark):
    df = spark.createDataFrame([(1, 0)] * 50 + [(k, 0) for k in range(2, 52)], "a long, label int")
    got = stratified_split(df, "label", ["a"], 0.5).collect()
    assert len({r.is_test for r in got if r.a == 1}) == 1  # equal keys stay together
    assert sum(r.is_test for r in got) >= 50
    assert stratified_split(df.limit(0), "label", ["a"]).count() == 0
    many = spark.range(split.MOST_STRATA + 1).selectExpr("id AS a", "id AS label")
    with pytest.raises(ValueError):
        stratified_split(many, "label", ["a"])


def test_key_hash_is_the_documented_one(spark):
    df = spark.createDataFrame([(5, None)], "a long, b string")
    assert df.select(key_hash(["a", "b"]).alias("h")).first().h == hashed(5, None)
