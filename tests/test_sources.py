"""File scans and sinks: CSV with declared schemas, parsed dates, Parquet/JSON/CSV round trips."""

from datetime import datetime

import pytest

from cartwise.operators.baskets import limit_lines
from cartwise.sources.files import read_grocery_csv, read_table, read_transactions_csv, write_table


def test_grocery_csv_with_schema(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
        "1,10,prior,1,2,8,\n2,10,train,2,3,9,7.0\n"
    )
    o = read_grocery_csv(spark, str(tmp_path), "orders")
    assert dict(o.dtypes)["days_since_prior_order"] == "double" and dict(o.dtypes)["order_id"] == "bigint"
    assert [r.days_since_prior_order for r in o.orderBy("order_id").collect()] == [None, 7.0]


def test_transactions_csv_parses_dates(spark, tmp_path):
    p = tmp_path / "tx.csv"
    p.write_text("transaction_date,order_id,user_id,product_id,quantity\n2020-01-01,1,10,5,1\n2020-01-02 12:00:00,2,10,6,1\n")
    t = read_transactions_csv(spark, str(p))
    assert dict(t.dtypes)["transaction_date"] == "timestamp_ntz"
    assert [r.transaction_date for r in t.orderBy("order_id").collect()] == [datetime(2020, 1, 1), datetime(2020, 1, 2, 12)]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_round_trip_and_missing_path(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, name string")
    path = str(tmp_path / f"t_{fmt}")
    write_table(df, path, fmt)
    back = read_table(spark, path, fmt, schema=df.schema if fmt != "parquet" else None)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "absent"), fmt)


def test_limit_lines_is_deterministic(spark):
    lines = spark.createDataFrame([(o, p) for o in range(5) for p in range(3)], "order_id long, product_id long")
    assert limit_lines(lines, 0).count() == 15
    got = sorted(tuple(r) for r in limit_lines(lines, 4).collect())
    assert got == [(0, 0), (0, 1), (0, 2), (1, 0)]
    many = spark.range(20_000).selectExpr("(id * 7919) % 20000 AS order_id", "id AS product_id").repartition(7)
    cap = limit_lines(many, 12_345)
    assert sorted(r.order_id for r in cap.select("order_id").collect()) == list(range(12_345))
    assert limit_lines(many, 50_000).count() == 20_000 and limit_lines(many.limit(0), 5).count() == 0


def test_rejects_and_good_rows_add_up(spark, tmp_path):
    from cartwise.sources import schemas
    from cartwise.sources.files import ingest_csv

    head = "transaction_date,order_id,user_id,product_id,quantity"
    good = ["2020-01-01,1,10,5,1", "2020-01-02 12:00:00,2,10,6,2.5", "2020-01-03,3,,7,"]
    bad = ["2020-13-01,4,10,5,1", "2020-01-01,x,10,5,1", "2020-01-01,6,10,5,many", "2020-01-01,7,10", "2020-01-01,8,10,5,1,9", '"2020-01-01,9,10,5,1', "nonsense"]
    missing = ["2020-01-01,,10,5,1", ",11,10,5,1"]
    for i, part in enumerate([good[:2] + bad[:3], bad[3:] + good[2:] + missing, []]):
        (tmp_path / f"p{i}.csv").write_text("\n".join([head, *part]) + "\n")
    ok, rejects = ingest_csv(spark, str(tmp_path / "*.csv"), schemas.TRANSACTIONS, required=["order_id", "transaction_date"], timestamp_format="yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]")
    assert ok.schema == schemas.TRANSACTIONS
    assert sorted((r.order_id, r.user_id, r.quantity) for r in ok.collect()) == [(1, 10, 1.0), (2, 10, 2.5), (3, None, None)]
    # what is read later does not decide a row's fate
    assert ok.select("user_id").count() == 3 and ok.where("quantity > 2").count() == 1 and rejects.select("reason").count() == 9
    got = rejects.collect()
    assert sorted(r.record for r in got if r.reason == "malformed") == sorted(bad)
    assert {(r.reason, r.record) for r in got if r.reason != "malformed"} == {("missing order_id", "2020-01-01 00:00:00,,10,5,1.0"), ("missing transaction_date", ",11,10,5,1.0")}
    assert {r.file.rsplit("/", 1)[1] for r in got} == {"p0.csv", "p1.csv"}


def test_rejects_of_a_clean_and_an_empty_file(spark, tmp_path):
    from cartwise.sources import schemas
    from cartwise.sources.files import ingest_csv

    (tmp_path / "a.csv").write_text("1,x\n")
    (tmp_path / "b.csv").write_text("")
    for name, n in (("a", 1), ("b", 0)):
        ok, rejects = ingest_csv(spark, str(tmp_path / f"{name}.csv"), schemas.AISLES, out=str(tmp_path / f"out_{name}"), header=False)
        assert (ok.count(), rejects.count()) == (n, 0)
