"""Every query with a SQL twin returns the same rows as DuckDB on the sf0.001 tables."""

import contextlib
import io
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_parity import digest
from cartwise import session
from cartwise.sources.testdata import TABLES

SF = os.environ.get("CARTWISE_PARITY_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    # plan shape, of the result and of everything written before it: no cross products or
    # nested-loop joins, no row-at-a-time Python
    plans = []

    def seen(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        plans.append(buf.getvalue())

    session.before_write.append(seen)
    try:
        with session.intermediates(spark):
            df = entry.queries()[name](spark, SF)
            seen(df)
            s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    finally:
        session.before_write.remove(seen)
    for plan in plans:
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert node not in plan, f"{name} plans {node}"
    res = con.execute(entry.oracle_sql()[name])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_scans_are_pruned(spark):
    buf = io.StringIO()

    def seen(df):
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")

    session.before_write.append(seen)
    try:
        with session.intermediates(spark):
            seen(entry.queries()["rfm_windows"](spark, SF))
            plan = buf.getvalue()
    finally:
        session.before_write.remove(seen)
    # the fact table once for the rows and once, keys only, for the bounds
    assert len(re.findall(r"lineitem.parquet", plan)) == 2
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_id", "cut_date", "user_id", "item", "recency", "frequency", "monetary", "label"]
    assert df.count() >= 0


def test_every_query_has_sql_or_is_a_model_query():
    missing = {q for q in set(entry.queries()) - set(entry.oracle_sql()) if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert missing == {"repurchase_scores", "feature_importance", "score_and_recommend", "model_metrics"}
