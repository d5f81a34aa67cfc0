"""What grows with the input is shuffled once and read by many tasks: plans and files of small inputs."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from cartwise.functions.selection import weighted_median
from cartwise.operators.features import assemble_features, mba_features
from cartwise.operators.model import repurchase_estimator
from cartwise.operators.recommend import recommend
from cartwise.operators.windows import sliding_window_rfm
from cartwise.session import cut_lineage


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


RULES = "rule_id long, antecedent array<long>, consequent array<long>, support double, confidence double, lift double"


def test_window_copies_are_not_shuffled(spark):
    df = spark.range(200).selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) AS t", "id % 5 AS u", "id % 3 AS i", "1.0D AS amt")
    plan = executed(sliding_window_rfm(df, "t", "u", "i", "amt", 60, 30, 15))
    plan = "\n".join(x for x in plan.splitlines() if not x.lstrip().startswith(":"))  # without the subqueries
    assert "Generate" in plan and "Exchange" not in plan[: plan.index("Generate")]


def test_samples_are_joined_once(spark):
    samples = spark.createDataFrame([(k, u, p, 1, 1, 1.0, 0) for k in range(3) for u in (1, 2, None) for p in (1, 2, None)], "window_id long, user_id long, product_id long, recency long, frequency long, monetary double, label int")
    interval = spark.createDataFrame([(1, 4.0)], "user_id long, avg_days_since_prior double")
    products = spark.createDataFrame([(1, 7), (1, 8), (2, None)], "product_id long, department_id int")  # an id with two departments
    dept = spark.createDataFrame([(1, 7, 3, 0.5)], "user_id long, department_id int, department_frequency long, department_frequency_ratio double")
    out = assemble_features(samples, interval, dept, products)
    node = out._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    assert "Join" not in node.children().head().toString()
    got = sorted((r.user_id or 0, r.product_id or 0, r.department_id, r.department_frequency, r.avg_days_since_prior) for r in out.where("window_id = 0").collect())
    assert got == sorted((u, p, d, 3.0 if (u, d) == (1, 7) else 0.0, 4.0) for u in (0, 1, 2) for p in (0, 1, 2) for d in ((7.0, 8.0) if p == 1 else (0.0,)))


@pytest.mark.parametrize("seed", range(4))
def test_weighted_median_counts_every_row(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice([None, float("nan"), *map(float, range(9))]), r.randint(0, 4)) for _ in range(r.choice([1, 2, 40]))]
    every = [x for x, n in rows for _ in range(n) if x is not None and x == x]
    got = weighted_median(spark.createDataFrame(rows, "x double, n long"), "x", "n")
    assert got == (median(every) if every else None)


def test_matches_are_hashed_and_stay_with_their_basket(spark):
    rules = spark.createDataFrame([(1, [1], [2], 0.2, 0.5, 2.0), (2, [1], [3], 0.1, 0.3, 1.2), (3, [3], [2], 0.1, 0.4, 1.1)], RULES)
    items = spark.createDataFrame([(1, 1), (1, 3), (2, 1)], "user_id long, product_id long")
    best = mba_features(items, rules)
    assert "SortAggregate" not in executed(best)
    assert sorted(tuple(r) for r in best.collect()) == [(1, 2, 2.0, 0.5, 2), (1, 3, 1.2, 0.3, 1), (2, 2, 2.0, 0.5, 1), (2, 3, 1.2, 0.3, 1)]
    names = spark.createDataFrame([(2, "p2")], "product_id long, product_name string")
    many = spark.range(20000).selectExpr("id AS basket_id", "id % 3 + 1 AS product_id")
    moved = [x for x in executed(recommend(many, cut_lineage(rules), names, 3)).splitlines() if "Exchange hashpartitioning(basket_id" in x]
    assert len(moved) == 1 and "REPARTITION_BY_NUM" in moved[0]


def test_nodes_are_found_in_the_tree():
    assert repurchase_estimator().getStages()[-1].getCacheNodeIds() is False


def test_rejects_are_written_as_they_are_parsed(spark, tmp_path):
    from pyspark.sql import types as T

    from cartwise.sources.files import ingest_csv

    (tmp_path / "a.csv").write_text("1,x\nno,y\n2,z\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    good, bad = ingest_csv(spark, str(tmp_path / "a.csv"), schema, out=str(tmp_path / "out"), header=False)
    assert sorted(r.n for r in good.collect()) == [1, 2] and [r.record for r in bad.collect()] == ["no,y"]
    assert not [p for p in (tmp_path / "out").iterdir() if p.is_dir()]  # a folder per value would sort each task's rows first


def test_the_inbox_has_as_many_files_as_tasks(spark, tmp_path, monkeypatch):
    import cartwise.streaming
    from cartwise.plans.queries import QUERIES

    day = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int))")
    spark.range(40).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), day.alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(120).selectExpr("id % 40 AS l_orderkey", "id % 9 AS l_partkey", "cast(id % 4 as int) AS l_linenumber", "1.0D AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(9).selectExpr("id AS p_partkey", "concat('n', id) AS p_name", "concat('t', id % 3) AS p_type", "concat('b', id % 2) AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    seen = {}

    def start(spark, inbox, *args, max_files, **kwargs):
        seen.update(files=len(spark.read.parquet(inbox).inputFiles()), max_files=max_files)
        raise InterruptedError

    monkeypatch.setattr(cartwise.streaming, "start_scoring_stream", start)
    with pytest.raises(InterruptedError):
        QUERIES["stream_scores"](spark, str(tmp_path))
    assert seen == {"files": 8, "max_files": 4}
