"""Feature assembly, a small boosted-tree fit, serving-time defaults and artifacts."""

import pytest

from cartwise.operators.features import assemble_features, split_flag
from cartwise.operators.model import feature_importance, interval_median, score, train_repurchase
from cartwise.sources.artifacts import load_artifacts, save_artifacts


@pytest.fixture(scope="module")
def parts(spark):
    samples = spark.createDataFrame(
        [(k, u, p, 5 + (u * p + k) % 20, 1 + (u + k) % 3, float(1 + (u + k) % 3), int((u + p + k) % 3 == 0)) for k in range(6) for u in range(1, 8) for p in (100, 101, 102)],
        "window_id long, user_id long, product_id long, recency long, frequency long, monetary double, label int",
    )
    interval = spark.createDataFrame([(1, 3.0), (2, 10.0), (3, 4.0), (4, 8.0)], "user_id long, avg_days_since_prior double")
    products = spark.createDataFrame([(100, 1), (101, 2)], "product_id long, department_id int")
    dept = spark.createDataFrame([(1, 1, 4, 0.8), (1, 2, 1, 0.2), (2, 1, 2, 1.0)], "user_id long, department_id int, department_frequency long, department_frequency_ratio double")
    return samples, interval, products, dept


def test_assemble_features_fills(spark, parts):
    samples, interval, products, dept = parts
    f = assemble_features(samples, interval, dept, products).where("window_id = 0")
    rows = {(r.user_id, r.product_id): r for r in f.collect()}
    # users 5-7 have no interval: row-weighted median over the sample rows (users 1-4 at 3 rows each)
    assert rows[(5, 100)].avg_days_since_prior == pytest.approx(6.0)
    assert rows[(1, 102)].department_id == 0.0 and rows[(1, 102)].department_frequency == 0.0
    assert rows[(1, 101)].department_frequency_ratio == pytest.approx(0.2)
    users = assemble_features(samples, interval, dept, products, fill="users").where("user_id = 6").first()
    assert users.avg_days_since_prior == pytest.approx(6.0)


def test_split_is_deterministic(spark, parts):
    samples = parts[0]
    a = {tuple(r) for r in samples.where(split_flag(["window_id", "user_id", "product_id"])).select("window_id", "user_id", "product_id").collect()}
    b = {tuple(r) for r in samples.where(split_flag(["window_id", "user_id", "product_id"])).select("window_id", "user_id", "product_id").collect()}
    assert a == b and 0 < len(a) < samples.count()


def test_train_score_and_artifacts(spark, parts, tmp_path):
    samples, interval, products, dept = parts
    feats = assemble_features(samples, interval, dept, products)
    tr = train_repurchase(feats, maxIter=3, maxDepth=2)
    scored = tr.test_scored.collect()
    assert scored and all(0.0 <= r.probability <= 1.0 for r in scored)
    assert set(tr.metrics.columns) == {"accuracy", "precision", "recall", "f1", "auc"}
    fi = feature_importance(tr.model).collect()
    assert len(fi) == 7 and [r.importance for r in fi] == sorted((r.importance for r in fi), reverse=True)

    requests = spark.createDataFrame([(1, 100, 3, 2, 2.0), (99, 999, None, None, None)], "user_id long, product_id long, recency int, frequency int, monetary double")
    pdept = products.select("product_id", "department_id")
    out = {r.user_id: r for r in score(requests, tr.model, interval, pdept, dept, interval_median(interval)).collect()}
    unknown = out[99]
    assert (unknown.recency, unknown.frequency, unknown.monetary, unknown.department_id) == (0.0, 1.0, 1.0, 0.0)
    assert unknown.avg_days_since_prior == pytest.approx(6.0)  # user-weighted median at serving time

    root = str(tmp_path / "model_dir")
    up = feature_importance(tr.model, ascending=True).collect()
    assert [r.importance for r in up] == sorted(r.importance for r in up)
    save_artifacts(root, tr.model, tr.feature_cols, tr.metrics, interval, dept, pdept, parameters={"interval_median": interval_median(interval), "maxIter": 3})
    art = load_artifacts(spark, root)
    assert art.feature_cols == tr.feature_cols and art.interval.count() == 4 and art.median == 6.0 and art.parameters["maxIter"] == 3
    again = {r.user_id: r.probability for r in score(requests, art.model, art.interval, art.product_dept, art.dept_freq, art.median).collect()}
    assert again == pytest.approx({k: v.probability for k, v in out.items()})
    with pytest.raises(FileNotFoundError):
        load_artifacts(spark, str(tmp_path / "nothing"))


def test_nodes_give_the_models_scores_and_importances(spark, parts):
    from pyspark.sql import functions as F

    from cartwise.operators.trees import model_nodes, node_importance, node_probability

    samples, interval, products, dept = parts
    feats = assemble_features(samples, interval, dept, products)
    for params in ({"maxIter": 8, "maxDepth": 4}, {"maxIter": 1, "maxDepth": 1}, {"maxIter": 2, "maxDepth": 3, "minInstancesPerNode": 10_000}):
        tr = train_repurchase(feats, **params)
        nodes = model_nodes(tr.model, tr.feature_cols).cache()
        assert nodes.columns == ["tree", "weight", "node", "feature", "threshold", "left", "right", "value", "gain", "rows"]
        scored = tr.test_scored.select("probability", node_probability(nodes).alias("again")).collect()
        assert scored and all(r.again == pytest.approx(r.probability, abs=1e-12) for r in scored)
        want = {r.feature: r.importance for r in feature_importance(tr.model, tr.feature_cols).collect() if r.importance}
        assert {r.feature: r.importance for r in node_importance(nodes).collect()} == pytest.approx(want)
        inner = nodes.where("feature is not null").count()
        assert nodes.count() == 2 * inner + nodes.select(F.count_distinct("tree")).first()[0]  # binary trees


def test_training_rows_are_dealt_evenly(spark):
    from pyspark.sql import functions as F

    from cartwise.operators.model import dealt_evenly

    cores = spark.sparkContext.defaultParallelism
    uneven = spark.range(0, 3000, 1, 1).union(spark.range(3000, 3010, 1, 7))
    for most, parts in ((10_000, cores), (-(-3010 // (2 * cores)), 2 * cores)):
        dealt = dealt_evenly(uneven, most)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == parts and max(sizes) <= 1.2 * 3010 / parts
        assert sorted(r.id for r in dealt.collect()) == list(range(3010))


def test_rows_are_written_once_and_scored_once(spark, parts):
    from cartwise import session

    samples, interval, products, dept = parts
    written = []
    session.before_write.append(lambda df: written.append(df.columns))
    try:
        tr = train_repurchase(assemble_features(samples, interval, dept, products), maxIter=2, maxDepth=2)
    finally:
        session.before_write.pop()
    assert sum("_is_test" in c for c in written) == 1 and sum("probability" in c for c in written) == 1
    # what is read back is a scan: neither the joins nor the trees run again
    plan = tr.test_scored._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "Join" not in plan and "UDF" not in plan
    assert tr.test_scored.count() == samples.where(split_flag(["window_id", "user_id", "product_id"])).count()


def _training_rows(spark, n):
    from pyspark.sql import functions as F

    r = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000))
    share = (r(6) % 4) / (1 + r(7) % 10)
    d = spark.range(n).select(
        (r(1) % 60).cast("double").alias("recency"), (1 + r(2) % 3).cast("double").alias("frequency"), (r(3) % 50).cast("double").alias("monetary"), (r(4) / 7.0).alias("avg_days_since_prior"),
        (r(5) % 150).cast("double").alias("department_id"), F.lit(1.0).alias("department_frequency"), share.alias("department_frequency_ratio"), r(8).alias("_x"),
    )
    return d.withColumn("label", ((F.col("recency") * 10 + F.col("monetary") * 5 + F.col("_x")) > 900).cast("int")).drop("_x")


@pytest.mark.parametrize("n, whole", [(300, None), (30_000, None), (30_000, 0)])
def test_boosted_trees_are_those_of_mllib(spark, monkeypatch, n, whole):
    """Same splits, scores and importances, with all rows behind the bins or a sample, and with sums taken as differences."""
    from cartwise.operators import boosting
    from cartwise.operators.model import dealt_evenly, repurchase_estimator
    from cartwise.operators.trees import model_nodes

    if whole is not None:
        monkeypatch.setattr(boosting, "WHOLE", whole)
    t = _training_rows(spark, n).cache()
    estimator = repurchase_estimator(maxIter=4, maxDepth=4)
    want, got = estimator.fit(dealt_evenly(t)), boosting.fit_boosted(estimator, t)
    cols = estimator.getStages()[0].getInputCols()
    a, b = ([tuple(r) for r in model_nodes(m, cols).orderBy("tree", "node").collect()] for m in (want, got))
    assert len(a) == len(b) > 60
    for x, y in zip(a, b):
        assert (x[0], x[2], x[3], x[5], x[6]) == (y[0], y[2], y[3], y[5], y[6])
        assert [v for v in x if isinstance(v, float)] == pytest.approx([v for v in y if isinstance(v, float)], abs=1e-9)
    p, q = (sorted((*r.features, r.probability[1]) for r in m.transform(t).collect()) for m in (want, got))
    assert p == [pytest.approx(x, abs=1e-9) for x in q]
    assert got.stages[1].uid == want.stages[1].uid and got.stages[1].getMaxDepth() == 4
    t.unpersist()


def test_boosting_is_one_stage(spark, parts):
    """The levels of the trees are no Spark jobs: training took six a tree, now a handful in all."""
    from cartwise.operators.boosting import fit_boosted
    from cartwise.operators.model import repurchase_estimator

    t = _training_rows(spark, 2000).cache()
    t.count()
    sc = spark.sparkContext
    sc.setJobGroup("boosting", "")
    fit_boosted(repurchase_estimator(maxIter=12), t)
    jobs = len(sc.statusTracker().getJobIdsForGroup("boosting"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    t.unpersist()
    assert 0 < jobs < 40


def test_boosting_refuses_what_the_trees_cannot_use(spark):
    from pyspark.sql import functions as F

    from cartwise.operators.boosting import fit_boosted
    from cartwise.operators.model import repurchase_estimator

    t = _training_rows(spark, 200)
    for bad in (t.withColumn("monetary", F.when(F.col("recency") > 3, F.col("monetary"))), t.withColumn("label", F.lit(2))):
        with pytest.raises(Exception, match="null or NaN|labels must be"):
            fit_boosted(repurchase_estimator(maxIter=1), bad)
    assert fit_boosted(repurchase_estimator(maxIter=1), t.limit(0)) is None  # MLlib says what is wrong
    assert fit_boosted(repurchase_estimator(maxIter=1, weightCol="recency"), t) is None
