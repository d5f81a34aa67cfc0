"""The scoring stream end to end over request files."""

from cartwise.operators.features import assemble_features
from cartwise.operators.model import train_repurchase
from cartwise.operators.rules import number_rules
from cartwise.sources.artifacts import load_artifacts, save_artifacts
from cartwise.streaming import REQUEST_SCHEMA, start_scoring_stream


def test_scoring_stream(spark, tmp_path):
    samples = spark.createDataFrame(
        [(k, u, p, (u + k) % 9, 1 + (u + p) % 3, 1.0, int((u + p + k) % 2 == 0)) for k in range(4) for u in range(1, 6) for p in (1, 2, 3)],
        "window_id long, user_id long, product_id long, recency long, frequency long, monetary double, label int",
    )
    interval = spark.createDataFrame([(1, 3.0), (2, 5.0)], "user_id long, avg_days_since_prior double")
    products = spark.createDataFrame([(1, "apple", 1), (2, "pear", 1), (3, "milk", 2)], "product_id long, product_name string, department_id int")
    dept = spark.createDataFrame([(1, 1, 3, 0.75), (1, 2, 1, 0.25)], "user_id long, department_id int, department_frequency long, department_frequency_ratio double")
    pdept = products.select("product_id", "department_id")
    tr = train_repurchase(assemble_features(samples, interval, dept, products), maxIter=2, maxDepth=2)
    rules = number_rules(
        spark.createDataFrame([([1], [2], 0.2, 0.5, 2.0), ([1], [3], 0.1, 0.3, 1.2)], "antecedent array<long>, consequent array<long>, support double, confidence double, lift double")
    )
    root = str(tmp_path / "artifacts")
    save_artifacts(root, tr.model, tr.feature_cols, tr.metrics, interval, dept, pdept, rules, products.select("product_id", "product_name"))
    art = load_artifacts(spark, root)

    inbox = tmp_path / "requests"
    spark.createDataFrame([(1, 1, 1, None, 2, 3, 3.0), (2, 9, 3, None, None, None, None), (3, 2, None, "APP", None, None, None)], REQUEST_SCHEMA).write.parquet(str(inbox / "part1"))
    q = start_scoring_stream(spark, str(inbox / "*"), art, str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = {r.request_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {1, 2, 3}
    assert got[3].product_id == 1 and got[3].recommendations == ["pear", "milk"] and got[3].probability_text.endswith("%")
    assert got[1].recommendations == ["pear", "milk"] and got[2].recommendations == []
    assert all(0.0 <= r.probability <= 1.0 for r in got.values())


def test_batches_pin_versions_and_repeats_are_dropped(spark, tmp_path):
    """Features only: each micro-batch takes the newest version whole; a request id is answered once."""
    from datetime import datetime, timedelta

    from cartwise.streaming import TIMED_REQUEST_SCHEMA

    root, inbox, out, state = (str(tmp_path / x) for x in ("artifacts", "requests", "out", "state"))
    pdept = spark.createDataFrame([(1, 1)], "product_id long, department_id int")
    dept = spark.createDataFrame([(1, 1, 3, 0.75)], "user_id long, department_id int, department_frequency long, department_frequency_ratio double")

    def save(v):
        interval = spark.createDataFrame([(1, float(v))], "user_id long, avg_days_since_prior double")
        save_artifacts(root, None, None, None, interval, dept, pdept, parameters={"interval_median": 100.0 + v})

    def ask(name, ids, minute):
        at = datetime(2024, 1, 1, 12) + timedelta(minutes=minute)
        rows = [(i, i % 2 + 1, 1, None, None, None, None, at) for i in ids]
        spark.createDataFrame(rows, TIMED_REQUEST_SCHEMA).coalesce(1).write.parquet(f"{inbox}/{name}")

    def go():
        q = start_scoring_stream(spark, f"{inbox}/*", root, out, state, available_now=True, dedupe_within="1 hour", with_model=False, max_files=1)
        q.awaitTermination(120)

    save(1)
    ask("a", [0, 1, 2, 2], 0)
    go()
    save(2)
    ask("b", [1, 2, 3, 4, 5], 10)
    go()
    got = {r.request_id: r for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == len(got) == 6
    assert {i: got[i].version for i in got} == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 2}
    # user 1 (even ids) is known, user 2 takes the median: both from the version that the batch pinned
    assert {i: got[i].avg_days_since_prior for i in got} == {0: 1.0, 1: 101.0, 2: 1.0, 3: 102.0, 4: 2.0, 5: 102.0}


def test_request_ids_are_kept_on_disk(spark, tmp_path):
    """The state of repeated ids is no table in memory, and the session's own settings are left as they were."""
    from datetime import datetime, timedelta

    from cartwise.streaming import TIMED_REQUEST_SCHEMA

    root, inbox = str(tmp_path / "artifacts"), str(tmp_path / "requests")
    figures = spark.createDataFrame([(1, 1.0)], "user_id long, avg_days_since_prior double")
    dept = spark.createDataFrame([(1, 1, 3, 0.75)], "user_id long, department_id int, department_frequency long, department_frequency_ratio double")
    save_artifacts(root, None, None, None, figures, dept, spark.createDataFrame([(1, 1)], "product_id long, department_id int"), parameters={"interval_median": 1.0})
    rows = [(i % 500, 1, 1, None, None, None, None, datetime(2024, 1, 1) + timedelta(seconds=i)) for i in range(1000)]
    spark.createDataFrame(rows, TIMED_REQUEST_SCHEMA).write.parquet(f"{inbox}/a")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    q = start_scoring_stream(spark, f"{inbox}/*", root, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True, dedupe_within="1 hour", with_model=False)
    q.awaitTermination(120)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    state = [s for p in q.recentProgress for s in p["stateOperators"]]
    assert state and any(k.startswith("rocksdb") for k in state[0]["customMetrics"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 500
