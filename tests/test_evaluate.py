"""Evaluation tables against direct computations over the rows."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from cartwise.operators import evaluate as ev


def brute_auc(data):
    pos = [p for y, p in data if y == 1]
    neg = [p for y, p in data if y != 1]
    wins = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def make(spark, data):
    return spark.createDataFrame([(y, p, 1.0 if p > 0.5 else 0.0) for y, p in data], "label int, probability double, prediction double")


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(3)
    return [(int(rnd.random() < 0.3 + 0.4 * p), p) for p in (round(rnd.random(), 2) for _ in range(400))]  # many ties


def test_auc_matches_pairwise_and_mllib(spark, data):
    df = make(spark, data)
    got = ev.roc_auc(df).collect()[0].auc
    assert got == pytest.approx(brute_auc(data), abs=1e-12)
    mllib = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label").evaluate(df.selectExpr("cast(label as double) label", "probability"))
    assert got == pytest.approx(mllib, abs=1e-12)


def test_metrics_and_confusion(spark, data):
    df = make(spark, data)
    tp = sum(1 for y, p in data if y == 1 and p > 0.5)
    fp = sum(1 for y, p in data if y != 1 and p > 0.5)
    fn = sum(1 for y, p in data if y == 1 and p <= 0.5)
    tn = len(data) - tp - fp - fn
    m = ev.classification_metrics(df).collect()[0]
    assert m.accuracy == pytest.approx((tp + tn) / len(data))
    assert m.precision == pytest.approx(tp / (tp + fp)) and m.recall == pytest.approx(tp / (tp + fn))
    assert m.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    cells = {(r.actual, r.predicted): r.n for r in ev.confusion_matrix(df).collect()}
    assert cells == {(0, 0): tn, (0, 1): fp, (1, 0): fn, (1, 1): tp}


def test_zero_division_and_one_class(spark):
    df = make(spark, [(0, 0.1), (0, 0.2)])
    m = ev.classification_metrics(df).collect()[0]
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0) and m.auc is None
    t = ev.threshold_metrics(df, 0.9).collect()[0]
    assert (t.tp, t.fp, t.tn, t.fn, t.miss_rate) == (0, 0, 2, 0, 0.0)


def test_curves_and_average_precision(spark, data):
    df = make(spark, data)
    P = sum(y for y, _ in data)
    N = len(data) - P
    scores = sorted({p for _, p in data}, reverse=True)
    roc = {r.threshold: (r.fpr, r.tpr) for r in ev.roc_points(df).collect()}
    pr = {r.threshold: (r.precision, r.recall) for r in ev.pr_points(df).collect()}
    gains = {r.threshold: (r.sample_share, r.gain) for r in ev.cumulative_gains(df).collect()}
    ap = 0.0
    prev_recall = 0.0
    for s in scores:
        tp = sum(1 for y, p in data if y == 1 and p >= s)
        fp = sum(1 for y, p in data if y != 1 and p >= s)
        assert roc[s] == pytest.approx((fp / N, tp / P))
        assert pr[s] == pytest.approx((tp / (tp + fp), tp / P))
        assert gains[s] == pytest.approx(((tp + fp) / len(data), tp / P))
        ap += (tp / P - prev_recall) * tp / (tp + fp)
        prev_recall = tp / P
    assert roc[None] == (0.0, 0.0) and pr[None] == (1.0, 0.0)
    assert ev.average_precision(df).collect()[0].average_precision == pytest.approx(ap)


def test_calibration_bins(spark):
    data = [(0, 0.0), (1, 0.1), (0, 0.2), (1, 0.3), (1, 1.0), (0, 0.95), (1, 0.55)]
    got = {r.bin: (r.n, r.mean_predicted, r.fraction_positive) for r in ev.calibration(make(spark, data)).collect()}
    # right-closed bins: 0.1 -> bin 0, 0.2 -> bin 1, 0.3 -> bin 2 (0.3 < the edge 0.30000000000000004); empty bins absent
    assert got == {0: (2, 0.05, 0.5), 1: (1, 0.2, 0.0), 2: (1, 0.3, 1.0), 5: (1, 0.55, 1.0), 9: (2, 0.975, 0.5)}
    assert ev.positive_rate(make(spark, data)).collect()[0].positive_rate == pytest.approx(4 / 7)


def test_auc_of_billions_of_rows(spark, monkeypatch):
    # two scores that hold 4 billion positives and negatives: the product passes BIGINT
    big = 4_000_000_000
    groups = spark.createDataFrame([(0.2, big, 3 * big), (0.8, 3 * big, big)], "score double, pos bigint, neg bigint")
    monkeypatch.setattr(ev, "_score_groups", lambda scored: groups)
    auc = ev.roc_auc(None).first()["auc"]
    assert abs(auc - (0.25 * 0.375 + 0.75 * (0.75 + 0.125))) < 1e-12
