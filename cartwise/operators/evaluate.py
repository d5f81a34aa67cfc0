"""Evaluation tables behind the classifier charts.

Input is any ``(label, probability[, prediction])`` table. Curves run over distinct scores:
rows are first grouped by score (partial aggregation, so a score held by a third of all rows is
one row after the map side), then cumulative counts come from ``global_running_totals``, which
never places all rows in one task.

Threshold semantics: ``prediction`` is used as given; with ``threshold=t`` a row is predicted
positive when ``probability >= t``. Zero divisions give 0 (E1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.prefix import global_running_totals
from cartwise.session import cut_lineage

# fixed values: interior edges of 10 uniform calibration bins, as numpy.linspace(0, 1, 11) yields them
CALIBRATION_EDGES_10 = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]


def _predicted(df: DataFrame, threshold: float | None) -> Column:
    if threshold is None:
        require_columns(df, ["prediction"], "scored rows")
        return F.col("prediction") >= 0.5
    return F.col("probability") >= F.lit(threshold)


def _safe_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row ``tn, fp, fn, tp`` (BIGINT)."""
    require_columns(scored, ["label"], "scored rows")
    pos = F.col("label") == 1
    pred = _predicted(scored, threshold)
    return scored.agg(
        F.count_if(~pos & ~pred).alias("tn"),
        F.count_if(~pos & pred).alias("fp"),
        F.count_if(pos & ~pred).alias("fn"),
        F.count_if(pos & pred).alias("tp"),
    )


def confusion_matrix(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """The 2x2 matrix as four rows ``actual, predicted, n`` including zero cells."""
    c = confusion_counts(scored, threshold)
    return c.select(F.expr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (actual, predicted, n)"))


def _score_groups(scored: DataFrame) -> DataFrame:
    """One row per distinct score with its positives and negatives, checkpointed: the curves read
    it several times (totals, bucket prefix, rows) and it is far smaller than the scored rows."""
    require_columns(scored, ["label", "probability"], "scored rows")
    groups = (
        scored.where(F.col("probability").isNotNull())
        .groupBy(F.col("probability").alias("score"))
        .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    )
    return cut_lineage(groups)


def _with_totals(groups: DataFrame) -> DataFrame:
    totals = groups.select(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    return groups.withColumn("P", totals["P"]).withColumn("N", totals["N"])


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row ``auc``: the probability that a random positive outranks a random negative, ties
    half (E2); null when one class is absent."""
    g = global_running_totals(_score_groups(scored), "score", ["neg"])  # negatives at or below
    g = _with_totals(g)
    # doubles before any product: positives x negatives passes BIGINT from about 3 billion of each on
    pos, neg, below = (F.col(c).cast("double") for c in ("pos", "neg", "cum_neg"))
    contrib = pos * (below - neg * F.lit(0.5))
    return g.agg(F.try_divide(F.sum(contrib), F.max("P").cast("double") * F.max("N").cast("double")).alias("auc"))


def classification_metrics(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row ``accuracy, precision, recall, f1, auc``."""
    c = confusion_counts(scored, threshold)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision = _safe_ratio(tp, tp + fp)
    recall = _safe_ratio(tp, tp + fn)
    auc = roc_auc(scored).select(F.col("auc")).scalar()
    return c.select(
        _safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
        auc.alias("auc"),
    )


def threshold_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    """Counts and rates at a chosen threshold (E11): ``threshold, tn, fp, fn, tp, accuracy,
    precision, recall, f1, miss_rate``."""
    c = confusion_counts(scored, threshold)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        F.lit(float(threshold)).alias("threshold"),
        "tn",
        "fp",
        "fn",
        "tp",
        _safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _safe_ratio(tp, tp + fp).alias("precision"),
        _safe_ratio(tp, tp + fn).alias("recall"),
        _safe_ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
        _safe_ratio(fn, tp + fn).alias("miss_rate"),
    )


def _descending_counts(scored: DataFrame) -> DataFrame:
    g = global_running_totals(_score_groups(scored), "score", ["pos", "neg"], descending=True)
    return _with_totals(g).withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")


def roc_points(scored: DataFrame) -> DataFrame:
    """``threshold, fpr, tpr`` for every distinct score (predicted positive at ``>= threshold``),
    plus the origin with a null threshold (E4). Collinear points are kept."""
    g = _descending_counts(scored)
    pts = g.select(
        F.col("score").alias("threshold"),
        _safe_ratio(F.col("fp"), F.col("N")).alias("fpr"),
        _safe_ratio(F.col("tp"), F.col("P")).alias("tpr"),
    )
    origin = scored.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def pr_points(scored: DataFrame) -> DataFrame:
    """``threshold, precision, recall`` per distinct score plus the end point precision 1,
    recall 0 with a null threshold (E5). Recall is 1 everywhere when there are no positives."""
    g = _descending_counts(scored)
    recall = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("P"))
    pts = g.select(
        F.col("score").alias("threshold"),
        _safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        recall.alias("recall"),
    )
    end = scored.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(scored: DataFrame) -> DataFrame:
    """One row ``average_precision = sum over scores of (R_n - R_n-1) * P_n``."""
    g = _descending_counts(scored)
    step = F.try_divide(F.col("pos").cast("double"), F.col("P")) * (F.col("tp") / (F.col("tp") + F.col("fp")))
    # summed as exact decimals, so the result does not depend on task boundaries
    return g.agg(F.sum(step.cast("decimal(38,18)")).cast("double").alias("average_precision"))


def positive_rate(scored: DataFrame) -> DataFrame:
    """One row ``positive_rate = mean(label)``."""
    return scored.agg(F.avg(F.col("label").cast("double")).alias("positive_rate"))


def calibration(scored: DataFrame, n_bins: int = 10) -> DataFrame:
    """Reliability table with uniform bins (E8): ``bin, n, mean_predicted, fraction_positive``;
    empty bins are absent. A score on an edge belongs to the lower bin (right-closed bins)."""
    if n_bins == 10:
        edges = CALIBRATION_EDGES_10
    else:
        edges = [i * (1.0 / n_bins) for i in range(1, n_bins)]
    edge_arr = F.array(*[F.lit(e) for e in edges])
    p = F.col("probability")
    b = F.size(F.filter(edge_arr, lambda e: e < p))
    return (
        scored.where(p.isNotNull())
        .groupBy(b.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            # an exact decimal sum: the mean does not depend on how rows are split across tasks
            F.avg(p.cast("decimal(38,18)")).cast("double").alias("mean_predicted"),
            F.avg(F.col("label").cast("double")).alias("fraction_positive"),
        )
    )


def cumulative_gains(scored: DataFrame) -> DataFrame:
    """Cumulative gains by descending score, one point per distinct score (E10, W4):
    ``threshold, sample_share, gain`` (share of rows at or above the score, share of positives)."""
    g = _descending_counts(scored)
    return g.select(
        F.col("score").alias("threshold"),
        ((F.col("tp") + F.col("fp")) / (F.col("P") + F.col("N"))).alias("sample_share"),
        _safe_ratio(F.col("tp"), F.col("P")).alias("gain"),
    )
