"""Repurchase classifier: training, scoring and the score-and-recommend request path
(A10, A13-A16, L1-L6, R1-R4, E9).

The learner is MLlib's gradient-boosted trees with the grocery model's settings: 100 trees of
depth 6, step 0.1, row sampling 0.8 and column sampling 0.8 (per node here), seed 42. They are grown by
``boosting.fit_boosted``, which gives the model that MLlib's own training gives, in less time. Scores are
not expected to equal another library's; the surface and the evaluation tables are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.selection import exact_quantile
from cartwise.functions.text import percent_text
from cartwise.operators.boosting import fit_boosted
from cartwise.operators.catalog import resolve_items
from cartwise.operators.evaluate import classification_metrics
from cartwise.operators.features import FEATURE_COLS, split_flag
from cartwise.operators.recommend import recommend
from cartwise.session import cut_lineage

GBT_DEFAULTS = dict(maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)

MOST_ROWS = 1_000_000  # of the training set in one partition: what a task keeps in memory


@dataclass
class TrainedRepurchase:
    model: PipelineModel
    test_scored: DataFrame  # keys + features + label, probability, prediction
    metrics: DataFrame  # one row: accuracy, precision, recall, f1, auc
    feature_cols: list[str]


def repurchase_estimator(feature_cols: list[str] | None = None, **params) -> Pipeline:
    """VectorAssembler (errors on missing values) + GBTClassifier; ``params`` override defaults (L4)."""
    cols = feature_cols or FEATURE_COLS
    gbt_params = {**GBT_DEFAULTS, **params}
    # the errors are checkpointed every 10 trees (to the shared checkpoint folder); a row finds its node by at most maxDepth
    # comparisons, which costs less than a table of node ids cached and joined at every level
    gbt = GBTClassifier(featuresCol="features", labelCol="label", checkpointInterval=10, cacheNodeIds=False, **gbt_params)
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error"), gbt])


def with_probability(scored: DataFrame) -> DataFrame:
    """Replace the model's vector columns by ``probability`` (positive class) and ``prediction``."""
    out = scored.withColumn("probability", vector_to_array("probability")[1])
    return out.drop("features", "rawPrediction")


def dealt_evenly(train: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """The rows in equal partitions, one per core, or a multiple of that so that none holds more than about ``most`` rows.

    Boosting runs a stage per level of every tree over the same partitions, and a stage lasts as long as its largest one: files
    read as they lie give parts of unequal size, or one part more than there are cores.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(cores * max(1, -(-train.count() // (cores * most))))


def train_repurchase(
    features: DataFrame,
    key_cols: list[str] | None = None,
    test_fraction: float = 0.2,
    seed: int = 42,
    feature_cols: list[str] | None = None,
    **params,
) -> TrainedRepurchase:
    """Deterministic hash split, fit on the train part, score and evaluate the test part (A10).

    The flagged rows are written to the session's shared checkpoint folder once for both parts: a lost executor re-reads
    them, not the whole lineage. The train part is dealt evenly over the cores (by ``fit_boosted``, or ``dealt_evenly`` where MLlib
    has to fit). The scored rows are written too, since the metrics read them several times.
    """
    cols = feature_cols or FEATURE_COLS
    require_columns(features, [*cols, "label"], "features")
    keys = key_cols or [c for c in ("window_id", "user_id", "product_id") if c in features.columns]
    flagged = cut_lineage(features.withColumn("_is_test", split_flag(keys, test_fraction, seed)))
    train = flagged.where(~F.col("_is_test")).select(*cols, "label")
    test = flagged.where(F.col("_is_test")).drop("_is_test")
    pipeline = repurchase_estimator(cols, **params)
    model = fit_boosted(pipeline, train) or pipeline.fit(dealt_evenly(train))
    scored = cut_lineage(with_probability(model.transform(test)))
    return TrainedRepurchase(model, scored, classification_metrics(scored), list(cols))


def feature_importance(model: PipelineModel, feature_cols: list[str] | None = None, ascending: bool = False) -> DataFrame:
    """``feature, importance`` sorted by importance, descending or ascending."""
    cols = feature_cols or FEATURE_COLS
    gbt = model.stages[-1]
    values = [float(v) for v in gbt.featureImportances.toArray()]
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(cols, values)), "feature string, importance double")
    return df.orderBy(F.col("importance").asc() if ascending else F.col("importance").desc(), "feature")


def interval_median(interval: DataFrame) -> float | None:
    """The median purchase interval over users: the serving-time fill for unknown ones.

    Computed once, in training, and kept with the artifacts; None when no user has an interval.
    """
    return exact_quantile(interval, "avg_days_since_prior")


def assemble_requests(
    requests: DataFrame, interval: DataFrame, product_dept: DataFrame, dept_freq: DataFrame, median: float | None
) -> DataFrame:
    """Serving-time features for ``(user_id, product_id[, recency, frequency, monetary])`` requests
    (R1-R3): unknown user -> median interval over users; unknown product -> department 0; unknown
    (user, department) -> frequency and ratio 0; missing recency/frequency/monetary -> 0, 1, 1.0.

    ``median`` is the one that training kept (``interval_median``; None: no user had an interval, and unknown ones get null)."""
    require_columns(requests, ["user_id", "product_id"], "requests")
    req = requests
    for c, default, t in (("recency", 0, "double"), ("frequency", 1, "double"), ("monetary", 1.0, "double")):
        val = F.col(c) if c in req.columns else F.lit(None)
        req = req.withColumn(c, F.coalesce(val.cast(t), F.lit(default).cast(t)))
    df = req.join(interval.select("user_id", "avg_days_since_prior"), "user_id", "left")
    df = df.withColumn("avg_days_since_prior", F.coalesce(F.col("avg_days_since_prior"), F.lit(median).cast("double")))
    pdept = product_dept.groupBy("product_id").agg(F.max("department_id").alias("department_id"))  # one department per id
    df = df.join(pdept, "product_id", "left").withColumn("department_id", F.coalesce(F.col("department_id"), F.lit(0)))
    freq = dept_freq.select("user_id", "department_id", "department_frequency", "department_frequency_ratio")
    df = df.join(freq, ["user_id", "department_id"], "left")
    return df.select(
        *[c for c in requests.columns if c not in ("recency", "frequency", "monetary")],
        "recency",
        "frequency",
        "monetary",
        F.col("avg_days_since_prior").cast("double").alias("avg_days_since_prior"),
        F.col("department_id").cast("double").alias("department_id"),
        F.coalesce(F.col("department_frequency").cast("double"), F.lit(0.0)).alias("department_frequency"),
        F.coalesce(F.col("department_frequency_ratio").cast("double"), F.lit(0.0)).alias("department_frequency_ratio"),
    )


def score(requests: DataFrame, model: PipelineModel, interval: DataFrame, product_dept: DataFrame, dept_freq: DataFrame, median: float | None) -> DataFrame:
    """The request rows plus ``probability`` and ``prediction`` (R1, R2: a one-row frame scores one pair)."""
    feats = assemble_requests(requests, interval, product_dept, dept_freq, median)
    return with_probability(model.transform(feats))


def resolve_requests(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Requests with ``product_id`` filled from ``product_name`` where it is null (the name columns stay)."""
    texts = requests.where(F.col("product_id").isNull()).select(F.col("product_name").alias("basket_id"), F.lit(None).cast("bigint").alias("product_id"), "product_name").where("product_name is not null").distinct()
    found = resolve_items(texts, products).select(F.col("basket_id").alias("product_name"), F.col("product_id").alias("_found"))
    out = requests.join(found, "product_name", "left")
    return out.withColumn("product_id", F.coalesce("product_id", "_found")).select(*requests.columns)


def score_and_recommend(
    requests: DataFrame,
    model: PipelineModel,
    interval: DataFrame,
    product_dept: DataFrame,
    dept_freq: DataFrame,
    rules: DataFrame,
    products: DataFrame,
    median: float | None,
    top_n: int = 3,
) -> DataFrame:
    """Repurchase probability of each (user, product) request plus what buyers of that product
    also buy (R4): the request columns, ``probability``, ``probability_text`` (percent) and
    ``recommendations ARRAY<STRING>``.

    A request names its product by ``product_id``, or by ``product_name`` where the id is null: exact name
    first, else the first catalog name that holds the text. A name that finds nothing is scored as an
    unknown product.

    Recommendations depend on the product alone (a one-item basket), so they are computed once per
    distinct requested product and joined back on ``product_id``; no request key is needed.
    """
    require_columns(requests, ["user_id", "product_id"], "requests")
    if "product_name" in requests.columns:
        requests = resolve_requests(requests, products)
    scored = score(requests, model, interval, product_dept, dept_freq, median)
    asked = requests.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    recs = recommend(asked.select(F.col("product_id").alias("basket_id"), "product_id"), rules, products, top_n)
    per_product = recs.groupBy(F.col("basket_id").alias("product_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "product_name"))), lambda s: s["product_name"]).alias("recommendations")
    )
    scored = scored.withColumn("probability_text", percent_text(F.col("probability")))
    keep = [c for c in requests.columns] + ["probability", "probability_text"]
    out = scored.select(*keep).join(per_product, "product_id", "left")
    return out.select(*keep, F.coalesce("recommendations", F.array().cast("array<string>")).alias("recommendations"))
