"""Training features.

The feature matrix joins window samples to the user's purchase interval, the product's
department and the user's department frequency. Fills follow the training path: a missing
interval takes the median (``fill='rows'``: over the sample rows, as in training; ``'users'``:
over users, as at serving time), a missing department frequency or ratio takes 0, and a missing
department takes 0 (tree learners here have no missing-value branch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.selection import exact_median, weighted_median
from cartwise.operators.recommend import matched_rules
from cartwise.operators.transactions import product_department
from cartwise.session import cut_lineage

FEATURE_COLS = [
    "recency",
    "frequency",
    "monetary",
    "avg_days_since_prior",
    "department_id",
    "department_frequency",
    "department_frequency_ratio",
]


def assemble_features(
    samples: DataFrame,
    interval: DataFrame,
    dept_freq: DataFrame,
    products: DataFrame,
    fill: str = "rows",
    keep: list[str] | None = None,
    median: float | None = None,
) -> DataFrame:
    """Samples with the seven features and ``label``.

    ``keep`` lists extra sample columns to carry (default: ``window_id, user_id, product_id``
    when present). ``median`` overrides the computed fill value (e.g. the one used in training).
    """
    require_columns(samples, ["user_id", "product_id", "recency", "frequency", "monetary"], "samples")
    require_columns(interval, ["user_id", "avg_days_since_prior"], "purchase interval")
    if fill not in ("rows", "users"):
        raise ValueError("fill must be 'rows' or 'users'")
    keep = keep if keep is not None else [c for c in ("window_id", "user_id", "product_id") if c in samples.columns]
    interval = interval.select("user_id", "avg_days_since_prior")
    # all that is joined depends on the user and the product alone: it is joined to their pairs, and those once to the samples
    pairs = cut_lineage(samples.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("_rows")))
    if median is None and fill == "rows":
        users = pairs.groupBy("user_id").agg(F.sum("_rows").alias("_rows"))
        median = weighted_median(users.join(interval, "user_id"), "avg_days_since_prior", "_rows")
        fill_value = F.lit(median).cast("double")
    elif median is None:
        fill_value = exact_median(interval, "avg_days_since_prior").select("median").scalar()
    else:
        fill_value = F.lit(float(median))
    figures = pairs.join(interval, "user_id", "left")
    figures = figures.withColumn("avg_days_since_prior", F.coalesce(F.col("avg_days_since_prior"), fill_value))
    figures = figures.join(product_department(products), "product_id", "left")
    freq = dept_freq.select("user_id", "department_id", "department_frequency", "department_frequency_ratio")
    figures = figures.join(freq, ["user_id", "department_id"], "left").drop("_rows")
    figures = figures.withColumnsRenamed({"user_id": "_user", "product_id": "_product"})
    same = F.col("user_id").eqNullSafe(F.col("_user")) & F.col("product_id").eqNullSafe(F.col("_product"))
    return feature_columns(samples.join(figures, same), keep)


def feature_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the seven features as doubles (department figures 0 where missing) and the label where there is one (L1)."""
    label = [F.col("label").cast("int").alias("label")] if "label" in df.columns else []
    plain = ("recency", "frequency", "monetary", "avg_days_since_prior")
    return df.select(
        *keep,
        *[F.col(c).cast("double").alias(c) if c in plain else F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURE_COLS],
        *label,
    )


def split_flag(key_cols: list[str], test_fraction: float = 0.2, seed: int = 42) -> F.Column:
    """True for the test part of a deterministic hash split (T7): the first 8 hex digits of
    ``md5(seed|k1|k2...)`` below ``test_fraction * 16^8``. Same rows on every run and engine."""
    cut = int(test_fraction * 16**8)
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") < F.lit(cut)


def user_product_features(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per (user, product) history features (D9-D11):
    ``user_id, product_id, up_orders, up_order_rate, up_orders_since_last_order,
    up_order_rate_since_first_order``."""
    require_columns(orders, ["order_id", "user_id", "order_number"], "orders")
    o = orders.select("order_id", "user_id", "order_number").where(F.col("user_id").isNotNull())
    user_n = o.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"), F.max("order_number").alias("_max"))
    up = (
        lines.select("order_id", "product_id")
        .distinct()
        .join(o, "order_id")
        .groupBy("user_id", "product_id")
        .agg(F.count(F.lit(1)).alias("up_orders"), F.min("order_number").alias("_first"), F.max("order_number").alias("_last"))
    )
    j = up.join(user_n, "user_id")
    return j.select(
        "user_id",
        "product_id",
        "up_orders",
        (F.col("up_orders") / F.col("_n")).alias("up_order_rate"),
        (F.col("_max") - F.col("_last")).cast("bigint").alias("up_orders_since_last_order"),
        (F.col("up_orders") / (F.col("_max") - F.col("_first") + F.lit(1))).alias("up_order_rate_since_first_order"),
    )


def mba_features(user_items: DataFrame, rules: DataFrame) -> DataFrame:
    """Rule strength per (user, product) (D12): over rules whose antecedent is inside the user's
    purchased items and whose consequent is the product, the best lift and that rule's confidence,
    and the number of such rules: ``user_id, product_id, mba_lift, mba_confidence, mba_rules``."""
    require_columns(user_items, ["user_id", "product_id"], "user items")
    items = user_items.select(F.col("user_id").alias("basket_id"), "product_id")
    m = matched_rules(items, rules, exclude_owned=False)
    c = m.select("basket_id", "rule_id", F.explode("consequent").alias("product_id"))
    # numbers only, so the aggregation hashes; a struct in its buffer would make it sort every match
    best = c.groupBy("basket_id", "product_id").agg(F.min("rule_id").alias("rule_id"), F.count(F.lit(1)).alias("mba_rules"))
    scores = cut_lineage(rules.groupBy("rule_id").agg(F.min(F.struct("lift", "confidence")).alias("b")))  # one row per id
    best = best.join(scores, "rule_id", "left")
    return best.select(F.col("basket_id").alias("user_id"), "product_id", F.col("b.lift").alias("mba_lift"), F.col("b.confidence").alias("mba_confidence"), "mba_rules")
