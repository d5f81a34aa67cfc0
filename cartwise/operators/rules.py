"""Association rules.

FP-Growth is MLlib's parallel FP-Growth. Rules are ordered by lift, then confidence, support,
antecedent and consequent (ties in lift follow no stable order in a plain sort), capped at
``max_rules`` with a top-k, and numbered: ``rule_id`` is that order, starting at 1.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import cut_lineage



def rule_order() -> list:
    """Lift, confidence and support descending, then antecedent and consequent ascending."""
    return [
        F.col("lift").desc(),
        F.col("confidence").desc(),
        F.col("support").desc(),
        F.col("antecedent").asc(),
        F.col("consequent").asc(),
    ]


def fp_growth(baskets: DataFrame, min_support: float = 0.001, min_confidence: float = 0.1, items_col: str = "items"):
    """Fit MLlib FP-Growth (itemsets of any length; support = share of the input rows)."""
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=min_confidence)
    # spread the conditional FP-trees over the cluster, not over however few input partitions remain
    fp = fp.setNumPartitions(baskets.sparkSession.sparkContext.defaultParallelism)
    return fp.fit(baskets.select(items_col))


def number_rules(rules: DataFrame, max_rules: int | None = 10_000) -> DataFrame:
    """Sort rules, keep the first ``max_rules`` (a top-k; None: all), and number them.

    The result is written: MLlib derives rules lazily from the mined itemsets, so every later use would
    otherwise mine again. All rules are numbered without meeting in one task: they are sorted by range,
    and each partition's numbers start after the rows of the partitions before it.
    """
    ordered = rules.select(
        F.array_sort("antecedent").alias("antecedent"),
        F.array_sort("consequent").alias("consequent"),
        F.col("support").cast("double").alias("support"),
        F.col("confidence").cast("double").alias("confidence"),
        F.col("lift").cast("double").alias("lift"),
    ).orderBy(*rule_order())
    if max_rules is not None:
        top = ordered.limit(max_rules)  # at most max_rules rows below
        return cut_lineage(top.select(F.row_number().over(Window.orderBy(*rule_order())).cast("bigint").alias("rule_id"), "*"))
    placed = cut_lineage(ordered.select(F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id() % (1 << 33)).alias("_row"), "*"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return cut_lineage(placed.join(starts, "_part").select((F.col("_start") + F.col("_row") + 1).alias("rule_id"), *ordered.columns))


def association_rules(
    baskets: DataFrame,
    min_support: float = 0.001,
    min_confidence: float = 0.1,
    max_rules: int | None = 10_000,
    items_col: str = "items",
) -> DataFrame:
    """``rule_id, antecedent, consequent, support, confidence, lift`` (single-item consequents)."""
    model = fp_growth(baskets, min_support, min_confidence, items_col)
    return number_rules(model.associationRules, max_rules)


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.001, items_col: str = "items") -> DataFrame:
    """``items`` (sorted), ``freq``, ``support`` of every frequent itemset (M1)."""
    model = fp_growth(baskets, min_support, 0.0, items_col)
    n = baskets.select(F.count(F.lit(1))).scalar()
    return model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq"), (F.col("freq") / n).alias("support"))


def pair_rules(
    baskets: DataFrame,
    min_support: float = 0.001,
    min_confidence: float = 0.1,
    max_rules: int | None = 10_000,
    items_col: str = "items",
) -> DataFrame:
    """Rules from frequent pairs only (itemset length capped at 2): one-item antecedents and
    consequents, the same numbers FP-Growth gives for them (M3).

    Support counts use FP-Growth's threshold ``ceil(min_support * n)``. A basket's ordered pairs stream from two nested
    explodes of its own array into one aggregation, whose partial counts are all that is shuffled; baskets are neither
    keyed nor regrouped. A basket of k items makes k²/2 rows, so pass baskets cut to the items that can be frequent
    (``mining_baskets``: at most ``total items / min count`` each, however large the order).
    """
    b = baskets.select(F.array_sort(F.array_distinct(items_col)).alias("items"))
    n = b.select(F.count(F.lit(1))).scalar()
    min_count = F.ceil(F.lit(min_support) * n)
    frequent = cut_lineage(b.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= min_count))
    left = b.select("items", F.posexplode("items").alias("pos", "a")).where(F.col("pos") + 1 < F.size("items"))
    pairs = left.select("a", F.explode(F.slice("items", F.col("pos") + 2, F.size("items"))).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("c_ab")).where(F.col("c_ab") >= min_count)
    ia = frequent.select(F.col("item").alias("a"), F.col("item").alias("item_a"), F.col("c").alias("c_a"))
    ib = frequent.select(F.col("item").alias("b"), F.col("item").alias("item_b"), F.col("c").alias("c_b"))
    p = pairs.join(ia, "a").join(ib, "b")

    def directed(x: str, y: str) -> DataFrame:
        conf = F.col("c_ab") / F.col(f"c_{x}")
        return p.select(
            F.array(F.col(f"item_{x}")).alias("antecedent"),
            F.array(F.col(f"item_{y}")).alias("consequent"),
            conf.alias("confidence"),
            (conf / (F.col(f"c_{y}") / n)).alias("lift"),
            (F.col("c_ab") / n).alias("support"),
        )

    both = directed("a", "b").unionByName(directed("b", "a")).where(F.col("confidence") >= F.lit(min_confidence))
    return number_rules(both, max_rules)


def pair_rules_fp(
    baskets: DataFrame,
    min_support: float = 0.001,
    min_confidence: float = 0.1,
    max_rules: int | None = 10_000,
    items_col: str = "items",
) -> DataFrame:
    """The same pair rules taken from a full FP-Growth run (a cross-check of ``pair_rules``)."""
    model = fp_growth(baskets, min_support, min_confidence, items_col)
    return number_rules(model.associationRules.where(F.size("antecedent") == 1), max_rules)


def rules_summary(
    rules: DataFrame,
    baskets: DataFrame | None = None,
    lines: DataFrame | None = None,
    products: DataFrame | None = None,
    min_support: float | None = None,
    min_confidence: float | None = None,
    limit_rows: int | None = None,
) -> DataFrame:
    """One row: rule count and the range of support, confidence and lift (G13), plus the run's
    parameters and input counts when given (G16; the fit time is not data and is left out)."""
    aggs = [
        F.count(F.lit(1)).alias("n_rules"),
        F.min("support").alias("min_support_seen"),
        F.max("support").alias("max_support_seen"),
        F.min("confidence").alias("min_confidence_seen"),
        F.max("confidence").alias("max_confidence_seen"),
        F.min("lift").alias("min_lift"),
        F.max("lift").alias("max_lift"),
    ]
    out = rules.agg(*aggs)
    extra = []
    if min_support is not None:
        extra.append(F.lit(float(min_support)).alias("min_support"))
    if min_confidence is not None:
        extra.append(F.lit(float(min_confidence)).alias("min_confidence"))
    if limit_rows is not None:
        extra.append(F.lit(int(limit_rows)).cast("bigint").alias("limit_rows"))
    if lines is not None:
        extra.append(lines.select(F.count(F.lit(1))).scalar().alias("total_transactions"))
    if baskets is not None:
        extra.append(baskets.select(F.count(F.lit(1))).scalar().alias("basket_count"))
    if products is not None:
        extra.append(products.select(F.count_distinct("product_id")).scalar().alias("n_products"))
    return out.select("*", *extra)


def rules_with_names(rules: DataFrame, names: DataFrame, top: int | None = 10) -> DataFrame:
    """First ``top`` rules with item names in place of ids (T4, F18); unknown ids keep their text."""
    head = rules.orderBy("rule_id").limit(top) if top is not None else rules

    def named(side: str) -> DataFrame:
        ex = head.select("rule_id", F.posexplode(side).alias("pos", "product_id"))
        # the exploded head is tiny; AQE broadcasts it against the catalog
        j = ex.join(names.select("product_id", "product_name"), "product_id", "left")
        label = F.coalesce(F.col("product_name"), F.col("product_id").cast("string"))
        return j.groupBy("rule_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", label.alias("name")))), lambda s: s["name"]).alias(f"{side}_names")
        )

    return head.join(named("antecedent"), "rule_id").join(named("consequent"), "rule_id")
