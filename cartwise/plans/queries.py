"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.

Outputs are shaped for comparison with the SQL twins in ``oracle.py``: timestamps render as
``yyyy-MM-dd HH:mm:ss`` text, arrays as comma-joined text, integer counts as BIGINT, and ratios
computed in different orders are rounded to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.text import percent_text
from cartwise.operators import asof, catalog, evaluate, explore, features, model, recommend, rules, split, transactions, trees, windows
from cartwise.operators.baskets import baskets, mining_baskets
from cartwise.session import cut_lineage, discard, free_shuffles, shuffle_partitions
from cartwise.sources.testdata import TestTables

# fixed parameters of the grocery runs
OBSERVATION_DAYS, LABEL_DAYS, STRIDE_DAYS = 60, 30, 15
MIN_SUPPORT, MIN_CONFIDENCE, MAX_RULES = 0.005, 0.1, 10_000
TOP_N = 3
REPORTED_THRESHOLD = 0.0615
SAMPLE_FRACTION, SEED = 0.1, 42
TOP_PRODUCTS, TOP_REORDERED = 30, 20

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def ts_text(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def ids_text(c: Column | str) -> Column:
    return F.array_join(F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("string")), ",")


# ---------------------------------------------------------------- timeline and windows


@query
def rfm_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding-window RFM on (customer, brand, quantity) at the real order dates (A5)."""
    t = TestTables(spark, sf_dir)
    # the bounds (one row) come from the orders that have a line, keys only: the fact join is neither repeated nor written
    span = cut_lineage(windows.date_span(t.lined_orders, "transaction_date"))
    w = windows.sliding_window_rfm(t.dated_lines("p_brand"), "transaction_date", "user_id", "item", "quantity", OBSERVATION_DAYS, LABEL_DAYS, STRIDE_DAYS, span)
    return w.select("window_id", ts_text("cut_date").alias("cut_date"), "user_id", "item", "recency", "frequency", "monetary", "label")


def _transactions(t: TestTables) -> DataFrame:
    # prior and train lines together are all lines of known orders: one scan and one join
    return transactions.build_transactions(t.orders, t.order_lines)


@query
def transactions_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prior + train lines dated on the rebuilt pseudo-timeline."""
    tx = _transactions(TestTables(spark, sf_dir))
    return tx.select(ts_text("transaction_date").alias("transaction_date"), "order_id", "user_id", "product_id", "quantity")


@query
def orders_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table rebuilt from the test tables: positions, gaps, weekday, eval set."""
    o = TestTables(spark, sf_dir).orders
    return o.select(
        "order_id", "user_id", F.col("order_number").cast("bigint").alias("order_number"), "days_since_prior_order",
        F.col("order_dow").cast("bigint").alias("order_dow"), "eval_set",
    )


@query
def purchase_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    pi = transactions.purchase_interval(TestTables(spark, sf_dir).orders)
    return pi.select("user_id", r6("avg_days_since_prior").alias("avg_days_since_prior"))


@query
def department_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    d = transactions.department_frequency(_transactions(t), t.products, t.departments)
    return d.select(
        "user_id", F.col("department_id").cast("bigint").alias("department_id"), "department", "department_frequency",
        r6("department_frequency_ratio").alias("department_frequency_ratio"),
    )


# ---------------------------------------------------------------- catalog


@query
def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    c = catalog.product_catalog(t.products, t.departments, t.aisles)
    return c.select(
        "product_id", "product_name", F.col("department_id").cast("bigint").alias("department_id"), "department",
        F.col("aisle_id").cast("bigint").alias("aisle_id"), "aisle",
    )


@query
def name_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.name_index(TestTables(spark, sf_dir).products)


def _requests(t: TestTables) -> DataFrame:
    """Three typed-in requests per order line: its part id, its exact name, and an upper-cased piece
    of the name (a case-insensitive substring); the basket is the order. The text is parsed the way
    a prompt would be: an integer is an id, anything else a name."""
    part = t.raw("part").select(F.col("p_partkey").alias("pid"), F.col("p_name").alias("pname"))
    lines = t.order_lines.select(F.col("order_id").alias("basket_id"), F.col("product_id").alias("pid")).join(part, "pid")
    texts = lines.select("basket_id", F.explode(F.array(F.col("pid").cast("string"), F.col("pname"), F.upper(F.substring("pname", 3, 5)))).alias("request"))
    return catalog.parse_requests(texts)


@query
def resolve_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    return catalog.resolve_items(_requests(t), t.products)


# ---------------------------------------------------------------- baskets and rules


def _name_rules(t: TestTables, mined: DataFrame | None = None, max_rules: int | None = MAX_RULES) -> DataFrame:
    mined = mined if mined is not None else mining_baskets(t.attribute_lines("name"), MIN_SUPPORT)
    return rules.pair_rules(mined, MIN_SUPPORT, MIN_CONFIDENCE, max_rules)


def _type_rules(t: TestTables) -> DataFrame:
    return rules.association_rules(mining_baskets(t.attribute_lines("type"), MIN_SUPPORT), MIN_SUPPORT, MIN_CONFIDENCE, MAX_RULES)


def _rules_out(r: DataFrame) -> DataFrame:
    return r.select(
        "rule_id", ids_text("antecedent").alias("antecedent"), ids_text("consequent").alias("consequent"),
        r6("support").alias("support"), r6("confidence").alias("confidence"), r6("lift").alias("lift"),
    )


@query
def baskets_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = baskets(TestTables(spark, sf_dir).attribute_lines("name"))
    return b.select("order_id", F.size("items").cast("bigint").alias("n_items"), ids_text("items").alias("items"))


@query
def pair_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from frequent pairs of product names, support 0.005, confidence 0.1 (M3)."""
    return _rules_out(_name_rules(TestTables(spark, sf_dir)))


@query
def fp_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FP-Growth rules of any length over department baskets."""
    return _rules_out(_type_rules(TestTables(spark, sf_dir)))


@query
def frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    f = rules.frequent_itemsets(mining_baskets(t.attribute_lines("type"), MIN_SUPPORT), MIN_SUPPORT)
    return f.select(ids_text("items").alias("items"), "freq", r6("support").alias("support"))


@query
def rules_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    lines = t.attribute_lines("name")
    mined = mining_baskets(lines, MIN_SUPPORT)  # the same basket set as baskets(lines), arrays trimmed
    s = rules.rules_summary(_name_rules(t, mined), mined, lines, t.products, MIN_SUPPORT, MIN_CONFIDENCE, limit_rows=0)
    return s.select(*[r6(c).alias(c) if c.endswith(("_seen", "lift")) else F.col(c) for c in s.columns])


@query
def rules_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10 department rules with names (T4)."""
    t = TestTables(spark, sf_dir)
    names = t.departments.select(F.col("department_id").cast("bigint").alias("product_id"), F.col("department").alias("product_name"))
    r = rules.rules_with_names(_type_rules(t), names, 10)
    return r.select("rule_id", F.array_join("antecedent_names", "|").alias("antecedent_names"), F.array_join("consequent_names", "|").alias("consequent_names"), r6("lift").alias("lift"))


# ---------------------------------------------------------------- recommendations


def _order_items(t: TestTables, attribute: str) -> DataFrame:
    return t.attribute_lines(attribute).select(F.col("order_id").alias("basket_id"), "product_id")


@query
def matched_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every department rule matching every order (antecedent inside, consequent outside)."""
    t = TestTables(spark, sf_dir)
    m = recommend.matched_rules(_order_items(t, "type"), _type_rules(t))
    return m.select("basket_id", "rule_id")


@query
def recommend_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 product-name recommendations for every order."""
    t = TestTables(spark, sf_dir)
    r = recommend.recommend(_order_items(t, "name"), _name_rules(t), t.name_products, TOP_N)
    return r.select("basket_id", F.col("rank").cast("bigint").alias("rank"), "product_id", "product_name", r6("lift").alias("lift"), r6("confidence").alias("confidence"))


def _micro(c: Column) -> Column:
    """A ratio as text in whole millionths (floats print differently from engine to engine)."""
    return F.round(c * 1_000_000).cast("bigint").cast("string")


@query
def recommend_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verbose record per order over department rules, flattened for comparison (A4, T5).

    Every order line asks for its department by id, by name, or by an upper-cased piece of the name; the texts
    are parsed and resolved like typed-in ones.
    """
    t = TestTables(spark, sf_dir)
    names = t.departments.select(F.col("department_id").cast("bigint").alias("product_id"), F.col("department").alias("product_name"))
    lines = _order_items(t, "type").join(names, "product_id")
    turn = F.col("basket_id") % 3
    request = F.when(turn == 0, F.col("product_id").cast("string")).when(turn == 1, F.col("product_name")).otherwise(F.upper(F.substring("product_name", 2, 4)))
    resolved = cut_lineage(catalog.resolve_items(catalog.parse_requests(lines.select("basket_id", request.alias("request"))), names))
    e = recommend.recommend_explain(resolved, _type_rules(t), names, top_n=5, top_rules=5)
    return e.select(
        "basket_id",
        F.size("input").cast("bigint").alias("n_inputs"),
        F.array_join(F.array_sort(F.transform("input", lambda s: F.concat_ws(":", s["original"], s["product_id"].cast("string"), s["product_name"], s["fuzzy_match"].cast("string")))), ";").alias("inputs"),
        F.array_join(F.transform("recommendations", lambda s: F.concat_ws(":", _micro(s["lift"]), _micro(s["confidence"]))), "|").alias("recommended_scores"),
        F.array_join(F.transform("top_matched_rules", lambda s: F.concat_ws(":", _micro(s["support"]), _micro(s["confidence"]), _micro(s["lift"]))), "|").alias("top_rule_scores"),
        ids_text("input_product_ids").alias("input_product_ids"),
        "matched_rules_count",
        F.array_join(F.transform("recommendations", lambda s: s["product_name"]), "|").alias("recommended"),
        F.array_join(F.transform("top_matched_rules", lambda s: F.concat(F.array_join(s["antecedent"], "+"), F.lit(">"), F.array_join(s["consequent"], "+"))), "|").alias("top_rules"),
    )


# the same three over brands, whose pairs are frequent at every scale


def _brand_rules(t: TestTables, max_rules: int | None = MAX_RULES) -> DataFrame:
    return rules.pair_rules(mining_baskets(t.attribute_lines("brand"), MIN_SUPPORT), MIN_SUPPORT, MIN_CONFIDENCE, max_rules)


@query
def pair_rules_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from frequent pairs of brands (M3)."""
    return _rules_out(_brand_rules(TestTables(spark, sf_dir)))


@query
def recommend_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 brand recommendations for every order."""
    t = TestTables(spark, sf_dir)
    names = t.aisles.select(F.col("aisle_id").cast("bigint").alias("product_id"), F.col("aisle").alias("product_name"))
    r = recommend.recommend(_order_items(t, "brand"), _brand_rules(t), names, TOP_N)
    return r.select("basket_id", F.col("rank").cast("bigint").alias("rank"), "product_id", "product_name", r6("lift").alias("lift"), r6("confidence").alias("confidence"))


@query
def mba_brand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best matching brand rule per (customer, brand) over each customer's purchased brands."""
    t = TestTables(spark, sf_dir)
    items = t.attribute_lines("brand").join(t.plain_orders.select("order_id", "user_id"), "order_id").select("user_id", "product_id").distinct()
    m = features.mba_features(items, _brand_rules(t, max_rules=None))
    return m.select("user_id", "product_id", r6("mba_lift").alias("mba_lift"), r6("mba_confidence").alias("mba_confidence"), "mba_rules")


# ---------------------------------------------------------------- evaluation tables


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TestTables(spark, sf_dir).scored_events


@query
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = evaluate.classification_metrics(_scored(spark, sf_dir))
    return m.select(*[r6(c).alias(c) for c in m.columns])


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_scored(spark, sf_dir))


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.roc_auc(_scored(spark, sf_dir)).select(r6("auc").alias("auc"))


@query
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = evaluate.roc_points(_scored(spark, sf_dir))
    return p.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = evaluate.pr_points(_scored(spark, sf_dir))
    return p.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.average_precision(_scored(spark, sf_dir)).select(r6("average_precision").alias("average_precision"))


@query
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = evaluate.calibration(_scored(spark, sf_dir))
    return c.select(F.col("bin").cast("bigint").alias("bin"), "n", r6("mean_predicted").alias("mean_predicted"), r6("fraction_positive").alias("fraction_positive"))


@query
def gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = evaluate.cumulative_gains(_scored(spark, sf_dir))
    return g.select("threshold", r6("sample_share").alias("sample_share"), r6("gain").alias("gain"))


@query
def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = evaluate.threshold_metrics(_scored(spark, sf_dir), REPORTED_THRESHOLD)
    return m.select(*[r6(c).alias(c) if c in ("accuracy", "precision", "recall", "f1", "miss_rate") else F.col(c) for c in m.columns])


@query
def positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.positive_rate(_scored(spark, sf_dir)).select(r6("positive_rate").alias("positive_rate"))


# ---------------------------------------------------------------- exploratory summaries


@query
def orders_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.orders_per_user(TestTables(spark, sf_dir).plain_orders)


@query
def orders_per_user_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.orders_per_user_distribution(TestTables(spark, sf_dir).plain_orders)


@query
def orders_by_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = explore.orders_by_dow(TestTables(spark, sf_dir).plain_orders)
    return d.select(F.col("order_dow").cast("bigint").alias("order_dow"), "n_orders")


@query
def orders_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity by hour of day from the timestamped event stream (order dates carry no time)."""
    h = explore.orders_by_hour(TestTables(spark, sf_dir).raw("events"), "ts")
    return h.select(F.col("order_hour_of_day").cast("bigint").alias("order_hour_of_day"), "n_orders")


@query
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    p = explore.top_products(t.order_lines, t.products, TOP_PRODUCTS)
    return p.select(F.col("rank").cast("bigint").alias("rank"), "product_id", "product_name", "n_lines")


@query
def department_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    d = explore.department_sales(t.order_lines, t.products, t.departments)
    return d.select(F.col("department_id").cast("bigint").alias("department_id"), "department", "n_lines")


@query
def department_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each department's part of all lines as percent text."""
    t = TestTables(spark, sf_dir)
    d = cut_lineage(explore.department_sales(t.order_lines, t.products, t.departments))
    total = d.select(F.sum("n_lines")).scalar()
    return d.select("department", percent_text(F.col("n_lines") / total).alias("share"))


@query
def reorder_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    r = explore.reorder_rate(t.order_lines, t.products, TOP_REORDERED, orders=t.plain_orders, sequence="sequence")
    return r.select(F.col("rank").cast("bigint").alias("rank"), "product_id", "product_name", "n_lines", r6("reorder_rate").alias("reorder_rate"))


@query
def order_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = explore.order_sequences(TestTables(spark, sf_dir).order_lines)
    return s.select("order_id", F.size("products").cast("bigint").alias("n_products"), ids_text("products").alias("products"))


@query
def order_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = TestTables(spark, sf_dir).plain_orders
    return explore.sample_orders(o, SAMPLE_FRACTION, SEED).select("order_id", "user_id")


# ---------------------------------------------------------------- features


def _samples(t: TestTables) -> DataFrame:
    tx = _transactions(t)
    return windows.sliding_window_rfm(tx, "transaction_date", "user_id", "product_id", "quantity", OBSERVATION_DAYS, LABEL_DAYS, STRIDE_DAYS)


def _feature_matrix(t: TestTables) -> DataFrame:
    # orders feed the line split and the intervals, the timeline feeds the windows (bounds and rows)
    # and the department counts, the samples feed the median and the joins: each is written once
    t.materialize_orders()
    tx = cut_lineage(_transactions(t))
    span = cut_lineage(windows.date_span(tx, "transaction_date"))
    samples = cut_lineage(
        windows.sliding_window_rfm(tx, "transaction_date", "user_id", "product_id", "quantity", OBSERVATION_DAYS, LABEL_DAYS, STRIDE_DAYS, span)
    )
    interval = transactions.purchase_interval(t.orders)
    dept = transactions.department_frequency(tx, t.products, t.departments)
    return features.assemble_features(samples, interval, dept, t.products)


@query
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window samples on the pseudo-timeline with all seven features."""
    f = _feature_matrix(TestTables(spark, sf_dir))
    return f.select(*[r6(c).alias(c) if c in ("avg_days_since_prior", "department_frequency_ratio") else F.col(c) for c in f.columns])


@query
def as_of_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature matrix with intervals and department figures as they were known at each cut (A9, J9-J11 without look-ahead)."""
    t = TestTables(spark, sf_dir).materialize_orders()
    dated = cut_lineage(transactions.order_dates(t.orders))
    # a line, then a sample, has its product's department with it: the samples, many times the lines, are not joined to the products
    pdept = transactions.product_department(t.products)
    tx = cut_lineage(transactions.build_transactions(t.orders, t.order_lines).join(pdept, "product_id", "left"))
    span = cut_lineage(windows.date_span(tx, "transaction_date"))
    lengths = (OBSERVATION_DAYS, LABEL_DAYS, STRIDE_DAYS)
    items = tx.withColumn("item", F.struct("product_id", "department_id")).where("product_id is not null")
    free_shuffles(spark)
    samples = cut_lineage(windows.sliding_window_rfm(items, "transaction_date", "user_id", "item", "quantity", *lengths, span).select("*", "item.*").drop("item", "cut_date"))
    free_shuffles(spark)
    f = asof.as_of_features(samples, dated, tx, t.products, span, *lengths)
    discard(dated, tx)  # what was known at the cuts is written
    return f.select(*[r6(c).alias(c) if c in ("avg_days_since_prior", "department_frequency_ratio") else F.col(c) for c in f.columns])


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and labels of an exact stratified 20 % test part: each label's share is off by less than one row."""
    f = cut_lineage(_feature_matrix(TestTables(spark, sf_dir)).select("window_id", "user_id", "product_id", "label"))
    return split.stratified_split(f, "label", ["window_id", "user_id", "product_id"], 0.2, SEED).where("is_test").drop("is_test")


@query
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per (test part, label) of the seeded 80/20 hash split."""
    f = _feature_matrix(TestTables(spark, sf_dir))
    flag = features.split_flag(["window_id", "user_id", "product_id"], 0.2, SEED)
    return f.groupBy(flag.alias("is_test"), "label").agg(F.count(F.lit(1)).alias("n"))


@query
def user_product_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    u = features.user_product_features(t.order_lines, t.orders)
    return u.select("user_id", "product_id", "up_orders", r6("up_order_rate").alias("up_order_rate"), "up_orders_since_last_order", r6("up_order_rate_since_first_order").alias("up_order_rate_since_first_order"))


@query
def mba_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best matching name rule per (customer, product name) over each customer's purchased names."""
    t = TestTables(spark, sf_dir)
    items = t.attribute_lines("name").join(t.plain_orders.select("order_id", "user_id"), "order_id").select("user_id", "product_id").distinct()
    m = features.mba_features(items, _name_rules(t, max_rules=None))
    return m.select("user_id", "product_id", r6("mba_lift").alias("mba_lift"), r6("mba_confidence").alias("mba_confidence"), "mba_rules")


@query
def product_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    p = explore.product_features(t.order_lines, t.plain_orders, "sequence")
    return p.select("product_id", "n_lines", "n_orders", "n_users", r6("reorder_rate").alias("reorder_rate"))


@query
def user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    u = explore.user_features(t.order_lines, t.plain_orders)
    return u.select("user_id", "n_orders", "n_lines", "n_products", r6("mean_basket_size").alias("mean_basket_size"))


# ---------------------------------------------------------------- model (no SQL twin)


def _fingerprint(t: TestTables) -> str:
    """Names, sizes and change times of the files that training reads: other data, another key."""
    import hashlib

    jvm, conf = t.spark.sparkContext._jvm, t.spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in ("orders", "lineitem", "part"):
        path = jvm.org.apache.hadoop.fs.Path(f"{t.sf_dir}/{name}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


_models: dict[str, model.TrainedRepurchase] = {}


def _trained(t: TestTables) -> model.TrainedRepurchase:
    """Train once per session and data (the files' sizes and change times are part of the key); the
    artifacts and the scored rows are written, and later model queries load them."""
    from cartwise.session import ensure_checkpoint_dir
    from cartwise.sources.artifacts import load_artifacts, save_artifacts

    key = f"{t.spark.sparkContext.applicationId}-{_fingerprint(t)}"
    if key not in _models:
        root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/cartwise-models/{key}"
        tr = model.train_repurchase(_feature_matrix(t))
        save_artifacts(root, tr.model, tr.feature_cols, tr.metrics, parameters={**model.GBT_DEFAULTS, "split_seed": SEED, "test_fraction": 0.2})
        tr.test_scored.write.mode("overwrite").parquet(f"{root}/test_scored")
        art = load_artifacts(t.spark, root)
        _models[key] = model.TrainedRepurchase(art.model, t.spark.read.parquet(f"{root}/test_scored"), art.metrics, art.feature_cols)
    return _models[key]


@query
def repurchase_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows scored by the boosted-tree model."""
    tr = _trained(TestTables(spark, sf_dir))
    return tr.test_scored.select("window_id", "user_id", "product_id", "label", "probability", "prediction")


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    tr = _trained(TestTables(spark, sf_dir))
    return model.feature_importance(tr.model, tr.feature_cols)


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, precision, recall, F1 and AUC of the trained model on the held-out rows."""
    return _trained(TestTables(spark, sf_dir)).metrics


@query
def model_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out rows, and how many of their probabilities and of the importances differ when recomputed from the table of
    the model's nodes (L5, L6, A10): none."""
    tr = _trained(TestTables(spark, sf_dir))
    nodes = cut_lineage(trees.model_nodes(tr.model, tr.feature_cols))
    again = tr.test_scored.select("label", (F.abs(F.col("probability") - trees.node_probability(nodes)) > 1e-9).cast("bigint").alias("off"))
    given = model.feature_importance(tr.model, tr.feature_cols).select("feature", "importance")
    own = trees.node_importance(nodes).select("feature", F.col("importance").alias("own"))
    wrong = given.join(own, "feature", "left").agg(F.sum((F.abs(F.col("importance") - F.coalesce("own", F.lit(0.0))) > 1e-9).cast("bigint"))).scalar()
    return again.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").cast("bigint").alias("n_positive"), F.sum("off").alias("n_probabilities_off"), F.max(wrong).alias("n_importances_off"))


@query
def repurchase_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and labels of the rows that the model is evaluated on."""
    f = _feature_matrix(TestTables(spark, sf_dir))
    return f.where(features.split_flag(["window_id", "user_id", "product_id"], 0.2, SEED)).select("window_id", "user_id", "product_id", "label")


def _serving_tables(t: TestTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    tx = cut_lineage(_transactions(t))
    return transactions.purchase_interval(t.orders), transactions.product_department(t.products), transactions.department_frequency(tx, t.products, t.departments)


def _serving_requests(t: TestTables) -> DataFrame:
    """A request per (customer, product) line: every third leaves out its figures, every fifth customer and every
    seventh product is moved beyond the known ids."""
    lines = t.order_lines.join(t.plain_orders.select("order_id", "user_id"), "order_id").select("user_id", "product_id").distinct()
    given = (F.col("user_id") + F.col("product_id")) % 3 != 0
    return lines.select(
        F.when(F.col("user_id") % 5 == 0, F.col("user_id") + 1_000_000_000).otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("product_id") % 7 == 0, F.col("product_id") + 1_000_000_000).otherwise(F.col("product_id")).alias("product_id"),
        F.when(given, F.col("product_id") % 50).cast("int").alias("recency"),
        F.when(given, F.col("user_id") % 4 + 1).cast("int").alias("frequency"),
        F.when(given, (F.col("product_id") % 9).cast("double") / 2).alias("monetary"),
    )


@query
def serving_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving-time features with every default: unknown customers, unknown products, missing figures."""
    t = TestTables(spark, sf_dir).materialize_orders()
    interval, pdept, dept = _serving_tables(t)
    out = model.assemble_requests(_serving_requests(t), interval, pdept, dept, model.interval_median(interval))
    return out.select(*[r6(c).alias(c) if c in ("avg_days_since_prior", "department_frequency_ratio") else F.col(c) for c in out.columns])


@query
def score_and_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (customer, product name) line asked for by name, scored, plus name recommendations."""
    t = TestTables(spark, sf_dir).materialize_orders()
    tr = _trained(t)
    interval, pdept, dept = _serving_tables(t)
    lines = t.attribute_lines("name").join(t.plain_orders.select("order_id", "user_id"), "order_id")
    requests = lines.select("user_id", "product_id").distinct().join(t.name_products, "product_id").select("user_id", F.lit(None).cast("bigint").alias("product_id"), "product_name")
    out = model.score_and_recommend(requests, tr.model, interval, pdept, dept, _name_rules(t), t.name_products, model.interval_median(interval), TOP_N)
    return out.select("user_id", "product_id", "probability", "probability_text", F.array_join("recommendations", "|").alias("recommendations"))


# ---------------------------------------------------------------- sources


@query
def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dated order lines written as CSV and scanned back with a declared schema and parsed dates."""
    from cartwise.session import intermediate_path
    from cartwise.sources.files import read_transactions_csv, write_table

    lines = TestTables(spark, sf_dir).dated_lines("p_brand")
    path = intermediate_path(spark)
    out = lines.select("transaction_date", "order_id", "user_id", F.regexp_extract("item", "([0-9]+)", 1).cast("bigint").alias("product_id"), "quantity")
    write_table(out.withColumn("transaction_date", ts_text("transaction_date")), path, "csv")
    back = read_transactions_csv(spark, path)
    return back.select(ts_text("transaction_date").alias("transaction_date"), "order_id", "user_id", "product_id", "quantity")


@query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dated order lines as CSV text with every kind of broken row, scanned into good rows and rejects.

    By the order's id: a quantity that is no number, a date that is none, a field too few, a field too many, no order id.
    """
    from cartwise.session import intermediate_path
    from cartwise.sources import schemas
    from cartwise.sources.files import ingest_csv

    lines = TestTables(spark, sf_dir).dated_lines("p_brand").withColumn("product_id", F.regexp_extract("item", "([0-9]+)", 1))
    kind = F.col("order_id") % 11
    fields = [
        F.when(kind == 1, F.lit("1998-13-45")).otherwise(ts_text("transaction_date")),
        F.when(kind == 4, F.lit("")).otherwise(F.col("order_id").cast("string")),
        F.col("user_id").cast("string"),
        F.col("product_id"),
        F.concat(F.when(kind == 0, F.lit("x")).otherwise(F.lit("")), F.col("quantity").cast("bigint").cast("string")),
    ]
    text = F.when(kind == 2, F.concat_ws(",", *fields[:-1])).when(kind == 3, F.concat_ws(",", *fields, F.lit("7"))).otherwise(F.concat_ws(",", *fields))
    path = intermediate_path(spark)
    lines.select(text.alias("value")).write.text(path)
    good, bad = ingest_csv(spark, path, schemas.TRANSACTIONS, required=["order_id"], header=False, timestamp_format="yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]")
    none = F.lit(None).cast("string")
    good = good.select(ts_text("transaction_date").alias("transaction_date"), "order_id", "user_id", "product_id", "quantity", none.alias("reason"), none.alias("record"))
    empty = [F.lit(None).cast(good.schema[c].dataType).alias(c) for c in good.columns[:5]]
    return good.unionByName(bad.select(*empty, "reason", "record"))


@query
def artifact_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every saved table read back from the newest of two versions, one row per entry.

    The first version holds only rules without any row and other parameters; the second replaces both and adds the rest.
    """
    from cartwise.session import intermediate_path
    from cartwise.sources.artifacts import load_artifacts, save_artifacts

    t = TestTables(spark, sf_dir).materialize_orders()
    interval, pdept, dept = _serving_tables(t)
    found, metrics = _brand_rules(t), evaluate.confusion_matrix(t.scored_events)
    root = intermediate_path(spark)
    save_artifacts(root, rules=found.limit(0), parameters={"min_support": 1.0})
    save_artifacts(
        root, None, features.FEATURE_COLS, metrics, interval, dept, pdept, found, t.products,
        parameters={"min_support": MIN_SUPPORT, "min_confidence": MIN_CONFIDENCE, "limit_rows": 0},
    )
    art = load_artifacts(spark, root, with_model=False)

    def entries(df: DataFrame, part: str, key: Column, value: Column) -> DataFrame:
        return df.select(F.lit(part).alias("part"), key.cast("string").alias("key"), value.cast("string").alias("value"))

    rule_key = F.concat_ws(">", ids_text("antecedent"), ids_text("consequent"))
    names = spark.createDataFrame([(i, c) for i, c in enumerate(art.feature_cols)], "position int, feature string")
    numbers = spark.createDataFrame(sorted((k, float(v)) for k, v in art.parameters.items()), "name string, number double")
    out = [
        entries(art.interval, "interval", F.col("user_id"), _micro(F.col("avg_days_since_prior"))),
        entries(art.dept_freq, "department_frequency", F.concat_ws("/", "user_id", "department_id"), F.concat_ws("/", F.col("department"), F.col("department_frequency"), _micro(F.col("department_frequency_ratio")))),
        entries(art.product_dept, "product_department", F.col("product_id"), F.col("department_id")),
        entries(art.rules, "rules", rule_key, F.concat_ws("/", _micro(F.col("support")), _micro(F.col("confidence")), _micro(F.col("lift")))),
        entries(art.products, "products", F.col("product_id"), F.concat_ws("/", F.col("product_name"), F.coalesce(F.col("department_id").cast("string"), F.lit("-")))),
        entries(art.metrics, "metrics", F.concat_ws("/", "actual", "predicted"), F.col("n")),
        entries(names, "feature_cols", F.col("position"), F.col("feature")),
        entries(numbers, "parameters", F.col("name"), _micro(F.col("number"))),
    ]
    return reduce(DataFrame.unionByName, out)


@query
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving requests as a stream in several micro-batches, a quarter of them sent twice, answered with features.

    Every micro-batch pins the newest committed artifacts; a repeated request id is dropped by a bounded state.
    """
    from cartwise.session import intermediate_path
    from cartwise.sources.artifacts import save_artifacts
    from cartwise.streaming import TIMED_REQUEST_SCHEMA, start_scoring_stream

    t = TestTables(spark, sf_dir).materialize_orders()
    interval, pdept, dept = (cut_lineage(x) for x in _serving_tables(t))
    root, inbox, out, state = (intermediate_path(spark) for _ in range(4))
    save_artifacts(root, None, features.FEATURE_COLS, None, interval, dept, pdept, parameters={"interval_median": model.interval_median(interval)})

    asked = _serving_requests(t).withColumns({"request_id": F.monotonically_increasing_id(), "product_name": F.lit(None).cast("string")})
    asked = asked.withColumn("requested_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("request_id"), F.lit(1800))))
    first = cut_lineage(asked.select(*TIMED_REQUEST_SCHEMA.fieldNames()))
    # the files of the inbox: all requests, and a quarter of them once more; a batch takes half of the files, however many
    files = max(4, shuffle_partitions(spark))
    first.unionAll(first.where(F.col("request_id") % 4 == 0)).repartition(files).write.parquet(inbox)
    start_scoring_stream(spark, inbox, root, out, state, available_now=True, dedupe_within="1 hour", with_model=False, max_files=(files + 1) // 2).awaitTermination()
    back = spark.read.parquet(out)
    return back.select("user_id", "product_id", *[r6(c).alias(c) if c in ("avg_days_since_prior", "department_frequency_ratio") else F.col(c) for c in features.FEATURE_COLS])
