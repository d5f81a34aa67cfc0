"""Rule matching and top-N recommendations for many baskets at once.

A rule matches a basket when its antecedent is a subset of the basket and its consequent shares
no item with it. Plan:

1. a basket is reduced to the items that some rule names, one sorted array per basket: at most as long as the
   rules' vocabulary, however large the basket is; duplicates go before the shuffle. The arrays are written once;
2. every rule is indexed under the antecedent item that the fewest baskets hold. A basket looks only at the rules
   under its own items, and the join itself checks the rest of the antecedent and the consequent against the
   array, so only matches leave it;
3. rankings are algebraic: the first rule per (basket, product), the first N products and rules by
   rank, a count of rules. No basket's rules are ever gathered.

Nothing is broadcast by hint: rules are few, and AQE decides on their measured bytes.

For each candidate product the first matching rule in rule order (highest lift) gives its lift
and confidence; candidates rank by that rule's place, then by product id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.text import unknown_name
from cartwise.operators.catalog import id_names
from cartwise.session import cut_lineage, shuffle_partitions


def _basket_sets(items: DataFrame, rules: DataFrame) -> DataFrame:
    """``basket_id, items``: the rule items of each basket that holds any, sorted and distinct; written."""
    require_columns(items, ["basket_id", "product_id"], "basket items")
    named = rules.select(F.explode("antecedent").alias("item")).unionByName(rules.select(F.explode("consequent").alias("item"))).distinct()
    pairs = items.select("basket_id", F.col("product_id").alias("item")).where(F.col("item").isNotNull() & F.col("basket_id").isNotNull())
    return cut_lineage(pairs.join(named, "item", "left_semi").groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items")))


def _rule_index(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``item, rule_id, rest, consequent``: each rule under its rarest antecedent item; at most a row per rule, written.

    A rule with an item that no basket holds can match none and is left out.
    """
    held = sets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    wanted = rules.select("rule_id", F.array_distinct("antecedent").alias("antecedent"), "consequent")
    parts = wanted.select("rule_id", F.explode("antecedent").alias("item")).join(held, "item")
    rarest = parts.groupBy("rule_id").agg(F.min_by("item", F.struct("n", "item")).alias("item"), F.count(F.lit(1)).alias("k"))
    index = wanted.join(rarest, "rule_id").where(F.size("antecedent") == F.col("k"))
    return cut_lineage(index.select("item", "rule_id", F.array_remove("antecedent", F.col("item")).alias("rest"), "consequent"))


def _matches(items: DataFrame, rules: DataFrame, exclude_owned: bool) -> DataFrame:
    """``basket_id, rule_id`` of every match."""
    sets = _basket_sets(items, rules)
    index = _rule_index(sets, rules)
    # placed by basket before they grow: while the rules are few, the joins and groupings by basket below need no other shuffle
    sets = sets.repartition(shuffle_partitions(sets.sparkSession), "basket_id")
    probes = sets.select("basket_id", F.col("items").alias("held"), F.explode("items").alias("item"))
    inside = (F.size("rest") == 0) | (F.size(F.array_except("rest", "held")) == 0)
    new = ~F.arrays_overlap("consequent", "held") if exclude_owned else F.lit(True)
    return probes.join(index, (probes["item"] == index["item"]) & inside & new).select("basket_id", "rule_id")


def matched_rules(items: DataFrame, rules: DataFrame, exclude_owned: bool = True) -> DataFrame:
    """``basket_id, rule_id, antecedent, consequent, support, confidence, lift`` for every match.

    With ``exclude_owned=False`` a rule whose consequent is already in the basket still matches.
    """
    require_columns(rules, ["rule_id", "antecedent", "consequent", "lift", "confidence"], "rules")
    cols = ["rule_id", "antecedent", "consequent"] + [c for c in ("support", "confidence", "lift") if c in rules.columns]
    return _matches(items, rules, exclude_owned).join(rules.select(*cols), "rule_id").select("basket_id", *cols)


def _ranked(matches: DataFrame, rules: DataFrame, top_n: int) -> DataFrame:
    """``basket_id, rank, product_id, rule_id``: the first ``top_n`` products by their first matched rule."""
    gives = rules.select("rule_id", F.explode("consequent").alias("product_id"))
    first = matches.join(gives, "rule_id").groupBy("basket_id", "product_id").agg(F.min("rule_id").alias("rule_id"))
    w = Window.partitionBy("basket_id").orderBy("rule_id", "product_id")
    return first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def _with_scores(ranked: DataFrame, rules: DataFrame, products: DataFrame) -> DataFrame:
    named = ranked.join(rules.select("rule_id", "lift", "confidence"), "rule_id").join(id_names(products), "product_id", "left")
    pid = F.col("product_id")
    return named.select("basket_id", F.col("rank").cast("int").alias("rank"), pid, F.coalesce("product_name", unknown_name(pid)).alias("product_name"), "lift", "confidence", "rule_id")


def recommend(items: DataFrame, rules: DataFrame, products: DataFrame, top_n: int = 3) -> DataFrame:
    """Top ``top_n`` products per basket: ``basket_id, rank, product_id, product_name, lift, confidence, rule_id``."""
    require_columns(rules, ["rule_id", "antecedent", "consequent", "lift", "confidence"], "rules")
    return _with_scores(_ranked(_matches(items, rules, True), rules, top_n), rules, products)


def _rule_labels(rules: DataFrame, products: DataFrame) -> DataFrame:
    """``rule_id, antecedent, consequent`` with item names in place of ids (an unknown id keeps its text)."""
    names = id_names(products)

    def side(c: str) -> DataFrame:
        ex = rules.select("rule_id", F.posexplode(c).alias("pos", "product_id")).join(names, "product_id", "left")
        label = F.coalesce("product_name", F.col("product_id").cast("string"))
        return ex.groupBy("rule_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", label.alias("name")))), lambda s: s["name"]).alias(c))

    return side("antecedent").join(side("consequent"), "rule_id")


def recommend_explain(
    resolved: DataFrame, rules: DataFrame, products: DataFrame, top_n: int = 3, top_rules: int = 5
) -> DataFrame:
    """One record per basket, as the verbose recommender returns it (A4, F19):
    ``basket_id, input ARRAY<STRUCT>, input_product_ids ARRAY, matched_rules_count BIGINT,
    recommendations ARRAY<STRUCT>, top_matched_rules ARRAY<STRUCT>`` (first ``top_rules`` in rule order,
    item ids replaced by names; an unknown id keeps its text)."""
    # ids only; the count, the products and the first rules all read it
    matches = cut_lineage(_matches(resolved, rules, True))
    counts = matches.groupBy("basket_id").agg(F.count(F.lit(1)).alias("matched_rules_count"))
    placed = matches.repartition(shuffle_partitions(matches.sparkSession), "basket_id")  # once for both rankings
    recs = _with_scores(_ranked(placed, rules, top_n), rules, products)
    recs = recs.groupBy("basket_id").agg(F.array_sort(F.collect_list(F.struct("rank", "product_id", "product_name", "lift", "confidence"))).alias("r"))
    recs = recs.select("basket_id", F.transform("r", lambda r: F.struct(r["product_id"].alias("product_id"), r["product_name"].alias("product_name"), r["lift"].alias("lift"), r["confidence"].alias("confidence"))).alias("recommendations"))
    w = Window.partitionBy("basket_id").orderBy("rule_id")
    firsts = placed.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top_rules).join(rules.select("rule_id", "support", "confidence", "lift"), "rule_id").join(_rule_labels(rules, products), "rule_id")
    firsts = firsts.groupBy("basket_id").agg(F.array_sort(F.collect_list(F.struct("k", "antecedent", "consequent", "support", "confidence", "lift"))).alias("m"))
    firsts = firsts.select(
        "basket_id",
        F.transform("m", lambda r: F.struct(r["antecedent"].alias("antecedent"), r["consequent"].alias("consequent"), r["support"].alias("support"), r["confidence"].alias("confidence"), r["lift"].alias("lift"))).alias("top_matched_rules"),
    )
    inputs = resolved.groupBy("basket_id").agg(
        F.collect_list(F.struct(F.col("request").alias("original"), "product_id", "product_name", "fuzzy_match")).alias("input"),
        F.array_sort(F.collect_set("product_id")).alias("input_product_ids"),
    )
    out = inputs.join(counts, "basket_id", "left").join(recs, "basket_id", "left").join(firsts, "basket_id", "left")
    return out.select(
        "basket_id",
        "input",
        "input_product_ids",
        F.coalesce("matched_rules_count", F.lit(0).cast("bigint")).alias("matched_rules_count"),
        F.coalesce("recommendations", F.array().cast(recs.schema["recommendations"].dataType)).alias("recommendations"),
        F.coalesce("top_matched_rules", F.array().cast(firsts.schema["top_matched_rules"].dataType)).alias("top_matched_rules"),
    )
