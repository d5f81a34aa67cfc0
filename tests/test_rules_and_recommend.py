"""Baskets, FP-Growth and pair rules against brute-force counts; rule matching and ranking."""

from itertools import combinations
from math import ceil

import pytest

from cartwise.operators.baskets import baskets, mining_baskets
from cartwise.operators.recommend import matched_rules, recommend, recommend_explain
from cartwise.operators.rules import association_rules, pair_rules, pair_rules_fp, rules_summary

LINES = [
    # order, item (duplicates and single-item orders included)
    (1, 10), (1, 20), (1, 30), (1, 10),
    (2, 10), (2, 20),
    (3, 10), (3, 30),
    (4, 20), (4, 30), (4, 40),
    (5, 10), (5, 20), (5, 30), (5, 40),
    (6, 50),
    (7, 10), (7, 20),
    (8, 30), (8, 40),
]


def brute_rules(lines, min_support, min_conf):
    bs = {}
    for o, i in lines:
        bs.setdefault(o, set()).add(i)
    bs = [b for b in bs.values() if len(b) >= 2]
    n = len(bs)
    mc = ceil(min_support * n)
    count = lambda s: sum(1 for b in bs if s <= b)
    items = sorted({i for b in bs for i in b})
    freq = {}
    for k in range(1, len(items) + 1):
        for c in combinations(items, k):
            f = count(set(c))
            if f >= mc:
                freq[c] = f
    out = set()
    for s, f in freq.items():
        if len(s) < 2:
            continue
        for y in s:
            x = tuple(i for i in s if i != y)
            conf = f / freq[x]
            if conf >= min_conf:
                out.add((x, (y,), round(f / n, 9), round(conf, 9), round(conf / (freq[(y,)] / n), 9)))
    return out


def as_set(r):
    return {(tuple(x.antecedent), tuple(x.consequent), round(x.support, 9), round(x.confidence, 9), round(x.lift, 9)) for x in r.collect()}


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(LINES, "order_id long, product_id long")


def test_baskets_dedupe_and_min_items(lines):
    got = {r.order_id: r.items for r in baskets(lines).collect()}
    assert got[1] == [10, 20, 30] and 6 not in got and len(got) == 7


def test_fp_growth_matches_brute_force(lines):
    for sup, conf in ((0.2, 0.3), (0.3, 0.6), (0.1, 0.0)):
        assert as_set(association_rules(baskets(lines), sup, conf)) == brute_rules(LINES, sup, conf)


def test_mining_baskets_keep_denominator(lines):
    mb = mining_baskets(lines, 0.3)
    assert mb.count() == 7
    assert as_set(association_rules(mb, 0.3, 0.2)) == brute_rules(LINES, 0.3, 0.2)


def test_pair_rules_equal_fp_pairs(lines):
    for sup in (0.2, 0.3):
        exp = {r for r in brute_rules(LINES, sup, 0.1) if len(r[0]) == 1}
        assert as_set(pair_rules(baskets(lines), sup, 0.1)) == exp
        assert as_set(pair_rules_fp(baskets(lines), sup, 0.1)) == exp


def test_rule_ids_follow_lift_order(lines):
    r = association_rules(baskets(lines), 0.2, 0.3).orderBy("rule_id").collect()
    lifts = [x.lift for x in r]
    assert lifts == sorted(lifts, reverse=True) and [x.rule_id for x in r] == list(range(1, len(r) + 1))
    s = rules_summary(association_rules(baskets(lines), 0.2, 0.3)).collect()[0]
    assert s.n_rules == len(r) and s.max_lift == pytest.approx(max(lifts))


@pytest.fixture(scope="module")
def toy_rules(spark):
    rows = [
        (1, [1], [2], 0.1, 0.5, 3.0),
        (2, [1, 3], [4], 0.1, 0.4, 2.5),
        (3, [1], [4], 0.1, 0.9, 2.0),  # same product as rule 2, lower lift: rule 2 gives its score
        (4, [5], [6], 0.1, 0.6, 2.0),  # equal lift with rule 3: rule order breaks the tie
        (5, [1], [3], 0.1, 0.7, 1.5),  # consequent already in some baskets
        (6, [7, 8], [9], 0.1, 0.7, 9.0),  # antecedent only partly present
    ]
    return spark.createDataFrame(rows, "rule_id long, antecedent array<long>, consequent array<long>, support double, confidence double, lift double")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(i, f"p{i}") for i in (1, 2, 3, 4, 5, 7, 8)], "product_id long, product_name string")


def items_df(spark, baskets_):
    return spark.createDataFrame([(b, i) for b, its in baskets_.items() for i in its], "basket_id long, product_id long")


def test_matching_rules(spark, toy_rules):
    items = items_df(spark, {1: [1, 3], 2: [1], 3: [1, 5, 7], 4: [8, 2]})
    got = {(r.basket_id, r.rule_id) for r in matched_rules(items, toy_rules).collect()}
    assert got == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 3), (2, 5), (3, 1), (3, 3), (3, 4), (3, 5)}
    owned = {(r.basket_id, r.rule_id) for r in matched_rules(items, toy_rules, exclude_owned=False).collect()}
    assert (1, 5) in owned


def test_recommend_ranking_and_unknown_names(spark, toy_rules, names):
    items = items_df(spark, {1: [1, 3], 3: [1, 5, 7]})
    got = sorted((r.basket_id, r.rank, r.product_id, r.product_name, r.lift, r.confidence) for r in recommend(items, toy_rules, names, 5).collect())
    assert got == [
        (1, 1, 2, "p2", 3.0, 0.5),
        (1, 2, 4, "p4", 2.5, 0.4),
        (3, 1, 2, "p2", 3.0, 0.5),
        (3, 2, 4, "p4", 2.0, 0.9),
        (3, 3, 6, "Unknown(6)", 2.0, 0.6),
        (3, 4, 3, "p3", 1.5, 0.7),
    ]
    top1 = recommend(items, toy_rules, names, 1).collect()
    assert sorted((r.basket_id, r.product_id) for r in top1) == [(1, 2), (3, 2)]


def test_recommend_explain_record(spark, toy_rules, names):
    resolved = spark.createDataFrame(
        [(1, "1", 1, "p1", False), (1, "p", 3, "p3", True), (2, "9", 9, None, False)],
        "basket_id long, request string, product_id long, product_name string, fuzzy_match boolean",
    )
    rec = {r.basket_id: r for r in recommend_explain(resolved, toy_rules, names, top_n=3).collect()}
    one = rec[1]
    assert one.input_product_ids == [1, 3] and one.matched_rules_count == 3
    assert [x.product_name for x in one.recommendations] == ["p2", "p4"]
    assert [(x.antecedent, x.consequent) for x in one.top_matched_rules] == [(["p1"], ["p2"]), (["p1", "p3"], ["p4"]), (["p1"], ["p4"])]
    assert rec[2].matched_rules_count == 0 and rec[2].recommendations == []


def test_matching_equals_subset_tests(spark):
    import random

    r = random.Random(5)
    rules = [(i, r.sample(range(12), r.randint(1, 4)), [r.randrange(14)], 1.0, 1.0, 1.0) for i in range(1, 60)]
    rules += [(60, [3, 3, 1], [2], 1.0, 1.0, 1.0), (61, [99], [1], 1.0, 1.0, 1.0), (62, [], [1], 1.0, 1.0, 1.0), (63, [2], [4, 5], 1.0, 1.0, 1.0)]
    items = [(b, r.randrange(14)) for b in range(40) for _ in range(r.randint(1, 9))] + [(100, i) for i in range(14)] * 30 + [(None, 1), (7, None)]
    schema = "rule_id long, antecedent array<long>, consequent array<long>, support double, confidence double, lift double"
    rdf, idf = spark.createDataFrame(rules, schema), spark.createDataFrame(items, "basket_id long, product_id long")
    held = {}
    for b, i in items:
        if b is not None and i is not None:
            held.setdefault(b, set()).add(i)
    for owned in (True, False):
        want = sorted((b, k) for b, s in held.items() for k, a, c, *_ in rules if a and set(a) <= s and not (owned and set(c) & s))
        assert sorted((x.basket_id, x.rule_id) for x in matched_rules(idf, rdf, exclude_owned=owned).collect()) == want
    assert matched_rules(idf.limit(0), rdf).count() == 0 and matched_rules(idf, rdf.limit(0)).count() == 0


def test_matching_emits_no_more_rows_than_matches(spark, toy_rules):
    """Each rule waits under one item only, the one that the fewest baskets hold."""
    from cartwise.operators.recommend import _basket_sets, _rule_index

    items = items_df(spark, {b: [1, 7] + [3] * (b % 2) + [8] * (b == 4) + [50 + b] for b in range(1, 9)})
    sets = _basket_sets(items, toy_rules)
    assert {i for x in sets.collect() for i in x["items"]} == {1, 3, 7, 8}  # only what rules name
    index = {x.rule_id: (x.item, x.rest) for x in _rule_index(sets, toy_rules).collect()}
    assert index == {1: (1, []), 2: (3, [1]), 3: (1, []), 5: (1, []), 6: (8, [7])}  # rule 4 needs an item that no basket holds
