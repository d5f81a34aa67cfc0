"""Request resolution: ids, exact names, case-insensitive substrings, and their tie rules."""

from cartwise.operators.catalog import name_index, resolve_items

CATALOG = [
    (1, "Organic Bananas"),
    (2, "Banana"),
    (3, "Organic Baby Spinach"),
    (4, "100% Juice_Box"),
    (5, "Banana"),  # duplicate name: a lookup by name returns the last id
    (6, "Limes"),
    (7, "Organic Cilantro"),
]


def resolve(spark, reqs):
    products = spark.createDataFrame(CATALOG, "product_id long, product_name string")
    r = spark.createDataFrame(reqs, "basket_id long, product_id long, product_name string")
    return {(x.basket_id, x.request, x.product_id, x.product_name, x.fuzzy_match) for x in resolve_items(r, products).collect()}


def test_ids_and_unknown_id(spark):
    assert resolve(spark, [(1, 6, None), (1, 404, None)]) == {(1, "6", 6, "Limes", False)}


def test_exact_name_last_wins(spark):
    assert resolve(spark, [(1, None, "Banana")]) == {(1, "Banana", 5, "Banana", False)}


def test_fuzzy_first_name_in_catalog_order(spark):
    # "banana" is inside "Organic Bananas" (first seen at id 1) and "Banana" (first seen at id 2)
    assert resolve(spark, [(1, None, "BANANA")]) == {(1, "BANANA", 1, "Organic Bananas", True)}
    assert resolve(spark, [(2, None, "cilan")]) == {(2, "cilan", 7, "Organic Cilantro", True)}


def test_wildcards_are_literal_and_no_match_and_blank(spark):
    got = resolve(spark, [(1, None, "0% j"), (1, None, "e_b"), (2, None, "%"), (3, None, "zzz"), (4, None, "   "), (5, None, "q")])
    assert got == {(1, "0% j", 4, "100% Juice_Box", True), (1, "e_b", 4, "100% Juice_Box", True), (2, "%", 4, "100% Juice_Box", True)}


def test_one_and_two_letter_queries(spark):
    got = resolve(spark, [(1, None, "L"), (2, None, "bY")])
    assert got == {(1, "L", 6, "Limes", True), (2, "bY", 3, "Organic Baby Spinach", True)}


def test_name_index(spark):
    products = spark.createDataFrame(CATALOG, "product_id long, product_name string")
    idx = {(r.product_name, r.product_id, r.first_product_id) for r in name_index(products).collect()}
    assert ("Banana", 5, 2) in idx and len(idx) == 6


def test_parse_requests(spark):
    from cartwise.operators.catalog import parse_requests

    df = spark.createDataFrame([(1, " 42 "), (1, "Banana"), (2, "   "), (2, "12abc"), (3, None)], "basket_id long, request string")
    got = {(r.basket_id, r.product_id, r.product_name) for r in parse_requests(df).collect()}
    assert got == {(1, None, "Banana"), (1, 42, None), (2, None, "12abc")}


def test_only_integer_like_text_is_an_id(spark):
    from cartwise.operators.catalog import parse_requests

    texts = ["+7", "-3", " 0012 ", "12.0", "1e3", "99999999999999999999999", "٣", "7 up", "1_000", "0x1F"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "basket_id long, request string")
    got = {r.basket_id: (r.product_id, r.product_name) for r in parse_requests(df).collect()}
    assert [got[i][0] for i in range(3)] == [7, -3, 12]
    assert all(got[i] == (None, texts[i]) for i in range(3, 10))


def test_range_lookup_equals_a_search_through_all_names(spark):
    import random

    from cartwise.operators.catalog import fuzzy_lookup

    r = random.Random(11)
    names = sorted({"".join(r.choice("abAB é%") for _ in range(r.randint(0, 14))) for _ in range(300)})
    names += ["a" * 400, "ring " * 30 + "z", "İstanbul", "straße", "x\U0010FFFFy"]
    r.shuffle(names)
    order = list(range(1000, 1000 + len(names)))
    texts = {t for n in names for t in [n[2:5].upper(), n[1:], n[:1], n[3:9]]} | {"a", "B", " ", "", "A" * 399, "a" * 401, "zzz", "%", "\U0010FFFF", "RING RING", "ß", "é"}
    index = spark.createDataFrame(list(zip(names, order)), "product_name string, first_product_id long").repartition(5)
    asked = spark.createDataFrame([(t,) for t in sorted(texts)] * 2, "query string")
    got = {x.query: x.product_name for x in fuzzy_lookup(asked, index).collect()}
    # lower-casing as the engine does it
    low = {x.n: x.l for x in spark.createDataFrame([(n,) for n in [*names, *texts]], "n string").selectExpr("n", "lower(n) AS l").collect()}
    want = {}
    for t in texts:
        if t.strip(" "):
            hits = [n for n in names if low[t] in low[n]]
            if hits:
                want[t] = hits[0]
    assert got == want
    assert fuzzy_lookup(asked, index.limit(0)).count() == 0 and fuzzy_lookup(asked.limit(0), index).count() == 0


def test_blocks_cover_every_range_once(spark):
    from pyspark.sql import functions as F

    from cartwise.operators.catalog import BLOCK, _cover

    ranges = [(a, b) for a in (0, 1, 7, 8, 9, 63, 64, 70, 500) for b in (1, 8, 9, 64, 65, 71, 511, 512) if a < b]
    df = spark.createDataFrame(ranges, "lo long, hi long")
    for r in df.select("lo", "hi", _cover(F.col("lo"), F.col("hi"), 3).alias("c")).collect():
        inside = sorted(x for b in r["c"] for x in range(b["block"] * BLOCK ** b["level"], (b["block"] + 1) * BLOCK ** b["level"]))
        assert inside == list(range(r["lo"], r["hi"])) and len(r["c"]) <= 2 * (BLOCK - 1) * 3
