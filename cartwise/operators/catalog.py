"""Product catalog, name lookup and request resolution.

Name rules kept from the grocery recommender:

- an id resolves when it is in the catalog; an unknown id is skipped;
- a name resolves exactly first (case-sensitive). When several products share a name the
  last one wins (``dict(zip(names, ids))``); catalog order here is ``product_id``;
- otherwise the first catalog name (in order of first appearance) that contains the text,
  case-insensitively, is taken, and its id by the rule above (``fuzzy_match = true``);
- blank text resolves to nothing.

The substring match is a range lookup among the sorted suffixes of the names, never a cross product: a name
contains a text when one of its suffixes starts with it, and those suffixes stand together. A text finds
its range by its place in the sort, and the best name of a range is the minimum over at most a few dozen aligned
blocks of ranks, whose minima are known. A text that most names hold costs what a rare one costs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.functions.text import parse_request_token
from cartwise.functions.time import ceil_div, floor_div
from cartwise.session import cut_lineage

BLOCK = 8  # ranks per aligned block, and blocks per block of the next level


def product_catalog(products: DataFrame, departments: DataFrame, aisles: DataFrame) -> DataFrame:
    """Products with department and aisle names (J1): two left joins."""
    require_columns(products, ["product_id", "product_name", "department_id", "aisle_id"], "products")
    return products.join(departments, "department_id", "left").join(aisles, "aisle_id", "left")


def id_names(products: DataFrame) -> DataFrame:
    """``product_id -> product_name``, one row per id (last wins: the greatest name)."""
    return products.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.max("product_name").alias("product_name"))


def name_index(products: DataFrame) -> DataFrame:
    """One row per distinct name: ``product_name, product_id`` (the id a lookup by this name
    returns: the last product with it) and ``first_product_id`` (its catalog position)."""
    return (
        products.where(F.col("product_name").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("product_name")
        .agg(F.max("product_id").alias("product_id"), F.min("product_id").alias("first_product_id"))
    )


def _places(suffixes: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Suffixes with their rank (from 0), and texts with the ranks ``lo`` (included) to ``hi`` (not) of those that start with them.

    Suffixes and both ends of each text's range are sorted together: one range exchange, counts per sorted partition, and a
    running count inside each. Binary keys sort by byte; no UTF-8 text holds the byte FF, so it ends a range.
    """
    key = F.col("text").cast("binary")
    ends = texts.select(key.alias("key"), F.lit(0).alias("kind"), F.col("text")).unionAll(texts.select(F.concat(key, F.unhex(F.lit("FF"))), F.lit(1), F.col("text")))
    both = suffixes.select(F.col("suffix").cast("binary").alias("key"), F.lit(2).alias("kind"), F.lit(None).cast("string").alias("text"), "best").unionAll(ends.select("*", F.lit(None).cast(suffixes.schema["best"].dataType)))
    sorted_ = cut_lineage(both.repartitionByRange("key", "kind").withColumn("part", F.spark_partition_id()))
    is_suffix = (F.col("kind") == 2).cast("bigint")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sorted_.groupBy("part").agg(F.sum(is_suffix).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    upto = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, -1)  # a sorted partition
    placed = sorted_.withColumn("at", F.coalesce(F.sum(is_suffix).over(upto), F.lit(0))).join(starts, "part").withColumn("at", F.col("at") + F.col("start"))
    placed = cut_lineage(placed.select("kind", "text", "best", "at"))
    ranks = placed.where("kind = 2").select(F.col("at").alias("rank"), "best")
    ranges = placed.where("kind < 2").groupBy("text").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    return ranks, ranges.where("lo < hi")


def _block_minima(ranks: DataFrame, levels: int) -> DataFrame:
    """``level, block, best``: the least ``best`` of every aligned block of ``BLOCK ** level`` ranks."""
    level = ranks.select(F.lit(0).alias("level"), F.col("rank").alias("block"), "best")
    out = level
    for k in range(1, levels):
        level = level.groupBy(F.expr(f"block div {BLOCK}").alias("block")).agg(F.min("best").alias("best")).select(F.lit(k).alias("level"), "block", "best")
        out = out.unionAll(level)
    return out


def _cover(lo: Column, hi: Column, levels: int) -> Column:
    """The aligned blocks that make up the ranks ``lo`` to ``hi``: at most ``2 * (BLOCK - 1)`` per level."""

    def blocks(level: int, a: Column, b: Column) -> Column:
        some = F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(level).alias("level"), x.alias("block")))
        return F.when(a < b, some).otherwise(F.array().cast("array<struct<level: int, block: bigint>>"))

    parts = []
    for k in range(levels):
        a, b = ceil_div(lo, BLOCK**k), floor_div(hi, BLOCK**k)
        up_a, up_b = ceil_div(lo, BLOCK ** (k + 1)), floor_div(hi, BLOCK ** (k + 1))
        if k == levels - 1:
            parts.append(blocks(k, a, b))
            continue
        above = up_a < up_b  # whole blocks of the next level lie inside
        parts.append(blocks(k, a, F.when(above, F.least(up_a * BLOCK, b)).otherwise(b)))
        parts.append(F.when(above, blocks(k, F.greatest(up_b * BLOCK, a), b)).otherwise(F.array().cast("array<struct<level: int, block: bigint>>")))
    return F.concat(*parts)


def fuzzy_lookup(queries: DataFrame, names: DataFrame) -> DataFrame:
    """For each distinct query text, the first name (smallest ``first_product_id``) that contains
    it case-insensitively. Input ``queries(query)``, output ``query, product_name``."""
    q = queries.select("query").where(F.trim(F.col("query")) != "").distinct().withColumn("text", F.lower("query"))
    lname = F.lower(F.col("product_name"))
    tails = F.transform(F.sequence(F.lit(1), F.length(lname)), lambda s: F.substring(lname, s, F.length(lname)))
    named = names.where(F.length("product_name") > 0).select(F.struct(F.col("first_product_id").alias("first"), "product_name").alias("best"), F.explode(tails).alias("suffix"))
    suffixes = named.groupBy("suffix").agg(F.min("best").alias("best"))
    ranks, ranges = _places(suffixes, q.select("text").distinct())
    n = ranks.count()
    levels = 1
    while BLOCK**levels < n:
        levels += 1
    asked = ranges.select("text", F.inline(_cover(F.col("lo"), F.col("hi"), levels)))
    best = asked.join(_block_minima(ranks, levels), ["level", "block"]).groupBy("text").agg(F.min("best").alias("best"))
    return q.join(best, "text").select("query", F.col("best.product_name").alias("product_name"))


def parse_requests(requests: DataFrame, text_col: str = "request", basket_col: str = "basket_id") -> DataFrame:
    """Typed-in request text to ``basket_id, product_id, product_name`` (F12-F14): text that parses
    as an integer (after trimming) is an id, other text a name, blank text nothing."""
    as_id, as_name = parse_request_token(F.col(text_col))
    return requests.select(F.col(basket_col).alias("basket_id"), as_id.alias("product_id"), as_name.alias("product_name")).where(
        F.col("product_id").isNotNull() | F.col("product_name").isNotNull()
    )


def resolve_items(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Resolve basket requests to catalog ids (A3/A4 input parsing, F14, P12, J14).

    ``requests(basket_id, product_id BIGINT nullable, product_name STRING nullable)``: one of the two
    is set per row (an id wins when both are). Output one row per resolved request:
    ``basket_id, request STRING, product_id, product_name, fuzzy_match BOOLEAN``.
    Unknown ids and names drop out.

    The requests are written once (their upstream may be a large join): the distinct texts and ids are resolved by
    joins with the catalog, those that miss by the range lookup, and the answers are joined back.
    """
    require_columns(requests, ["basket_id", "product_id", "product_name"], "requests")
    index = cut_lineage(name_index(products))
    rid = F.col("product_id").cast("bigint")
    by_id = rid.isNotNull()
    request = F.when(by_id, rid.cast("string")).otherwise(F.col("product_name"))
    req = cut_lineage(requests.select("basket_id", by_id.alias("by_id"), request.alias("request")).where(request.isNotNull()))
    asked = cut_lineage(req.select("by_id", "request").distinct())

    ids = id_names(products).select(F.col("product_id").cast("string").alias("request"), "product_id", "product_name")
    known = asked.where("by_id").join(ids, "request").select("by_id", "request", "product_id", "product_name", F.lit(False).alias("fuzzy_match"))
    texts = asked.where("not by_id")
    exact = index.select(F.col("product_name").alias("request"), "product_id", "product_name")
    named = texts.join(exact, "request").select("by_id", "request", "product_id", "product_name", F.lit(False).alias("fuzzy_match"))
    misses = texts.join(exact, "request", "left_anti").select(F.col("request").alias("query"))
    found = fuzzy_lookup(misses, index).join(index.select("product_name", "product_id"), "product_name")
    found = found.select(F.lit(False).alias("by_id"), F.col("query").alias("request"), "product_id", "product_name", F.lit(True).alias("fuzzy_match"))
    answers = cut_lineage(known.unionByName(named).unionByName(found))
    return req.join(answers, ["by_id", "request"]).select("basket_id", "request", "product_id", "product_name", "fuzzy_match")
