import zlib

import pytest
from pyspark.sql import functions as F

from cartwise.llm import sharding


def test_sharding(spark):
    texts = [None, "", "é" * 10, *["copy " * 20] * 40, *[f"text {i} " * (i % 50) for i in range(3000)]]
    rows = [(None if i == 3 else i // 2 if i in (50, 51) else i, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, size string, other int").repartition(5)
    out = sharding.shard(docs)
    assert {"other", "shard", "slot"} <= set(out.columns) and dict(out.dtypes)["size"] == "bigint"
    got = out.collect()
    assert len(got) == len(texts)
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    total, largest, by = sum(r["size"] for r in got), max(r["size"] for r in got), {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    for s in range(24):
        assert abs(sum(r["size"] for r in by[s]) - total / 24) <= 2 * (0.004 * total / 24 + largest)
        assert sorted(r["slot"] for r in by[s]) == list(range(len(by[s])))
    copies = {r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"copy " * 20)}
    assert len(copies) <= 3  # equal texts stand together
    assert sharding.shard(docs.limit(0)).count() == 0


def test_one_text_with_most_of_the_bytes_is_divided_between_its_rows(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, "same").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    sizes = [r["b"] for r in sharding.shard(docs).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 4 * 13


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_rows_than_shards(spark, n):
    got = sharding.shard(spark.range(n).selectExpr("id AS doc_id", "'x' AS text")).collect()
    assert len(got) == n and all(0 <= r["shard"] < 24 and r["slot"] >= 0 for r in got)


@pytest.mark.parametrize("piece_bytes", [200, 64_000_000])
def test_places_equal_a_plain_sort(spark, piece_bytes):
    """Every document's size, crc32, shard and slot against one sort of all rows by (hash of the text, id)."""
    texts = [None, "", *["copy " * 20] * 300, *[f"text {i} " * (i % 50) for i in range(1500)]]
    docs = spark.createDataFrame([(7 * i - 400, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in sharding.shard(docs, piece_bytes=piece_bytes).collect()}
    hashes = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    size = {7 * i - 400: len((t or "").encode()) + 8 for i, t in enumerate(texts)}
    order = sorted(size, key=lambda i: (hashes[i], i))
    total = sum(size.values())
    shards = [got[i]["shard"] for i in order]
    assert shards == sorted(shards)  # contiguous in the order
    slots, below = {}, 0
    for i in order:
        r = got[i]
        assert r["slot"] == slots.get(r["shard"], 0)
        slots[r["shard"]] = r["slot"] + 1
        assert (r["size"], r["text_crc32"]) == (size[i], zlib.crc32((texts[(i + 400) // 7] or "").encode()))
        # a row lies beyond its shard's ideal ends by the tolerance and the rows at the ends at most
        assert below + size[i] > total * r["shard"] / 24 - 0.004 * total / 24 - 500 and below < total * (r["shard"] + 1) / 24 + 0.004 * total / 24 + 500
        below += size[i]


def test_pieces_follow_the_bytes_and_divide_copies(spark):
    keys = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 12345 ELSE xxhash64(id) END AS h", "id * 3 AS k", "10L AS size").repartition(4)
    for most in (30_000, 3_000, 100):
        bounds, counts = sharding.pieces(keys, [(0, 0)], most)
        assert sum(counts.values()) == 3000 and max(counts.values()) * 10 <= most
        assert (0, 0) in bounds and bounds == sorted(bounds)
    same = spark.range(50).selectExpr("7L AS h", "1L AS k", "10L AS size")  # one key: not divided, and no endless search
    assert max(sharding.pieces(same, [(0, 0)], 20)[1].values()) == 50
