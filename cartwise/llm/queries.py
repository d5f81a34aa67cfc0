"""Named queries of the operators over the test tables, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import audit, bpe, dartminhash, langid, merkle, nndescent, packing, pii, quality, sharding, tokenfile, topk, urltrie
from cartwise.llm.common import held_out

#: Folder of the public vocabulary files; unset: that of the installed package.
TOKENIZERS = os.environ.get("CARTWISE_TOKENIZERS")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return os.path.join(TOKENIZERS, name) if TOKENIZERS else public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links (cosine >= 0.9) and components of all embeddings by NN-descent."""
    return nndescent.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents (five-word shingles, similarity 0.8) by DartMinHash."""
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text by hyperdimensional profiles."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every whole text, decoded again."""
    import public_tokenizers

    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes by histogram sort."""
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens by multiway differencing."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), keep_ids=False)


@query
def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as seekable zstandard files and read back."""
    manifest = tokenfile.write(table(spark, sf_dir, "documents"), tokenfile.new_folder(spark), vocabulary("word_bpe_49k.json"), end_id=1)
    return tokenfile.read(manifest, keep_ids=False)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text by the byte-level convolutional network."""
    docs = table(spark, sf_dir, "documents")
    scored = quality.classify(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows by integer inner product for every vec_id divisible by 50, exactly."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: fixed patterns, and the spans that the random field adds."""
    return pii.detect(table(spark, sf_dir, "documents"), pii.train())


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, by language; proofs folded from leaves of which about a seventh are tampered with."""
    docs = table(spark, sf_dir, "documents")
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, n_chars + 1).otherwise(n_chars)

    def leaf(n):
        return merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")])

    out = merkle.manifest(docs, "lang", "doc_id", leaf(n_chars), {"doc_id": F.col("doc_id"), "tampered": leaf(tampered)})
    out = out.withColumn("folded", merkle.fold(F.col("tampered"), F.col("path")))
    digests = {"leaf": "leaf", "subroot": "subroot", "root": "root", "folded_root": "folded"}
    hexed = {k: merkle.hex_of(F.col(c)).alias(k) for k, c in digests.items()}
    return out.select("doc_id", hexed["leaf"], hexed["subroot"], hexed["root"], merkle.proof(F.col("path")).alias("proof_sha256"), hexed["folded_root"], (F.col("folded") == F.col("root")).alias("verified"))


#: The contract's rules (fixed values).
URL_RULES = [
    urltrie.Rule("allow", "com"),
    urltrie.Rule("block", "example.com", "/en/"),
    urltrie.Rule("allow", "www.example.com", "/en/"),
    urltrie.Rule("block", "net", "/es/"),
    urltrie.Rule("block", "net", "/fr/"),
]


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the longest of five rules; URLs that no rule fits are allowed."""
    return urltrie.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents in all 120 orders: what each step removes, per language."""
    docs = audit.measured(table(spark, sf_dir, "documents"))
    return audit.audit(docs, audit.prose_filters(), "lang", table(spark, sf_dir, "labels"), duplicate="E")


#: The smallest node reachable from each by links (a, b) given both ways.
_REACH = """
reach(node, low) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node WHERE r.low < l.b),
component AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)"""


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


# crc32 bit by bit: a byte is xored in (values from 0 on), then come eight shifts (-1)
_MERKLE = f"""
WITH RECURSIVE
d AS (SELECT doc_id, lang, n_chars, {_field("doc_id")} || {_field("source")} || {_field("lang")} AS a, {_field("text")} AS z,
             xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, CAST(4294967295 AS BIGINT)), 4294967295) AS crc
      FROM documents),
h AS (SELECT doc_id, lang, sha256(a || {_field("n_chars")} || z) AS leaf,
             sha256(a || {_field("(CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END)")} || z) AS given FROM d),
leaves AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM h),
up AS (SELECT g, 0 AS level, i, n, leaf AS h FROM leaves
       UNION ALL
       SELECT g, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY g, level, i // 2),
sub AS (SELECT g, h FROM up WHERE n = 1),
top AS (SELECT 0 AS level, g AS i, (SELECT count(*) FROM sub) AS n, h FROM sub
        UNION ALL
        SELECT level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2),
steps AS (
  SELECT l.g, l.i, 0 AS tree, u.level, CASE WHEN s.h IS NULL THEN '-' WHEN u.i % 2 = 0 THEN '>' || s.h ELSE '<' || s.h END AS step
  FROM leaves l JOIN up u ON u.g = l.g AND u.n > 1 AND u.i = l.i >> u.level LEFT JOIN up s ON s.g = u.g AND s.level = u.level AND s.i = xor(u.i, 1)
  UNION ALL
  SELECT l.g, l.i, 1, u.level, CASE WHEN s.h IS NULL THEN '-' WHEN u.i % 2 = 0 THEN '>' || s.h ELSE '<' || s.h END
  FROM leaves l JOIN top u ON u.n > 1 AND u.i = l.g >> u.level LEFT JOIN top s ON s.level = u.level AND s.i = xor(u.i, 1)),
paths AS (SELECT g, i, list(step ORDER BY tree, level) AS path FROM steps GROUP BY g, i),
f AS (SELECT l.*, sub.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(p.path, CAST([] AS VARCHAR[])) AS path
      FROM leaves l JOIN sub ON sub.g = l.g LEFT JOIN paths p ON p.g = l.g AND p.i = l.i),
r AS (SELECT *, list_reduce(path, lambda a, s: CASE s[1] WHEN '<' THEN sha256(s[2:] || a) WHEN '>' THEN sha256(a || s[2:]) ELSE sha256(a) END, given) AS folded FROM f)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM r"""

_URLS = f"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}),
u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path, row_number() OVER () AS k FROM pages),
m AS (SELECT u.k, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
      FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY u.k)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m ON m.k = u.k"""

_AUDIT = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT t.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
              regexp_matches(text, '[#$%&*|]'), coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)] AS fails
      FROM t LEFT JOIN marks m ON m.doc_id = t.doc_id),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || e.x || g.x AS filter_order FROM f a, f b, f c, f e, f g WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
mask AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, fails),
s AS (SELECT *, list_min(list_filter([CASE WHEN fails[i] THEN position(substr('ABCDE', i, 1) IN filter_order) END for i in range(1, 6)], lambda p: p IS NOT NULL)) AS gone FROM mask, o),
cells AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS x FROM (SELECT DISTINCT part FROM d), o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT c.part, c.filter_order, c.step, c.x,
             sum(CASE WHEN gone IS NULL OR gone > c.step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = c.step THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone < c.step AND fails[ascii(c.x) - 64] THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails[ascii(c.x) - 64] AND len(list_filter(fails, lambda b: b)) = 1 THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN gone = c.step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = c.step THEN toxic ELSE 0 END) AS toxic_lost
      FROM cells c JOIN s ON s.part = c.part AND s.filter_order = c.filter_order GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r"""


def oracle_sql() -> dict[str, str]:
    """DuckDB twins of the operators that SQL can express."""
    return {
        "op1_near_vectors": f"""
WITH RECURSIVE
v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
nodes AS (SELECT vec_id AS node FROM embeddings),
{_REACH.strip()}
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.node = e.vec_id""",
        "op2_dart_minhash": f"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x00-\\x20]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                                     ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k >= 0.8 * (x.n + y.n - k)),
nodes AS (SELECT doc_id AS node FROM documents),
{_REACH.strip()}
SELECT d.doc_id, c.component_id AS class_id, coalesce(n.n, 0) AS n_shingles, d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON c.node = d.doc_id LEFT JOIN n USING (doc_id)""",
        "op9_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 5""",
        "op11_merkle": _MERKLE,
        "op12_url_filter": _URLS,
        "op13_filter_audit": _AUDIT,
    }
