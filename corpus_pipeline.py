"""The training-data pipeline over ``documents``: quality, language, near duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept, and returns the columns
of ``documents``; the last returns the pieces of the packed sequences. Between stages the documents are
written to the shared checkpoint folder and read again, so a lost executor repeats a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import dartminhash, langid, packing, pii, quality
from cartwise.llm.queries import table, vocabulary
from cartwise.session import cut_lineage

CACHE = (20_000_000, 24_000_000)  # bytes of the encoder's caches: the stages before have filled their executors' heaps


def _apart(docs: DataFrame) -> DataFrame:
    """All columns but the id and the text under names of their own, so that no stage's columns can clash with them."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"__{i}") for i, c in enumerate(docs.columns)])


def _together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order and by their names."""
    return rows.select(*[F.col(c if c in ("doc_id", "text") else f"__{i}").alias(c) for i, c in enumerate(docs.columns)])


def _kept(rows: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in rows.columns if c != "doc_id")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of label 1 reaches the operator's threshold (null and empty texts are scored as empty)."""
    rows = _apart(docs)
    network = quality.learn(rows, table(spark, sf_dir, "labels"))
    return _together(quality.classify(rows, network, keep=_kept(rows)).where("predicted = 1"), docs)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without a letter go, and those that resemble every language far less than
    texts of their length do (``langid.floors``)."""
    profiles = langid.learn(docs)
    floors = langid.floors(docs, profiles)
    rows = _apart(docs)
    found = langid.identify(rows, profiles, keep=_kept(rows))
    return _together(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= langid.floor_of(F.col("text"), floors))), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the smallest id; rows equal in id and text count once.

    Rows without an id take part under numbers of their own above all ids, so they stay only where no
    document with an id resembles them.
    """
    rows = _apart(docs)
    ends = rows.agg(F.max("doc_id").alias("high"), F.min("doc_id").alias("low")).first()  # one row
    # the rows of a written table have the same places whenever they are read
    place = F.monotonically_increasing_id()
    high = -1 if ends["high"] is None else ends["high"]
    number = F.lit(high) + 1 + place if high < 1 << 62 else F.lit(min(ends["low"], 0)) - 1 - place
    rows = rows.withColumnRenamed("doc_id", "__id").withColumn("doc_id", F.coalesce("__id", number))
    kept = dartminhash.near_duplicates(rows).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    named = rows.join(kept, F.col("doc_id") == F.col("__kept")).dropDuplicates(["doc_id", "text"])
    return _together(named.drop("doc_id").withColumnRenamed("__id", "doc_id"), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    return pii.redact(docs, pii.train(), count_col="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), keep_ids=False, cache=CACHE)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

# no stage can be put in SQL (learned models, signatures, tokenizer); tests/llm compares them with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
