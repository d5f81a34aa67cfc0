"""The pipeline's stages on a small corpus, each checked on what its predecessor kept."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cartwise.llm import pii
from cartwise.llm.queries import QUERIES

SYLLABLES = {"en": ["the", "ing", "wh", "or", "ed", "an"], "de": ["sch", "ung", "ei", "ver", "keit", "ß"], "es": ["ción", "que", "ll", "os", "ado", "ñ"]}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    r = random.Random(7)
    rows, labels = [], []
    for i in range(700):
        lang = r.choice(sorted(SYLLABLES))
        words = ["".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(40, 160))]
        bad = i % 5 == 4
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        if i % 50 == 0:
            text += " write to jan.doe@mail.example.com or +1 (389) 555-5010"
        rows.append([i, text, lang, "s"])
        labels.append((i, int(not bad)))
    good = [x for x in rows if x[0] % 5 != 4 and x[0] % 50]
    for k, x in enumerate(good[:30]):  # near copies: one word changed, and exact ones
        w = x[1].split(" ")
        w[len(w) // 2] = "other"
        rows.append([1000 + k, " ".join(w) if k % 2 else x[1], x[2], "t"])
    rows += [[2000, None, "en", "s"], [2001, "", None, None], [2002, "12 34 " * 40, "en", "s"], [None, good[-1][1], "en", "s"], list(good[40]), [2003, good[41][1] + " end", "en", "s"]]
    alone = good[42][1].split(" ")
    rows += [[None, " ".join(alone[::-1]), "en", "s"]] * 2  # no id, and like no other text
    return [tuple([*x, None if x[1] is None else len(x[1])]) for x in rows], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("start", docs.collect())]
    for name, f in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(f(spark, docs, folder))
        out.append((name, docs.collect()))
        if name != "packing":
            assert docs.columns == COLUMNS
    return folder, dict(out)


def test_quality_and_language(stages):
    _, s = stages
    kept = {r["doc_id"] for r in s["quality"]}
    junk = {i for i in range(700) if i % 5 == 4}
    assert len(kept & junk) <= 0.05 * len(junk) and len(set(range(700)) - junk - kept) <= 0.02 * 560
    known = {r["doc_id"] for r in s["language"]}
    assert known == {r["doc_id"] for r in s["quality"] if r["text"] and any(c.isalpha() for c in r["text"])}
    assert not {2000, 2001, 2002} & known


def test_language_rejects_what_resembles_no_language(spark):
    """Long texts of one strange word go; ordinary and short ones stay."""
    r = random.Random(1)

    def prose(lang, n):
        return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))

    rows = [(i, prose(sorted(SYLLABLES)[i % 3], r.choice([2, 5, 60, 90, 200])), sorted(SYLLABLES)[i % 3]) for i in range(600)]
    odd = [(1000, "xqz " * 300, "en"), (1001, "zzzyx, " * 400, None), (1002, "qq", None), (1003, prose("en", 100) + " " + prose("de", 100), None)]
    docs = spark.createDataFrame([(*x, "s", len(x[1])) for x in rows + odd], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {x["doc_id"] for x in corpus_pipeline.keep_language(spark, docs, "").collect()}
    assert kept == {i for i, *_ in rows} | {1002, 1003}


def test_near_duplicates_leave_one(stages):
    _, s = stages

    def key(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    before = [(r["doc_id"], key(r["text"])) for r in s["language"] if r["doc_id"] is not None]
    after = {r["doc_id"] for r in s["near_duplicates"]}
    assert len(s["near_duplicates"]) == len(after)  # repeated rows count once
    # of three rows without an id one resembles a document, the others each other
    assert sum(r["doc_id"] is None for r in s["language"]) == 3 and None in after
    for i, a in before:
        copies = [j for j, b in before if j < i and len(a & b) >= 0.8 * len(a | b)]
        assert (i in after) == (not copies), i


def test_personal_data_is_masked(stages):
    _, s = stages
    before = {r["doc_id"]: r for r in s["near_duplicates"]}
    field = pii.train()
    for r in s["personal_data"]:
        old = before[r["doc_id"]]
        spans = pii.find([old["text"]], field)[0][1]
        assert r["text"] == pii.mask(old["text"], spans) and r["n_chars"] == len(r["text"])
        assert "@" not in r["text"] and "555-5010" not in r["text"]
    assert sum("[EMAIL]" in r["text"] and "[PHONE]" in r["text"] for r in s["personal_data"]) >= 10
    assert len(s["personal_data"]) == len(before)


def test_packing_is_a_partition(stages):
    _, s = stages
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in s["personal_data"]}
    got = {}
    for r in s["packing"]:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_run_equals_its_stages(spark, stages):
    folder, s = stages
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    order = lambda rows: sorted(tuple(-1 if r[c] is None else r[c] for c in cols) for r in rows)
    assert order(corpus_pipeline.run(spark, folder).collect()) == order(s["packing"])


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and set(QUERIES) <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


EXTRA = ["predicted", "score", "lang_pred", "kept", "class_id", "__kept", "__id", "__text", "__1", "spans", "a.b"]


def test_columns_with_the_stages_names_come_through(spark, stages, tmp_path):
    folder, s = stages
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    from pyspark.sql import functions as F

    wide = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in EXTRA])
    for name, f in corpus_pipeline.STAGES[:-1]:
        wide = corpus_pipeline.cut_lineage(f(spark, wide, folder))
        assert wide.columns == COLUMNS + EXTRA
        rows = wide.collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in s[name])
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}:{r['doc_id']}") for r in rows for c in EXTRA)
    last = corpus_pipeline.STAGES[-1][1](spark, wide, folder).collect()
    assert len(last) == len(s["packing"])


def test_stages_take_empty_tables_and_very_long_texts(spark, stages, tmp_path):
    folder, s = stages
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs.limit(0), folder).count() == 0
    r = random.Random(4)
    long = " ".join("".join(r.choice(SYLLABLES["en"]) for _ in range(r.randint(1, 3))) for _ in range(60_000))
    rows = [(10_000, long, "en", "s", len(long)), (10_001, long + " more", "en", "s", len(long) + 5), (10_002, "é" * 300_000, None, "s", 300_000)]
    more = docs.unionAll(spark.createDataFrame(rows, docs.schema))
    kept = {}
    for name, f in corpus_pipeline.STAGES[:-1]:
        more = corpus_pipeline.cut_lineage(f(spark, more, folder))
        kept[name] = {x["doc_id"] for x in more.collect()}
    assert {10_000, 10_001} <= kept["language"] and 10_000 in kept["near_duplicates"] and 10_001 not in kept["near_duplicates"]
    pieces = [x for x in corpus_pipeline.STAGES[-1][1](spark, more, folder).collect() if x["doc_id"] == 10_000]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = more.where("doc_id = 10000").first()["text"]
    assert sum(x["length"] for x in pieces) == len(t.encode(text, add_special_tokens=False).ids) + 1
