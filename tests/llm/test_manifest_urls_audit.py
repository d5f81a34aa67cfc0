"""Operators 11 to 13 against brute force: Merkle manifest, URL rules, filter interaction audit."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import audit, merkle, urltrie
from cartwise.llm.queries import URL_RULES, op11_merkle, op12_url_filter, op13_filter_audit
from cartwise.llm.urltrie import Rule

# ---------------------------------------------------------------- Merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def trees(rows, k):
    """``{row index: (leaf, siblings per level, folds)}`` and the root of ``(group, order, leaf)`` rows, by plain loops."""
    groups = {}
    for i, (g, o, h) in enumerate(rows):
        groups.setdefault(g, []).append(((o is not None, o or 0), h, i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))

    def climb(nodes):  # nodes: (hash, members); returns the last hash and each member's siblings
        paths = {m: [] for _, ms in nodes for m in ms}
        while len(nodes) > 1:
            up = []
            for at in range(0, len(nodes), k):
                run = nodes[at : at + k]
                for j, (_, ms) in enumerate(run):
                    for m in ms:
                        paths[m].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1 :])))
                up.append((sha("".join(h for h, _ in run)), [m for _, ms in run for m in ms]))
            nodes = up
        return nodes[0][0], paths

    subs, below = [], {}
    for g in names:
        top, paths = climb([(h, [i]) for _, h, i in sorted(groups[g])])
        subs.append((top, [i for _, _, i in groups[g]]))
        below |= paths
    subroot = {i: h for h, ms in subs for i in ms}
    root, above = climb(subs)
    return {i: (subroot[i], below[i] + above[i]) for i in below}, root


def fold(h, path):
    for left, right in path:
        h = sha(left + h + right)
    return h


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_equals_plain_loops(spark, fanout):
    r = random.Random(fanout)
    rows = [(None if i % 11 == 0 else "abcdé"[i * i % 5], None if i == 7 else i // 2, f"t{i // 3}", "x") for i in range(90)]
    rows += [("solo", 1, "only", "y"), *[("b", 5, "again", "z")] * 4]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o bigint, t string, idx string").repartition(5)
    out = merkle.manifest(df, "g", "o", merkle.leaf([F.col("t")]), {"g": F.col("g"), "t": F.col("t"), "n": F.lit(1)}, fanout)
    h = merkle.hex_of
    got = out.select("g", "t", "n", h(F.col("leaf")), h(F.col("subroot")), h(F.col("root")), merkle.proof(F.col("path")), h(merkle.fold(F.col("leaf"), F.col("path")))).collect()
    want, root = trees([(g, o, sha(field(t))) for g, o, t, _ in rows], fanout)
    expected = [(g, t, 1, sha(field(t)), want[i][0], root, sha("".join(a + b for a, b in want[i][1])), root) for i, (g, o, t, _) in enumerate(rows)]
    text = lambda rs: sorted(map(str, map(tuple, rs)))
    assert text(got) == text(expected)


def test_one_group_one_row_and_none(spark):
    one = spark.createDataFrame([("a", 3, None)], "g string, o bigint, t string")
    made = merkle.manifest(one, "g", "o", merkle.leaf([F.col("o"), F.col("t")]), {"o": F.col("o")}).first()
    assert made["leaf"] == made["subroot"] == made["root"] == hashlib.sha256(b"1:3-").digest() and made["path"] == []
    assert merkle.manifest(one.limit(0), "g", "o", merkle.leaf([F.col("t")])).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(one, "g", "o", merkle.leaf([F.col("t")]), fanout=1)


def test_merkle_query_equals_plain_loops(spark, tmp_path):
    import zlib

    rows = [(i, f"text é {i}\n" * (i % 5), ["en", "de", None][i % 3], None if i % 4 == 0 else "web", None if i % 9 == 0 else 10 * i) for i in range(60)]
    rows += [(None, None, "en", "s", 1), (61, "", "", "s", 2**63 - 1), (62, "long " * 50_000, "en", "s", 5), rows[4], rows[4], (4, "other", "de", "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(*x, b"w", 0.5) for x in rows], schema + ", leaf binary, path double").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")

    def leaf(d, text, lang, source, n):
        return sha("".join(map(field, (d, source, lang, n, text))))

    want, root = trees([(x[2], x[0], leaf(*x)) for x in rows], 2)
    expected = []
    for i, x in enumerate(rows):
        bad = x[0] is not None and zlib.crc32(str(x[0]).encode()) % 7 == 0 and x[4] is not None
        folded = fold(leaf(*x[:4], x[4] + 1) if bad else leaf(*x), want[i][1])
        assert (folded == root) != bad
        expected.append((x[0], leaf(*x), want[i][0], root, sha("".join(a + b for a, b in want[i][1])), folded, not bad))
    got = op11_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_no_task_holds_a_group(spark):
    """Places come from sorted partitions: no window is keyed by the group alone over rows."""
    df = spark.range(5000).select(F.lit("en").alias("g"), F.col("id").alias("o"), F.col("id").cast("string").alias("t")).repartition(6)
    nodes, groups = merkle.numbered(df.withColumn("h", merkle.leaf([F.col("t")])), "g", ["o"])
    got = nodes.select("g", "idx", "n", "o").collect()
    assert all((r["g"], r["idx"], r["n"]) == (0, r["o"], 5000) for r in got) and len(got) == 5000
    assert [tuple(r) for r in groups.collect()] == [("en", 0, 5000)]


# ---------------------------------------------------------------- URLs


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c.group().lower(), m.group(1)), m.group(2)) if m else ("", "")


def plain(url, rules, default="allow"):
    host, path = split(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if not fit:
        return host, path, None, default
    best = max(fit, key=lambda r: (len(r.text), len(r.host), r.verdict == "block"))
    return host, path, best.text, best.verdict


URLS = [
    None, "", "no scheme/en/", "http://", "http:///en/x", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/1?q=/es/", "https://example.com/en/", "https://example.com/en",
    "https://a.b.example.com/en/x/y", "https://notexample.com/en/x", "ftp://x.net/es/1#/fr/", "http://x.net/fr", "http://x.net/de/es/", "http://net/es/", "http://x.net?/es/", "http://x.net#/es/",
    "http://a..com/q", "http://example.com./en/", "http://user@example.com:80/en/", "x://y://com/", "http://ÄÖ.com/ß", "http://a\nb.com/e\nn/", "://net/fr/", "http://x.net//es/", "http://x.net/es/" + "p/" * 20_000,
    "http://" + "s." * 200 + "com/en/", "http://com/en/ ", "http://Example.org/en/",
]
MORE = [*URL_RULES, Rule("block", "example.com", "/en/1"), Rule("allow", "example.com", "/en/1"), Rule("block", "org", ""), Rule("allow", "b.example.com", "/en/x/y"), Rule("block", "x.net", "/e"), Rule("allow", "net", "//es")]


@pytest.mark.parametrize("rules", [URL_RULES, MORE, []])
@pytest.mark.parametrize("most_text", [10_000, -1])
def test_verdicts_by_trie_and_by_join(spark, rules, most_text):
    r = random.Random(1)
    hosts, paths = ["com", "example.com", "www.example.com", "b.example.com", "net", "x.net", "org", "q.org"], ["", "/", "/en/", "/en/1", "/en/x/y/z", "/es/", "/e", "/fr/2", "//es/"]
    urls = URLS + [f"http://{r.choice(['', 'm.', 'a.b.'])}{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '?a=/en/', '#t'])}" for _ in range(150)]
    rows = [(None if i == 3 else i, u, "w", "w") for i, u in enumerate(urls)] + [(5, URLS[5], "w", "w")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string").repartition(3)
    got = urltrie.judge(pages, rules, most_text=most_text)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((i, *plain(u, rules))) for i, u, _, _ in rows)


def test_rules_as_a_table_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.x.org/q"), (2, "http://y.org")], "page_id bigint, url string")
    table = spark.createDataFrame([Rule("block", "X.org", "/q")], "verdict string, host string, path string")
    for most in (100, 0):
        got = urltrie.judge(pages, table, default="block", most_text=most).orderBy("page_id").collect()
        assert [tuple(r)[3:] for r in got] == [("x.org/q", "block"), (None, "block")]
        assert urltrie.judge(pages.limit(0), table, most_text=most).count() == 0
    with pytest.raises(ValueError):
        urltrie.Trie([Rule("deny", "x.org")])


def test_url_query(spark, tmp_path):
    spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(URLS)], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = op12_url_filter(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *plain(u, URL_RULES))) for i, u in enumerate(URLS))


# ---------------------------------------------------------------- audit


def fails(text, smaller):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        any(c in "#$%&*|" for c in text),
        smaller,
    ]


def plain_audit(rows, labels):
    """All orders applied one after another to every row."""
    low = {}
    for d, t, *_ in rows:
        if d is not None:
            low[t or ""] = min(d, low.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}  # no id, no label
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    docs = [(g or "", fails(t or "", d is not None and d > low[t or ""]), d in good, d in toxic) for d, t, g in rows]
    out, shapley = [], {}
    for order in permutations(range(5)):
        for part in sorted({d[0] for d in docs}):
            left = [d for d in docs if d[0] == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                failing = sum(d[1][f] for d in everything)
                alone = sum(d[1][f] and sum(d[1]) == 1 for d in everything)
                out.append((part, f, ("".join("ABCDE"[x] for x in order), step, len(left), len(gone), failing - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone))))
    return sorted(str((part, *row, shapley[part, f])) for part, f, row in out)


def documents():
    r = random.Random(3)
    vocabulary = ["the", "Word", "BIG", "é", "x\x85y", "a\u00a0b", "#tag", "100%"]
    rows = []
    for i in range(160):
        n = r.choice([0, 3, 90, 120, 200])
        some = r.sample(vocabulary, r.randint(1, 4))
        words = [r.choice(some) + (str(k) if r.random() < 0.9 else "") for k in range(n)]
        rows.append((i, "".join(w + r.choice([" ", "\n", "\t", "\x0b ", "  ", "\x0c"]) for w in words), r.choice(["en", "de", "", None])))
    rows += [(500 + i, rows[i % 7][1], r.choice(["en", "de"])) for i in range(60)]  # copies in other parts too
    rows += [(700, None, "en"), (701, "", "de"), (702, None, None), (None, rows[3][1], "en"), (None, None, "de"), rows[9], rows[9], (9, rows[10][1], "en"), (703, "Ab " * 60_000, "solo")]
    labels = [(i, i % 3 % 2, int(i % 10 == 0)) for i in range(0, 700, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None), (99_999, 1, 1)]
    return rows, labels


def test_audit_query_equals_plain_loops(spark, tmp_path):
    rows, labels = documents()
    spark.createDataFrame([(*x, 1, "w") for x in rows], "doc_id bigint, text string, lang string, good bigint, part string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op13_filter_audit(spark, str(tmp_path))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(str, map(tuple, got.collect()))) == plain_audit(rows, labels)


def test_audit_of_other_filters_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "x", 5), (2, "a", "x", None), (3, "b", None, 1)], "doc_id bigint, text string, lang string, v int")
    conditions = {"S": F.col("v") < 3, "L": F.col("v") > 4}
    got = {(r["part"], r["filter_order"], r["step"]): r for r in audit.audit(df, conditions, "lang").collect()}
    assert len(got) == 2 * 2 * 2 and (got["x", "LS", 1]["removed"], got["x", "LS", 1]["kept"], got["x", "LS", 2]["kept"]) == (1, 1, 1)
    assert got["", "SL", 1]["shapley"] == 2 and got["", "SL", 1]["good_lost"] == 0
    assert audit.audit(df.limit(0), conditions, "lang", duplicate="D").count() == 0
    with pytest.raises(ValueError):
        audit.audit(df, conditions, "lang", duplicate="S")


def test_removal_steps_are_the_min_plus_product():
    orders = list(permutations(range(4)))
    steps = audit.removal_steps(4, orders)
    for mask in range(16):
        for o, order in enumerate(orders):
            at = [k for k, f in enumerate(order, 1) if mask >> f & 1]
            assert steps[mask, o] == (min(at) if at else np.inf)
