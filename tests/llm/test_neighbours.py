import math
import random

import numpy as np
from cartwise.llm import dartminhash, nndescent, topk
from cartwise.llm.common import components
from cartwise.llm.shingles import shingles


def classes(n, edges):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(r.randint(100, 160), r.randint(100, 160)) for _ in range(30)] + [(200, i) for i in range(201, 260)] + [(7, 7)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = classes(300, edges)
    assert got and all(want[n] == c for n, c in got.items())
    assert {n for e in edges for n in e if e[0] != e[1]} == set(got)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near(rng, v, noise):
    x = v + rng.normal(size=len(v)) * noise / math.sqrt(len(v))
    return x / np.linalg.norm(x)


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    v = [rng.normal(size=32) for _ in range(250)]
    v += [near(rng, v[0] / np.linalg.norm(v[0]), 0.2) for _ in range(40)]  # a group, links among all
    v += [near(rng, v[i] / np.linalg.norm(v[i]), 0.3) for i in range(1, 30)]
    chain = [v[40] / np.linalg.norm(v[40])]
    for _ in range(6):  # a chain: neighbours link, ends do not
        chain.append(near(rng, chain[-1], 0.38))
    v += chain[1:] + [v[60], v[60] * 3.5]  # an equal vector and one of the same direction
    rows = [(i + 1, [float(np.float32(x)) for x in w], 1, "s") for i, w in enumerate(v)]
    n = len(rows)
    x = np.array([r[1] for r in rows])
    x = x / np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    want = classes(n, np.argwhere(linked).tolist())
    odd = [(1001, None, 1, "s"), (1002, [0.0] * 32, 1, "s"), (1003, [None] + rows[0][1][1:], 1, "s"), (1004, [float("nan")] + rows[0][1][1:], 1, "s"), (1005, [float("inf")] + rows[0][1][1:], 1, "s"), (1006, [], 1, "s"), (1007, [1.0, 0.0], 1, "s"), (1008, [1.0, 0.1], 1, "s"), (None, [0.5] * 5, 1, "s")]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, n_links int, kept string").repartition(3)
    got = {r["vec_id"]: r for r in nndescent.near_vectors(df).collect()}
    assert len(got) == n + len(odd)
    for i in range(n):
        r = got[i + 1]
        assert (r["n_links"], r["component_id"], r["kept"]) == (linked[i].sum(), want[i] + 1, want[i] == i), i
    for i in (1001, 1002, 1003, 1004, 1005, 1006):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert (got[1008]["n_links"], got[1008]["component_id"]) == (1, 1007) and got[None]["component_id"] is None
    assert nndescent.near_vectors(df.limit(0)).count() == 0


def test_a_large_component_is_counted_without_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "BLOCK", 20)  # shrinks blocks so that the mean's shortcut and several blocks are used
    rng = np.random.default_rng(8)
    base = np.eye(16)[0]
    v = [near(rng, base, 0.25) for _ in range(90)] + [near(rng, base, 0.55) for _ in range(25)]
    x = np.array(v)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in nndescent.near_vectors(df).collect()}
    want = classes(len(v), np.argwhere(linked).tolist())
    assert [got[i]["n_links"] for i in range(len(v))] == linked.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(v))] == want


def test_dense_groups_keep_the_links_between_them(spark):
    rng = np.random.default_rng(12)
    frame = np.linalg.qr(rng.normal(size=(256, 256)))[0].T
    far = 0.92 / 0.99
    centres = [frame[0], far * frame[0] + math.sqrt(1 - far * far) * frame[1]]
    v = [math.sqrt(0.99) * c + 0.1 * frame[2 + 70 * g + i] for g, c in enumerate(centres) for i in range(70)]  # 0.99 inside, 0.92 across
    df = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = nndescent.near_vectors(df).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(139, 0)} and sum(r["kept"] for r in got) == 1


def test_audit_sees_missing_pairs(spark):
    rng = np.random.default_rng(14)
    single = [near(rng, rng.normal(size=64), 0) for _ in range(1500)]
    pair = [near(rng, single[0], 0.1)]

    def table(v, copies):
        df = spark.createDataFrame([(i, w.tolist(), copies[i]) for i, w in enumerate(v)], "id bigint, e array<double>, copies bigint")
        return nndescent.unit_vectors(df, "id", "e").drop("copies").join(df.select("id", "copies"), "id").select("id", "copies", "u").checkpoint()

    none = spark.createDataFrame([], "id bigint, links bigint")
    # one pair among 1,501 vectors: a sample of 256 may hold neither
    lone = table(single + pair, [1] * 1501)
    by_hash = [r["id"] for r in lone.orderBy(nndescent.F.xxhash64("id"), "id").select("id").collect()]
    assert not {0, 1500} & set(by_hash[:16])
    assert nndescent.audit(lone, none, 64, 0.9, sample=16)[0] == 0
    found = spark.createDataFrame([(0, 1), (1500, 1)], "id bigint, links bigint")
    recall, bound = nndescent.audit(lone, found, 64, 0.9, sample=16)
    assert recall == 1 and bound == 3 / 1501
    # a bounded look: it stops early and says how much it knows
    recall, bound = nndescent.audit(lone, none, 64, 0.9, sample=16, most=16)
    assert recall == 1 and bound == 3 / 16
    assert nndescent.audit(lone.limit(0), none, 64, 0.9) == (1.0, 0.0)
    # a group with many copies is whole, 60 pairs are missing
    group = [near(rng, single[0], 0.05) for _ in range(40)]
    far = single[1:61] + [near(rng, w, 0.1) for w in single[1:61]]
    copies = [1000] * 40 + [1] * 120
    found = spark.createDataFrame([(i, 39_000) for i in range(40)], "id bigint, links bigint")
    assert abs(nndescent.audit(table(group + far, copies), found, 64, 0.9)[0] - 40 / 160) < 1e-9


def test_rough_vectors_are_near_enough():
    """One byte per component moves a cosine by less than the margin, for ordinary, sparse and long vectors."""
    rng = np.random.default_rng(3)
    for make in (lambda: rng.normal(size=(300, 64)), lambda: rng.normal(size=(300, 64)) * (rng.random((300, 64)) < 0.1) + 1e-9, lambda: rng.standard_cauchy((300, 768)), lambda: rng.normal(size=(300, 3))):
        x = make()
        x = np.r_[x, x + 0.3 * rng.normal(size=x.shape) * np.abs(x)]
        u = x / np.sqrt((x * x).sum(axis=1))[:, None]
        r = nndescent._from_rough(nndescent._rough(u))
        real = u @ u.T
        assert np.abs(r @ r.T - real)[real > 0.85].max() < nndescent.ROUGH


def words(r, n):
    return [f"w{r.randint(0, 3000)}" for _ in range(n)]


def text_sets(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def near_texts(seed=5):
    r = random.Random(seed)
    texts = []
    for n in (3, 6, 40, 200, 900):
        base = words(r, n)
        texts.append(" ".join(base))
        for k in range(14):
            w = list(base)
            for _ in range(r.randint(0, max(1, n // 40))):
                w[r.randrange(n)] = f"x{r.randint(0, 99)}"
            texts.append(" ".join(w).upper() if k % 5 == 0 else " ".join(w))
    return texts + [" ".join(words(r, r.randint(1, 120))) for _ in range(120)] + ["one line again and again\n" * 30, "one line again and again\n" * 31]


def test_near_duplicates_equal_brute_force(spark):
    texts = near_texts()
    sets = text_sets(texts)
    edges = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = classes(len(texts), edges)
    rows = [(i, t, "c", True) for i, t in enumerate(texts)]
    odd = [(5001, None, "c", True), (5002, "", "c", True), (5003, " \n ", "c", True), (5004, texts[0], "c", True), (5004, texts[0], "c", True), (None, texts[0], "c", True), (5005, "long text here now " * 30_000, "c", True)]
    df = spark.createDataFrame(rows + odd, "doc_id bigint, text string, class_id string, kept boolean").repartition(3)
    out = dartminhash.near_duplicates(df).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) + len(odd)
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    assert [got[i]["kept"] for i in range(len(texts))] == [w == i for i, w in enumerate(want)]
    assert all(got[i]["class_id"] == i and got[i]["kept"] for i in (5001, 5002, 5003, 5005))
    assert got[5004]["class_id"] == 0 and not got[5004]["kept"] and got[None]["class_id"] is None and got[None]["kept"]
    assert dartminhash.near_duplicates(df.limit(0)).count() == 0


def test_a_group_over_several_blocks_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(dartminhash, "BLOCK", 8)
    texts = near_texts(9)
    sets = text_sets(texts)
    edges = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == classes(len(texts), edges)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(2)
    for scale in (1, 1.7, 9):
        h = rng.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = rng.random(300) * scale + 0.05, rng.random(300) * scale + 0.05
        x, y = np.zeros(400), np.zeros(400)
        x[:300], y[100:] = a, b
        want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        s = dartminhash.signatures([(h[:300], a), (h[100:], b)], 2048)
        assert abs((s[0] == s[1]).mean() - want) < 0.05
    one = dartminhash.signatures([(h[:1], np.ones(1)), (h[:1], np.ones(1)), (h[:0], np.ones(0))], 192)
    assert (one[0] == one[1]).all() and not one[2].any()


def test_signature_does_not_depend_on_the_batch():
    sets = [(h, np.ones(len(h))) for h, _ in shingles(near_texts(4)[:40])]
    together = dartminhash.signatures(sets)
    assert all((dartminhash.signatures([s])[0] == t).all() for s, t in zip(sets, together))


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(700, 16)).round(1) / 4  # coarse: many ties
    rows = [(i, [float(x) for x in w], "q") for i, w in enumerate(v)]
    odd = [(5000, None, "q"), (5050, [None] + rows[0][1][1:], "q"), (5100, [float("nan")] + rows[0][1][1:], "q"), (5150, [1.0, 2.0], "q"), (None, rows[0][1], "q")]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, score string").repartition(4)
    ints = topk.integer_vectors(df)
    got = [tuple(r) for r in topk.top_k(ints, ints.where("id % 50 = 0"), 5, pivots=8, block=6).orderBy("query_id", "rank").collect()]
    q = np.floor(256 * v.astype(np.float32).astype(np.float64)).astype(np.int64)
    want = []
    for i in range(0, 700, 50):
        s = q @ q[i]
        order = [j for j in np.lexsort((np.arange(700), -s)) if j != i][:5]
        want += [(i, k + 1, int(j), int(s[j])) for k, j in enumerate(order)]
    assert got == want
    few = topk.integer_vectors(df.where("vec_id in (0, 1, 2)"))
    assert topk.top_k(few, few.where("id = 0"), 5).count() == 2
    assert topk.top_k(ints.limit(0), ints.limit(0), 5).count() == 0
    big = spark.createDataFrame([(0, [4e6, 1.0]), (50, [4e6, 3.0]), (7, [4e6, 2.0])], "vec_id bigint, embedding array<double>")
    vectors = topk.integer_vectors(big)  # products that float64 does not hold exactly
    assert [r["vec_id"] for r in topk.top_k(vectors, vectors.where("id = 0"), 2).orderBy("rank").collect()] == [50, 7]


def test_an_outlier_is_no_pivot(spark):
    rng = np.random.default_rng(21)
    q = np.c_[np.zeros(600, dtype=np.int64), rng.integers(495, 505, size=(600, 3))]
    q[::60] = [300, 510, 510, 510]  # the best of all, if their distance to the outlier is not rounded to 512 off
    ids = spark.range(600).orderBy(topk.F.xxhash64("id"), "id").limit(1).collect()[0]["id"]  # the first by hash
    q[ids] = [3 * 10**18, 0, 0, 0]
    rows = [(i, x.tolist()) for i, x in enumerate(q)]
    schema = "id bigint, v array<bigint>"
    others = spark.createDataFrame([r for r in rows if r[0] != ids], schema).coalesce(1)
    vectors = others.unionAll(spark.createDataFrame([rows[ids]], schema).coalesce(1))  # in a batch of its own
    assert topk.choose_pivots(vectors, 1).collect()[0]["id"] != ids
    got = topk.top_k(vectors, others.where("id % 20 = 1"), 5, pivots=1).collect()
    big = q.astype(object)
    for i in sorted({r["query_id"] for r in got}):
        s = sorted((-int(v), j) for j, v in enumerate(big @ big[i]) if j != i)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == i] == s, i


def test_elimination_skips_candidates():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 24)) * 1000
    x = np.round(np.repeat(centres, 100, axis=0) + rng.normal(size=(2000, 24)) * 20)
    q, q_ids, x_ids, pivots = x[::100], np.arange(0, 2000, 100), np.arange(2000), x[::63][:32]
    dq, dx = topk._distances(q, pivots).astype(np.float32), topk._distances(x, pivots).astype(np.float32)
    shares = []
    # without a threshold, with those of a sample, and with rows that came before
    for seed, cut in ((0, 2000), (300, 2000), (300, 500)):
        some = rng.permutation(2000)[:seed]
        first = topk.first_thresholds(q.astype(np.int64), q_ids, x[some].astype(np.int64), x_ids[some], 5)
        best = topk.Best(q_ids, 5, first)
        evaluated = sum(topk.eliminate(best, np.arange(20), q, dq, x[lo : lo + cut], x_ids[lo : lo + cut], dx[lo : lo + cut]) for lo in range(0, 2000, cut))
        shares.append(evaluated / (20 * 2000))
        for i in range(20):
            full = x @ q[i]
            full[i * 100] = -np.inf
            want = np.lexsort((x_ids, -full))[:5]
            assert best.ids[i].tolist() == want.tolist() and best.scores[i].tolist() == full[want].tolist()
    assert shares[0] < 0.5 and shares[1] <= shares[0] and shares[2] < 0.2


def test_scores_are_exact_up_to_64_bits_and_clamped_beyond():
    r = random.Random(8)
    edge = [0, 1, -1, 2**22 - 1, 2**22, -(2**22), 2**44, -(2**44) - 1, 2**62, 2**63 - 1, -(2**63), 3_037_000_500]
    for size in (1, 3, 700):
        rows = [[r.choice(edge) if r.random() < 0.5 else r.randrange(-(2**r.randint(1, 63)), 2 ** r.randint(1, 63)) for _ in range(size)] for _ in range(30)]
        rows += [[0] * size, [2**31] * size, [-(2**31)] * size]
        m = np.array(rows, dtype=np.int64)
        want = [[max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, y)))) for y in rows] for x in rows]
        assert topk.exact_scores(m, m).tolist() == want


def test_outliers_among_ordinary_rows(spark):
    """Rows and queries beyond the exact limit, in the same batch as ordinary ones, and scores beyond 64 bits."""
    rng = np.random.default_rng(12)
    v = rng.integers(-300, 300, size=(400, 6)).astype(object)
    v[50], v[51], v[107], v[200] = [2**62] * 6, [2**62, 1, 0, 0, 0, -(2**62)], [-(2**63)] * 6, [40_000_000, 0, 1, 2, 3, 4]
    v[300], v[301] = [2**62] * 6, [2**61] * 6
    rows = [(i, [int(c) for c in x]) for i, x in enumerate(v)]
    vectors = spark.createDataFrame(rows, "id bigint, v array<bigint>").repartition(3)
    got = topk.top_k(vectors, vectors.where("id % 50 = 0 or id in (107, 301)"), 5, pivots=6).collect()
    clamp = lambda s: max(-(2**63), min(2**63 - 1, int(s)))
    for i in (*range(0, 400, 50), 107, 301):
        want = sorted((-clamp(v[j] @ v[i]), j) for j in range(400) if j != i)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == i] == want, i
    assert any(r["score"] == 2**63 - 1 for r in got)


def test_huge_components_become_the_nearest_integer(spark):
    df = spark.createDataFrame([(0, [1e300, -1e300]), (50, [1e18, -2.0])], "vec_id bigint, embedding array<double>")
    assert {r["id"]: r["v"] for r in topk.integer_vectors(df).collect()} == {0: [2**63 - 1, -(2**63)], 50: [2**63 - 1, -512]}
    got = topk.top_k(topk.integer_vectors(df), topk.integer_vectors(df), 5).collect()
    assert {(r["query_id"], r["vec_id"], r["score"]) for r in got} == {(0, 50, 2**63 - 1), (50, 0, 2**63 - 1)}
