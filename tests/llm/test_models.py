import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cartwise.llm import langid, pii, quality

SYLLABLES = {"aa": ["the", "ing", "wh", "or"], "bb": ["sch", "ung", "ei", "ä"], "cc": ["ción", "que", "ll", "os"]}


def corpus(n=600, seed=2):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(sorted(SYLLABLES))
        words = ["".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(8, 90))]
        bad = r.random() < 0.25
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in words), lang if i % 7 else None, int(not bad)))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_language_of_held_out_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, g, "s", 0.5) for i, t, g, _ in rows], "doc_id bigint, text string, lang string, lang_pred string, score double")
    profiles = langid.learn(docs, dimensions=512)
    assert profiles.languages == sorted(SYLLABLES)
    odd = spark.createDataFrame([(-1, None, None, "s", 0.0), (-2, "", "aa", "s", 0.0), (-3, "12 + 3 !", "aa", "s", 0.0), (-4, "the " * 40_000, None, "s", 0.0), (None, "ung", "cc", "s", 0.0)], docs.schema)
    got = {r["doc_id"]: r for r in langid.identify(docs.unionAll(odd), profiles).collect()}
    assert len(got) == len(rows) + 5
    right = [got[i]["lang_pred"] == g for i, _, g, _ in rows if g and held(i)]
    assert np.mean(right) > 0.97
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (-1, -2, -3))
    assert got[-4]["lang_pred"] == "aa" and got[None]["lang_pred"] == "bb" and all(0 <= r["score"] <= 1 for r in got.values())
    empty = docs.limit(0)
    assert langid.identify(empty, langid.learn(empty)).count() == 0
    assert langid.identify(docs, langid.learn(empty)).where("lang_pred <> 'und'").count() == 0


def test_prototypes_and_floors_come_from_all_known_documents(spark):
    rows = [(i, "ab" * 8 if i % 9 else "cde fgh ij" * 2, "x") for i in range(2300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.learn(docs, dimensions=64)
    known = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5]
    v, _ = langid.bundles(known, 64)
    want = (v / np.linalg.norm(v, axis=1)[:, None]).sum(axis=0, dtype=np.float64)
    assert len(known) > 1500 and np.allclose(got.prototypes[0], want / np.linalg.norm(want), atol=2e-6)
    scores = np.round(got.predict(known)["score"], 4)
    q = np.quantile([s for s, t in zip(scores, known) if len(t) >= 16], [0.25, 0.5, 0.75])
    assert langid.floors(docs, got)[4] == pytest.approx(min(q[1] / 2, q[0] - 3 * (q[2] - q[0])), abs=1e-9)


def test_bundles_equal_their_definition():
    text, d = "Äb c, bä", 64
    low = " äb c bä "
    want = np.zeros(d)
    for i in range(len(low) - 2):
        if low[i + 1] == " ":
            continue
        parts = [langid.letter(0 if c == " " else ord(c), d).astype(float) for c in low[i : i + 3]]
        want += np.roll(parts[0], 2) * np.roll(parts[1], 1) * parts[2]
    got, has = langid.bundles([text, "??", None], d)
    assert np.array_equal(got[0], want) and has.tolist() == [True, False, False] and not got[1:].any()


def test_quality_of_held_out_documents(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, t, 9.0, 1) for i, t, _, _ in rows], "doc_id bigint, text string, score double, quality int")
    labels = spark.createDataFrame([(i, q, "x") for i, _, _, q in rows if i % 3] + [(1, None, "x"), (None, 1, "x")], "doc_id bigint, quality int, text string")
    net = quality.learn(docs, labels)
    odd = spark.createDataFrame([(-1, None, 0.0, 0), (-2, "", 0.0, 0), (-3, "thing whor " * 20_000, 0.0, 0), (None, "the", 0.0, 0)], docs.schema)
    got = {r["doc_id"]: r for r in quality.classify(docs.unionAll(odd), net).collect()}
    assert len(got) == len(rows) + 4
    assert np.mean([got[i]["predicted"] == q for i, _, _, q in rows if held(i)]) > 0.95
    assert got[-1]["score"] == got[-2]["score"] and got[-3]["predicted"] == 1
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    nothing = quality.learn(docs, labels.limit(0))
    assert {r["score"] for r in quality.classify(docs, nothing).collect()} == {0.5}
    assert quality.classify(docs.limit(0), net).count() == 0


def test_every_byte_of_a_text_counts():
    rng = np.random.default_rng(0)
    net = quality.Network(rng.normal(size=(257, 8)).astype("f4"), rng.normal(size=(64, 32)).astype("f4"), rng.normal(size=32).astype("f4"), rng.normal(size=32).astype("f4"), 0.1)
    net.embed[256] = 0
    text = "".join(rng.choice(list("abcdefgh "), 5000))

    def slow(raw):
        blocks = max(1, -(-len(raw) // 64))
        data = np.full(blocks * 64 + 64, 256)
        data[: len(raw)] = list(raw)
        e = net.embed[data]
        top = np.array([np.max([e[p : p + 8].reshape(-1) @ net.filters for p in range(b * 64, b * 64 + 64, 4)], axis=0) for b in range(blocks)])
        logits = [np.maximum(top[s : s + 8].max(axis=0) + net.bias, 0) @ net.dense + net.offset for s in range(0, max(1, blocks - 1), 7)]
        return 1 / (1 + np.exp(-np.mean(logits)))

    for n in (0, 1, 63, 64, 65, 511, 512, 513, 900, 5000):
        assert net.score([text[:n], "other"])[0] == pytest.approx(slow(text[:n].encode()), rel=1e-3)


def brute_spans(text):
    """The contract's patterns as they are stated."""
    out = []
    out += [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def test_patterns_equal_their_statement():
    r = random.Random(4)
    bits = ["a", "b.c", "@", "@x", ".com", ".", "-", "1", "255", "256", "4111111111111111", "4111 1111-1111 1111", "+1", "+", " ", "(", ")", "é", "\n", "0", "7.8.9", "_%", "²"]
    for _ in range(20_000):
        t = "".join(r.choice(bits) for _ in range(r.randint(1, 12)))
        assert pii.base_spans(t) == brute_spans(t), repr(t)
    assert [pii.luhn(x) for x in ("4111111111111111", "4111111111111112")] == [True, False]


@pytest.fixture(scope="module")
def field():
    return pii.train()


def test_field_adds_loose_forms_and_leaves_clean_lines(field):
    texts = ["please call (415) 555-2671 today", "ask bob at example dot com soon", "version 2.0. of 1999 costs 15.99", "the dot at the end", "write a@b.com or 10.0.0.1", None]
    got = pii.find(texts, field)
    assert [s[0] for s in got[0][1]] == ["phone"] and texts[0][got[0][1][0][1] : got[0][1][0][2]] == "(415) 555-2671"
    assert [s[0] for s in got[1][1]] == ["email"]
    assert got[2][1] == [] == got[3][1] == got[5][1]
    assert got[4][0] == got[4][1] == [("email", 6, 13), ("ip", 17, 25)]
    assert pii.mask(texts[4], got[4][1]) == "write [EMAIL] or [IP]"
    right = sum(sorted(s) == [x for x in pii.find([t], field)[0][1] if x not in pii.base_spans(t)] for t, s in map(pii.parse, pii.TABLE))
    assert right >= 0.95 * len(pii.TABLE)


def test_every_stretch_is_decoded_once(field, monkeypatch):
    texts = ["write to anna at firm dot de first", "x" * 40 + " mail theo at post dot net or call", "room 12"] * 3
    runs, decode = [], field.decode
    monkeypatch.setattr(pii, "BATCH", 1)  # a batch per stretch

    def counted(lines):
        runs.append(len(lines))
        assert len(runs) <= len(texts), "a stretch is decoded again"
        return decode(lines)

    monkeypatch.setattr(field, "decode", counted)
    got = pii.find(texts, field)
    assert sum(runs) == len(texts) and [[k for k, *_ in s] for _, s in got] == [["email"], ["email"], []] * 3


def test_a_long_line_is_decoded_whole(field, monkeypatch):
    number = "(415) 555-2671"
    assert [k for k, *_ in pii.find([f"please call {number} today"], field)[0][1]] == ["phone"]
    for before in range(160, 260, 3):  # every place of the number in a line full of clues
        text = "row 7 " * (before // 2) + "x " * (before % 2) + f"please call {number} today " + "row 7 " * 120
        a = text.index(number)
        assert ("phone", a, a + len(number)) in pii.find([text], field)[0][1], before
    line = [[text[a:z] for a, z in pii.words(text)], ["call", "555-0142"], ["x"]]
    whole = [x.tolist() for x in field.decode(line)]
    monkeypatch.setattr(pii, "STEP", 7)  # several blocks
    assert [x.tolist() for x in field.decode(line)] == whole


def test_viterbi_equals_brute_force(field):
    from itertools import product

    lines = [["call", "555-0142", "now"], ["x"], ["a", "at", "b"]]
    e, sizes = field.scores(lines)
    for line, n, tags in zip(e, sizes, field.decode(lines)):
        def total(path):
            return field.begin[path[0]] + sum(line[t, p] for t, p in enumerate(path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

        best = max(total(p) for p in product(range(len(pii.TAGS)), repeat=int(n)))
        assert total(tags.tolist()) == pytest.approx(best)


def test_detect_and_redact(spark, field):
    rows = [(1, "mail a.b@c.de, card 4111 1111 1111 1111 end", "en", "s", 43), (2, None, None, "s", None), (3, "", "en", "s", 0), (1, "mail a.b@c.de, card 4111 1111 1111 1111 end", "en", "s", 43), (None, "+1 (389) 555-5010 é 10.1.2.3", "en", "s", 28), (5, "z" * 200_000 + "@" + "1" * 50_000 + ".", "en", "s", 250_002)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, n_ip string, n_chars bigint")
    got = pii.detect(docs, field).collect()
    one = [r for r in got if r["doc_id"] == 1]
    assert len(got) == 6 and len(one) == 2 and one[0] == one[1]
    assert (one[0]["n_email"], one[0]["n_card"], one[0]["n_ip"], one[0]["n_phone"]) == (1, 1, 0, 0)
    assert one[0]["base_sha256"] == hashlib.sha256(b"email:5:13,card:20:39").hexdigest() and one[0]["spans"] == "email:5:13,card:20:39"
    none = next(r for r in got if r["doc_id"] is None)
    assert none["spans"] == "ip:20:28,phone:0:17"
    assert next(r for r in got if r["doc_id"] == 2)["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = pii.redact(docs, field, count_col="n_chars")
    assert clean.columns == docs.columns
    texts = {(r["doc_id"], r["text"], r["n_chars"]) for r in clean.collect()}
    assert (1, "mail [EMAIL], card [CARD] end", 29) in texts and (2, None, None) in texts and (None, "[PHONE] é [IP]", 14) in texts
    assert pii.detect(docs.limit(0), field).count() == 0


def test_learning_chunks_reach_every_place_of_a_text():
    size = quality.CHUNK * quality.BLOCK * quality.STEP
    for n in (0, 1, size - 1, size, size + 1, 5 * size + 7):
        raw = bytes((i * 7) % 251 for i in range(n))
        chunks, draw = quality.chunks_of(raw, 1)
        assert len(chunks) == len(draw) == max(1, -(-n // size)) and (draw > 0).all()
        seen = set()
        for i, c in enumerate(chunks):
            at = i * size if i < len(chunks) - 1 else max(0, n - size)
            part = raw[at : at + size]
            assert c[: len(part)].tolist() == list(part) and (c[len(part) :] == quality.PAD).all()
            seen |= set(range(at, at + len(part)))
        assert seen == set(range(n))
    # every document weighs alike: the chunks of a long one have as many, but later draws
    short = sum(quality.chunks_of(b"a", s)[1].min() < 0.1 for s in range(4000))
    long = sum((quality.chunks_of(b"a" * 50 * size, s)[1] < 0.1).sum() for s in range(4000))
    assert abs(short - long) < 120


def test_learning_is_bounded_in_chunks(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t * 40) for i, t, _, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows], "doc_id bigint, quality int")
    seen = []
    train = quality.train
    try:
        quality.train = lambda data, y, share, **k: seen.append((len(data), y.sum())) or train(data[:64], np.r_[np.zeros(32), np.ones(32)].astype(np.float32), share, **k)
        quality.learn(docs, labels, chunks=50)
    finally:
        quality.train = train
    assert seen == [(100, 50.0)]


def test_letter_vectors_are_bounded():
    keep = langid.MOST_LETTERS
    try:
        langid.MOST_LETTERS = 64 * 100
        langid.bundles(["".join(chr(0x4E00 + i) for i in range(1000))], 64)
        assert len(langid._LETTERS) <= 100
    finally:
        langid.MOST_LETTERS = keep
        langid._LETTERS.clear()


def test_kept_columns_may_not_have_the_names_of_added_ones(spark):
    docs = spark.createDataFrame([(1, "a", 2.0)], "doc_id bigint, text string, Score double")
    with pytest.raises(ValueError):
        langid.identify(docs, langid.learn(docs.selectExpr("doc_id", "text", "'x' AS lang")), keep=("Score",))


def planted(seed, n):
    """Loose forms of personal data in prose of invented words, and prose with other numbers; ``(text, kind or None, span)``."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(["the", "ing", "wh", "or", "ed", "an", "st", "re", "on"]) for _ in range(r.randint(1, 3)))
    host = lambda: r.choice(["example", "mail", "post", "firm"])
    tld = lambda: r.choice(["com", "org", "net", "de"])
    card = lambda s: s.join(["4111", "1111", "1111", "1111"]) if r.random() < 0.5 else s.join(["5500", "0000", "0000", "0004"])
    forms = [
        ("phone", lambda: f"({d(3)}) {d(3)}-{d(4)}"), ("phone", lambda: f"{d(3)}-{d(3)}-{d(4)}"), ("phone", lambda: f"0{d(2)} {d(3)} {d(4)}"), ("phone", lambda: f"1-800-{d(3)}-{d(4)}"),
        ("email", lambda: f"{word()} at {host()} dot {tld()}"), ("email", lambda: f"{word()}.{word()} [at] {host()}.{tld()}"), ("email", lambda: f"{word()} (at) {host()} (dot) {tld()}"),
        ("ip", lambda: f"{r.randint(10, 250)}.{r.randint(0, 250)}.{r.randint(0, 99)}[.]{r.randint(1, 99)}"), ("ip", lambda: f"10 . {r.randint(0, 99)} . {r.randint(0, 99)} . {r.randint(1, 99)}"),
        ("card", lambda: card(".")), ("card", lambda: card("/")), ("card", lambda: card("_")),
    ]
    cue = {"phone": ["call", "phone", "tel", "ring"], "email": ["write to", "mail", "contact"], "ip": ["host", "server", "from"], "card": ["card", "pay with", "charged"]}
    clean = [lambda: f"{d(2)}.{d(2)}", lambda: f"on 20{d(2)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}", lambda: f"version {d(1)}.{d(1)}.{d(1)}", lambda: f"the dot at the {word()}", lambda: f"order {d(8)}", lambda: f"{d(1)} of {d(2)}", lambda: f"meet at {word()}"]
    out = []
    for i in range(n):
        a, b = " ".join(word() for _ in range(r.randint(2, 12))), " ".join(word() for _ in range(r.randint(2, 12)))
        if i % 2:
            out.append((f"{a} {r.choice(clean)()} {b}", None, None))
        else:
            kind, make = forms[i // 2 % len(forms)]
            span = make()
            out.append((f"{a} {r.choice(cue[kind])} {span} {b}", kind, span))
    return out


def test_recall_of_the_field_on_planted_loose_forms(field):
    rows = planted(7, 2400)
    found, whole, false = {}, 0, 0
    for (text, kind, span), (base, every) in zip(rows, pii.find([t for t, *_ in rows], field)):
        if kind is None:
            false += bool(every)
            continue
        a = text.index(span)
        hit = any(k == kind and x < a + len(span) and z > a for k, x, z in every)
        whole += (kind, a, a + len(span)) in every
        found.setdefault(kind, []).append((hit, bool(base)))
    recall = {k: np.mean([h for h, _ in v]) for k, v in found.items()}
    print("recall", recall, "whole spans", whole / 1200, "by the patterns alone", np.mean([b for v in found.values() for _, b in v]), "clean lines touched", false / 1200)
    assert min(recall.values()) > 0.8 and np.mean(list(recall.values())) > 0.9 and false <= 12
