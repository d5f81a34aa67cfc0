import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from cartwise.llm import bpe, packing, tokenfile
from cartwise.llm.tokens import library_encoder

DOCS = "doc_id bigint, text string, n_tokens string, ids string, __text string"
ODD = ["", " ", "  a", "a  b", "a   b ", "x \n\n y\n", "don't 'll 's", "é" * 500, "a" * 3000, "日本語 テキスト", "<|endoftext|> a<|startoftext|>", "\x1c a\tb", "1 22 333", "ÀÉ Σας ΣΑΣ é", "a\r\n b"]


def make(spark, texts, ids=None):
    rows = [(i, t, "x", "y", "z") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def random_texts(n, seed=3):
    r = random.Random(seed)
    bits = [" ", "  ", "\n", "a", "the", "'s", "9", "é", "\t", "!", "Word", "naïve", "²", "<|endoftext|>"]
    return ["".join(r.choice(bits) for _ in range(r.randint(1, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.asarray(ids, dtype="<u4").tobytes()


def test_bpe_equals_the_library(reference):
    own = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ODD + random_texts(3000)
    for t, ids in zip(texts, own.text.many(texts)):
        assert ids == packed(reference.encode_ordinary(t)), repr(t)
        assert own.decode(ids).decode() == t


def test_bpe_with_any_ranks_merges_lowest_then_leftmost():
    r = random.Random(5)
    for _ in range(300):  # ranks in an order that no training gives: a longer token may rank below its parts
        tokens = {bytes([97 + i]) for i in range(3)} | {"".join(r.choice("abc") for _ in range(r.randint(2, 4))).encode() for _ in range(12)}
        order = sorted(tokens, key=lambda _: r.random())
        ranks = {t: i for i, t in enumerate(order)}
        piece = "".join(r.choice("abc") for _ in range(r.randint(1, 14))).encode()
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1)]
            if not pairs or min(pairs)[0] == 1 << 30:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.BytePairs(ranks, r".+").merge([piece, piece]) == [[ranks[p] for p in parts]] * 2


def test_bpe_of_a_very_long_piece(reference):
    own = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    t = "ab" * 20_000 + "é" * 5_000
    assert own.encode(t) == packed(reference.encode_ordinary(t))


def test_encode_documents(spark, reference):
    texts = [None, "", "same", "same", *ODD]
    rows = bpe.encode_documents(make(spark, texts, [7, None, 2, 2, *range(10, 10 + len(ODD))]), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts) and sum(r["doc_id"] is None for r in rows) == 1
    by = {r["doc_id"]: r for r in rows}
    assert by[7]["n_tokens"] == 0 and by[7]["ids_sha256"] == hashlib.sha256(b"").hexdigest() == by[7]["decoded_sha256"]
    for i, t in zip(range(10, 10 + len(ODD)), ODD):
        assert bytes(by[i]["ids"]) == packed(reference.encode_ordinary(t))
        assert by[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.encode_documents(make(spark, []), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoder_equals_the_library(file):
    t = Tokenizer.from_file(public_tokenizers.path(file))
    texts = ODD + random_texts(3000)
    for x, ids in zip(texts, library_encoder(public_tokenizers.path(file)).many(texts)):
        assert ids == packed(t.encode(x, add_special_tokens=False).ids), repr(x)


def test_differencing_keeps_the_capacity():
    r = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        sizes = r.integers(1, 513, n)
        w = packing.windows_of(sizes, 1024)
        assert len(w) == n and np.bincount(w, weights=sizes).max() <= 1024
    sizes = np.array([c[1] for n in r.integers(1, 1024, 1500) for c in packing.cuts(int(n), 1024, 512)])
    w = packing.windows_of(sizes, 1024)
    assert (w.max() + 1) * 1024 < 1.015 * sizes.sum()  # little padding
    assert packing.windows_of(np.zeros(0, dtype=np.int64), 1024).size == 0


def test_pack_is_a_partition_of_every_document(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = [None, "", "same text", "same text", "word " * 5000, *ODD]
    ids = [0, 1, 2, 2, None, *range(10, 10 + len(ODD))]
    docs = make(spark, texts, ids)
    rows = packing.pack(docs, path).collect()
    want = sorted(packed([*t.encode(x or "", add_special_tokens=False).ids, 0]) for x in texts)
    by_doc = {}
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] <= 4096
        by_doc.setdefault(r["doc_id"], []).append(r)
    twice = by_doc.pop(2)
    assert len(twice) == 2 and bytes(twice[0]["ids"]) == bytes(twice[1]["ids"])
    got = [bytes(x["ids"]) for x in twice]
    for doc in by_doc.values():
        doc.sort(key=lambda r: r["start"])
        assert [r["start"] for r in doc] == np.r_[0, np.cumsum([r["length"] for r in doc])[:-1]].tolist()
        got.append(b"".join(bytes(r["ids"]) for r in doc))
        assert {r["doc_tokens"] for r in doc} == {len(got[-1]) // 4}
    assert sorted(got) == want
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == np.r_[0, np.cumsum([n for _, n in w])[:-1]].tolist() and sum(n for _, n in w) <= 1024
    seq = packing.sequences(packing.pack(docs, path)).collect()
    assert sum(s["n_tokens"] for s in seq) == sum(len(x) // 4 for x in want)
    assert all(len(s["ids"]) == 4 * (s["n_tokens"] + s["n_padding"]) for s in seq)
    assert packing.pack(make(spark, []), path).count() == 0


def test_equal_rows_spread_over_the_groups(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, "the same few words") for i in range(2000)], "doc_id bigint, text string")
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), group=100, keep_ids=False).collect()
    sizes = {}
    for r in got:
        sizes[r["sequence_id"] >> 32] = sizes.get(r["sequence_id"] >> 32, 0) + 1
    assert len(got) == 2000 and len(sizes) >= 15 and max(sizes.values()) <= 200


def test_token_files_round_trip(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    texts = [None, "", "same", "same", "long words here " * 30_000, *ODD]
    ids = [5, None, 2, 2, 3, *range(10, 10 + len(ODD))]
    manifest = tokenfile.write(make(spark, texts, ids).repartition(3), str(tmp_path), path, end_id=1)
    rows = tokenfile.read(manifest).collect()
    assert len(rows) == len(texts)
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == np.r_[0, np.cumsum([r["n_tokens"] for r in rows])[:-1]].tolist()
    known = [r["doc_id"] for r in rows if r["doc_id"] is not None]
    assert rows[0]["doc_id"] is None and known == sorted(known)
    want = sorted(packed([*t.encode(x or "", add_special_tokens=False).ids, 1]) for x in texts)
    assert sorted(bytes(r["ids"]) for r in rows) == want
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    few = tokenfile.read(manifest, wanted=[3, 12]).collect()
    assert {r["doc_id"] for r in few} == {3, 12}
    empty = tokenfile.write(make(spark, []), str(tmp_path / "none"), path, end_id=1)
    assert tokenfile.read(empty).count() == 0


def test_a_reader_decompresses_only_what_is_asked(tmp_path):
    import zstandard

    file = str(tmp_path / "a.tok.zst")
    w = tokenfile.Writer(file, 2)
    docs = [np.arange(50_000), np.arange(10), np.arange(200_000) % 60_000, np.zeros(0, dtype=int), np.arange(7)]
    for i, d in enumerate(docs):
        w.add(i, d)
    w.close()
    r = tokenfile.Reader(file)
    touched = []
    frame = r.frame
    r.frame = lambda k: (touched.append(k), frame(k))[1]
    assert r.tokens(4).tolist() == list(range(7)) and r.tokens(3).size == 0
    assert set(touched) == {len(r.checks) - 1}
    for i, d in enumerate(docs):
        assert np.array_equal(r.tokens(i), d)
    raw = open(file, "rb").read()  # any decoder reads all ids
    all_ids = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
    assert np.array_equal(np.frombuffer(all_ids, "<u2"), np.concatenate(docs))
    broken = bytearray(raw)
    broken[20] ^= 1
    open(file, "wb").write(bytes(broken))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokenfile.Reader(file).tokens(0)


def test_caches_are_bounded_in_bytes_and_keep_no_long_text():
    import sys

    from cartwise.llm import tokens

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = library_encoder(public_tokenizers.path("byte_bpe_50k.json"), cache=(300_000, 200_000))
    r = random.Random(9)
    for k in range(40):  # texts without spaces, and words that never come back
        long = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(3000))
        words = " ".join("".join(r.choice("abcdefghij") for _ in range(9)) + r.choice(["", ",", "é!"]) for _ in range(500))
        for text in (long, words):
            assert encoder(text) == packed(t.encode(text, add_special_tokens=False).ids)
        for cache in (encoder.units, encoder.pieces):
            held = sum(sys.getsizeof(a) + sys.getsizeof(b) for g in (cache, cache.old) for a, b in g.items()) + sys.getsizeof(dict(cache)) + sys.getsizeof(cache.old)
            assert held < 2 * cache.most and all(len(a) <= cache.longest == tokens.LONGEST for g in (cache, cache.old) for a in g)
    assert encoder.units.old and encoder.pieces.old  # both went through a generation
    own = bpe.BytePairs.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    own.text.many(["漢" * 2000, "a" * 2000, "short words"])
    assert all(len(a) <= c.longest <= 3 * tokens.LONGEST for c in (own.text.units, own.text.pieces) for a in c) and own.text.units


def test_a_cache_makes_old_entries_young_again():
    from cartwise.llm.tokens import Cache

    made = []
    cache = Cache(lambda k: made.append(k) or k.encode(), 1000)
    for k in ("a", "b", "c", "d", "e", "a", "f", "a"):
        assert cache[k] == k.encode()
    assert made.count("a") == 1 and made == ["a", "b", "c", "d", "e", "f"]
    assert sorted(cache.unknown({"a", "z", "q"})) == ["q", "z"]
    cache.learn(["z", "long" * 10], [b"Z", b"L"])  # what is too long is held for a while
    assert (cache["z"], cache["long" * 10], cache["a"]) == (b"Z", b"L", b"a") and "long" * 10 not in cache
    cache.unknown(set())
    assert cache["long" * 10] == b"long" * 10


def test_other_tokenizer_files_take_whole_texts(tmp_path):
    from tokenizers import Regex, models, pre_tokenizers

    from cartwise.llm.tokens import WholeTexts

    base = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    base.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(r"[\p{L}\s]+"), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    base.save(str(tmp_path / "other.json"))
    encoder = library_encoder(str(tmp_path / "other.json"))
    assert isinstance(encoder, WholeTexts) and models
    for text in [*ODD, *random_texts(200)]:
        assert encoder(text) == packed(base.encode(text, add_special_tokens=False).ids)


def test_a_known_word_costs_no_call_with_marks_or_at_a_line_break():
    encoder = library_encoder(public_tokenizers.path("byte_bpe_50k.json"), cache=(1_000_000, 900_000))
    encoder.clear()
    encoder("x zorglewick naïveté")
    encoder("x zorglewick, naïveté!!! zorglewick.\nWord naïveté,$$$")
    kept = set(encoder.pieces) | set(encoder.pieces.old)
    assert not any("zorglewick" in p for p in kept) and not any(p.startswith("Ġna") for p in kept)
    assert {",", "!!!", ",$$$", "Word"} <= kept


def test_units_with_marks_breaks_and_control_characters_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encoder, r = Tokenizer.from_file(path), library_encoder(path), random.Random(11)
    bits = [" ", "\n", "\n", "\n\n", "\r", "\x1c", "\x1f", "\x85", "\xa0", " ", "the", "Word", "naïve", "日本", "'s", "'", "9", "²", ".", ",$$$", "***", "—", "ª", "́"]
    for _ in range(3000):
        x = "x " * r.randint(0, 1) + "".join(r.choice(bits) for _ in range(r.randint(1, 9)))
        assert encoder(x) == packed(tokenizer.encode(x, add_special_tokens=False).ids), x
