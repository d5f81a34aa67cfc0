"""Near duplicates by DartMinHash signatures (operator 2).

Every element of a weighted set owns a region: its weight times all ranks. Hashed darts fall into the
regions, one per unit of area on average, the same for every set that holds the element. A dart whose
weight coordinate is below the element's weight in a set hits that set. Each dart belongs to one of
``k`` coordinates, and a coordinate's value is the dart of the lowest rank that hits the set. Two sets
agree in a coordinate with the probability of their weighted Jaccard similarity. Only darts below a rank that
falls with the set's total weight are thrown, so a signature takes O(k log k + elements).

Signatures are cut into bands. Texts that share a band are joined into groups of candidates by
connected components; within a group every pair is compared by its signature and, where that allows 0.8, by
its whole shingle sets, in blocks, so that a group of any size is split over tasks and no pairs are
emitted but those that join two classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import components, map_texts, mix64
from cartwise.llm.shingles import WORDS, shingles
from cartwise.session import cut_lineage

COORDINATES, ROWS = 192, 6  # 32 bands: a pair at 0.8 shares none with probability 0.00006
SIMILARITY = 0.8
ALLOW = 0.6  # signatures that agree less than this are compared no further: 0.8 is 6.9 deviations above
BLOCK = 400  # texts per block of a large group
LEVELS = 7  # rank cells below 1: [0, 1/64), [1/64, 1/32), ..., [1/2, 1)
_STEP = np.uint64(0xD1342543DE82EF95)


def _poisson(area: float) -> np.ndarray:
    """Cumulative Poisson probabilities as 64-bit thresholds."""
    p, total, out, i = np.exp(-area), 0.0, [], 0
    while i < 24:
        total += p
        out.append(min(int(total * 2.0**64), 2**64 - 1))
        i += 1
        p *= area / i
    return np.array(out, dtype=np.uint64)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _throw(sets: list[tuple[np.ndarray, np.ndarray]], reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest ranks and their darts' hashes (sets x k) among darts up to at least ``reach``."""
    n = len(sets)
    sizes = np.array([len(h) for h, _ in sets], dtype=np.int64)
    element = np.concatenate([h for h, _ in sets])
    weight = np.concatenate([w for _, w in sets]).astype(np.float64)
    doc = np.repeat(np.arange(n, dtype=np.int64), sizes)
    units = np.maximum(np.ceil(weight), 1).astype(np.int64)
    if units.max(initial=1) > 1:  # a region is cut into cells of weight 1
        first = np.cumsum(units) - units
        doc, element, weight = np.repeat(doc, units), np.repeat(element, units), np.repeat(weight, units)
        level = np.arange(len(doc)) - np.repeat(first, units)
        weight = weight - level
        element = mix64(element + level.astype(np.uint64) * _STEP)
    part = weight < 1
    lowest = np.full(n * k, np.inf)
    value = np.zeros(n * k, dtype=np.uint32)

    def cells(at: np.ndarray, low: np.ndarray | float, width: float, cell: np.ndarray | int) -> None:
        seed = mix64(element[at] ^ (np.atleast_1d(np.asarray(cell, dtype=np.uint64)) + np.uint64(1)) * _STEP)
        darts = np.searchsorted(_poisson(width), seed, side="right")
        hit = np.flatnonzero(darts)
        count = darts[hit]
        seed, at = np.repeat(seed[hit], count), np.repeat(at[hit], count)
        low = np.repeat(low[hit], count) if isinstance(low, np.ndarray) else low
        turn = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        seed = mix64(seed + (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        if part.any():
            ok = _unit(mix64(seed + np.uint64(3))) < weight[at]
            seed, at = seed[ok], at[ok]
            low = low[ok] if isinstance(low, np.ndarray) else low
        rank = low + width * _unit(seed)
        mark = mix64(seed + np.uint64(7))
        key = doc[at] * k + ((mark >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
        np.minimum.at(lowest, key, rank)
        best = lowest[key] == rank
        value[key[best]] = (mark[best] & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    for j in range(LEVELS):
        low, width = (0.0, 2.0 ** (1 - LEVELS)) if j == 0 else (2.0 ** (j - LEVELS), 2.0 ** (j - LEVELS))
        cells(np.flatnonzero(reach[doc] > low), low, width, j)
    more = np.ceil(reach - 1).clip(0).astype(np.int64)[doc]  # cells of rank 1 to 2, 2 to 3, ...
    if more.any():
        at = np.repeat(np.arange(len(doc)), more)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more)
        for lo in range(0, len(at), 2_000_000):
            t = turn[lo : lo + 2_000_000]
            cells(at[lo : lo + 2_000_000], t + 1.0, 1.0, t + LEVELS)
    return lowest.reshape(n, k), value.reshape(n, k)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int = COORDINATES) -> np.ndarray:
    """One signature (k 32-bit values) per set of (element hashes, weights); zeros for an empty set."""
    out = np.zeros((len(sets), k), dtype=np.uint32)
    todo = np.array([i for i, (h, _) in enumerate(sets) if len(h)], dtype=np.int64)
    factor = 1.0
    while len(todo):
        totals = np.array([float(sets[i][1].sum()) for i in todo])
        lowest, value = _throw([sets[i] for i in todo], factor * (k * np.log(k) + 2 * k) / totals, k)
        full = np.isfinite(lowest).all(axis=1)
        out[todo[full]] = value[full]
        todo, factor = todo[~full], factor * 2  # a coordinate without a dart: reach farther
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    n, k = signature.shape
    s = signature[:, : k // rows * rows].astype(np.uint64).reshape(n, k // rows, rows)
    key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64) * _STEP, s.shape[:2]).copy()
    for j in range(rows):
        key = mix64(key ^ (s[:, :, j] + np.uint64(0x9E3779B97F4A7C15)))
    return key.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0.0
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return common / (len(a) + len(b) - common)


def joining_pairs(ids: list, sets: list[np.ndarray], sigs: np.ndarray, side: np.ndarray | None, similarity: float, allow: float) -> list[tuple[int, int]]:
    """Pairs at or above the similarity that join two classes, by falling agreement of signatures.

    ``side``: None compares all pairs, else only those of different sides.
    """
    n = len(ids)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    size = np.array([len(s) for s in sets], dtype=np.float64)
    found_i, found_j, found_s = [], [], []
    for i in range(n - 1):
        agree = (sigs[i + 1 :] == sigs[i]).mean(axis=1)
        fits = np.minimum(size[i + 1 :], size[i]) >= similarity * np.maximum(size[i + 1 :], size[i])
        ok = (agree >= allow) & fits
        if side is not None:
            ok &= side[i + 1 :] != side[i]
        j = np.flatnonzero(ok)
        found_i.append(np.full(len(j), i))
        found_j.append(j + i + 1)
        found_s.append(agree[j])
    if not found_i:
        return []
    i, j, s = np.concatenate(found_i), np.concatenate(found_j), np.concatenate(found_s)
    out = []
    for t in np.argsort(-s, kind="stable").tolist():
        a, b = root(int(i[t])), root(int(j[t]))
        if a != b and jaccard(sets[i[t]], sets[j[t]]) >= similarity:
            parent[a] = b
            out.append((ids[i[t]], ids[j[t]]))
    return out


def fingerprint(hashes: np.ndarray) -> str | None:
    """128 bits of a set and its size (None: empty)."""
    if not len(hashes):
        return None
    return f"{int(mix64(hashes).sum(dtype=np.uint64)):016x}{int(np.bitwise_xor.reduce(mix64(hashes ^ _STEP))):016x}{len(hashes):x}"


def occurrences(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A sorted set with one element per occurrence: its plain similarity is the weighted one of the counts."""
    turn = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.unique(mix64(np.repeat(hashes, counts) + turn.astype(np.uint64) * _STEP))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, k: int = COORDINATES, rows: int = ROWS, allow: float = ALLOW, weights: str = "set", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, class_id, n_shingles, kept)``: one row per document with the smallest id of its class.

    Two texts are linked when the Jaccard similarity of their sets of ``words``-word shingles is at least
    ``similarity``; classes are the connected components of the links. With ``weights="count"`` both the signatures and the links
    weigh shingles by their occurrences (similarity: the sum of the lesser counts over that of the greater). ``kept`` marks the class's smallest id (rows
    that repeat it are all marked). A null or empty text has no
    shingles and is its own class; a row with a null id is its own class (null) and kept. Equal sets of shingles are
    merged before any comparison. Other columns are not read; an empty table gives an empty one.
    """
    def elements(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        return occurrences(h, c) if weights == "count" else h

    def sign(texts: list) -> dict[str, list]:
        sets = shingles(texts, words)
        sig = band_keys(signatures([(h, c if weights == "count" else np.ones(len(h))) for h, c in sets], k), rows)
        return {"n_shingles": [len(h) for h, _ in sets], "__print": [fingerprint(elements(h, c)) for h, c in sets], "__bands": [s if len(h) else None for s, (h, _) in zip(sig, sets)]}

    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    signed = cut_lineage(map_texts(source, sign, "n_shingles bigint, __print string, __bands array<bigint>", "__text", ("__id",), most=1_000_000))
    # equal sets: one representative each; combined before the shuffle, so copies cost nothing
    usable = signed.where("__print is not null and __id is not null")
    unique = cut_lineage(usable.groupBy("__print").agg(F.min("__id").alias("rep"), F.any_value("__bands").alias("bands")))
    keyed = unique.select("rep", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    touching = keyed.join(buckets, "key").where("rep <> first").select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct()
    groups = cut_lineage(components(touching).select(F.col("node").alias("rep"), F.col("component").alias("g")))
    sizes = groups.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"))
    placed = groups.join(sizes, "g").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))

    # the whole sets of the candidates, dealt to the pairs of blocks of their group; of rows that share an id any
    # one stands for it here if its set is the merged one
    prints = unique.select("rep", F.col("__print").alias("p"))
    wanted = placed.join(prints, "rep")
    texts = source.join(wanted, F.col("__id") == F.col("rep")).select("rep", "p", "g", "nb", "block", "__text")

    def gather(ts: list) -> dict[str, list]:
        sets = shingles(ts, words)
        sig = signatures([(h, c if weights == "count" else np.ones(len(h))) for h, c in sets], k)
        linked = [elements(h, c) for h, c in sets]
        return {"print": [fingerprint(h) for h in linked], "hashes": [h.tobytes() for h in linked], "sig": [s.tobytes() for s in sig]}

    whole = map_texts(texts, gather, "print string, hashes binary, sig binary", "__text", ("rep", "p", "g", "nb", "block"), most=1_000_000).where("p = print")
    dealt = whole.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = dealt.select("g", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "hashes", "sig")
    spread = dealt.repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi", "rep")

    def compare(batches):
        held: list = []

        def close():
            t = pa.Table.from_batches(held)
            lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
            ids = t["rep"].to_pylist()
            sets = [np.frombuffer(x, dtype=np.uint64) for x in t["hashes"].to_pylist()]
            sigs = np.frombuffer(b"".join(t["sig"].to_pylist()), dtype=np.uint32).reshape(len(ids), k)
            side = t["block"].to_numpy() if lo != hi else None
            pairs = joining_pairs(ids, sets, sigs, side, similarity, allow)
            held.clear()
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

        last = None
        for b in batches:
            keys = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            at = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for x, y in zip(at[:-1], at[1:]):
                if x == y:
                    continue
                key = tuple(keys[x].tolist())
                if held and key != last:
                    yield from close()
                last = key
                held.append(b.slice(x, y - x))
        if held:
            yield from close()

    links = cut_lineage(spread.mapInArrow(compare, "a bigint, b bigint"))
    classes = components(links).select(F.col("node").alias("rep"), F.col("component").alias("class"))
    named = unique.select(F.col("__print").alias("p"), "rep").join(classes, "rep", "left").select("p", F.coalesce("class", "rep").alias("class_id"))
    out = signed.join(named, F.col("__print") == F.col("p"), "left").select(
        F.col("__id").alias(id_col),
        F.when(F.col("__id").isNotNull(), F.coalesce("class_id", "__id")).alias("class_id"),
        "n_shingles",
    )
    return out.withColumn("kept", F.coalesce(F.col(f"`{id_col}`") == F.col("class_id"), F.lit(True)))
