"""Sharding by histogram sort (operator 5): probe, count exactly, refine, then exchange once.

Rows are ordered by ``(hash of the text, id)``: equal texts stand together and the order mixes the
sources. A boundary is a key; a boundary is good once the exact bytes below it are within a tolerance
of its target. Each round places equally spaced probes inside every interval that still holds an open
boundary and counts the exact bytes of the stretches between probes, in every partition at once. Only
the counts reach the driver (probes x open boundaries). The splitters are broadcast (a fixed
number), rows learn their piece from them, and one exchange deals the pieces out. Pieces are the tasks of that
exchange and the unit in which slots are numbered: their number follows the bytes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import cut_lineage

SHARDS = 24
PIECE_BYTES = 64_000_000  # of a piece, about; heavier ones are divided
MOST_PIECES = 200_000  # beyond, pieces grow: their bounds are broadcast and their counts reach the driver
PROBES = 64
LOW, HIGH = -(2**63), 2**63


def _stretches(keys: DataFrame, hi: str, lo: str, bounds: list[tuple[int, int]]) -> DataFrame:
    """Exact bytes and rows per stretch between sorted composite bounds (``searchsorted`` per batch)."""
    first = np.array([b[0] for b in bounds], dtype=np.int64)
    second = np.array([b[1] for b in bounds], dtype=np.int64)

    def run(batches):
        total = np.zeros((len(bounds) + 1, 2), dtype=np.int64)
        for b in batches:
            total_of(b, total)
        at = np.flatnonzero(total[:, 1])
        yield pd.DataFrame({"stretch": at, "bytes": total[at, 0], "n": total[at, 1]})

    def total_of(b: pd.DataFrame, total: np.ndarray) -> None:
        s = place(b[hi].to_numpy(), b[lo].to_numpy(), first, second)
        n = len(total)
        total[:, 0] += np.bincount(s, weights=b["size"].to_numpy(), minlength=n).astype(np.int64)
        total[:, 1] += np.bincount(s, minlength=n)

    return keys.select(hi, lo, "size").mapInPandas(run, "stretch bigint, bytes bigint, n bigint").groupBy("stretch").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))


def place(hi: np.ndarray, lo: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each key, how many of the sorted bounds are at most it."""
    left, right = np.searchsorted(first, hi, "left"), np.searchsorted(first, hi, "right")
    out = left.copy()
    inside = np.flatnonzero(left < right)  # rows whose hash is itself a bound: their ids decide
    if len(inside):
        # the rows of one hash together: one search per hash that is a bound
        order = inside[np.argsort(left[inside], kind="stable")]
        for part in np.split(order, np.flatnonzero(np.diff(left[order])) + 1):
            a, z = left[part[0]], right[part[0]]
            out[part] = a + np.searchsorted(second[a:z], lo[part], "right")
    return out


def as_key(x: int) -> tuple[int, int]:
    """The key ``(hi, lo)`` of a 128-bit number."""
    return (x >> 64, (x & (2**64 - 1)) + LOW) if x < HIGH << 64 else (HIGH - 1, HIGH - 1)


def as_number(key: tuple[int, int]) -> int:
    return (key[0] << 64) + key[1] - LOW


def _between(a: int, z: int, probes: int) -> set[int]:
    """Equally spaced marks inside ``a`` to ``z``: between hashes as long as there are any, then between ids."""
    unit = 64 if (z >> 64) - (a >> 64) > 1 else 0
    p, q = (a >> unit), (z >> unit)
    return {x for x in ((p + (q - p) * j // probes) << unit for j in range(1, probes)) if a < x < z}


def splitters(keys: DataFrame, targets: list[float], slack: list[float], hi: str = "h", lo: str = "k", probes: int = PROBES, rounds: int = 40) -> list[tuple[int, int]]:
    """A boundary key for each ascending target of bytes below it, exact to its slack.

    A key is ``(hi, lo)``, both 64-bit, written here as one 128-bit number. A boundary falls
    between two hashes unless one hash alone holds more than the slack; then it moves between the ids
    inside that hash. A boundary that reaches a single row stays on its nearer side.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    open_ = {i: (LOW << 64, HIGH << 64, 0, total) for i in range(len(targets))}
    done: dict[int, int] = {}

    for _ in range(rounds):
        if not open_ or not total:
            break
        marks: set[int] = set()
        for a, z in {(a, z) for a, z, _, _ in open_.values()}:
            marks |= _between(a, z, probes) | {a, z}
        at = sorted(marks)
        inner = [x for x in at if x < HIGH << 64]
        got = {r["stretch"]: r["bytes"] for r in _stretches(keys, hi, lo, [as_key(x) for x in inner]).collect()}
        below = np.cumsum([got.get(i, 0) for i in range(len(inner))]).tolist() + [total] * (len(at) - len(inner))
        for i in list(open_):
            j = min(max(bisect_left(below, targets[i]), 1), len(at) - 1)
            near = j - 1 if targets[i] - below[j - 1] <= below[j] - targets[i] else j
            if abs(below[near] - targets[i]) <= slack[i] or at[j] - at[j - 1] <= 1:
                done[i] = at[near]
                del open_[i]
            else:
                open_[i] = (at[j - 1], at[j], below[j - 1], below[j])
    for i, (a, z, b, u) in open_.items():
        done[i] = a if targets[i] - b <= u - targets[i] else z
    return [as_key(done[i]) for i in range(len(targets))]


def pieces(keys: DataFrame, bounds: list[tuple[int, int]], most: float, hi: str = "h", lo: str = "k", probes: int = PROBES, rounds: int = 60) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """The bounds and more between them, until no stretch holds more than ``most`` bytes; and the rows per stretch.

    Hashes are evenly spread, so the first marks are equally spaced; a stretch that is still too heavy holds a
    text with many copies and is divided again, down to its ids. Only a single key is never divided.
    """
    marks = sorted({as_number(b) for b in bounds})
    counts: dict[int, int] = {}
    for _ in range(rounds):
        edges = [LOW << 64, *marks, HIGH << 64]
        got = _stretches(keys, hi, lo, [as_key(x) for x in marks]).collect()
        counts = {r["stretch"]: r["n"] for r in got}
        heavy = [(edges[r["stretch"]], edges[r["stretch"] + 1], r["bytes"]) for r in got if r["bytes"] > most]
        more = {x for a, z, size in heavy for x in _between(a, z, max(8, min(probes, 1 + int(2 * size / most))))} - set(marks)
        if not more:
            break
        marks = sorted({*marks, *more})
    return [as_key(x) for x in marks], counts


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = 0.004, id_col: str = "doc_id", text_col: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """All rows with ``size``, ``text_crc32``, ``law`` = 'bytes', ``shard``, gapless ``slot`` and ``grown_shard``.

    Size is the text's UTF-8 bytes (null: none) plus 8. Shards have near-equal bytes: every boundary
    is within ``tolerance`` of a shard from its target, or next to the single row that straddles it.
    Equal texts stand together; a group of them is divided only where a boundary must fall inside
    it. A null text counts as empty; null ids and repeated rows are kept, each with its own slot
    (their order among themselves is free); an empty table gives an empty one; the other input
    columns (but for names given here) are carried along. ``grown_shard`` is null: the law is by bytes.
    """
    own = {"size", "text_crc32", "law", "shard", "slot", "grown_shard", "__h", "__k", "__piece"}
    d = docs.drop(*[c for c in docs.columns if c.lower() in own])
    text = F.col(f"`{text_col}`").cast("string")
    raw = F.coalesce(text, F.lit(""))
    d = d.select(
        "*",
        (F.octet_length(raw) + 8).cast("bigint").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.xxhash64(raw).alias("__h"),
        F.coalesce(F.col(f"`{id_col}`").try_cast("bigint"), F.xxhash64(F.col(f"`{id_col}`").cast("string"))).alias("__k"),
    )
    keys = cut_lineage(d.select(F.col("__h").alias("h"), F.col("__k").alias("k"), "size"))
    total = keys.agg(F.sum("size")).first()[0] or 0
    ends = splitters(keys, [total * i / shards for i in range(1, shards)], [max(1.0, tolerance * total / shards)] * (shards - 1))
    bounds, counts = pieces(keys, ends, max(piece_bytes, total / MOST_PIECES))
    first = np.array([b[0] for b in bounds], dtype=np.int64)
    second = np.array([b[1] for b in bounds], dtype=np.int64)

    # a piece belongs to the shard whose lower end is the last at or before its own
    numbers, lower = [as_number(e) for e in ends], [LOW << 64, *(as_number(b) for b in bounds)]
    rows, base = [], dict.fromkeys(range(shards), 0)
    for p, x in enumerate(lower):
        s = bisect_right(numbers, x)
        rows.append((p, s, base[s]))
        base[s] += counts.get(p, 0)
    piece = F.pandas_udf(lambda h, k: pd.Series(place(h.to_numpy(), k.to_numpy(), first, second)), "bigint")
    placed = d.withColumn("__piece", piece("__h", "__k"))
    table = d.sparkSession.createDataFrame(rows, "__piece bigint, shard int, __base bigint")
    return _numbered(placed, table, [c for c in d.columns if not c.startswith("__")])


def _numbered(placed: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Slots within shards: rows are numbered inside their piece, after the rows of the shard's earlier pieces."""
    w = Window.partitionBy("__piece").orderBy("__h", "__k")
    return placed.withColumn("__r", F.row_number().over(w)).join(F.broadcast(table), "__piece").select(
        *[F.col(f"`{c}`") for c in columns], F.lit("bytes").alias("law"), "shard", (F.col("__base") + F.col("__r") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
