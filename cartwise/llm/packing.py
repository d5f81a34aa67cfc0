"""Packing by Karmarkar-Karp multiway differencing (operator 6).

Every document is its token ids and an end id. Full windows are cut off first: they hold a whole
window of one document and need no padding. What is left of each document (less than a window) is cut
into pieces of ``max_piece`` tokens and a remnant, and the pieces of a group of documents are partitioned
into windows of near-equal sums: partial partitions are merged, the two of the largest spread
first, the fullest windows of one onto the emptiest of the other. When a window exceeds the capacity,
the number of windows rises by one and the group is partitioned again.
"""

from __future__ import annotations

import zlib
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cartwise.llm.common import map_texts, whole_groups
from cartwise.llm.tokens import library_encoder
from cartwise.session import cut_lineage

WINDOW = 1024
MAX_PIECE = 512
GROUP = 2000  # pieces partitioned together, on average


def differencing(sizes: np.ndarray, m: int) -> np.ndarray:
    """The window (0 to m - 1) of each item, by multiway differencing."""
    if m == 1:
        return np.zeros(len(sizes), dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    # a partial partition: window sums (ascending, the lowest taken off) and the items' chains
    heap: list[tuple] = []
    for lo in range(0, len(order), m):  # m items start as one partial partition: one each
        part = order[lo : lo + m][::-1]
        sums = np.zeros(m, dtype=np.int64)
        sums[m - len(part) :] = sizes[part]
        sets: list[list[int]] = [[] for _ in range(m - len(part))] + [[int(i)] for i in part]
        heap.append((-int(sums[-1] - sums[0]), lo, sums, sets))
    heapify(heap)
    tick = len(order)
    while len(heap) > 1:
        _, _, s1, a = heappop(heap)
        _, _, s2, b = heappop(heap)
        sums = s1 + s2[::-1]
        sets = [x + y if len(x) >= len(y) else y + x for x, y in zip(a, reversed(b))]
        by = np.argsort(sums, kind="stable")
        sums = sums[by]
        heappush(heap, (-int(sums[-1] - sums[0]), tick, sums, [sets[i] for i in by]))
        tick += 1
    out = np.empty(len(sizes), dtype=np.int64)
    for w, items in enumerate(heap[0][3]):
        out[items] = w
    return out


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item, as few windows as differencing fills without exceeding ``capacity``."""
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    m = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        if m >= len(sizes):
            return np.arange(len(sizes))
        w = differencing(sizes, m)
        if np.bincount(w, weights=sizes).max() <= capacity:
            return w
        m += 1


def cuts(n: int, window: int, max_piece: int) -> list[tuple[int, int, bool]]:
    """``(start, length, full)`` of a document of ``n`` ids: full windows, then pieces of ``max_piece`` and what is left.

    Pieces of mixed sizes are what lets differencing level the windows: equal ones leave several
    times the padding.
    """
    whole = n - n % window
    return [(s, window, True) for s in range(0, whole, window)] + [(s, min(max_piece, n - s), False) for s in range(whole, n, max_piece)]


def pieces_of(docs: DataFrame, path: str, end_id: int = 0, window: int = WINDOW, max_piece: int = MAX_PIECE, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, cache: tuple[int, int] | None = None) -> DataFrame:
    """One row per piece: ``(id, doc_tokens, start, length, full, ids_crc32[, ids])``."""

    def run(texts: list) -> dict[str, list]:
        encode, end = library_encoder(path, cache=cache), end_id.to_bytes(4, "little")
        docs_out, counts = [], []
        for ids in encode.many(texts):
            ids += end
            n = len(ids) // 4
            counts.append(n)
            made = []
            for s, k, full in cuts(n, window, max_piece):
                part = ids[4 * s : 4 * (s + k)]
                made.append({"start": s, "length": k, "full": full, "ids_crc32": zlib.crc32(part), **({"ids": part} if keep_ids else {})})
            docs_out.append(made)
        return {"doc_tokens": counts, "p": docs_out}

    item = "start: bigint, length: bigint, full: boolean, ids_crc32: bigint" + (", ids: binary" if keep_ids else "")
    rows = map_texts(docs, run, f"doc_tokens bigint, p array<struct<{item}>>", text_col, (id_col,), caches="tokens")
    return rows.select(id_col, "doc_tokens", F.inline("p"))


def pack(docs: DataFrame, path: str, end_id: int = 0, window: int = WINDOW, max_piece: int = MAX_PIECE, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, cache: tuple[int, int] | None = None) -> DataFrame:
    """All documents packed: one row per piece with ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])``.

    A null or empty text is its end id alone. Repeated rows are packed each; a null id is kept. An
    empty table gives an empty one, other columns are not read. Pieces are dealt to groups by a hash of
    their id and place, and their row in the written pieces, so equal rows spread too and a group holds about ``group`` pieces
    whatever the input; a window never holds pieces of two groups (the one source of padding beside the
    rounding of the count). Full windows get negative sequence ids by partition and row of the written pieces.
    ``cache`` bounds the encoder's caches in entries (units, pieces); it changes no result.
    """
    pieces = cut_lineage(pieces_of(docs, path, end_id, window, max_piece, id_col, text_col, keep_ids, cache))
    n = pieces.where("not full").count()
    groups = max(1, -(-n // group))
    # rows equal in id, place and ids are told apart by their place in the written pieces
    spread = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string"), "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))
    small = pieces.where("not full").withColumn("__g", spread)
    order = ["__g", F.col("length").desc(), F.col(f"`{id_col}`"), "start", "ids_crc32"]
    dealt = small.repartition("__g").sortWithinPartitions(*order).select("__g", "length", F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("__row"))
    # the group's key and lengths go through numpy; the row rides along as it is
    schema = StructType([*dealt.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches):
        import pyarrow as pa

        held: list = []
        names = [f.name for f in schema]

        def close():
            t = pa.Table.from_batches(held)
            g = t.column(0)[0].as_py()
            size = t.column(1).to_numpy().astype(np.int64)
            w = windows_of(size, window)
            order = np.argsort(w, kind="stable")
            ends = np.cumsum(size[order])
            starts = ends - size[order]
            first = np.r_[True, w[order][1:] != w[order][:-1]]
            base = np.maximum.accumulate(np.where(first, starts, 0))
            offset = np.empty(len(w), dtype=np.int64)
            offset[order] = starts - base
            t = t.append_column(names[-2], pa.array(((g + 1) << 32) + w, pa.int64())).append_column(names[-1], pa.array(offset, pa.int64()))
            return t.combine_chunks().to_batches()

        for b in batches:
            g = b.column(0).to_numpy()
            at = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
            for lo, hi in zip(at[:-1], at[1:]):
                if lo == hi:
                    continue
                if held and held[-1].column(0)[0].as_py() != int(g[lo]):
                    yield from close()
                    held.clear()
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from close()

    packed = dealt.mapInArrow(run, schema).select("__row.*", "sequence_id", "offset")
    whole = pieces.where("full").select("*", _own_window(id_col).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    out = packed.unionByName(whole)
    return out.select(id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else []))


def _own_window(id_col: str):
    """Sequence ids of the full windows: negative, by partition and row of the written pieces."""
    return -1 - F.monotonically_increasing_id()


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The training sequences ``(sequence_id, ids, n_tokens, n_padding)`` of a packing that kept its ids.

    Padded to the window, except where the length is a power of two already.
    """

    def run(batches):
        for g in whole_groups(batches, ["sequence_id"]):
            ids = b"".join(g.sort_values("offset")["ids"])
            n = len(ids) // 4
            pad = 0 if n & (n - 1) == 0 else window - n
            yield pd.DataFrame({"sequence_id": [g["sequence_id"].iloc[0]], "ids": [ids + pad * pad_id.to_bytes(4, "little")], "n_tokens": [n], "n_padding": [pad]})

    rows = packed.select("sequence_id", "offset", "ids").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return rows.mapInPandas(run, "sequence_id bigint, ids binary, n_tokens bigint, n_padding bigint")
