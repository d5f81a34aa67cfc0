"""Helpers shared by the operators: written intermediates, connected components, batches, held-out rows."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from cartwise.session import cut_lineage, discard

FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the rows that no model learns from: crc32(id as text) mod 5 = 0 (null id: held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def slices(sizes: np.ndarray, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of a batch with at most ``most`` bytes each (a longer text is alone)."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


_HELD: dict[str, Callable[[], None]] = {}


def holds_caches(name: str, clear: Callable[[], None]) -> None:
    """Register a module's caches, so that work of another kind in the same worker process can free them."""
    _HELD[name] = clear


def keep_only(name: str | None) -> None:
    """Free the caches of every other kind of work: Python workers outlive tasks and stages."""
    for other, clear in _HELD.items():
        if other != name:
            clear()


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers wait idle with what they hold."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def _sizes(texts: pa.Array) -> np.ndarray:
    return pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)


def text_slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """A batch of (id, text) in slices of bounded text."""
    for lo, hi in slices(_sizes(batch.column(1))):
        yield batch.column(0).slice(lo, hi - lo).to_pylist(), batch.column(1).slice(lo, hi - lo).to_pylist()


def map_texts(df: DataFrame, fn: Callable[[list], dict[str, list]], added: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), most: int = 2_000_000, caches: str | None = None) -> DataFrame:
    """The ``keep`` columns as they are plus the columns ``added`` (DDL) that ``fn`` makes of a list of texts.

    ``fn`` gets a slice of texts (None for null) of at most ``most`` bytes, or one longer text; ``caches``
    names what it keeps between slices (all other caches of the worker are freed). Rows stay where they are: no shuffle.
    Columns not named are not read, so extra ones cannot clash; a kept column with an added one's name is an error.
    """
    clash = {k.lower() for k in keep} & {f.name.lower() for f in StructType.fromDDL(added)}
    if clash:
        raise ValueError(f"kept columns have the names of added ones: {sorted(clash)}")
    kept = [StructField(f.name, f.dataType, True) for f in df.select(*[F.col(f"`{k}`") for k in keep]).schema]
    new = list(StructType.fromDDL(added))
    types = {f.name: to_arrow_type(f.dataType) for f in new}
    names = [f.name for f in (*kept, *new)]
    # a kept text column is not sent to the workers a second time
    at = keep.index(text_col) if text_col in keep and kept[keep.index(text_col)].dataType.simpleString() == "string" else len(kept)
    sent = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keep)] + [F.col(f"`{text_col}`").cast("string").alias("__text")] * (at == len(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(caches)
        for b in batches:
            for lo, hi in slices(_sizes(b.column(at)), most):
                part = b.slice(lo, hi - lo)
                made = fn(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), *(pa.array(made[k], t) for k, t in types.items())], names)
        give_back()

    return df.select(*sent).mapInArrow(run, StructType([*kept, *new]))


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key of a partition sorted by key, one frame per key.

    Only the group that a batch boundary cuts is carried over, so memory is bound by a batch
    and a group; callers bound the groups.
    """
    held: list[pd.DataFrame] = []

    def starts(b: pd.DataFrame) -> np.ndarray:
        change = np.zeros(len(b), dtype=bool)
        change[0] = True
        for k in keys:
            v = b[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(change)

    for b in batches:
        if not len(b):
            continue
        at = [*starts(b), len(b)]
        for i, j in zip(at[:-1], at[1:]):
            g = b.iloc[i:j]
            if i == 0 and held and all(held[-1][k].iloc[-1] == g[k].iloc[0] for k in keys):
                held.append(g)
                continue
            if held:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            held = [g]
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of the undirected edges ``(a, b)``: the smallest node reachable.

    Alternating large-star and small-star steps: every round re-hangs neighbours on the smallest
    node seen, so the edge list stays linear and long chains halve. A node's neighbours are only ever
    reduced with ``min``, which combines before the shuffle; a hub is never gathered. The minima are
    written and joined from there: both sides of the join then have an exchange of their own, whose
    partitions AQE can split at a hub (or the minima are broadcast, when their bytes allow it).
    """
    e = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = cut_lineage(e)
    before = None
    for _ in range(max_rounds):
        # large star: neighbours above a node hang on the smallest of its neighbourhood
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut_lineage(both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct())
        # small star: a node and its smaller neighbours hang on the smallest of them
        m2 = cut_lineage(large.groupBy("b").agg(F.min("a").alias("m")))
        nxt = large.join(m2, "b").select(F.col("m").alias("a"), F.col("a").alias("x")).unionAll(m2.select(F.col("m").alias("a"), F.col("b").alias("x")))
        last, e = e, cut_lineage(nxt.where("a <> x").select("a", F.col("x").alias("b")).distinct())
        discard(last, low, large, m2)
        now = e.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wraps on overflow)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
