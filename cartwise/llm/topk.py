"""Exact top-k by inner product with pivot-table elimination (operator 9).

Every candidate keeps its distances to a fixed set of pivots, computed once and written with it. For a query q and a
candidate x the greatest |d(q, p) - d(x, p)| over the pivots bounds their distance from below, and so, by
2<q, x> = |q|^2 + |x|^2 - d(q, x)^2, their inner product from above. A query's candidates are evaluated in the order of these
bounds until no bound left reaches the k-th best score known; bounds carry a margin for rounding, so the result is
exact. The k-th best score starts from a sample of rows and is carried on from batch to batch of a task, so a bound meets a
threshold from its first row on. Queries go over the table in blocks of a fixed size: a block is broadcast, each
partition sends at most k rows per query on, and the broadcast is released.

Distances and scores are exact in float64 for components up to a limit that follows from the length. Rows beyond it are
multiplied in limbs of 22 bits, exactly, whatever the other rows of their batch are. A score beyond 64 bits counts as the
nearest 64-bit integer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cartwise.session import cut_lineage, discard

PIVOTS = 32
BLOCK = 4096  # queries per broadcast block
SEED_ROWS = 2048  # rows whose scores give the first thresholds
SCALE = 256.0
LEAST, MOST = -(2**63), 2**63 - 1
_BITS = 22  # of a limb: 512 products of two limbs stay below 2^53
_MASK = (1 << _BITS) - 1


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``(id, v)``: components turned into floor(scale * x); rows that are null or hold null or non-finite ones are left out.

    A component beyond 64 bits becomes the nearest 64-bit integer."""
    v = F.col(f"`{vector_col}`")
    usable = v.isNotNull() & F.col(f"`{id_col}`").isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return df.where(F.coalesce(usable, F.lit(False))).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("bigint")).alias("v"))


def exact_limit(size: int) -> int:
    """The greatest component with which inner products and distances of vectors of ``size`` stay exact in float64."""
    return int(np.sqrt((2.0**52 - 1) / max(size, 1)))


def beyond(rows: np.ndarray) -> np.ndarray:
    """Which rows hold a component beyond the limit."""
    most = exact_limit(rows.shape[1])
    return ((rows > most) | (rows < -most)).any(axis=1)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact squared distances (integers in float64), then their roots."""
    sq = (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None] - 2 * x @ p.T
    return np.sqrt(np.maximum(sq, 0))


def _limbs(a: np.ndarray) -> list[np.ndarray]:
    return [(a & _MASK).astype(np.float64), ((a >> _BITS) & _MASK).astype(np.float64), (a >> 2 * _BITS).astype(np.float64)]


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all 64-bit integer rows, exactly, then clamped to 64 bits."""
    sums = np.zeros((5, len(q), len(x)), dtype=np.int64)
    for lo in range(0, q.shape[1], 512):
        a, b = _limbs(q[:, lo : lo + 512]), _limbs(x[:, lo : lo + 512])
        for i in range(3):
            for j in range(3):
                sums[i + j] += (a[i] @ b[j].T).astype(np.int64)
    low, carry = [], np.zeros(sums.shape[1:], dtype=np.int64)
    for k in range(4):
        carry += sums[k]
        low.append(carry & _MASK)
        carry >>= _BITS
    top = carry + sums[4]  # the score is top * 2^88 + low[3] * 2^66 + low[2] * 2^44 + low[1] * 2^22 + low[0]
    half = 1 << (63 - 2 * _BITS)
    fits = ((top == 0) & (low[3] == 0) & (low[2] < half)) | ((top == -1) & (low[3] == _MASK) & (low[2] >= (1 << _BITS) - half))
    high = np.where(fits & (top < 0), low[2] - (1 << _BITS), np.where(fits, low[2], 0))
    return np.where(fits, (high << 2 * _BITS) + (low[1] << _BITS) + low[0], np.where(top < 0, LEAST, MOST))


class Best:
    """The k best rows per query so far, and the score that a row must reach to matter."""

    def __init__(self, q_ids: np.ndarray, k: int, threshold: np.ndarray):
        self.q_ids, self.k, self.threshold = q_ids, k, threshold.copy()
        self.scores = [np.zeros(0, dtype=np.int64)] * len(q_ids)
        self.ids = [np.zeros(0, dtype=np.int64)] * len(q_ids)

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.r_[self.scores[i], scores], np.r_[self.ids[i], ids]
        keep = np.lexsort((ids, ~scores))[: self.k]  # ~s: the order of -s without overflow
        self.scores[i], self.ids[i] = scores[keep], ids[keep]
        if len(keep) == self.k:
            self.threshold[i] = max(self.threshold[i], scores[keep[-1]])

    def add_exact(self, at: np.ndarray, q: np.ndarray, x: np.ndarray, x_ids: np.ndarray, step: int = 256) -> None:
        """Rows ``x`` against the queries ``at`` in exact arithmetic, a bounded slice at a time."""
        for lo in range(0, len(x), step):
            ids = x_ids[lo : lo + step]
            s = exact_scores(q[at], x[lo : lo + step])
            worth = (s >= self.threshold[at][:, None]) & (ids[None] != self.q_ids[at][:, None])
            for r in np.flatnonzero(worth.any(axis=1)):
                self.add(int(at[r]), s[r][worth[r]], ids[worth[r]])


def eliminate(best: Best, at: np.ndarray, q: np.ndarray, dq: np.ndarray, x: np.ndarray, x_ids: np.ndarray, dx: np.ndarray, first: int = 64) -> int:
    """Meet the queries ``at`` with the rows ``x`` (all within the exact limit); how many pairs were evaluated.

    ``dq`` and ``dx`` are distances to the pivots in float32; the margin covers their rounding.
    """
    nq, nx = (q * q).sum(axis=1), (x * x).sum(axis=1)
    columns = np.ascontiguousarray(dx.T)
    rounding = 2.0**-22 * float(max(np.abs(dx).max(initial=0), np.abs(dq).max(initial=0))) + 1e-6
    evaluated, few = 0, max(1, len(columns) // 4)
    slack = 1e-3 + 2.0**-50 * (nq + nx.max(initial=0))  # rounding of the sums of squares
    for i in at:
        # a candidate matters while its distance stays below what the threshold allows: groups of pivots narrow them down
        limit = nq[i] + nx - 2.0 * (float(best.threshold[i]) - slack[i]) if best.threshold[i] > LEAST else np.full(len(x), np.inf)
        left, low = np.flatnonzero(limit >= 0), None
        for lo in range(0, len(columns), few):
            for j in range(lo, min(lo + few, len(columns))):
                gap = np.abs(columns[j][left] - dq[i, j]) if low is None or len(left) < len(x) else np.abs(columns[j] - dq[i, j])
                low = gap if low is None else np.maximum(low, gap, out=low)
            squared = np.maximum(low.astype(np.float64) - rounding, 0) ** 2
            stay = squared <= limit[left]
            if not stay.all():
                left, low = left[stay], low[stay]
            if not len(left):
                break
        if not len(left):
            continue
        if low is None:
            bound = (nq[i] + nx[left]) * 0.5 + slack[i]
        else:
            bound = (nq[i] + nx[left] - np.maximum(low.astype(np.float64) - rounding, 0) ** 2) * 0.5 + slack[i]
        other = x_ids[left] != best.q_ids[i]
        left, bound = left[other], bound[other]
        n = first
        while len(left):
            part = np.argpartition(-bound, n - 1)[:n] if n < len(left) else np.arange(len(left))
            some = left[part]
            best.add(int(i), (x[some] @ q[i]).astype(np.int64), x_ids[some])
            evaluated += len(some)
            rest = np.ones(len(left), dtype=bool)
            rest[part] = False
            rest &= bound >= float(best.threshold[i])
            left, bound, n = left[rest], bound[rest], n * 4
    return evaluated


def choose_pivots(vectors: DataFrame, n: int = PIVOTS) -> DataFrame:
    """The ``n`` vectors of the smallest hash of their id among those whose distances float64 holds exactly:
    any number of them, none too, keeps the result exact."""
    most = F.floor(F.sqrt(F.lit(2.0**52 - 1) / F.greatest(F.size("v"), F.lit(1))))
    return vectors.where(F.forall("v", lambda x: x.between(-most, most))).orderBy(F.xxhash64("id"), "id").limit(n)


def _flat(column: pa.Array, size: int, kind) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, size).astype(kind, copy=False) if size else np.zeros((len(column), 0), dtype=kind)


def with_pivot_table(vectors: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """``(id, v, d)``: the vectors of one length with their distances to the pivots (float32; not used beyond the exact limit)."""

    def run(batches):
        for b in batches:
            x = _flat(b.column(1), size, np.int64)
            d = _distances(np.where(beyond(x)[:, None], 0, x).astype(np.float64), pivots).astype(np.float32)
            made = pa.FixedSizeListArray.from_arrays(pa.array(d.ravel(), pa.float32()), max(len(pivots), 1)).cast(pa.list_(pa.float32())) if len(pivots) else pa.array([[]] * len(x), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), made], ["id", "v", "d"])

    return vectors.select("id", "v").mapInArrow(run, "id bigint, v array<bigint>, d array<float>")


def first_thresholds(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query among some rows: no answer of the whole table is below it."""
    out = np.full(len(q), LEAST, dtype=np.int64)
    wide = beyond(x).any() or beyond(q).any()
    for lo in range(0, len(q), 256):
        part = q[lo : lo + 256]
        s = exact_scores(part, x) if wide else (part.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        for i, row in enumerate(s):
            row = row[x_ids != q_ids[lo + i]]
            if len(row) >= k:
                out[lo + i] = np.partition(row, len(row) - k)[len(row) - k]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best other rows by integer inner product.

    ``vectors`` and ``queries`` are ``(id, v array<bigint>)`` as from ``integer_vectors``. A query never
    meets rows of its own id. Ties go to the smaller id; a query with fewer than k others gets all; vectors of
    another length than the query's do not meet it; repeated rows count as several candidates,
    and a repeated query id is answered once (its smallest vector by order). Components may be any 64-bit integers; scores
    beyond 64 bits count as the nearest 64-bit integer, and tie there. Empty tables give an empty
    result. Work is queries x vectors in the worst case, as the task is stated; the driver holds one block
    of queries and ``SEED_ROWS`` rows at a time, and results of blocks are written, not collected.
    """
    spark = vectors.sparkSession
    vectors = cut_lineage(vectors.select("id", "v", F.size("v").alias("n")))
    queries = queries.groupBy("id").agg(F.min("v").alias("v")).withColumn("n", F.size("v"))
    shapes = [r["n"] for r in queries.select("n").distinct().orderBy("n").collect()]
    parts = []
    for size in shapes:
        mine = vectors.where(F.col("n") == size)
        asked = queries.where(F.col("n") == size)
        blocks = max(1, -(-asked.count() // block))
        # blocks by the rank of a hash: equal shares without numbering all queries in one task
        asked = cut_lineage(asked.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("b")))
        seeds = mine.orderBy(F.xxhash64("id"), "id").limit(SEED_ROWS).select("id", "v").collect()
        s_ids, s = np.array([r["id"] for r in seeds], dtype=np.int64), np.array([r["v"] for r in seeds], dtype=np.int64).reshape(-1, size)
        p = np.array([r["v"] for r in choose_pivots(mine, pivots).collect()], dtype=np.float64).reshape(-1, size)
        table = cut_lineage(with_pivot_table(mine, p, size))
        for b in range(blocks):
            rows = asked.where(F.col("b") == b).select("id", "v").orderBy("id").collect()
            if not rows:
                continue
            ids, q = np.array([r["id"] for r in rows], dtype=np.int64), np.array([r["v"] for r in rows], dtype=np.int64).reshape(-1, size)
            sent = spark.sparkContext.broadcast((ids, q, p, first_thresholds(q, ids, s, s_ids, k)))
            parts.append(cut_lineage(table.mapInArrow(_search(sent, k), "query_id bigint, vec_id bigint, score bigint")))
            sent.destroy()
        discard(table, asked)
    discard(vectors)
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, LongType()) for c in ("query_id", "rank", "vec_id", "score")])).withColumn("rank", F.col("rank").cast("int"))
    found = parts[0]
    for other in parts[1:]:
        found = found.unionAll(other)
    # a few rows per query and partition come together here
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search(sent, k: int):
    def run(batches):
        ids, q, pivots, threshold = sent.value
        size = q.shape[1]
        best, wide_q = Best(ids, k, threshold), beyond(q)
        plain = np.where(wide_q[:, None], 0, q).astype(np.float64)
        dq = _distances(plain, pivots).astype(np.float32)
        near, far = np.flatnonzero(~wide_q), np.flatnonzero(wide_q)
        for b in batches:
            x, x_ids = _flat(b.column(1), size, np.int64), b.column(0).to_numpy()
            wide = beyond(x)
            # only pairs with a row or a query beyond the limit take the exact arithmetic
            if wide.any():
                best.add_exact(near, q, x[wide], x_ids[wide])
            if len(far):
                best.add_exact(far, q, x, x_ids)
            if len(near) and not wide.all():
                dx = _flat(b.column(2), len(pivots), np.float32)
                eliminate(best, near, plain, dq, x[~wide].astype(np.float64), x_ids[~wide], dx[~wide])
        n = [len(s) for s in best.scores]
        if sum(n):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.scores))], ["query_id", "vec_id", "score"])

    return run
