"""Near-duplicate vectors by NN-descent (operator 1).

Each vector keeps a short list of its best neighbours. Lists start from a few sorted random-hyperplane codes
(neighbours in the order of the codes; their number does not depend on the rows), and every round joins each vector's neighbours, forward and
reverse, with one another: a neighbour of a neighbour is likely a neighbour. Every pair met at or above the
threshold is kept as a link before any list is cut. A list has room for neighbours of the vector's own component
and, apart from them, for those of others, so that a dense group does not fill its members' lists; one that holds
nothing but links is saturated and is enlarged for the next round. Rounds go on until one joins no two components.
Then the components are compared inside, exactly, in double precision: that gives each vector all of its links,
whatever the length of its list. Searching needs no more than a rough cosine, so the codes and the rounds exchange
vectors of one byte per component, with a margin under the threshold for their rounding. An audit compares a sample with all rows by brute force; where it finds a missing
link, more codes and rounds follow, and a table whose audit stays below the target is an error.

A group of copies is never expanded. Equal vectors are merged first. In a large component the vectors
within half the threshold's angle of its mean direction are linked to one another by the triangle inequality
(angles are a metric) and are only counted; what is left of it is compared in blocks.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import components
from cartwise.session import cut_lineage

THRESHOLD = 0.9
LIST, LONGEST = 10, 40  # neighbours of a list, and of one that was enlarged
CODES, NEAR = 24, 8  # orders by random codes in the first turn, and how far apart in an order two vectors are compared
ROUGH = 0.008  # more than a cosine of vectors of one byte per component is off (checked in the tests)
BLOCK = 512  # vectors per block of a component
AUDIT = 256  # vectors with links that the audit compares with all rows
MOST_AUDIT = 8192  # vectors that it looks at to find these
_log = logging.getLogger(__name__)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v array<double>)`` of the vectors that can link: no null, no null or non-finite part, not zero."""
    v = F.col(f"`{vector_col}`")
    fine = v.isNotNull() & F.col(f"`{id_col}`").isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return df.where(F.coalesce(fine, F.lit(False))).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.cast("array<double>").alias("v"))


def _unit_rows(v: pa.Array) -> np.ndarray:
    x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
    x = x / np.abs(x).max(axis=1)[:, None]  # very large and very small vectors keep their direction
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def _pack(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def _rough(u: np.ndarray) -> pa.Array:
    """Unit vectors at one byte per component, after their scale (float32)."""
    scale = (np.abs(u).max(axis=1) / 127).astype(np.float32)
    q = np.rint(u / scale[:, None].astype(np.float64)).astype(np.int8)
    return pa.array([a.tobytes() + b.tobytes() for a, b in zip(scale, q)], pa.binary())


def _from_rough(column: pa.Array) -> np.ndarray:
    """The vectors again (float32), scaled to length one."""
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.int8).reshape(len(column), -1)
    x = raw[:, 4:].astype(np.float32)  # the scale drops out
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def unit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, copies, n, u, q)``: one row per distinct vector, its smallest id, how many rows share it, its unit vector in
    doubles and at one byte per component."""
    merged = usable(df, id_col, vector_col).groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))

    def run(batches):
        for b in batches:
            sizes = pa.compute.list_value_length(b.column(2)).to_numpy(zero_copy_only=False)
            for n in np.unique(sizes).tolist():
                part = b.take(pa.array(np.flatnonzero(sizes == n)))
                u = _unit_rows(part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([n] * len(part), pa.int32()), _pack(u), _rough(u)], ["id", "copies", "n", "u", "q"])

    return merged.select("id", "copies", "v").mapInArrow(run, "id bigint, copies bigint, n int, u binary, q binary")


def seed_pairs(vectors: DataFrame, size: int, codes: int, near: int, seed: int, threshold: float) -> DataFrame:
    """``(a, b, sim)`` both ways: per vector and order its best neighbour and all that are linked."""

    def code(batches):
        rng = np.random.default_rng(seed)
        planes = rng.normal(size=(codes, size, 64)).astype(np.float32)
        weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for b in batches:
            x, packed = _from_rough(b.column(1)), b.column(1)
            for r in range(codes):
                bits = (x @ planes[r] > 0).astype(np.uint64)
                key = ((bits * weights).sum(axis=1, dtype=np.uint64) ^ np.uint64(2**63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), r, dtype=np.int32)), pa.array(key), b.column(0), packed], ["r", "key", "id", "x"])

    coded = vectors.select("id", "q").mapInArrow(code, "r int, key bigint, id bigint, x binary")
    ordered = coded.repartitionByRange("r", "key", "id").sortWithinPartitions("r", "key", "id")
    floor = threshold - ROUGH

    def pairs(batches):
        tail: pa.RecordBatch | None = None
        for b in batches:
            new = len(b)
            if tail is not None:  # the last rows of the batch before stand in front again
                b = pa.Table.from_batches([tail, b]).combine_chunks().to_batches()[0]
            old = len(b) - new
            r, ids, x = b.column(0).to_numpy(), b.column(2).to_numpy(), _from_rough(b.column(3))
            n = len(ids)
            sims = np.full((2 * near, n), -2.0, dtype=np.float32)
            for s in range(1, min(near, n - 1) + 1):
                d = np.einsum("ij,ij->i", x[:-s], x[s:])
                d[r[:-s] != r[s:]] = -2
                sims[s - 1, s:] = d
                sims[near + s - 1, :-s] = d
            best = sims.argmax(axis=0)
            keep = sims >= floor
            keep[best, np.arange(n)] |= sims[best, np.arange(n)] > -2
            which, at = np.nonzero(keep)
            other = np.where(which < near, at - which - 1, at + which - near + 1)
            fresh = (at >= old) | (other >= old)
            at, other, which = at[fresh], other[fresh], which[fresh]
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[other]), pa.array(sims[which, at])], ["a", "b", "sim"])
            tail = b.slice(max(0, n - near))

    return ordered.mapInArrow(pairs, "a bigint, b bigint, sim float")


def _classes(links: DataFrame) -> DataFrame:
    """``(node, component)`` of the links, written; vectors without a link are left out."""
    return cut_lineage(components(links))


def _named(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs with the components ``ca`` and ``cb`` of their ends (a vector without a link is its own)."""
    for c in ("a", "b"):
        of = classes.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        pairs = pairs.join(of, c, "left").withColumn(f"c{c}", F.coalesce(f"c{c}", c))
    return pairs


def _lists(pairs: DataFrame, classes: DataFrame, limits: DataFrame | None) -> DataFrame:
    """The best distinct neighbours of each vector: of its own component as many as its limit (``LIST`` where
    none is given), and ``LIST`` of other components."""
    best = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    best = _named(best, classes).withColumn("own", F.col("ca") == F.col("cb")).drop("ca", "cb")
    w = Window.partitionBy("a", "own").orderBy(F.col("sim").desc(), "b")
    ranked = best.withColumn("k", F.row_number().over(w))
    if limits is None:
        return ranked.where(F.col("k") <= LIST)
    return ranked.join(limits, "a", "left").where(F.col("k") <= F.when(F.col("own"), F.coalesce("most", F.lit(LIST))).otherwise(LIST)).drop("most")


def _limits(lists: DataFrame, threshold: float) -> DataFrame:
    """Saturated lists of the own component hold nothing but links: twice as long from now on, up to ``LONGEST``."""
    full = lists.where("own").groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("worst"))
    return full.where((F.col("n") >= LIST) & (F.col("worst") >= threshold)).select("a", F.least(2 * F.col("n"), F.lit(LONGEST)).cast("int").alias("most"))


def descend(vectors: DataFrame, lists: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """One round: candidate pairs ``(a, b, sim)`` among the neighbours, forward and reverse, of every vector.

    A reverse list is a sample of at most ``LIST`` by hash, taken in two steps so that a vector that is
    everyone's neighbour is not gathered; a pair is offered only where it improves on the lists' last entries,
    the best few per vector and meeting place, apart for the own and for other components. A link between two
    components that meet is always returned, one per two components and place.
    """
    last = lists.groupBy("a").agg(
        *(F.when(F.count(F.when(c, 1)) >= LIST, F.min(F.when(c, F.col("sim")))).otherwise(-1.0).cast("float").alias(k) for k, c in (("worst_own", F.col("own")), ("worst_other", ~F.col("own"))))
    )
    forward = lists.select(F.col("a").alias("at"), F.col("b").alias("a"), "fresh")
    back = lists.select(F.col("b").alias("at"), "a", "fresh").withColumn("h", F.xxhash64("at", "a"))
    for salt in (F.pmod(F.xxhash64("a"), F.lit(64)), F.lit(0)):
        w = Window.partitionBy("at", "salt").orderBy("h")
        back = back.withColumn("salt", salt).withColumn("k", F.row_number().over(w)).where(F.col("k") <= LIST)
    own = lists.select(F.col("a").alias("at"), "a").distinct().withColumn("fresh", F.lit(False))
    meet = forward.unionByName(back.select("at", "a", "fresh")).unionByName(own).groupBy("at", "a").agg(F.max("fresh").alias("fresh"))
    known = vectors.select(F.col("id").alias("a"), "q").join(last, "a", "left").join(classes.select(F.col("node").alias("a"), "component"), "a", "left")
    none = F.lit(-1.0).cast("float")
    full = meet.join(known, "a").select("at", "a", "fresh", "q", F.coalesce("worst_own", none).alias("worst_own"), F.coalesce("worst_other", none).alias("worst_other"), F.coalesce("component", "a").alias("c"))
    placed = full.repartition("at").sortWithinPartitions("at", "a")

    def run(batches):
        held: list = []

        def close():
            t = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            ids = t.column(1).to_numpy()
            new = np.asarray(t.column(2).to_pylist(), dtype=bool)
            if len(ids) < 2:
                return None
            x = _from_rough(t.column(3))
            c = np.unique(t.column(6).to_numpy(), return_inverse=True)[1]
            own = c[:, None] == c[None, :]
            s = x @ x.T
            np.fill_diagonal(s, -2)
            # links between two components: the first of each two
            i, j = np.nonzero(~own & (s >= floor))
            first = np.unique(c[i] * len(c) + c[j], return_index=True)[1]
            i, j = i[first], j[first]
            got = [(i, j, s[i, j])]
            if new.any():
                s[~(new[:, None] | new[None, :])] = -2
                for mine, worst in ((own, t.column(4).to_numpy()), (~own, t.column(5).to_numpy())):
                    r = np.where(mine & (s > worst[:, None]), s, -2)
                    k = min(4, len(ids) - 1)
                    top = np.argpartition(-r, k - 1, axis=1)[:, :k]
                    i, j = np.repeat(np.arange(len(ids)), k), top.reshape(-1)
                    ok = r[i, j] > -2
                    got.append((i[ok], j[ok], r[i[ok], j[ok]]))
            i, j, s = (np.concatenate(g) for g in zip(*got))
            return ids[i], ids[j], s

        out: list = []

        def flush():
            a, b, s = (np.concatenate([o[i] for o in out]) for i in range(3))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s.astype(np.float32))], ["a", "b", "sim"])

        for b in batches:
            at = b.column(0).to_numpy()
            cut = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for lo, hi in zip(cut[:-1], cut[1:]):
                if lo == hi:
                    continue
                if held and held[-1].column(0)[0].as_py() != int(at[lo]):
                    got = close()
                    if got is not None and len(got[0]):
                        out.append(got)
                    if len(out) > 2000:
                        yield flush()
                held.append(b.slice(lo, hi - lo))
        if held:
            got = close()
            if got is not None and len(got[0]):
                out.append(got)
        if out:
            yield flush()

    return placed.mapInArrow(run, "a bigint, b bigint, sim float")


def neighbour_links(vectors: DataFrame, size: int, threshold: float, seed: int, rounds: int, known: DataFrame | None = None, codes: int = CODES) -> tuple[DataFrame, bool]:
    """Links ``(a, b)`` that hold the components of all pairs met at or above the threshold (less ``ROUGH``: what is
    a link is decided afterwards), written; and whether the last round joined no two components. ``known`` links are kept."""
    floor = threshold - ROUGH
    seeds = cut_lineage(seed_pairs(vectors, size, codes, NEAR, seed, threshold).groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("fresh", F.lit(True)))
    links = seeds.where(F.col("sim") >= floor).select("a", "b")
    _log.info("%d orders: %d pairs near the threshold", codes, links.count() // 2)
    classes = _classes(links if known is None else links.unionAll(known))
    lists, settled = cut_lineage(_lists(seeds, classes, None)), False
    for turn in range(rounds):
        limits = _limits(lists, threshold)
        found = cut_lineage(descend(vectors, lists, classes, floor).withColumn("fresh", F.lit(True)))
        joins = cut_lineage(_named(found.where(F.col("sim") >= floor).select("a", "b"), classes).where("ca <> cb").select("ca", "cb").distinct())
        settled = joins.isEmpty()
        _log.info("round %d: %d pairs near the threshold met, %d of them join two components", turn + 1, found.where(F.col("sim") >= floor).count(), joins.count())
        if settled and turn:
            break
        if not settled:
            classes = _classes(classes.select("node", "component").unionAll(joins))
        old = lists.select("a", "b", "sim").withColumn("fresh", F.lit(False))
        lists = cut_lineage(_lists(old.unionByName(found), classes, limits))
    return classes.select(F.col("node").alias("a"), F.col("component").alias("b")), settled


def exact_links(vectors: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, n)`` written: n links more for vector a (b null), or a link (a, b) that joins a component (n null).

    Everything inside a component of the candidate links is compared in double precision.
    """
    groups = components(links).select(F.col("node").alias("id"), F.col("component").alias("g"))
    sizes = groups.groupBy("g").agg(F.count(F.lit(1)).alias("m"))
    members = cut_lineage(groups.join(sizes, "g").join(vectors, "id").select("g", "m", "id", "copies", "u"))
    angle = float(np.arccos(threshold))

    # large components: their mean direction, added up per task and component
    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            g, u = b.column(0).to_numpy(), _matrix(b.column(1), "f8")
            for k in np.unique(g).tolist():
                total[k] = total.get(k, 0) + u[g == k].sum(axis=0)
        for k, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(v), pa.int64()), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], ["g", "i", "x"])

    large = members.where(F.col("m") > BLOCK)
    mean = large.select("g", "u").mapInArrow(sums, "g bigint, i int, x double").groupBy("g", "i").agg(F.sum("x").alias("x"))
    mean = mean.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c"))

    def mark(batches):
        for b in batches:
            u, c = _matrix(b.column(4), "f8"), b.column(5)
            core = np.zeros(len(b), dtype=bool)
            some = np.flatnonzero(~np.asarray(c.is_null()))
            if len(some):
                m = c.take(pa.array(some))
                m = m.flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)
                m = m / np.maximum(np.sqrt((m * m).sum(axis=1)), 1e-300)[:, None]
                core[some] = np.arccos(np.clip((u[some] * m).sum(axis=1), -1, 1)) <= angle / 2 - 1e-7
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(core)], ["g", "m", "id", "copies", "u", "core"])

    marked = cut_lineage(members.join(mean, "g", "left").select("g", "m", "id", "copies", "u", "c").mapInArrow(mark, "g bigint, m bigint, id bigint, copies bigint, u binary, core boolean"))
    shape = marked.groupBy("g").agg(
        F.ceil(F.count(F.when(~F.col("core"), 1)) / BLOCK).cast("int").alias("loose"),
        F.ceil(F.count(F.when(F.col("core"), 1)) / BLOCK).cast("int").alias("tight"),
        F.sum(F.when(F.col("core"), F.col("copies"))).alias("inside"),
        F.min(F.when(F.col("core"), F.col("id"))).alias("first"),
    )
    full = marked.join(shape, "g")
    core = full.where("core")
    certain = core.select(F.col("id").alias("a"), F.lit(None).cast("bigint").alias("b"), (F.col("inside") - F.col("copies")).alias("n"))
    joined = core.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"), F.lit(None).cast("bigint").alias("n"))

    h = F.xxhash64("id")
    mine = F.when(F.col("core"), F.col("loose") + F.pmod(h, F.greatest("tight", F.lit(1)))).otherwise(F.pmod(h, F.greatest("loose", F.lit(1)))).cast("int")
    partners = F.when(F.col("core"), F.col("loose")).otherwise(F.col("loose") + F.col("tight"))
    dealt = full.withColumn("block", mine).withColumn("other", F.explode(F.when(partners > 0, F.sequence(F.lit(0), partners - 1))))
    tasks = dealt.select("g", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "copies", "u")
    spread = tasks.repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi", "id")

    def compare(batches):
        held: list = []

        def close():
            t = pa.Table.from_batches(held)
            held.clear()
            lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
            ids, copies, block = t["id"].to_numpy(), t["copies"].to_numpy(), t["block"].to_numpy()
            u = _matrix(t["u"].combine_chunks(), "f8")
            left = np.flatnonzero(block == lo)
            right = left if lo == hi else np.flatnonzero(block == hi)
            linked = u[left] @ u[right].T >= threshold
            if lo == hi:
                np.fill_diagonal(linked, False)
                n = linked @ copies[right]
                at, counts = left, n
            else:
                at = np.r_[left, right]
                counts = np.r_[linked @ copies[right], linked.T @ copies[left]]
            some = counts > 0
            # the links that join two components of this block pair
            parent = list(range(len(ids)))

            def root(i):
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            a, b = [], []
            for i in np.flatnonzero(linked.any(axis=1)).tolist():
                for j in np.flatnonzero(linked[i]).tolist():
                    p, q = root(int(left[i])), root(int(right[j]))
                    if p != q:
                        parent[p] = q
                        a.append(int(ids[left[i]]))
                        b.append(int(ids[right[j]]))
            k = int(some.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array([*ids[at][some].tolist(), *a], pa.int64()), pa.array([None] * k + b, pa.int64()), pa.array([*counts[some].tolist(), *[None] * len(a)], pa.int64())], ["a", "b", "n"]
            )

        last = None
        for b in batches:
            keys = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for x, y in zip(cut[:-1], cut[1:]):
                if x == y:
                    continue
                key = tuple(keys[x].tolist())
                if held and key != last:
                    yield close()
                last = key
                held.append(b.slice(x, y - x))
        if held:
            yield close()

    compared = spread.mapInArrow(compare, "a bigint, b bigint, n bigint")
    return cut_lineage(compared.unionAll(certain).unionAll(joined))


def audit(vectors: DataFrame, counts: DataFrame, size: int, threshold: float, sample: int = AUDIT, most: int = MOST_AUDIT) -> tuple[float, float]:
    """Share of the vectors with links of which all links were found, each vector weighing the same; and a bound on the share of
    all vectors that miss a link (with 95 % confidence).

    Vectors are taken in the order of a hash of the id until ``sample`` of them have links, or ``most`` are taken, or all
    (no link at all gives a share of 1). Each part of the sample is compared with every row, in double precision; each task
    returns a count per sampled vector. The bound is that of a proportion: of m sampled vectors with f misses about
    (f + 2 sqrt(f) + 3) / m, so a table with hardly a link is not compared as a whole to prove it.
    """
    keyed = vectors.select("id", "u", F.xxhash64("id").alias("h"))
    linked = whole = taken = 0
    step, last = sample, None
    while linked < sample and taken < most:
        rest = keyed if last is None else keyed.where((F.col("h") > last[0]) | ((F.col("h") == last[0]) & (F.col("id") > last[1])))
        rows = rest.orderBy("h", "id").limit(min(step, most - taken)).collect()
        if not rows:
            break
        taken += len(rows)
        last, step = (rows[-1]["h"], rows[-1]["id"]), min(2 * step, 4096)
        true = _true_counts(vectors, np.array([r["id"] for r in rows]), np.array([np.frombuffer(r["u"], "f8") for r in rows]), threshold)
        got = true.where("n > 0").join(counts.select("id", F.col("links").alias("found")), "id", "left")
        n, full = got.agg(F.count(F.lit(1)), F.count(F.when(F.col("found") >= F.col("n"), 1))).first()
        linked, whole = linked + n, whole + full
    missed = linked - whole
    return (whole / linked if linked else 1.0), (min(1.0, (missed + 2 * math.sqrt(missed) + 3) / taken) if taken else 0.0)


def _true_counts(vectors: DataFrame, ids: np.ndarray, x: np.ndarray, threshold: float) -> DataFrame:
    """``(id, n)``: the rows linked to each of the given vectors, by comparison with all."""

    def run(batches):
        total = np.zeros(len(ids), dtype=np.int64)
        for b in batches:
            u, own, copies = _matrix(b.column(2), "f8"), b.column(0).to_numpy(), b.column(1).to_numpy()
            for lo in range(0, len(ids), 256):
                linked = u @ x[lo : lo + 256].T >= threshold
                linked &= own[:, None] != ids[None, lo : lo + 256]
                total[lo : lo + 256] += copies @ linked
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["id", "n"])

    return vectors.select("id", "copies", "u").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, rounds: int = 6, audits: int = 3, target: float = 0.999, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, n_links, component_id, kept)``: one row per vector.

    ``n_links`` counts the other vectors (rows) with a cosine of at least ``threshold`` in double precision,
    ``component_id`` is the smallest id reachable by links, ``kept`` marks it. A vector that is null, zero or
    holds null or non-finite components links with nothing, nor do vectors of different lengths; such
    rows are components of their own (null id: null component, kept). Equal vectors link with one
    another; rows that repeat an id share its figures. An empty table gives an empty one; other columns are not read.
    """
    spark = df.sparkSession
    vectors = cut_lineage(unit_vectors(df, id_col, vector_col))
    sizes = [r["n"] for r in vectors.select("n").distinct().orderBy("n").collect()]
    results = []
    for size in sizes:
        mine = vectors.where(F.col("n") == size).select("id", "copies", "u", "q")
        known = None
        for turn in range(audits):
            known, settled = neighbour_links(mine, size, threshold, 1000 * turn + 17, rounds, known, CODES << turn)
            exact = exact_links(mine, known, threshold)
            counts = exact.where("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
            recall, bound = audit(mine, counts, size, threshold)
            _log.info("vectors of length %d: audited recall %.4f after %d turns; at most %.5f of the vectors miss a link", size, recall, turn + 1, bound)
            if recall >= target and settled:
                break
        else:
            raise RuntimeError(f"vectors of length {size}: audited recall {recall:.4f} after {audits} turns (target {target}), rounds {'' if settled else 'not '}settled")
        results.append(exact)
    if results:
        exact = results[0]
        for x in results[1:]:
            exact = exact.unionAll(x)
    else:
        exact = spark.createDataFrame([], "a bigint, b bigint, n bigint")
    counts = exact.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    classes = components(exact.where("n is null").select("a", "b")).select(F.col("node").alias("rep"), F.col("component").alias("class"))
    # back to all rows: each row's representative by its vector
    rep = usable(df, id_col, vector_col).groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    named = rep.join(counts, "rep", "left").join(classes, "rep", "left").select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("class", "rep").alias("class"))
    rows = usable(df, id_col, vector_col).join(named, "v").select("id", "links", "class")
    rows = rows.groupBy("id").agg(F.max("links").alias("links"), F.min("class").alias("class"))
    own = F.col(f"`{id_col}`").cast("bigint")
    out = df.select(own.alias("__id")).join(rows, F.col("__id") == F.col("id"), "left").select(
        F.col("__id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("class", "__id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(f"`{id_col}`") == F.col("component_id"), F.lit(True)))
