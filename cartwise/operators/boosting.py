"""Boosted trees grown by tasks that keep their rows in memory as bins (A10, L3).

MLlib runs one stage per level of every tree and, for each of them, builds an object per row. Here the rows are dealt evenly
over the cores once and every task keeps its part as a byte per feature plus label, score and node for the whole training (one barrier
stage). A level is one pass over these arrays that adds up the gradients by node, feature and bin; the tasks exchange
those sums (bounded by nodes x features x bins), as files in the session's shared folder, and each derives the same splits from them.

Nothing else differs from ``GBTClassifier``: bins from the same sample, the same random rows per tree and features per node, the same
gains, ties and pruning. The result is its ``GBTClassificationModel``. Where two splits are equally good but for the last bit of
a sum, either may be taken, as by MLlib when its partial sums arrive in another order.
"""

from __future__ import annotations

import base64
import json
import math
import sys
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import discard_path, intermediate_path

CHUNK = 1 << 16  # rows of a task that are worked on at once
WHOLE = 200_000  # up to so many rows the sums of both children are counted; beyond, the larger child's are a difference
MOST_TASKS = 32  # all tasks get the sums of all others: rows, not tasks, grow beyond
SAMPLE = 10_000  # rows that the bins come from, as in MLlib
EPSILON = 2.0**-52

_M64 = (1 << 64) - 1

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package


# ---------------------------------------------------------------- MLlib's random numbers


def _murmur3(data: bytes, seed: int) -> int:
    """MurmurHash3 (32 bits) of 8 bytes."""
    h = seed
    for i in (0, 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def hash_seed(seed: int) -> int:
    """The first state of Spark's XORShift generator."""
    data = (seed & _M64).to_bytes(8, "big")
    low = _murmur3(data, 0x3C074A61)
    return _murmur3(data, low) << 32 | low


def _step(s):
    """The next state (an int or an array of uint64)."""
    if isinstance(s, int):
        s ^= s << 21 & _M64
        s ^= s >> 35
        return s ^ (s << 4 & _M64)
    s = s ^ (s << np.uint64(21))
    s = s ^ (s >> np.uint64(35))
    return s ^ (s << np.uint64(4))


def xor_int(seed: int) -> int:
    """``new XORShiftRandom(seed).nextInt()``."""
    x = _step(hash_seed(seed)) & 0xFFFFFFFF
    return x - (1 << 32) if x >> 31 else x


def _doubles(seed: int, n: int) -> list[float]:
    s, out = hash_seed(seed), []
    for _ in range(n):
        a = _step(s)
        s = _step(a)
        out.append(((a & (1 << 26) - 1) << 27 | s & (1 << 27) - 1) * 2.0**-53)
    return out


def _moved(columns: np.ndarray, states: np.ndarray) -> np.ndarray:
    """A linear map over bits (the images of the 64 bits) applied to states."""
    out = np.zeros_like(states)
    for b in range(64):
        out ^= np.where(states >> np.uint64(b) & np.uint64(1), columns[b], np.uint64(0))
    return out


class RowSample:
    """Which of ``n`` rows a generator's numbers below ``rate`` choose, many stretches of the sequence at a time."""

    def __init__(self, n: int, rate: float, lanes: int = 4096):
        self.n, self.rate, self.jumps = n, rate, []
        lanes = min(lanes, 1 << max(0, (n // 64).bit_length() - 1)) if n >= 64 else 1
        self.length = -(-n // lanes) if n else 0
        bits = np.array([1 << b for b in range(64)], dtype=np.uint64)
        power, jump, k = _step(bits), bits, 2 * self.length  # two steps a number
        while k:
            if k & 1:
                jump = _moved(power, jump)
            power, k = _moved(power, power), k >> 1
        for _ in range(lanes.bit_length() - 1):
            self.jumps.append(jump)
            jump = _moved(jump, jump)

    def rows(self, seed: int) -> np.ndarray:
        s = np.array([hash_seed(seed)], dtype=np.uint64)
        for jump in self.jumps:
            s = np.concatenate([s, _moved(jump, s)])
        out = np.empty((len(s), self.length), dtype=bool)
        for i in range(self.length):
            a = _step(s)
            s = _step(a)
            x = (a & np.uint64((1 << 26) - 1)) << np.uint64(27) | s & np.uint64((1 << 27) - 1)
            out[:, i] = x * 2.0**-53 < self.rate
        return out.reshape(-1)[: self.n]


class JavaRandom:
    def __init__(self, seed: int):
        self.s = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.s = (self.s * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        x = self.s >> 16
        return x - (1 << 32) if x >> 31 else x

    def long(self) -> int:
        return (self._next() << 32) + self._next()


def features_per_node(strategy: str, n: int) -> int:
    if strategy in ("auto", "all"):
        return n
    if strategy == "sqrt":
        return math.ceil(math.sqrt(n))
    if strategy == "log2":
        return max(1, math.ceil(math.log2(n)))
    if strategy == "onethird":
        return math.ceil(n / 3.0)
    return min(int(strategy), n) if strategy.isdigit() else math.ceil(float(strategy) * n)


def feature_subset(n: int, k: int, rng: JavaRandom) -> list[int]:
    """A reservoir sample of k of n features (all of them, in order, when k is n)."""
    kept = list(range(k))
    if k < n:
        for item, x in zip(range(k, n), _doubles(rng.long(), n - k)):
            at = int(x * (item + 1))
            if at < k:
                kept[at] = item
    return kept


# ---------------------------------------------------------------- bins


def split_points(sampled: np.ndarray, expected: float, most: int) -> list[float]:
    """At most about ``most`` thresholds of a feature from its sampled values, by equal counts, as MLlib places them.

    Zeros are not counted but taken as the rest of the ``expected`` number of sampled rows.
    """
    values, counts = np.unique(sampled[sampled != 0], return_counts=True)
    if not len(values):
        return []
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if zeros > EPSILON * counts.sum() * 100:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    if len(values) - 1 <= most:
        return [float(x) for x in (values[:-1] + values[1:]) / 2.0]
    stride = expected / (most + 1)
    out, so_far, target = [], counts[0], stride
    for i in range(1, len(values)):
        before, so_far = so_far, so_far + counts[i]
        if abs(before - target) < abs(so_far - target):
            out.append(float((values[i - 1] + values[i]) / 2.0))
            target += stride
    return out


# ---------------------------------------------------------------- trees


def _impurity(s: np.ndarray) -> np.ndarray:
    """The variance of sums ``(..., [count, sum, sum of squares])``; 0 for none."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(s[..., 0] == 0, 0.0, (s[..., 2] - s[..., 1] * s[..., 1] / s[..., 0]) / s[..., 0])


def best_splits(nodes: list[dict], sums: np.ndarray, splits: list[int], min_rows: int, min_gain: float) -> None:
    """Sets ``feature, bin, gain, left, right`` (sums of the sides) of each node from its ``sums`` (node, feature, bin, 3); a node
    without a valid split keeps none. A root also gets its own ``sums`` and ``impurity``."""
    upto = np.cumsum(sums, axis=2)
    most = max(splits, default=0)
    left = upto[:, :, :most]
    right = upto[:, :, -1:] - left
    for i, node in enumerate(nodes):
        if "sums" not in node:
            first = next((f for f in node["features"] if splits[f]), None)
            node["sums"] = upto[i, 0, -1] if first is None else left[i, first, 0] + right[i, first, 0]
            node["impurity"] = float(_impurity(node["sums"]))
    if not most:
        return
    n_left, n_right = left[..., 0], right[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        total = n_left + n_right
        gain = np.array([n["impurity"] for n in nodes])[:, None, None] - n_left / total * _impurity(left) - n_right / total * _impurity(right)
    valid = (n_left >= min_rows) & (n_right >= min_rows) & (gain >= min_gain) & (np.arange(most) < np.array(splits)[:, None])
    gain = np.where(valid, gain, -np.inf)
    for i, node in enumerate(nodes):
        order = [f for f in node["features"] if splits[f]]
        if not order:
            continue
        per = gain[i, order]
        at = per.argmax(axis=1)
        best = int(per.max(axis=1).argmax())
        f, b = order[best], int(at[best])
        if gain[i, f, b] > 0:
            node.update(feature=f, bin=b, gain=float(gain[i, f, b]), left=left[i, f, b], right=right[i, f, b])


class Exchange:
    """Gives every task of a barrier stage the bytes of all, in the order of the tasks.

    They go through files in a folder that all tasks see; Spark's own messages take a second each and are used where the folder is
    out of reach. A task has read all of a round before it writes the next, so the round before can go: two files a task are kept.
    """

    def __init__(self, context: BarrierTaskContext, folder: str):
        from pyarrow import fs

        self.context, self.part, self.round = context, context.partitionId(), 0
        tries = context.allGather(str(context.taskAttemptId()))  # other ones when the stage is run again
        self.tasks = len(tries)
        try:
            self.fs, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
            self.folder = f"{path.rstrip('/')}/{tries[0]}"
            self.fs.create_dir(self.folder)
            self._write(b"")
            written = True
        except (OSError, ValueError, NotImplementedError, pa.ArrowException):
            written = False
        all_wrote = "no" not in context.allGather("yes" if written else "no")
        seen = all_wrote and all(x.is_file for x in self.fs.get_file_info([self._path(0, i) for i in range(self.tasks)]))
        self.files = "no" not in context.allGather("yes" if seen else "no")

    def _path(self, k: int, part: int) -> str:
        return f"{self.folder}/{k}-{part}"

    def _write(self, data: bytes) -> None:
        draft = f"{self.folder}/.{self.round}-{self.part}"
        with self.fs.open_output_stream(draft) as out:
            out.write(data)
        self.fs.move(draft, self._path(self.round, self.part))  # seen whole or not at all

    def _read(self, part: int) -> bytes:
        wait = 0.0005
        while True:
            try:
                with self.fs.open_input_stream(self._path(self.round, part)) as f:
                    return f.read()
            except FileNotFoundError:  # if its task fails, Spark ends this one too
                time.sleep(wait)
                wait = min(2 * wait, 0.02)

    def __call__(self, data: bytes) -> list[bytes]:
        self.round += 1
        if not self.files:
            return [base64.b64decode(x) for x in self.context.allGather(base64.b64encode(data).decode())]
        self._write(data)
        found = [data if i == self.part else self._read(i) for i in range(self.tasks)]
        self.fs.delete_file(self._path(self.round - 1, self.part))
        return found


def _summed(parts: list[bytes], shape: tuple) -> np.ndarray:
    total = None
    for p in parts:
        a = np.frombuffer(p, dtype=np.float64).reshape(shape)
        total = a.copy() if total is None else np.add(total, a, out=total)
    return total


class Rows:
    """A task's rows: chunks of bins, labels, scores, nodes and whether the tree at hand learns from them."""

    def __init__(self, batches: Iterator[pa.RecordBatch], thresholds: list[list[float]]):
        self.splits = [len(t) for t in thresholds]
        self.width = max(self.splits, default=0) + 1
        kind = np.uint8 if self.width <= 256 else np.uint16
        cuts = [np.array(t) for t in thresholds]
        self.bins: list[np.ndarray] = []
        labels: list[np.ndarray] = []
        held, n = [], 0

        def chunk() -> None:
            table = pa.Table.from_batches(held)
            made = np.empty((len(cuts), n), dtype=kind)
            for i, c in enumerate(cuts):
                v = table.column(i).to_numpy()
                if table.column(i).null_count or np.isnan(v).any():
                    raise ValueError(f"feature {table.column_names[i]} has a null or NaN value")
                made[i] = np.searchsorted(c, v, side="left")
            y = table.column(len(cuts)).to_numpy()
            if table.column(len(cuts)).null_count or not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            self.bins.append(made)
            labels.append((y * 2 - 1).astype(np.int8))

        for b in batches:
            while b.num_rows:
                part = b.slice(0, CHUNK - n)
                b = b.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == CHUNK:
                    chunk()
                    held, n = [], 0
        if n:
            chunk()
        self.labels = labels
        self.scores = [np.zeros(len(y)) for y in labels]
        self.nodes = [np.ones(len(y), dtype=np.uint8) for y in labels]
        self.n = sum(len(y) for y in labels)
        self.chosen = None

    def choose(self, rows: np.ndarray | None) -> None:
        self.chosen = rows
        for k in self.nodes:
            k.fill(1)

    def step(self, split: dict[int, tuple[int, int]], size: int) -> None:
        """Send the rows of split nodes ``{node: (feature, bin)}`` to their children; node numbers are below ``size``."""
        if not split:
            return
        feature, at, inner = np.zeros(size, dtype=np.intp), np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool)
        for k, (f, b) in split.items():
            feature[k], at[k], inner[k] = f, b, True
        kind = np.uint8 if 2 * size <= 256 else np.uint32
        for c, (bins, nodes) in enumerate(zip(self.bins, self.nodes)):
            m = len(nodes)
            own = bins.reshape(-1).take(feature.take(nodes) * m + np.arange(m))
            child = nodes.astype(kind) * kind(2) + (own > at.take(nodes))
            self.nodes[c] = np.where(inner.take(nodes), child, nodes).astype(kind)

    def sums(self, build: list[int], size: int, first: bool) -> np.ndarray:
        """Counts, sums and sums of squares of what is to be learned, by node of ``build``, feature and bin."""
        place = np.full(size, -1, dtype=np.int64)
        place[build] = np.arange(len(build))
        cells = len(build) * self.width
        out = np.zeros((3, len(self.splits), cells))
        lo = 0
        for bins, y, p, nodes in zip(self.bins, self.labels, self.scores, self.nodes):
            m = len(y)
            at = place.take(nodes)
            take = at >= 0
            if self.chosen is not None:
                take &= self.chosen[lo : lo + m]
            lo += m
            sel = np.flatnonzero(take)
            if not len(sel):
                continue
            base = at.take(sel) * self.width
            label = y.take(sel).astype(np.float64)
            g = label if first else 4.0 * label / (1.0 + np.exp(2.0 * label * p.take(sel)))
            g2 = g * g
            for f in range(len(self.splits)):
                if self.splits[f]:
                    cell = base + bins[f].take(sel)
                    out[0, f] += np.bincount(cell, minlength=cells)
                    out[1, f] += np.bincount(cell, g, minlength=cells)
                    out[2, f] += np.bincount(cell, g2, minlength=cells)
                else:
                    here = base[:0]
                    if not any(self.splits) and f == 0:
                        here = base
                    out[0, f] += np.bincount(here, minlength=cells)
                    out[1, f] += np.bincount(here, g[: len(here)], minlength=cells)
                    out[2, f] += np.bincount(here, g2[: len(here)], minlength=cells)
        return np.ascontiguousarray(out.reshape(3, len(self.splits), len(build), self.width).transpose(2, 1, 3, 0))

    def learn(self, value: np.ndarray, weight: float) -> None:
        for p, nodes in zip(self.scores, self.nodes):
            with np.errstate(invalid="ignore"):
                p += value.take(nodes) * weight


def grow_trees(rows: Rows, part: int, total: int, exchange, spec: dict) -> list[dict[int, dict]]:
    """All trees, each a dict of its nodes by number (the root 1, the children of k at 2k and 2k + 1).

    ``exchange`` takes bytes and returns those of all tasks in their order; every task ends with the same trees.
    """
    sample = RowSample(rows.n, spec["rate"]) if spec["rate"] < 1 else None
    n_features, trees = len(rows.splits), []
    whole = total <= WHOLE
    for m in range(spec["trees"]):
        rows.choose(sample.rows(spec["seed"] + m + part + 1) if sample else None)
        rng = JavaRandom(spec["seed"] + m)
        tree: dict[int, dict] = {1: {}}
        todo, before = [1], {}
        for level in range(spec["depth"] + 1):
            size = 2 << level
            if level == spec["depth"] or not todo:
                break
            for k in todo:
                tree[k]["features"] = feature_subset(n_features, spec["features"], rng)
            # of two siblings that are both to be split, the larger one's sums are those of the parent less the other's
            pairs = {k: k ^ 1 for k in todo if k > 1 and k ^ 1 in todo and not whole and (tree[k]["sums"][0], k) > (tree[k ^ 1]["sums"][0], k ^ 1)}
            build = [k for k in todo if k not in pairs]
            shape = (len(build), n_features, rows.width, 3)
            own = rows.sums(build, size, m == 0)
            found = dict(zip(build, _summed(exchange(own.tobytes()), shape)))
            for k, other in pairs.items():
                found[k] = before[k >> 1] - found[other]
            best_splits([tree[k] for k in todo], np.stack([found[k] for k in todo]), rows.splits, spec["min_rows"], spec["min_gain"])
            split, after = {}, []
            for k in todo:
                node = tree[k]
                if "feature" not in node:
                    continue
                split[k] = node["feature"], node["bin"]
                for child, s in ((2 * k, node["left"]), (2 * k + 1, node["right"])):
                    tree[child] = {"sums": s, "impurity": float(_impurity(s))}
                    if level + 1 < spec["depth"] and abs(tree[child]["impurity"]) >= EPSILON:
                        after.insert(0, child)
            rows.step(split, size)
            todo, before = after, found
        value = np.zeros(2 << spec["depth"])
        for k, node in tree.items():
            c, s, _ = node["sums"]
            value[k] = node["value"] = float(s / c) if c else 0.0
        rows.learn(value, 1.0 if m == 0 else spec["step"])
        trees.append(tree)
    return trees


def _as_text(trees: list[dict[int, dict]]) -> str:
    return json.dumps([{k: [list(map(float, n["sums"])), n["impurity"], n["value"], n.get("feature", -1), n.get("bin", 0), n.get("gain", 0.0)] for k, n in t.items()} for t in trees])


# ---------------------------------------------------------------- the model


def _node_rows(tree: dict, thresholds: list[list[float]]) -> list[dict]:
    """A tree's nodes as MLlib saves them: numbered from the root, left before right; two leaves of one value are one."""
    rows: list[dict] = []

    def add(k: int) -> float | None:
        """Adds a node and all below it; its value if it is a leaf."""
        sums, impurity, value, feature, at, gain = tree[str(k)]
        row = {"id": len(rows), "prediction": value, "impurity": impurity, "impurityStats": sums, "rawCount": int(sums[0]), "gain": -1.0, "leftChild": -1, "rightChild": -1, "split": (-1, [], -1)}
        rows.append(row)
        if feature < 0:
            return value
        left = row["id"] + 1
        before = add(2 * k)
        right = len(rows)
        after = add(2 * k + 1)
        if before is not None and before == after:
            del rows[left:]
            row["prediction"] = before
            return before
        row.update(gain=gain, leftChild=left, rightChild=right, split=(feature, [thresholds[feature][at]], -1))
        return None

    add(1)
    return rows


def _saved_model(spark: SparkSession, gbt: GBTClassifier, trees: list[dict], thresholds: list[list[float]]) -> GBTClassificationModel:
    """The model of the trees: one of mere roots is saved by MLlib, its nodes are replaced, and it is loaded."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    made, weights = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees)), gateway.new_array(jvm.double, len(trees))
    root = ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0))
    for i in range(len(trees)):
        made[i] = ml.regression.DecisionTreeRegressionModel(root, len(thresholds))
        weights[i] = 1.0 if i == 0 else gbt.getStepSize()
    bare = gbt._copyValues(GBTClassificationModel(ml.classification.GBTClassificationModel(gbt.uid, made, weights, len(thresholds), 2)))
    path = intermediate_path(spark)
    try:
        bare.write().overwrite().save(path)
        schema = spark.read.parquet(f"{path}/data").schema
        names = schema["nodeData"].dataType.names
        nodes = [(i, tuple(r[c] for c in names)) for i, t in enumerate(trees) for r in _node_rows(t, thresholds)]
        spark.createDataFrame(nodes, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
        return GBTClassificationModel.load(path)
    finally:
        discard_path(spark, path)


def _tasks(spark: SparkSession) -> int:
    """Tasks that run at the same time here; 0 where that is not known beforehand."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    sc = spark.sparkContext._jsc.sc()
    return min(MOST_TASKS, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def _plain(gbt: GBTClassifier) -> bool:
    """Whether only such settings are used as are known here."""
    unset = ("weightCol", "validationIndicatorCol", "thresholds")
    return not any(gbt.isDefined(p) for p in unset) and gbt.getMinWeightFractionPerNode() == 0 and gbt.getMaxDepth() <= 16


def fit_boosted(pipeline: Pipeline, train: DataFrame) -> PipelineModel | None:
    """``pipeline`` (an assembler of feature columns and a ``GBTClassifier``) fitted to ``train``; None where the training cannot
    run this way (no fixed number of cores, no rows, settings beyond those above).

    A null or NaN feature and a label other than 0 and 1 are errors. ``train`` is read three times: pass a written table. A task keeps
    about 18 bytes per row; a task that fails starts the training anew.
    """
    assembler, gbt = pipeline.getStages()
    if not isinstance(assembler, VectorAssembler) or not isinstance(gbt, GBTClassifier) or not _plain(gbt):
        return None
    spark, n, tasks = train.sparkSession, train.count(), _tasks(train.sparkSession)
    if not n or not tasks:
        return None
    cols = assembler.getInputCols()
    dealt = train.repartition(tasks).select(*[F.col(c).cast("double").alias(c) for c in cols], F.col("label").cast("double").alias("label"))
    required = max(min(gbt.getMaxBins(), n) ** 2, SAMPLE)
    fraction = required / n if required < n else 1.0
    sampled = dealt
    if fraction < 1:
        drawn = dealt._jdf.toJavaRDD().sample(False, fraction, xor_int(gbt.getSeed()))
        sampled = DataFrame(spark._jsparkSession.createDataFrame(drawn, dealt._jdf.schema()), spark)
    some = sampled.select(*cols).collect()
    most = min(gbt.getMaxBins(), n) - 1
    # a missing value is an error where all rows are read
    thresholds = [split_points(np.array([r[i] for r in some if r[i] is not None and r[i] == r[i]], dtype=float), fraction * n, most) for i in range(len(cols))]
    spec = {
        "trees": gbt.getMaxIter(), "depth": gbt.getMaxDepth(), "step": gbt.getStepSize(), "rate": gbt.getSubsamplingRate(), "seed": gbt.getSeed(),
        "features": features_per_node(gbt.getFeatureSubsetStrategy(), len(cols)), "min_rows": gbt.getMinInstancesPerNode(), "min_gain": gbt.getMinInfoGain(),
    }

    folder = intermediate_path(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        trees = grow_trees(Rows(batches, thresholds), context.partitionId(), n, Exchange(context, folder), spec)
        yield pa.RecordBatch.from_arrays([pa.array([_as_text(trees)] if context.partitionId() == 0 else [], pa.string())], ["trees"])

    try:
        trees = json.loads(dealt.mapInArrow(run, "trees string", barrier=True).collect()[0]["trees"])
    finally:
        discard_path(spark, folder)
    return PipelineModel([assembler, _saved_model(spark, gbt, trees, thresholds)])
