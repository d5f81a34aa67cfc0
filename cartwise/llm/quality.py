"""Quality classifier: a byte-level convolutional network in numpy (operator 8).

Bytes are embedded, filters of eight bytes slide over them in steps of four, and each overlapping
chunk of 512 bytes keeps every filter's greatest response. A dense layer turns a chunk's maxima into a
logit. The mean of a document's chunk logits, all of them, is its own, and a sigmoid makes it the one
probability. Embedding, filters and dense layer are learned together on the driver from a
bounded sample of labelled rows; scoring runs over every byte of every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import held_out, map_texts
from cartwise.session import cut_lineage, discard

SAMPLE = 1500  # labelled documents per class that are learned from
SAMPLE_CHUNKS = 4500  # chunks of these per class
THRESHOLD = 0.3
EMBED, FILTERS, STEP = 8, 32, 4
BLOCK = 16  # positions per block of 64 bytes
CHUNK, ADVANCE = 8, 7  # blocks per chunk, and from one chunk to the next
PAD = 256


def _layout(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes padded to whole blocks, blocks per document, and the count of real positions per block."""
    unit = BLOCK * STEP
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    blocks = np.maximum(1, -(-sizes // unit))
    starts = np.cumsum(blocks) - blocks
    data = np.full(int(blocks.sum()) * unit + unit, PAD, dtype=np.int16)
    for r, s in zip(raw, starts.tolist()):
        data[s * unit : s * unit + len(r)] = np.frombuffer(r, dtype=np.uint8)
    return data, blocks, starts


@dataclass
class Network:
    embed: np.ndarray  # 257 x EMBED, the last row for padding
    filters: np.ndarray  # (2 * STEP * EMBED) x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: float

    def _responses(self, data: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Filter responses at each step of the padded bytes; nothing follows a document's ``last`` step."""
        x = self.embed[data].reshape(-1, STEP * EMBED)
        half = STEP * EMBED
        follows = x[1:] @ self.filters[half:]
        follows[last] = 0
        return x[:-1] @ self.filters[:half] + follows

    def score(self, texts: list) -> np.ndarray:
        """Probability of label 1 per text (null: empty)."""
        if not texts:
            return np.zeros(0)
        data, blocks, starts = _layout([(t or "").encode("utf-8", "replace") for t in texts])
        unit, n = BLOCK * STEP, int(blocks.sum())
        top = np.empty((n, len(self.bias)), dtype=np.float32)
        for lo in range(0, n, 4096):  # bounded memory for a text of any length
            hi = min(n, lo + 4096)
            ends = (starts + blocks)[(starts + blocks > lo) & (starts + blocks <= hi)] - lo
            r = self._responses(data[lo * unit : hi * unit + STEP], ends * BLOCK - 1)
            top[lo:hi] = r.reshape(hi - lo, BLOCK, -1).max(axis=1)
        chunks = np.maximum(1, -(-(blocks - 1) // ADVANCE))
        doc = np.repeat(np.arange(len(texts)), chunks)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        begin = starts[doc] + k * ADVANCE
        end = np.minimum(begin + CHUNK, starts[doc] + blocks[doc])
        pooled = top[begin]
        for j in range(1, CHUNK):
            pooled = np.maximum(pooled, top[np.minimum(begin + j, end - 1)])
        logit = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        mean = np.bincount(doc, weights=logit, minlength=len(texts)) / chunks
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def train(chunks: np.ndarray, labels: np.ndarray, share: float = 0.5, epochs: int = 12, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> Network:
    """Adam on chunks (rows of 516 padded bytes) with their documents' labels; label 1 weighs ``share`` in all.

    Every chunk is learned from as it is and once more cut short, since short texts have few responses to
    take the greatest of.
    """
    rng = np.random.default_rng(seed)
    short = chunks.copy()
    short[np.arange(chunks.shape[1])[None] >= rng.integers(12, 240, len(chunks))[:, None]] = PAD
    chunks, labels = np.concatenate([chunks, short]), np.concatenate([labels, labels])
    half = STEP * EMBED
    p = {
        "embed": rng.normal(0, 0.5, (257, EMBED)),
        "filters": rng.normal(0, 1 / np.sqrt(2 * half), (2 * half, FILTERS)),
        "bias": np.zeros(FILTERS),
        "dense": rng.normal(0, 0.3, FILTERS),
        "offset": np.zeros(1),
    }
    p["embed"][PAD] = 0
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, s, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    mean = labels.mean()
    weight = np.where(labels > 0, share / max(mean, 1e-6), (1 - share) / max(1 - mean, 1e-6)).astype(np.float32)
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // batch)):
            data, y = chunks[at], labels[at]
            n, width = data.shape
            e = p["embed"][data].reshape(n, width // STEP, half)
            x = np.concatenate([e[:, :-1], e[:, 1:]], axis=2)
            z = x @ p["filters"]
            where = z.argmax(axis=1)
            top = np.take_along_axis(z, where[:, None], axis=1)[:, 0] + p["bias"]
            h = np.maximum(top, 0)
            q = 1 / (1 + np.exp(-np.clip(h @ p["dense"] + p["offset"], -30, 30)))
            d = (q - y) * weight[at] / n
            g = {"dense": h.T @ d, "offset": np.array([d.sum()], dtype=np.float32)}
            dh = d[:, None] * p["dense"] * (top > 0)
            g["bias"] = dh.sum(axis=0)
            windows = x[np.arange(n)[:, None], where]  # n x FILTERS x 2 half
            g["filters"] = np.einsum("nfk,nf->kf", windows, dh)
            de = dh[:, :, None] * p["filters"].T  # n x FILTERS x 2 half
            places = where[:, :, None] * STEP + np.arange(2 * STEP)
            ids = data[np.arange(n)[:, None, None], places]
            g["embed"] = np.zeros_like(p["embed"])
            np.add.at(g["embed"], ids.reshape(-1), de.reshape(-1, EMBED))
            g["embed"][PAD] = 0
            step += 1
            now = rate * (1 - epoch / epochs) + 1e-4
            for k, v in p.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                v -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Network(p["embed"], p["filters"], p["bias"], p["dense"], float(p["offset"][0]))


def chunks_of(raw: bytes, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of a document for learning, the last one ending with it, and a draw for each.

    The draws are those of weighted sampling (an exponential variable over the weight, one in the number of
    chunks): the smallest draws of many documents are a sample in which every document weighs alike and
    every place of it can come up.
    """
    size = CHUNK * BLOCK * STEP
    n = max(1, -(-len(raw) // size))
    out = np.full((n, size + STEP), PAD, dtype=np.int16)
    for i, a in enumerate([*range(0, (n - 1) * size, size), max(0, len(raw) - size)]):
        part = np.frombuffer(raw[a : a + size], dtype=np.uint8)
        out[i, : len(part)] = part
    return out, np.random.default_rng(seed).exponential(size=n) * n


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chunks: int = SAMPLE_CHUNKS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Network:
    """Learn from a sample of chunks of labelled documents that are not held out.

    ``sample`` documents per class, those of the smallest hashes of their ids, are cut into chunks over their whole texts, and
    ``chunks`` chunks per class are drawn from these, every document with the same weight. Both bounds count rows:
    the first makes the documents' ids small enough to be broadcast, the second bounds what reaches the
    driver. Without labels of both kinds the
    network is the untrained constant: the share of label 1, or 0.5 where there is none. Classes weigh
    as often as they occur among all usable labels, so that scores are probabilities.
    """
    usable = labels.where(F.col(f"`{label_col}`").isin(0, 1) & ~held_out(id_col)).groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.max(F.col(f"`{label_col}`")).alias("__y"))
    totals = {r["__y"]: r["count"] for r in usable.groupBy("__y").count().collect()}
    first = [usable.where(F.col("__y") == y).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(sample) for y in (0, 1)]
    picked = first[0].unionAll(first[1])
    source = docs.select(F.col(f"`{id_col}`").alias("__of"), F.col(f"`{text_col}`").alias("__text"))
    rows = source.join(F.broadcast(picked), F.col("__of") == F.col("__id")).select("__id", "__y", "__text")

    def run(batches):
        import pandas as pd

        for b in batches:
            for i, y, t in zip(b["__id"], b["__y"], b["__text"]):
                made, draw = chunks_of((t or "").encode("utf-8", "replace"), int(i) & 0xFFFFFFFF)
                for lo in range(0, len(made), 4096):
                    part = made[lo : lo + 4096]
                    yield pd.DataFrame({"i": i, "y": y, "place": np.arange(lo, lo + len(part)), "draw": draw[lo : lo + len(part)], "chunk": [c.tobytes() for c in part]})

    cut = cut_lineage(rows.mapInPandas(run, "i bigint, y int, place bigint, draw double, chunk binary"))
    parts = [cut.where(F.col("y") == y).orderBy("draw", "i", "place").limit(chunks) for y in (0, 1)]
    got = sorted((r["i"], r["place"], r["y"], bytes(r["chunk"])) for r in parts[0].unionAll(parts[1]).collect())
    discard(cut)
    size = CHUNK * BLOCK * STEP + STEP
    data = np.frombuffer(b"".join(c for *_, c in got), dtype=np.int16).reshape(-1, size)
    y = np.array([r[2] for r in got], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        half = STEP * EMBED
        zero = np.zeros(FILTERS, dtype=np.float32)
        return Network(np.zeros((257, EMBED), np.float32), np.zeros((2 * half, FILTERS), np.float32), zero, zero, float(np.log(share / (1 - share))))
    return train(data.astype(np.int64), y, totals[1] / (totals[0] + totals[1]))


def classify(docs: DataFrame, network: Network, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, score, predicted)`` of every whole text; the text alone decides.

    A null text counts as empty and gets the score of an empty one. Repeated rows give repeated rows, an
    empty table an empty one; a text of any length is scored whole, block by block.
    """

    def run(texts: list) -> dict[str, list]:
        s = network.score(texts)
        return {"score": s.tolist(), "predicted": (s >= threshold).astype(int).tolist()}

    return map_texts(docs, run, "score double, predicted int", text_col, (id_col, *keep))
