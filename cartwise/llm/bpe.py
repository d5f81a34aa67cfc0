"""Byte-level BPE by a hierarchical-bitmap rank queue (operator 4).

The pieces of a text are the matches of the public split pattern. A piece's bytes form a linked list.
Each pair of neighbours that has a merge rank is queued in that rank's bucket, and a two-level bitmap
marks the buckets that hold something: find-first-set on the upper word, then on the lower one, gives
the lowest rank in constant time, however long the piece. A bucket's positions are taken from left to
right; a position whose pair has changed since is stale and skipped. So a piece of n bytes takes
O(n log n), where scanning for the lowest rank takes O(n^2). Many short pieces share one queue.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
from pyspark.sql import DataFrame

from cartwise.llm.common import holds_caches, map_texts
from cartwise.llm.tokens import TextEncoder

LOWER = 256  # ranks per lower bitmap word


class RankQueue:
    """Positions by merge rank; ``lowest`` finds the lowest rank that holds any."""

    def __init__(self, n_ranks: int):
        self.low = [0] * (n_ranks // LOWER + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def fill(self, rank: int, positions: list[int]) -> None:
        """A rank that held nothing gets these positions."""
        self.buckets[rank] = positions
        word = rank // LOWER
        self.low[word] |= 1 << (rank % LOWER)
        self.top |= 1 << word

    def lowest(self) -> int:
        """Find-first-set on the upper word, then on the lower one; -1 when empty."""
        top = self.top
        if not top:
            return -1
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        return word * LOWER + (bits & -bits).bit_length() - 1

    def empty(self, rank: int) -> None:
        """The rank's bucket is used up."""
        del self.buckets[rank]
        word = rank // LOWER
        self.low[word] &= ~(1 << (rank % LOWER))
        if not self.low[word]:
            self.top &= ~(1 << word)


class BytePairs:
    """Encoder and decoder of a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.two = np.full(65536, -1, dtype=np.int64)  # ranks of all byte pairs
        for b, i in ranks.items():
            if len(b) == 2:
                self.two[b[0] * 256 + b[1]] = i
        self.n_ranks = max(ranks.values(), default=0) + 1
        self.text = TextEncoder(regex.compile(pattern).findall, self._pieces)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> BytePairs:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece: its lowest-ranked pair merges first, the leftmost on ties.

        The pieces share one list and one queue (no pair crosses from one piece to the next, so
        they cannot disturb each other): a rank is found once for all of its positions.
        """
        ranks, data = self.ranks, b"".join(pieces)
        get, n = ranks.get, len(data)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(sizes)
        starts = bytearray(n + 1)  # 1 where a piece begins, and behind the last
        for s in (ends - sizes).tolist():
            starts[s] = 1
        starts[n] = 1
        b = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
        first = np.full(n, -1, dtype=np.int64)
        if n > 1:
            first[:-1] = self.two[b[:-1] * 256 + b[1:]]
        first[ends[sizes > 0] - 1] = -1
        queue = RankQueue(self.n_ranks)
        at = np.flatnonzero(first >= 0)
        at = at[np.argsort(first[at], kind="stable")]
        if len(at):
            for group in np.split(at, np.flatnonzero(np.diff(first[at])) + 1):
                queue.fill(int(first[group[0]]), group.tolist())
        pair = first.tolist()  # the rank that the part at a position and its successor have now
        end = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n - 1))  # where the part before it starts
        buckets, fill = queue.buckets, queue.fill
        while (rank := queue.lowest()) >= 0:
            bucket, lower = buckets[rank], False
            bucket.sort()  # from left to right; nothing is added while it is used, since what a merge makes is longer
            for taken, i in enumerate(bucket, 1):
                if pair[i] != rank:  # stale
                    continue
                j = end[i]
                stop = end[j]
                end[i], pair[j] = stop, -1
                if starts[stop]:
                    pair[i] = -1
                else:
                    before[stop] = i
                    r = pair[i] = get(data[i : end[stop]], -1)
                    if r >= 0:
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            fill(r, [i])
                        lower = r < rank
                if not starts[i]:
                    h = before[i]
                    r = get(data[h:stop], -1)
                    if r != pair[h]:
                        pair[h] = r
                        if r >= 0:
                            if r in buckets:
                                buckets[r].append(h)
                            else:
                                fill(r, [h])
                            lower = lower or r < rank
                if lower:
                    break
            if lower and taken < len(bucket):
                del bucket[:taken]
            else:
                queue.empty(rank)
        out, i = [], 0
        for stop in ends.tolist():
            ids = []
            while i < stop:
                ids.append(ranks[data[i : end[i]]])
                i = end[i]
            out.append(ids)
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        ids: list = [self.ranks.get(p) for p in raw]  # a piece that is a token stays whole
        rest = [k for k, i in enumerate(ids) if i is None]
        for k, made in zip(rest, self.merge([raw[k] for k in rest])):
            ids[k] = made
        return [i.to_bytes(4, "little") if isinstance(i, int) else array("I", i).tobytes() for i in ids]

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.text(text)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(packed).cast("I")))


_LOADED: dict[tuple[str, str], BytePairs] = {}


def _clear() -> None:
    for b in _LOADED.values():
        b.text.clear()


holds_caches("bpe", _clear)


def load(path: str, pattern: str) -> BytePairs:
    """One encoder per worker process and file."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = BytePairs.from_file(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """``(id, n_tokens, ids, ids_sha256, decoded_sha256)`` of every whole text, one row per input row.

    ``ids`` (binary, little-endian unsigned 32-bit) is left out with ``keep_ids=False``. The ids are
    decoded again for ``decoded_sha256``. A null or empty text has no ids and the digests of no bytes;
    a null id stays null; repeated rows give repeated rows; an empty table gives an empty one; other
    columns are not read. Rows never meet, so there is no shuffle, and a lost task is simply run again.
    """

    def run(texts: list) -> dict[str, list]:
        bpe = load(path, pattern)
        ids = bpe.text.many(texts)
        return {
            "n_tokens": [len(x) // 4 for x in ids],
            "ids": ids,
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
        }

    added = "n_tokens bigint, " + ("ids binary, " if keep_ids else "") + "ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, run, added, text_col, (id_col,), caches="bpe")
