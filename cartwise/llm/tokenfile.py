"""Token-id files: independent zstandard frames with a trailing seek table (operator 7).

A file holds the ids of consecutive documents as little-endian integers of a fixed width:

- zstandard frames of at most ``FRAME`` ids each, every one independent, cut at a document's end where
  one is near (a long document takes several frames);
- a skippable frame (magic 0x184D2A50) with the zstandard-compressed document table: the ids as
  64-bit integers, the validity of each id, the token counts, and the width;
- the seek table, a skippable frame in the public seekable format: compressed size, decompressed size
  and checksum (low 32 bits of XXH64 of the content) of each frame, then the number of frames, the
  descriptor byte and the magic 0x8F92EAB1.

Any zstandard decoder yields all ids. A reader that wants some documents takes the two tables from
the end of the file and decompresses only the frames that hold them, checking each frame's checksum.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import keep_only, text_slices
from cartwise.llm.tokens import library_encoder
from cartwise.session import cut_lineage, intermediate_path

FRAME = 65_536
# fixed values of the public formats
SKIP_TABLE, SKIP_SEEK, SEEK_MAGIC, CHECKED = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80


def _filesystem(uri: str):
    """(file system, path) of a shared folder's URI; a bare path is a mounted one."""
    from pyarrow import fs

    if "://" not in uri:
        uri = uri.removeprefix("file:")
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class Writer:
    """Writes documents in order; ``close`` adds the tables."""

    def __init__(self, uri: str, width: int, level: int = 3):
        import zstandard

        f, path = _filesystem(uri)
        self.out = f.open_output_stream(path, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.width, self.dtype = width, np.dtype(f"<u{width}")
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(tokens))
        if self.n_held and self.n_held + len(tokens) > FRAME:
            self._frame()
        for lo in range(0, len(tokens), FRAME):
            part = tokens[lo : lo + FRAME]
            self.held.append(part.astype(self.dtype))
            self.n_held += len(part)
            if self.n_held >= FRAME:
                self._frame()

    def _frame(self) -> None:
        import xxhash

        raw = b"".join(x.tobytes() for x in self.held)
        if raw:
            packed = self.zstd.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.n_held = [], 0

    def close(self) -> None:
        self._frame()
        known = np.array([i is not None for i in self.ids], dtype=np.uint8)
        ids = np.array([0 if i is None else i for i in self.ids], dtype="<i8")
        table = struct.pack("<BQ", self.width, len(ids)) + ids.tobytes() + known.tobytes() + np.array(self.counts, dtype="<i8").tobytes()
        packed = self.zstd.compress(table + struct.pack("<I", zlib.crc32(table)))
        self.out.write(struct.pack("<II", SKIP_TABLE, len(packed)) + packed)
        seek = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKED, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIP_SEEK, len(seek)) + seek)
        self.out.close()


class Reader:
    """Random access to a file's documents."""

    def __init__(self, uri: str):
        f, path = _filesystem(uri)
        self.file = f.open_input_file(path)
        size = self.file.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flag != CHECKED:
            raise ValueError(f"{uri}: no seek table")
        rows = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.checks = rows[:, 2]
        self.offset = np.r_[0, np.cumsum(rows[:, 0])]  # of frames in the file
        self.content = np.r_[0, np.cumsum(rows[:, 1])]  # of frames in the ids
        end = int(self.offset[-1])
        magic, length = struct.unpack("<II", self._at(end, 8))
        if magic != SKIP_TABLE:
            raise ValueError(f"{uri}: no document table")
        table = self._unpack(self._at(end + 8, length))
        table, check = table[:-4], struct.unpack("<I", table[-4:])[0]
        if zlib.crc32(table) != check:
            raise ValueError(f"{uri}: damaged document table")
        self.width, n_docs = struct.unpack("<BQ", table[:9])
        self.doc_ids = np.frombuffer(table, "<i8", n_docs, 9)
        self.known = np.frombuffer(table, "u1", n_docs, 9 + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(table, "<i8", n_docs, 9 + 9 * n_docs)
        self.starts = np.cumsum(self.counts) - self.counts
        self.last = (-1, b"")

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    @staticmethod
    def _unpack(raw: bytes) -> bytes:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(raw)

    def frame(self, k: int) -> bytes:
        import xxhash

        if self.last[0] != k:
            raw = self._unpack(self._at(int(self.offset[k]), int(self.offset[k + 1] - self.offset[k])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[k]:
                raise ValueError(f"frame {k}: checksum differs")
            self.last = k, raw
        return self.last[1]

    def tokens(self, i: int) -> np.ndarray:
        """Ids of the i-th document; only the frames that hold it are decompressed."""
        lo, hi = int(self.starts[i]) * self.width, int(self.starts[i] + self.counts[i]) * self.width
        parts, k = [], int(np.searchsorted(self.content, lo, "right") - 1)
        while lo < hi:
            z = min(hi, int(self.content[k + 1]))
            parts.append(self.frame(k)[lo - int(self.content[k]) : z - int(self.content[k])])
            lo, k = z, k + 1
        return np.frombuffer(b"".join(parts), dtype=f"<u{self.width}").astype("<u4")

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start in the file, ids)`` of all documents, or of those with a wanted id."""
        at = range(len(self.counts)) if wanted is None else np.flatnonzero(np.isin(self.doc_ids, list(wanted)) & self.known)
        for i in at:
            yield (int(self.doc_ids[i]) if self.known[i] else None), int(self.starts[i]), self.tokens(i)


def write(docs: DataFrame, folder: str, path: str, end_id: int, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending id order; the manifest ``(file, part, n_docs, n_tokens)``.

    Texts are exchanged by id ranges (smaller than their ids), then encoded and written where they
    land, one file per partition, in a stream. Only files that the manifest names count: an attempt
    that dies or runs twice leaves a file that nobody reads. A null or empty text is its end id;
    null ids come first; documents with equal ids stand in the order of their texts' hash (and may be
    split over files); an empty table writes no file; other columns are not read. ``width`` is the
    bytes per id: 2 for vocabularies up to 65,536.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    keys = ["doc_id", "tie", "row"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        keep_only("tokens")
        part, out, name = TaskContext.get().partitionId(), None, ""
        encode, end = library_encoder(path), end_id.to_bytes(4, "little")
        for b in batches:
            if out is None and len(b):
                name = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
                out = Writer(name, width)
            for ids_of, texts in text_slices(b):
                for doc_id, ids in zip(ids_of, encode.many(texts)):
                    out.add(doc_id, np.frombuffer(ids + end, dtype="<u4"))
        if out is not None:
            out.close()
            yield from pd_batches(pd.DataFrame({"file": [name], "part": [part], "n_docs": [len(out.counts)], "n_tokens": [int(sum(out.counts))]}))

    return cut_lineage(dealt.mapInArrow(run, "file string, part bigint, n_docs bigint, n_tokens bigint"))


def pd_batches(frame: pd.DataFrame):
    import pyarrow as pa

    return pa.Table.from_pandas(frame, preserve_index=False).to_batches()


def read(manifest: DataFrame, wanted: list[int] | None = None, keep_ids: bool = True) -> DataFrame:
    """Documents of the written files: ``(doc_id, start, n_tokens, ids_crc32[, ids])``, each file in a task of its own.

    ``start`` counts the ids of all documents before it. With ``wanted`` only the frames of those ids
    are decompressed. The manifest (a row per file) is brought to the driver for the starts.
    """
    files = sorted(manifest.collect(), key=lambda r: r["part"])
    spark = manifest.sparkSession
    rows, base = [], 0
    for r in files:
        rows.append((r["file"], base))
        base += r["n_tokens"]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if keep_ids else "")
    table = spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), "file string, base bigint")

    def run(batches):
        import pyarrow as pa

        types = [pa.int64()] * 4 + ([pa.binary()] if keep_ids else [])
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(types)]

        def flush(held):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held, n = [], 0
                for doc_id, at, ids in Reader(file).documents(wanted):
                    raw = ids.tobytes()
                    held.append((doc_id, start + at, len(ids), zlib.crc32(raw), *([raw] if keep_ids else [])))
                    n += len(raw)
                    if len(held) >= 5000 or n > 4_000_000:
                        yield flush(held)
                        held, n = [], 0
                if held:
                    yield flush(held)

    return table.mapInArrow(run, schema)


def new_folder(spark) -> str:
    """A fresh folder for files in the shared checkpoint folder."""
    path = intermediate_path(spark)
    f, p = _filesystem(path)
    f.create_dir(p, recursive=True)
    return path
