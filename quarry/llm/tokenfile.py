"""Token-ID files: one wavelet matrix per shard.

A file holds a few documents' ids (in ascending document order) as succinct
bit-planes. Plane l has the l-th highest bit of every id, the ids being stably
parted by each plane before the next; every 512 bits a running count of ones
gives rank, and by binary search select. One file so answers the id at a
place, how often an id occurs in a range, and where, without unpacking.

Layout, little endian: ``WVM1``, then u32 planes, u64 tokens, u64 documents;
i64 document ids, u8 "has an id", u64 end places; per plane u64 zeros, the
bits (64-byte blocks), the u32 ones before each block.

Files are written as rows of a Parquet table ``(part, shard, n_docs, n_tokens,
file)`` in the shared folder: parts are ranges of the document order, shards
count up inside a part, and a shard holds about ``shard_tokens`` ids (one
document at least). Reading prunes to the small columns where they suffice.

Defined results: a null text is empty; every document gets the end id, so none
is without ids; null ids come first; repeated rows are kept, ordered by text;
an empty table gives no file and no row.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import WordTokenizer, text_bytes, text_slices

MAGIC = b"WVM1"
BLOCK = 512           # bits between two running counts
FILES = "part int, shard int, n_docs long, n_tokens long, file binary"


# ------------------------------------------------------------- one shard file
def build(ids: np.ndarray, doc_ids: np.ndarray, has_id: np.ndarray, ends: np.ndarray,
          planes: int) -> bytes:
    """The file of ``ids`` (any unsigned integers below 2**planes)."""
    n = len(ids)
    out = [MAGIC, struct.pack("<IQQ", planes, n, len(ends)), doc_ids.astype("<i8").tobytes(),
           has_id.astype(np.uint8).tobytes(), ends.astype("<u8").tobytes()]
    blocks = -(-n // BLOCK)
    bits = np.zeros(blocks * BLOCK, np.uint8)
    x = ids
    for level in range(planes - 1, -1, -1):
        one = (x & x.dtype.type(1 << level)) != 0
        bits[:n] = one
        packed = np.packbits(bits, bitorder="little")
        ones = np.bitwise_count(packed.view("<u8")).reshape(blocks, -1).sum(axis=1, dtype=np.uint32)
        before = np.cumsum(ones, dtype=np.uint32) - ones
        zero = np.compress(~one, x)                # index lists beat masks here by far
        x = np.concatenate([zero, np.compress(one, x)])
        out += [struct.pack("<Q", len(zero)), packed.tobytes(), before.astype("<u4").tobytes()]
    return b"".join(out)


class WaveletMatrix:
    """Queries on one file."""

    def __init__(self, file: bytes):
        if file[:4] != MAGIC:
            raise ValueError("not a token file")
        self.planes, self.n, n_docs = struct.unpack_from("<IQQ", file, 4)
        at = 24
        def take(kind, count):
            nonlocal at
            got = np.frombuffer(file, kind, count, at)
            at += got.nbytes
            return got
        self.doc_ids, self.has_id, self.ends = take("<i8", n_docs), take(np.uint8, n_docs), take("<u8", n_docs)
        blocks = -(-self.n // BLOCK)
        self.zeros, self.bits, self.before = [], [], []
        for _ in range(self.planes):
            self.zeros.append(int(take("<u8", 1)[0]))
            self.bits.append(take(np.uint8, blocks * BLOCK // 8))
            self.before.append(take("<u4", blocks))

    def _plane(self, level: int) -> np.ndarray:
        return np.unpackbits(self.bits[level], count=self.n, bitorder="little").view(bool)

    def _rank1(self, level: int, at: int) -> int:
        """Ones before place ``at``."""
        if at >= self.n:
            return self.n - self.zeros[level]
        block, rest = divmod(at, BLOCK)
        part = self.bits[level][block * 64:block * 64 + (rest + 7) // 8]
        ones = np.unpackbits(part, count=rest, bitorder="little").sum() if rest else 0
        return int(self.before[level][block]) + int(ones)

    def _select(self, level: int, bit: int, rank: np.ndarray) -> np.ndarray:
        """Places of the ``rank``-th (from 0) bits of that kind."""
        before = self.before[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, rank, side="right") - 1
        rows = self.bits[level].reshape(-1, 64)[block]
        ones = np.unpackbits(rows, axis=1, bitorder="little")
        count = np.cumsum(ones if bit else 1 - ones, axis=1, dtype=np.int32)
        return block * BLOCK + (count <= (rank - before[block])[:, None]).sum(axis=1)

    def access(self, at: int) -> int:
        """The id at a place."""
        got = 0
        for level in range(self.planes):
            bit = int(self.bits[level][at >> 3] >> (at & 7)) & 1
            ones = self._rank1(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            got = got << 1 | bit
        return got

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.planes:
            return 0, 0
        for level in range(self.planes):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            if (token >> (self.planes - 1 - level)) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in places ``lo`` to ``hi``."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def places(self, token: int) -> np.ndarray:
        """All places of an id, ascending."""
        lo, hi = self._range(token, 0, self.n)
        at = np.arange(lo, hi)
        for level in range(self.planes - 1, -1, -1):
            if not len(at):
                break
            bit = (token >> (self.planes - 1 - level)) & 1
            out = [self._select(level, bit, (at - (self.zeros[level] if bit else 0))[i:i + 4096])
                   for i in range(0, len(at), 4096)]
            at = np.concatenate(out)
        return np.sort(at)

    def tokens(self) -> np.ndarray:
        """All ids in order, plane by plane from the last."""
        x = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for level in range(self.planes - 1, -1, -1):
            one = self._plane(level)
            up = np.empty_like(x)
            up[np.flatnonzero(~one)] = x[:self.zeros[level]]
            up[np.flatnonzero(one)] = x[self.zeros[level]:] | x.dtype.type(1 << (self.planes - 1 - level))
            x = up
        return x


# --------------------------------------------------------------- tables of files
def write_files(docs: DataFrame, path: str, end_id: int, tokenizer: str | None = None,
                shard_tokens: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` in ascending id order into the file table at ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        tok = WordTokenizer.shared(tokenizer)
        planes = (max(tok.full.get_vocab_size() - 1, end_id)).bit_length()
        part, shard = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        held = 0

        def flush():
            ends = np.cumsum([len(x) for x in ids])
            has = np.array([x is not None for x in names])
            file = build(np.concatenate(ids), np.array([x or 0 for x in names], np.int64), has, ends, planes)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)]),
                 pa.array([int(ends[-1])]), pa.array([file], pa.binary())],
                ["part", "shard", "n_docs", "n_tokens", "file"])

        for b in batches:
            for i, texts in text_slices(b.column(1)):
                for name, got in zip(b.column(0).slice(i, len(texts)).to_pylist(), tok.encode(texts)):
                    x = np.append(got, tok.dtype.type(end_id))
                    if ids and held + len(x) > shard_tokens:
                        yield flush()
                        shard, ids, names, held = shard + 1, [], [], 0
                    ids.append(x)
                    names.append(name)
                    held += len(x)
        if ids:
            yield flush()

    (docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("_t"))
     .repartitionByRange("_id", F.xxhash64("_t")).sortWithinPartitions("_id", "_t")
     .mapInArrow(run, FILES).write.option("compression", "none").parquet(path))


def open_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(path)


def offsets(files: DataFrame) -> DataFrame:
    """``(part, shard, first)``: ids in all files before each file. Parts, whose
    number is that of the write's tasks, are summed first."""
    small = files.select("part", "shard", "n_tokens")
    run = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (small.groupBy("part").agg(F.sum("n_tokens").alias("t"))
             .select("part", F.coalesce(F.sum("t").over(run), F.lit(0)).alias("_p")))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (small.withColumn("_s", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(parts, "part").select("part", "shard", (F.col("_p") + F.col("_s")).alias("first")))


def documents(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of every document, decoded from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32
        for b in batches:
            for part, shard, file in zip(*(c.to_pylist() for c in b.columns)):
                w = WaveletMatrix(file)
                ids = w.tokens().astype("<u4")
                ends = w.ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                crc = [crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, shard, np.int32)),
                     pa.array(w.doc_ids.astype(np.int64), mask=w.has_id == 0), pa.array(starts),
                     pa.array(ends - starts), pa.array(crc, pa.int64())],
                    ["part", "shard", id_col, "_local", "n_tokens", "ids_crc32"])

    found = files.select("part", "shard", "file").mapInArrow(
        run, f"part int, shard int, `{id_col}` long, _local long, n_tokens long, ids_crc32 long")
    return (found.join(offsets(files), ["part", "shard"])
            .select(id_col, (F.col("first") + F.col("_local")).alias("start"), "n_tokens", "ids_crc32"))


def occurrences(files: DataFrame, token: int, id_col: str = "doc_id") -> DataFrame:
    """``(id, place)`` of every occurrence of a token id inside its document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                w = WaveletMatrix(file)
                at = w.places(token)
                doc = np.searchsorted(w.ends.astype(np.int64), at, side="right")
                start = np.concatenate([[0], w.ends.astype(np.int64)])[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.doc_ids[doc].astype(np.int64), mask=w.has_id[doc] == 0),
                     pa.array(at - start)], [id_col, "place"])

    return files.select("file").mapInArrow(run, f"`{id_col}` long, place long")


def encode_and_read(docs: DataFrame, end_id: int, tokenizer: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_files(docs, path, end_id, tokenizer, id_col=id_col, text_col=text_col)
    return documents(open_files(spark, path), id_col)
