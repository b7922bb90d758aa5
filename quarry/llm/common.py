"""Shared pieces of the corpus operators: table access, lineage cuts, byte-level
word splitting and the tokenizer with a bounded word cache.

Workers receive this package's functions by value, so module globals do not
survive between tasks. What should (a loaded tokenizer and its cache) is kept
in ``worker_state()``, a process-wide dictionary of the reused Python worker.
"""

from __future__ import annotations

import ctypes
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# A-Z to a-z, every other byte unchanged.
ASCII_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
# The same, with tab, newline, VT, FF and CR as blanks.
LOWER_BLANK = bytes(32 if 9 <= i <= 13 else i for i in ASCII_LOWER)
# Text handled at once inside a task; bounds the objects and arrays alive.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. Unlike a
    cached table it survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_passes(rows: DataFrame, key: str, size: Column, limit: int) -> Iterator[list]:
    """The rows on the driver, a bounded part of them at a time, for a broadcast: parts by
    hash of ``key`` whose total ``size`` is about ``limit`` bytes. Sizes are added up before
    anything is fetched, and there are more parts until the largest has at most twice the
    limit or a single row."""
    sized = rows.select(F.col(key), size.cast("long").alias("_n"))
    total, count = sized.agg(F.sum("_n"), F.count(F.lit(1))).first()
    n = max(1, -(-(total or 0) // limit))

    def part(n):
        return F.pmod(F.xxhash64(key, F.lit(3)), F.lit(n))

    while n < count:
        if sized.groupBy(part(n)).agg(F.sum("_n").alias("_n")).agg(F.max("_n")).first()[0] <= 2 * limit:
            break
        n = 2 * n
    for i in range(n):
        got = rows.where(part(n) == i).collect()
        if got:
            yield got


def text_bytes(col: str = "text") -> Column:
    """The UTF-8 bytes of a text column; null is the empty text."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def crc_mod5(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def worker_state() -> dict:
    mod = sys.modules.get("quarry_worker_state")
    if mod is None:
        mod = sys.modules["quarry_worker_state"] = types.ModuleType("quarry_worker_state")
        mod.state = {}
    return mod.state


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive (from, to) ranges of about ``limit`` bytes, one text at least."""
    i, n = 0, len(texts)
    while i < n:
        j, size = i, 0
        while j < n and (j == i or size + len(texts[j]) <= limit):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(from, texts) of consecutive slices of a binary column, of about
    ``limit`` bytes; then memory that a batch no longer needs is given back."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(column):
        before = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield i, column.slice(i, j - i).to_pylist()
        i = j
    release()


def release() -> None:
    """Hand freed memory back to the system: idle workers share an executor's."""
    pa.default_memory_pool().release_unused()
    if "libc" not in worker_state():
        try:
            worker_state()["libc"] = ctypes.CDLL("libc.so.6").malloc_trim
        except (OSError, AttributeError):       # another C library
            worker_state()["libc"] = None
    if worker_state()["libc"]:
        worker_state()["libc"](0)


# ------------------------------------------------------------------ word hashes
_BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, up to the n-th."""
    got = worker_state().get("powers")
    if got is None or len(got[0]) <= n:
        one = np.ones(1, np.uint64)
        got = tuple(np.cumprod(np.concatenate([one, np.full(n, x, np.uint64)]), dtype=np.uint64)
                    for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        worker_state()["powers"] = got
    return got


def hash_runs(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each run ``begin .. end``: a polynomial in
    the bytes from one running sum over the buffer, then mixed."""
    power, inverse = _powers(max(len(buf), SLICE_BYTES + 1024))
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(buf * power[:len(buf)], out=run[1:])
    h = (run[end] - run[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(_BASE)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _cut_long(text: bytes) -> list[bytes]:
    """A text in parts of at most a slice, cut at blanks (one word at least)."""
    parts, at = [], 0
    while len(text) - at > SLICE_BYTES:
        cut = text.rfind(b" ", at, at + SLICE_BYTES)
        if cut <= at:
            cut = text.find(b" ", at + SLICE_BYTES)
            if cut < 0:
                break
        parts.append(text[at:cut])
        at = cut
    parts.append(text[at:])
    return parts


def word_hashes(texts: list[bytes], table: bytes = LOWER_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and each text's number of words.
    ``table`` translates the bytes first; words are what blanks leave."""
    parts, owner = [], []
    for i, x in enumerate(texts):
        more = _cut_long(x.translate(table))
        parts += more
        owner += [i] * len(more)
    hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in slices(parts):
        buf = np.frombuffer(b" " + b" ".join(parts[i:j]) + b" ", np.uint8)
        word = buf != 32
        begin = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        end = np.flatnonzero(word[:-1] & ~word[1:]) + 1
        hashes.append(hash_runs(buf, begin, end))
        starts = np.cumsum([1, *(len(x) + 1 for x in parts[i:j])])
        sizes.append(np.diff(np.searchsorted(begin, starts)))
    return (np.concatenate(hashes),
            np.bincount(owner, np.concatenate(sizes), minlength=len(texts)).astype(np.int64))


class WordTokenizer:
    """Encode texts with a ``tokenizers`` file, encoding each distinct word once.

    The tokenizer (``word_bpe_49k.json``) drops white space and never lets a
    token cross it, so a text's ids are its white-space pieces' ids in order.
    numpy cuts a slice of texts into pieces and hashes them (64 bits); ids of
    known hashes come from sorted arrays, which hold at most ``cap`` pieces.
    A full stop or comma after an ASCII letter at a piece's end is a token
    group of its own in this tokenizer and so is cut off as a piece. Unknown
    pieces of plain letters skip the (slow) normaliser, whose result on them is
    known; all others, and whole texts that could hold a special token's
    string, go through the full tokenizer.
    """

    def __init__(self, path: str | None = None, cap: int = 1_000_000):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        self.full = Tokenizer.from_file(path)
        split = pre_tokenizers.WhitespaceSplit()
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = split
        self.letters = Tokenizer(self.full.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = [i for t, i in self.full.get_vocab(False).items() if t.endswith("</w>")]
        self.is_end = np.zeros(self.full.get_vocab_size(), dtype=bool)
        self.is_end[ends] = True
        self.dtype = np.dtype("<u2" if self.full.get_vocab_size() <= 1 << 16 else "<u4")
        self.cap = cap
        self._forget()

    @classmethod
    def shared(cls, path: str | None = None) -> "WordTokenizer":
        state = worker_state()
        key = ("tokenizer", path)
        if key not in state:
            state[key] = cls(path)
        return state[key]

    def _forget(self) -> None:
        # Two tiers of sorted hashes with places in ``ids``; the small one takes new pieces.
        self.tiers = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in range(2)]
        self.ids, self.n_ids = np.zeros(1 << 16, self.dtype), 0

    def _pack(self, encodings) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in encodings]

    def _pack_words(self, tok, words: str, n: int) -> list[bytes]:
        """Ids of each of n plain words: one call for all, cut after each word-end token."""
        ids = np.array(tok.encode_batch_fast([words], add_special_tokens=False)[0].ids, dtype=self.dtype)
        cut = (np.flatnonzero(self.is_end[ids]) + 1) * self.dtype.itemsize
        if len(cut) != n:
            return self._pack(tok.encode_batch_fast(words.split(" "), add_special_tokens=False))
        buf, cut = ids.tobytes(), cut.tolist()
        return [buf[a:b] for a, b in zip([0, *cut], cut)]

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, A-Z already lowered."""
        out: list[bytes] = [b""] * len(pieces)
        plain, accented, texts, rest = [], [], [], []
        for i, w in enumerate(pieces):
            if w.isalpha():                        # bytes: true for ASCII letters alone
                plain.append(i)
                continue
            text = w.decode("utf-8", "replace").lower()
            if text.isalpha() and max(text) <= "ſ" and unicodedata.is_normalized("NFC", text):
                accented.append(i)
                texts.append(text)
            else:
                rest.append(i)
        got = []
        if plain:
            got.append((plain, self._pack_words(self.bare, b" ".join([pieces[i] for i in plain]).decode(), len(plain))))
        if accented:
            got.append((accented, self._pack_words(self.letters, " ".join(texts), len(texts))))
        if rest:
            got.append((rest, self._pack(self.full.encode_batch_fast(
                [pieces[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False))))
        for places, ids in got:
            for i, x in zip(places, ids):
                out[i] = x
        return out

    def _cut(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin and end in a buffer that starts and ends with a blank."""
        blank = buf == 32
        mark = (buf == 46) | (buf == 44)                      # . and ,
        mark[1:-1] &= blank[2:] & _LETTER[buf[:-2]]
        mark[0] = mark[-1] = False
        begin = np.flatnonzero(~blank[1:] & (blank[:-1] | mark[1:])) + 1
        end = np.flatnonzero(~blank[:-1] & (blank[1:] | mark[1:])) + 1
        return begin, end

    def _lookup(self, buf: bytes, begin, end, hashes) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of ids for distinct sorted hashes, given one piece of each."""
        at, size = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int32)
        for known, place, n in self.tiers:
            if len(known):
                i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[i] == hashes
                at[hit], size[hit] = place[i[hit]], n[i[hit]]
        miss = np.flatnonzero(size < 0)
        if not len(miss):
            return at, size
        if sum(len(t[0]) for t in self.tiers) + len(miss) > self.cap and len(miss) < len(hashes):
            self._forget()
            return self._lookup(buf, begin, end, hashes)
        packed = self._encode_pieces([buf[a:b] for a, b in zip(begin[miss].tolist(), end[miss].tolist())])
        n = np.fromiter(map(len, packed), np.int32, len(packed)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(packed), self.dtype)
        if self.n_ids + len(flat) > len(self.ids):
            bigger = np.zeros(2 * (self.n_ids + len(flat)), self.dtype)
            bigger[:self.n_ids] = self.ids[:self.n_ids]
            self.ids = bigger
        self.ids[self.n_ids:self.n_ids + len(flat)] = flat
        place = self.n_ids + np.cumsum(n, dtype=np.int64) - n
        self.n_ids += len(flat)
        at[miss], size[miss] = place, n
        new = (hashes[miss], place, n)
        self.tiers[1] = self._merged(self.tiers[1], new)
        if len(self.tiers[1][0]) > 100_000:
            self.tiers = [self._merged(*self.tiers), (new[0][:0], new[1][:0], new[2][:0])]
        return at, size

    @staticmethod
    def _merged(a, b):
        where = np.searchsorted(a[0], b[0])
        return tuple(np.insert(x, where, y) for x, y in zip(a, b))

    def _pieces(self, parts: list[bytes]):
        """For a slice of texts: each text's first piece, each piece's place and
        number of ids in ``ids``."""
        joined = b" " + b" ".join(parts) + b" "
        buf = np.frombuffer(joined, np.uint8)
        begin, end = self._cut(buf)
        uniq, first, inv = np.unique(hash_runs(buf, begin, end), return_index=True, return_inverse=True)
        at, size = self._lookup(joined, begin[first], end[first], uniq)
        starts = np.cumsum([1, *(len(x) + 1 for x in parts)])
        return np.searchsorted(begin, starts), at[inv], size[inv]

    def _parts(self, texts: list[bytes]):
        """The texts in parts of at most a slice, each with its text's number;
        texts that could hold a special token's string stay out."""
        parts, owner = [], []
        for i, x in enumerate(texts):
            if b"<|" not in x:
                more = _cut_long(x.translate(LOWER_BLANK))
                parts += more
                owner += [i] * len(more)
        for i, j in slices(parts):
            yield owner[i:j], self._pieces(parts[i:j])

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.full.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, self.dtype)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list = [None] * len(texts)
        for owner, (first, at, size) in self._parts(texts):
            ends = np.cumsum(size, dtype=np.int64)
            ids = self.ids[np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
            cut = np.concatenate([[0], ends])[first].tolist()
            for k, i in enumerate(owner):
                got = ids[cut[k]:cut[k + 1]]
                out[i] = got if out[i] is None else np.concatenate([out[i], got])
        return [self._whole(x) if got is None else got for x, got in zip(texts, out)]

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """The number of ids of each text."""
        out = np.zeros(len(texts), np.int64)
        for owner, (first, _, size) in self._parts(texts):
            total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[first]
            np.add.at(out, owner, np.diff(total))
        for i, x in enumerate(texts):
            if b"<|" in x:
                out[i] = len(self._whole(x))
        return out


_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
