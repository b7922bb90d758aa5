"""Language-model scoring with a weighted backoff automaton.

The model is an interpolated n-gram model over words, with all counts taken from
all training rows. An n-gram seen at least ``min_count`` times is a state's
arc: from the state of its first words on its last word, with probability
(c - d) / c(context) plus what the failure arc gives. Every state has a failure
arc to the state of its words but the first, weighted with the mass the
discounts (and the unlisted n-grams) leave over; the last state is the unigram
model (c + 0.5) / (N + 0.5 (V + 1)). So the probabilities after any state sum
to one. The state after a token is the longest listed n-gram ending there; a
traversal from left to right carries it and adds up the logarithms. As the
state depends on the last words only, a task follows all texts of a block at
once, one numpy step for each arc level.

Neither texts nor the model fit one machine, so they meet in blocks:

1. Texts become blocks of about ``block_tokens`` word numbers with the block's
   sorted word hashes, written as a table bucketed by block, so that no later
   step shuffles it.
2. Each block sends its distinct n-grams (sorted 64-bit hashes with the
   training counts) to hash ranges. A range adds the counts up and answers
   each block: all word totals, and the totals of listed n-grams. A frequent
   n-gram is one entry per block, however often it occurs.
3. The first block to have a listed n-gram adds it to its context's sums; the
   ranges add these up and answer with every context's left-over mass.
4. Each block is scored with the two answers.

Defined results: a null or empty text is the end token alone; null ids are
never trained on; repeated rows count and are scored as often as they occur;
without training rows every token has probability one; words compare by their
64-bit hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialise, release, text_bytes, text_slices, word_hashes
from .packed import cuts, pack, totals, unpack

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
END = np.uint64(0)     # stands for the end token beside the words' hashes
BLOCK = ("block long, n_tokens long, doc_ids binary, has_id binary, train binary, "
         "ends binary, vocab binary, words binary")
ASK = "p int, block long, u_keys binary, u_counts binary, g_keys binary, g_counts binary"
ANSWER = "block long, p int, kind int, a binary, b binary, c binary, n_words long"
SUMS = "p int, block long, keys binary, kept binary, types binary"


@dataclass(frozen=True)
class Params:
    order: int = 2
    min_count: int = 1       # n-grams of order 2 and up below this are not listed
    discount: float = 0.75
    block_tokens: int = 600_000
    range_tokens: int = 2_000_000   # training and scoring tokens per hash range


# --------------------------------------------------------------------- blocks
def encode(docs: DataFrame, trainable: Column, p: Params, id_col: str, text_col: str) -> DataFrame:
    """One row per block of texts."""
    limit = p.block_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, seq = TaskContext.get().partitionId(), 0
        parts, sizes, ids, train, held = [], [], [], [], 0

        def flush():
            vocab, words = np.unique(np.concatenate(parts), return_inverse=True)
            ends = np.cumsum(sizes)
            has = np.array([i is not None for i in ids], np.uint8)
            return pa.RecordBatch.from_pydict({
                "block": [(task << 32) + seq], "n_tokens": [int(ends[-1])],
                "doc_ids": [np.array([i or 0 for i in ids], "<i8").tobytes()],
                "has_id": [has.tobytes()], "train": [np.array(train, np.uint8).tobytes()],
                "ends": [ends.astype("<i8").tobytes()], "vocab": [vocab.astype("<u8").tobytes()],
                "words": [words.astype("<u4").tobytes()]},
                schema=pa.schema([("block", pa.int64()), ("n_tokens", pa.int64()),
                                  *((c, pa.binary()) for c in ("doc_ids", "has_id", "train",
                                                               "ends", "vocab", "words"))]))

        for b in batches:
            for i, texts in text_slices(b.column(1)):
                h, n = word_hashes(texts)
                parts.append(np.insert(h, np.cumsum(n), END))
                sizes += (n + 1).tolist()
                ids += b.column(0).slice(i, len(texts)).to_pylist()
                train += b.column(2).slice(i, len(texts)).to_pylist()
                held += len(parts[-1])
                if held >= limit:
                    yield flush()
                    parts, sizes, ids, train, held, seq = [], [], [], [], 0, seq + 1
        if held:
            yield flush()

    use = F.col(id_col).isNotNull() & F.coalesce(trainable, F.lit(False))
    return docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("_t"),
                       use.cast("byte").alias("_u")).mapInArrow(run, BLOCK)


class Block:
    """A block's word hashes and its n-grams: ``keys`` of those of order 2, 3, ...
    (one order after another) and the places ``where`` they end."""

    def __init__(self, row, order: int):
        self.vocab = np.frombuffer(row.vocab, "<u8")
        self.words = np.frombuffer(row.words, "<u4")
        self.ends = np.frombuffer(row.ends, "<i8")
        self.starts = np.concatenate([[0], self.ends[:-1]])
        sizes = self.ends - self.starts
        self.train = np.repeat(np.frombuffer(row.train, np.uint8), sizes).astype(bool)
        word = self.vocab[self.words]
        inside = np.arange(len(word)) - np.repeat(self.starts, sizes)
        self.where, keys, full = [], [np.zeros(0, np.uint64)], word
        for k in range(2, order + 1):
            longer = np.zeros_like(word)
            longer[1:] = (full[:-1] * _MIX[0] + np.uint64(k)) ^ (word[1:] * _MIX[1])
            longer *= _MIX[0]
            longer ^= longer >> np.uint64(29)
            full = longer
            self.where.append(np.flatnonzero(inside >= k - 1))
            keys.append(full[self.where[-1]])
        self.keys = np.concatenate(keys)
        self.cut = np.cumsum([0, *map(len, self.where)])

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.words, self.train, minlength=len(self.vocab)).astype(np.uint64)

    def gram_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys and their training counts."""
        uniq = np.unique(self.keys)
        seen = np.sort(self.keys[np.concatenate([np.zeros(0, bool), *(self.train[w] for w in self.where)])])
        count = np.searchsorted(seen, uniq, side="right") - np.searchsorted(seen, uniq)
        return uniq, count.astype(np.uint64)


def _ask(blocks: DataFrame, p: Params, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pandas().itertuples():
                release()
                block = Block(row, p.order)
                u, uc = block.vocab, block.word_counts()
                g, gc = block.gram_counts()
                cu, cg = cuts(u, n), cuts(g, n)
                some = [i for i in range(n) if cu[i] < cu[i + 1] or cg[i] < cg[i + 1]]
                yield pa.RecordBatch.from_pydict(
                    {"p": pa.array(some, pa.int32()), "block": pa.array([row.block] * len(some), pa.int64()),
                     "u_keys": [pack(u[cu[i]:cu[i + 1]], True) for i in some],
                     "u_counts": [pack(uc[cu[i]:cu[i + 1]]) for i in some],
                     "g_keys": [pack(g[cg[i]:cg[i + 1]], True) for i in some],
                     "g_counts": [pack(gc[cg[i]:cg[i + 1]]) for i in some]})

    return (blocks.select("block", "train", "ends", "vocab", "words").mapInArrow(run, ASK))


def _answer(ask: DataFrame, p: Params) -> DataFrame:
    """Each block's answer from each range: kind 0, (word totals; places of the
    listed n-grams; their totals, doubled, plus one in the first block)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        u = [unpack(x, True) for x in pdf["u_keys"]]
        total, _, words = totals(u, [unpack(x) for x in pdf["u_counts"]])
        g = [unpack(x, True) for x in pdf["g_keys"]]
        listed, own, _ = totals(g, [unpack(x) for x in pdf["g_counts"]])
        cu, cg = (np.cumsum([0, *map(len, x)]) for x in (u, g))
        a, b, c = [], [], []
        for i in range(len(pdf)):
            a.append(pack(total[cu[i]:cu[i + 1]]))
            mine = listed[cg[i]:cg[i + 1]]
            at = np.flatnonzero(mine >= p.min_count)
            b.append(pack(at, True))
            c.append(pack(mine[at] * np.uint64(2) + own[cg[i]:cg[i + 1]][at].astype(np.uint64)))
        return pd.DataFrame({"block": pdf["block"].to_numpy(), "p": pdf["p"].to_numpy(), "kind": 0,
                             "a": a, "b": b, "c": c,
                             "n_words": [words] + [0] * (len(pdf) - 1)})

    return ask.groupBy("p").applyInPandas(run, ANSWER)


class _Model:
    """What a block was answered: totals of its words and its listed n-grams.

    States are numbered: a word's number, or the number of words plus that of
    a listed n-gram. ``gram[i]`` is the listed n-gram (or -1) of ``block.keys[i]``.
    """

    def __init__(self, block: Block, answers: pd.DataFrame, n: int, p: Params, first: bool = False):
        got = answers[answers["kind"] == 0].sort_values("p")
        none = np.zeros(0, np.uint64)
        self.word_total = np.concatenate([none, *(unpack(x) for x in got["a"])])
        uniq, *more = np.unique(block.keys, return_inverse=True, **({"return_index": True} if first else {}))
        cut = cuts(uniq, n)
        at = np.concatenate([none, *(unpack(x, True) + np.uint64(cut[r]) for r, x in zip(got["p"], got["b"]))])
        total = np.concatenate([none, *(unpack(x) for x in got["c"])])
        self.listed = uniq[at.astype(np.int64)]
        self.own, self.total = (total & np.uint64(1)).astype(bool), total >> np.uint64(1)
        self.first = more[0][at.astype(np.int64)] if first else None
        slot = np.full(len(uniq), -1, np.int32)
        slot[at.astype(np.int64)] = np.arange(len(at))
        self.gram = slot[more[-1]]
        # States that n-grams extend, in the order of their keys.
        v = len(block.vocab)
        words = np.flatnonzero(self.word_total >= p.min_count)
        shorter = np.unique(self.gram[:block.cut[p.order - 2]]) if p.order > 2 else np.zeros(0, np.int64)
        shorter = shorter[shorter >= 0]
        keys = np.concatenate([block.vocab[words], self.listed[shorter]])
        order = np.argsort(keys, kind="stable")
        self.states, self.state_keys = np.concatenate([words, v + shorter])[order], keys[order]
        self.count = np.concatenate([self.word_total, self.total]).astype(np.float64)

    def context(self, block: Block, k: int) -> np.ndarray:
        """The state before each n-gram of order k; -1 where it is not listed."""
        before = block.where[k - 2] - 1
        if k == 2:
            return block.words[before].astype(np.int64)
        held = np.full(len(block.words), -1, np.int64)
        held[block.where[k - 3]] = self.gram[block.cut[k - 3]:block.cut[k - 2]]
        held = held[before]
        return np.where(held < 0, -1, held + len(block.vocab))


def _context_sums(p: Params, n: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        release()
        if not len(left):
            return pd.DataFrame({c: [] for c in ("p", "block", "keys", "kept", "types")})
        row = next(left.itertuples())
        block = Block(row, p.order)
        model = _Model(block, right, n, p, first=True)
        kept, types = np.zeros(len(model.count)), np.zeros(len(model.count))
        for k in range(2, p.order + 1):
            mine = model.own & (model.first >= block.cut[k - 2]) & (model.first < block.cut[k - 1])
            ctx = model.context(block, k)[model.first[mine] - block.cut[k - 2]]
            kept += np.bincount(ctx, model.total[mine].astype(np.float64), minlength=len(kept))
            types += np.bincount(ctx, minlength=len(types))
        keys, kept, types = model.state_keys, kept[model.states], types[model.states]
        cut = cuts(keys, n)
        some = [i for i in range(n) if cut[i] < cut[i + 1]]
        return pd.DataFrame({"p": some, "block": row.block,
                             "keys": [pack(keys[cut[i]:cut[i + 1]], True) for i in some],
                             "kept": [pack(kept[cut[i]:cut[i + 1]]) for i in some],
                             "types": [pack(types[cut[i]:cut[i + 1]]) for i in some]})
    return run


def _answer_sums(sums: DataFrame) -> DataFrame:
    """Kind 1: kept counts and types of every context a block asked for."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        keys = [unpack(x, True) for x in pdf["keys"]]
        kept, _, _ = totals(keys, [unpack(x) for x in pdf["kept"]])
        types, _, _ = totals(keys, [unpack(x) for x in pdf["types"]])
        cut = np.cumsum([0, *map(len, keys)])
        part = lambda x, i: pack(x[cut[i]:cut[i + 1]])
        return pd.DataFrame({"block": pdf["block"].to_numpy(), "p": pdf["p"].to_numpy(), "kind": 1,
                             "a": [part(kept, i) for i in range(len(pdf))],
                             "b": [part(types, i) for i in range(len(pdf))], "c": b"", "n_words": 0})

    return sums.groupBy("p").applyInPandas(run, ANSWER)


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(p: Params, n: int, train_tokens: int, words: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        release()
        if not len(left):
            return pd.DataFrame({c.split()[0]: [] for c in SCORES.split(", ")})
        row = next(left.itertuples())
        block = Block(row, p.order)
        model = _Model(block, right, n, p)
        sums = right[right["kind"] == 1].sort_values("p")
        total = lambda c: np.concatenate([np.zeros(0), *(unpack(x) for x in sums[c])])
        failure = np.full(len(model.count) + 1, np.nan)         # the last place: no state
        failure[model.states] = 1 - (total("a") - p.discount * total("b")) / model.count[model.states]
        prob = ((model.word_total + 0.5) / (train_tokens + 0.5 * (words + 1)))[block.words]
        base = np.log10(prob)
        arc = np.concatenate([model.total - p.discount, [0.0]])  # the last place: not listed
        for k in range(2, p.order + 1):
            state = model.context(block, k)
            known = ~np.isnan(failure[state])
            state, place = state[known], block.where[k - 2][known]
            gram = model.gram[block.cut[k - 2]:block.cut[k - 1]][known]
            prob[place] = arc[gram] / model.count[state] + failure[state] * prob[place]
        has = np.frombuffer(row.has_id, np.uint8).astype(bool)
        ids = np.frombuffer(row.doc_ids, "<i8")
        return pd.DataFrame({
            "doc_id": pd.array(ids, dtype="Int64").copy() if has.all()
            else pd.array([i if ok else None for i, ok in zip(ids.tolist(), has)], dtype="Int64"),
            "n_tokens": block.ends - block.starts,
            "n_known": np.add.reduceat((model.word_total > 0)[block.words].astype(np.int64), block.starts),
            "base_score": np.add.reduceat(base, block.starts),
            "score": np.add.reduceat(np.log10(prob), block.starts)})
    return run


def score(docs: DataFrame, trainable: Column, params: Params = Params(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` of every row,
    by a model of the rows that meet ``trainable``. Scores are log10."""
    p, spark = params, docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"lm_blocks_{uuid.uuid4().hex}"
    (encode(docs, trainable, p, id_col, text_col).write.bucketBy(buckets, "block")
     .option("path", scratch_path(spark, "lm-blocks")).option("compression", "zstd").saveAsTable(name))
    blocks = spark.table(name)
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    n = max(1, -(-tokens // p.range_tokens))
    answers = materialise(_answer(_ask(blocks, p, n), p), "lm-counts")
    words = answers.agg(F.sum("n_words")).first()[0] or 0
    by_block = blocks.groupBy("block")
    sums = by_block.cogroup(answers.groupBy("block")).applyInPandas(_context_sums(p, n), SUMS)
    more = materialise(_answer_sums(sums), "lm-contexts")
    train_tokens = _train_tokens(blocks)
    found = materialise(by_block.cogroup(answers.unionByName(more).groupBy("block"))
                        .applyInPandas(_score(p, n, train_tokens, words), SCORES), "lm-scores")
    spark.sql(f"DROP TABLE {name}")             # its files stay in the shared folder
    return found.select(F.col("doc_id").alias(id_col), "n_tokens", "n_known",
                        F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _train_tokens(blocks: DataFrame) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = 0
            for train, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sizes = np.diff(np.frombuffer(ends, "<i8"), prepend=0)
                n += int(sizes[np.frombuffer(train, np.uint8) > 0].sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return blocks.select("train", "ends").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
