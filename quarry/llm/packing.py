"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

* Every text is encoded with an end token; only texts longer than a sequence
  are cut. Full pieces are sequences of their own.
* The other pieces are dealt by hash to cells of about ``cell_items`` pieces, so
  any number of pieces is packed in parallel. A cell is evolved on several
  islands. A member of a population is a whole packing of the cell.
* Crossover injects a sample of the other parent's best-filled bins, removes
  the bins that would hold an item twice and best-fits the displaced items,
  largest first; mutation dissolves some of the worst bins as well. Between
  rounds each island's elite migrates to the next island.
* Bins of the winning member that are not well filled are dissolved, and all
  cells' left-over pieces are packed once more, in fewer cells, as long as that
  takes fewer bins.

Populations are rows of (uids, lengths, bins) of bounded size; Spark shuffles
and writes them between rounds.

Defined results: a null or empty text is one piece holding the end token;
repeated rows and null ids are packed as rows of their own; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTokenizer, materialise, text_bytes, text_slices

MEMBER = "cell long, island int, member int, uids array<long>, lengths array<int>, bins array<int>"


@dataclass(frozen=True)
class Params:
    capacity: int = 2048
    cell_items: int = 4096
    islands: int = 2
    population: int = 4
    rounds: int = 2
    generations: int = 3
    well_filled: float = 0.97
    seed: int = 1


# ------------------------------------------------------------------- pieces
def pieces(docs: DataFrame, capacity: int, end_id: int, tokenizer: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` of every row's pieces."""
    from zlib import crc32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer.shared(tokenizer)
        for b in batches:
            for i, texts in text_slices(b.column(1)):
                row, piece, length, crc = [], [], [], []
                for k, ids in enumerate(tok.encode(texts), i):
                    ids = np.append(ids, end_id).astype("<u4")
                    for p, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at:at + capacity]
                        row.append(k)
                        piece.append(p)
                        length.append(len(part))
                        crc.append(crc32(part))
                piece = np.array(piece, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece),
                     pa.array(piece.astype(np.int64) * capacity), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())],
                    [id_col, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col), text_bytes(text_col).alias("_t"))
            .mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"))


# ---------------------------------------------------------------- one packing
class _Bins:
    """Open bins by room left; the tightest that fits is found in one bit scan."""

    def __init__(self, room: list[int]):
        self.room = room
        self.by_room: dict[int, list[int]] = {}
        self.mask = 0
        for b, r in enumerate(room):
            self._put(b, r)

    def _put(self, b: int, r: int) -> None:
        if r:
            self.by_room.setdefault(r, []).append(b)
            self.mask |= 1 << r

    def place(self, size: int, capacity: int) -> int:
        fits = self.mask >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            at = self.by_room[r]
            b = at.pop()
            if not at:
                self.mask ^= 1 << r
        else:
            b, r = len(self.room), capacity
            self.room.append(capacity)
        self.room[b] = r - size
        self._put(b, r - size)
        return b


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Place the items of ``order`` (bins[...] = -1) into the packing ``bins``."""
    held = bins >= 0
    used, packed = np.unique(bins[held], return_inverse=True)
    out = bins.copy()
    out[held] = packed
    room = capacity - np.bincount(packed, lengths[held], minlength=len(used)).astype(np.int64)
    open_bins = _Bins(room.tolist())
    sizes = lengths[order].tolist()
    out[order] = [open_bins.place(s, capacity) for s in sizes]
    return out


def _fills(lengths: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, lengths)


def fitness(lengths: np.ndarray, bins: np.ndarray) -> tuple[int, float]:
    """Smaller is better: bins used, then minus the sum of squared fills."""
    fill = _fills(lengths, bins)
    return int((fill > 0).sum()), -float((fill.astype(np.float64) ** 2).sum())


def _crossover(lengths, a, b, p: Params, rng) -> np.ndarray:
    """Child of ``a`` with some of the best-filled bins of ``b``."""
    fill_a, fill_b = _fills(lengths, a), _fills(lengths, b)
    good = np.flatnonzero(fill_b >= np.quantile(fill_b, 0.5))
    inject = rng.choice(good, max(1, len(good) // 20), replace=False)
    injected = np.isin(b, inject)
    broken = np.zeros(len(fill_a), bool)
    broken[a[injected]] = True                          # would hold an item twice
    worst = np.flatnonzero(fill_a < p.well_filled * p.capacity)
    broken[rng.permutation(worst)[:max(1, len(worst) // 2)]] = True
    child = np.where(injected, len(fill_a) + b, np.where(broken[a], -1, a))
    free = np.flatnonzero(child < 0)
    return best_fit(lengths, free[np.argsort(-lengths[free], kind="stable")], child, p.capacity)


def _evolve(lengths: np.ndarray, members: list[np.ndarray], p: Params, seed: list[int]) -> list[np.ndarray]:
    """The island's population after some generations, best first."""
    rng = np.random.default_rng(seed)
    none = np.full(len(lengths), -1, np.int64)
    while len(members) < p.population:
        noise = rng.uniform(1 - 0.05 * len(members), 1, len(lengths))  # member 0: best-fit decreasing
        members.append(best_fit(lengths, np.argsort(-lengths * noise, kind="stable"), none, p.capacity))
    least = -(-int(lengths.sum()) // p.capacity)
    ranked = sorted(((fitness(lengths, m), i, m) for i, m in enumerate(members)), key=lambda x: x[:2])
    for g in range(p.generations):
        if ranked[0][0][0] <= least:
            break
        for i in range(2):
            a = ranked[0][2] if i == 0 else ranked[rng.integers(len(ranked))][2]
            b = ranked[rng.integers(len(ranked))][2]
            child = _crossover(lengths, a, b, p, rng)
            ranked.append((fitness(lengths, child), len(ranked), child))
        ranked = sorted(ranked, key=lambda x: x[:2])[:p.population]
        ranked = [(f, i, m) for i, (f, _, m) in enumerate(ranked)]
    return [m for _, _, m in ranked]


# -------------------------------------------------------------------- islands
def _first_members(items: DataFrame, p: Params) -> DataFrame:
    """Every island's first population from ``items (cell, island, uid, length)``."""
    def start(key, pdf):
        import pandas as pd
        pdf = pdf.sort_values("uid")
        lengths = pdf["length"].to_numpy(np.int64)
        found = _evolve(lengths, [], p, [p.seed, int(key[0]), int(key[1]), 0])
        return _rows(pd, key, pdf["uid"].to_numpy(), lengths, found)

    return items.groupBy("cell", "island").applyInPandas(start, MEMBER)


def _rows(pd, key, uids, lengths, found):
    return pd.DataFrame({"cell": key[0], "island": key[1], "member": range(len(found)),
                         "uids": [uids] * len(found), "lengths": [lengths.astype(np.int32)] * len(found),
                         "bins": [m.astype(np.int32) for m in found]})


def _next_members(state: DataFrame, p: Params, round_no: int) -> DataFrame:
    """Elites migrate to the next island; every island goes on evolving."""
    elite = (state.where("member = 0")
             .withColumn("island", (F.col("island") + 1) % p.islands).withColumn("member", F.lit(-1)))

    def go(key, pdf):
        import pandas as pd
        pdf = pdf.sort_values("member")
        lengths = pdf["lengths"].iloc[0].astype(np.int64)
        members = [m.astype(np.int64) for m in pdf["bins"]]
        found = _evolve(lengths, members, p, [p.seed, int(key[0]), int(key[1]), round_no])
        return _rows(pd, key, pdf["uids"].iloc[0], lengths, found)

    return state.unionByName(elite).groupBy("cell", "island").applyInPandas(go, MEMBER)


def _winners(state: DataFrame, p: Params) -> DataFrame:
    """``(uid, length, sequence_id, offset, fill)`` by each cell's best member."""
    def pick(pdf):
        import pandas as pd
        best = min(zip(pdf["island"], pdf["lengths"], pdf["bins"], pdf["uids"]),
                   key=lambda r: (*fitness(r[1].astype(np.int64), r[2]), r[0]))
        lengths, bins, uids = best[1].astype(np.int64), best[2], best[3]
        order = np.lexsort((uids, bins))
        lengths, bins, uids = lengths[order], bins[order], uids[order]
        first = np.concatenate([[True], bins[1:] != bins[:-1]])
        at = np.flatnonzero(first)[np.cumsum(first) - 1]
        end = np.cumsum(lengths)
        return pd.DataFrame({"uid": uids, "length": lengths, "sequence_id": uids[at],
                             "offset": end - lengths - (end - lengths)[at],
                             "fill": np.bincount(bins, lengths)[bins].astype(np.int64)})

    return (state.where("member = 0").groupBy("cell")
            .applyInPandas(pick, "uid long, length long, sequence_id long, offset long, fill long"))


def _pack_cells(items: DataFrame, n_cells: int, p: Params) -> DataFrame:
    dealt = (items.withColumn("cell", F.pmod(F.xxhash64("uid", F.lit(p.seed)), F.lit(n_cells)))
             .withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(p.islands)])))
             .select("cell", "island", "uid", "length"))
    state = materialise(_first_members(dealt, p), "islands")
    for r in range(1, p.rounds):
        state = materialise(_next_members(state, p, r), "islands")
    return materialise(_winners(state, p), "packed")


def pack(items: DataFrame, params: Params = Params()) -> DataFrame:
    """``(uid, sequence_id, offset)`` for ``items (uid, length)``, lengths from
    1 to the capacity; a sequence is named by its smallest uid."""
    p = params
    full = (items.where(F.col("length") >= p.capacity)
            .select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    part = items.where(F.col("length") < p.capacity).select("uid", "length")
    n_cells = max(1, -(-part.count() // p.cell_items))
    packed = _pack_cells(part, n_cells, p)
    keep = ["uid", "sequence_id", "offset"]
    done = []
    while n_cells > 1:
        # What stands in loose bins is packed once more, over all cells; fewer bins win.
        loose = F.col("fill") < p.well_filled * p.capacity
        rest = packed.where(loose)
        items, bins = rest.agg(F.count(F.lit(1)), F.count_if(F.col("uid") == F.col("sequence_id"))).first()
        n_rest = max(1, -(-items // p.cell_items))
        if n_rest >= n_cells:
            break
        again = _pack_cells(rest.select("uid", "length"), n_rest, p)
        if again.where("uid = sequence_id").count() >= bins:
            break
        done.append(packed.where(~loose))
        packed, n_cells = again, n_rest
    out = full
    for bins in [*done, packed]:
        out = out.unionByName(bins.select(*keep))
    return out


def pack_documents(docs: DataFrame, end_id: int, params: Params = Params(),
                   tokenizer: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece."""
    cut = materialise(pieces(docs, params.capacity, end_id, tokenizer, id_col, text_col)
                      .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    return cut.join(pack(cut.select("uid", "length"), params), "uid").drop("uid")
