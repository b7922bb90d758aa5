"""SimHash near-duplicates, candidates by the generalised pigeonhole principle.

1. One map computes each text's 64-bit fingerprint: XXH64 (seed 42) of every
   k-word shingle, repeats included; a bit is 1 if set in over half of them.
2. Equal fingerprints fold to one class represented by its smallest id, so
   copies, however many, cost one row.
3. Correlated bits are grouped into m partitions. Partition i gets its own
   threshold t_i (-1: not probed) with sum(t_i + 1) = distance + 1; then two
   fingerprints within the distance differ in at most t_i bits of some
   partition i. m and the t_i come from dynamic programming on candidate
   counts estimated from the bit statistics of *all* classes.
4. Each class is filed under its value in every probed partition and visits
   the values within t_i bits; classes that meet are verified by their full
   distance. A crowded value is cut into a grid of bounded cells. A cell
   returns a spanning forest of its links, never all its pairs.
5. Connected components over the links give each class its smallest id.

Defined results: null text is empty; an empty text has fingerprint zero, which
links like any other; null ids get a fingerprint, take no part as
representatives and share their class's component (null if no row of the
component has an id); repeated rows are returned as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, materialise, slices, text_bytes, text_slices
from .components import components

SEED = 42
# A value met by more rows than this is cut into cells of at most twice as many.
CELL_ROWS = 2048
# Relative cost of writing a probe and of verifying a candidate pair.
PROBE_COST, CANDIDATE_COST = 4.0, 1.0


# ------------------------------------------------------------ fingerprints
def fingerprint_texts(texts: list[bytes], shingle: int) -> np.ndarray:
    """Unsigned 64-bit fingerprints."""
    from xxhash import xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i, j in slices(texts, 1 << 20):
        hashes, sizes = [], []
        for x in texts[i:j]:
            words = x.translate(ASCII_LOWER).split()
            joined = b" ".join(words)
            if len(words) <= shingle:
                got = [xxh64_intdigest(joined, SEED)] if words else []
            else:
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                starts = np.concatenate([[0], ends[:-1] + 1])
                got = [xxh64_intdigest(joined[a:b], SEED) for a, b in
                       zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
            hashes.append(np.array(got, np.uint64))
            sizes.append(len(got))
        size = np.array(sizes)
        full = np.flatnonzero(size)
        if not len(full):
            continue
        bits = np.unpackbits(np.concatenate(hashes).astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        first = np.concatenate([[0], np.cumsum(size[full])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        top = (2 * ones > size[full][:, None]).astype(np.uint8)
        out[i + full] = np.packbits(top, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, fp long)`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, texts in text_slices(b.column(1)):
                fp = fingerprint_texts(texts, shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, len(texts)), pa.array(fp)], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col), text_bytes(text_col).alias("_t"))
            .mapInArrow(run, f"`{id_col}` {kind}, fp long"))


# ------------------------------------------------- partitions and thresholds
def bit_statistics(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of classes and the 64 x 64 counts of bits set together, over all
    classes; each task sends 4,096 sums that Spark adds up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for i in range(0, len(fp), 1 << 15):
                x = np.unpackbits(fp[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").astype(np.float32)
                total += x.T @ x
            n += len(fp)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(4097)), pa.array(np.append(total.ravel(), n))], ["cell", "c"])

    got = (classes.select("fp").mapInArrow(run, "cell long, c double")
           .groupBy("cell").agg(F.sum("c").alias("c")).toPandas())
    flat = np.zeros(4097)
    flat[got["cell"].to_numpy(np.int64)] = got["c"].to_numpy()
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """Cut the bits into m groups of near-equal width, correlated bits together."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(64)), []
    for g in range(m):
        width = 64 // m + (g < 64 % m)
        seed = max(left, key=lambda b: (corr[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            nxt = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(nxt)
            left.remove(nxt)
        groups.append(sorted(group))
    return groups


def plan(n: int, together: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """The cheapest partitions and thresholds: ``[(bits, threshold)]``, without
    the partitions that are not probed."""
    differ = 2 * np.diag(together) / max(n, 1) * (1 - np.diag(together) / max(n, 1))
    best: tuple[float, list] = (np.inf, [])
    for m in range(1, distance + 2):
        groups = group_bits(n, together, m)
        # least[s]: cheapest way to give the groups so far thresholds with sum(t + 1) = s
        least: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * (distance + 1)
        for bits in groups:
            near = np.ones(1)                      # distribution of differing bits in the group
            for b in bits:
                near = np.convolve(near, [1 - differ[b], differ[b]])
            cost = [0.0]
            for t in range(distance + 1):
                probes = sum(comb(len(bits), r) for r in range(t + 1))
                cost.append(PROBE_COST * n * probes + CANDIDATE_COST * n * n / 2 * near[:t + 1].sum())
            least = [min(((least[s - u][0] + cost[u], least[s - u][1] + [u - 1])
                          for u in range(s + 1)), key=lambda x: x[0])
                     for s in range(distance + 2)]
        if least[-1][0] < best[0]:
            best = (least[-1][0], [(g, t) for g, t in zip(groups, least[-1][1]) if t >= 0])
    return best[1]


# ------------------------------------------------------------ probe and verify
def _probes(classes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """``(part, value, home, fp, rep)``: each class at home in every partition
    and visiting the values within its threshold. Of two values only the one
    with a 0 in the lowest differing bit visits, so a pair meets once."""
    masks = [np.array([sum(1 << i for i in c) for r in range(1, t + 1)
                       for c in combinations(range(len(bits)), r)], np.int64)
             for bits, t in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                fp = b.column(0).to_numpy(zero_copy_only=False)
                rep = b.column(1).to_numpy(zero_copy_only=False)
                for k, (bits, _) in enumerate(parts):
                    value = np.zeros(len(fp), np.int64)
                    for i, bit in enumerate(bits):
                        value |= ((fp >> bit) & 1) << i
                    rows, probe = np.arange(len(fp)), value
                    if len(masks[k]):
                        goes = (value[:, None] & (masks[k] & -masks[k])[None, :]) == 0
                        r, c = np.nonzero(goes)
                        rows = np.concatenate([rows, r])
                        probe = np.concatenate([probe, value[r] ^ masks[k][c]])
                    home = np.arange(len(rows)) < len(fp)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), k, np.int32)), pa.array(probe),
                         pa.array(home), pa.array(fp[rows]), pa.array(rep[rows])],
                        ["part", "value", "home", "fp", "rep"])

    return (classes.select("fp", F.col("rep").cast("long").alias("rep"))
            .mapInArrow(run, "part int, value long, home boolean, fp long, rep long"))


def _forest(fp: np.ndarray, rep: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among all rows of a cell."""
    edges = []
    rest = np.arange(len(fp))
    stack: list[int] = []
    while len(rest):
        if not stack:
            stack.append(int(rest[0]))
            rest = rest[1:]
        i = stack.pop()
        near = np.bitwise_count(fp[rest] ^ fp[i]) <= distance
        if near.any():
            for j in rest[near].tolist():
                edges.append((rep[i], rep[j]))
                stack.append(j)
            rest = rest[~near]
    return edges


def _link(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links within each cell of a stream sorted by cell (columns 0 to 3)."""
    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.int64)),
                                           pa.array(np.asarray(b, np.int64))], ["a", "b"])

    def cells(cols):
        key, home, fp, rep = cols
        new = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        cell = np.repeat(np.arange(len(start)), size)
        small = size[cell] <= 64
        a, b = [], []
        for k in range(1, min(int(size.max()), 64)):
            ok = (cell[k:] == cell[:-k]) & small[k:] & (home[k:] | home[:-k])
            i = np.flatnonzero(ok)
            if not len(i):
                continue
            i = i[(np.bitwise_count(fp[i] ^ fp[i + k]) <= distance) & (rep[i] != rep[i + k])]
            a.append(rep[i])
            b.append(rep[i + k])
        if a:
            yield out(np.concatenate(a), np.concatenate(b))
        for s, n in zip(start[size > 64].tolist(), size[size > 64].tolist()):
            edges = _forest(fp[s:s + n], rep[s:s + n], distance)
            if edges:
                yield out(*zip(*edges))

    held = None
    for b in batches:
        key = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        cols = [key, b.column(4).to_numpy(zero_copy_only=False),
                b.column(5).to_numpy(zero_copy_only=False).view(np.uint64),
                b.column(6).to_numpy(zero_copy_only=False)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        key = cols[0]
        if not len(key):
            continue
        last = int(np.flatnonzero((key != key[-1]).any(axis=1))[-1]) + 1 if (key != key[-1]).any() else 0
        if last:
            yield from cells([c[:last] for c in cols])
        held = [c[last:] for c in cols]                 # the last cell may go on
    if held is not None and len(held[0]):
        yield from cells(held)


def links(classes: DataFrame, distance: int) -> DataFrame:
    """``(a, b)`` links between class representatives, enough of them to join
    all classes within ``distance`` bits of each other, directly or in steps."""
    n, together = bit_statistics(classes)
    spark = classes.sparkSession
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    rows = _probes(classes, plan(n, together, distance))
    crowded = (rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > CELL_ROWS)
               .select("part", "value", F.ceil(F.col("_n") / CELL_ROWS).cast("int").alias("_r")))
    spread = (rows.join(crowded, ["part", "value"], "left")
              .withColumn("_r", F.coalesce("_r", F.lit(1)))
              .withColumn("_i", F.pmod(F.xxhash64("rep"), F.col("_r")).cast("int"))
              .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_r") - 1))))
    cell = ["part", "value", "_x", "_y"]
    met = (spread.select("part", "value", F.least("_i", "_j").alias("_x"),
                         F.greatest("_i", "_j").alias("_y"), "home", "fp", "rep")
           .repartition(*cell).sortWithinPartitions(*cell))
    return met.mapInArrow(lambda it: _link(it, distance), "a long, b long")


def _labelled(prints: DataFrame, distance: int, id_col: str) -> DataFrame:
    """``(fp, _c, _min)``: the component of every fingerprint and the least id that has
    it. All rows make classes, those without an id as well."""
    classes = materialise(prints.groupBy("fp").agg(F.min(id_col).cast("long").alias("_min"))
                          .withColumn("rep", F.col("fp")), "classes")
    found = components(links(classes.select("fp", "rep"), distance))
    return materialise(classes.join(found, classes["rep"] == found["node"], "left")
                       .select("fp", "_min", F.coalesce("component", "rep").alias("_c")), "components")


def near_duplicates(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id, fp, component_id)`` of every row; ids must be integers. Rows without
    an id link others like any row; a component of such rows alone has a null id."""
    prints = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    labels = _labelled(prints, distance, id_col)
    names = labels.groupBy("_c").agg(F.min("_min").alias("component_id"))
    named = labels.join(names, "_c").select(F.col("fp").alias("_fp"), "component_id")
    return (prints.join(named, F.col("fp") == F.col("_fp"), "left")
            .select(id_col, "fp", "component_id"))


def keep_one(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each component, all columns kept, whatever their names: the first by
    id (null last), then by text. Components are those of all rows, whatever their ids:
    rows without an id count, and a repeated id does not join its rows' texts.
    """
    columns = docs.columns
    prints = materialise(fingerprints(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")),
                                      shingle, "id", "text"), "fingerprints")
    docs = docs.select(F.struct(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns))).alias("row"),
                       F.col(f"`{id_col}`").alias("id"))
    text = F.col(f"row._{columns.index(text_col)}").alias("text")
    labels = _labelled(prints, distance, "id")
    best = labels.groupBy("_c").agg(F.min("_min").alias("_id"))
    ids = (prints.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("_id"))
           .agg(F.count(F.lit(1)).alias("_n")))
    once = docs.join(ids.where("_n = 1").join(best, "_id"), docs["id"] == F.col("_id"), "left_semi")
    # Null and repeated ids do not name a row: these rows are told apart by fingerprint and text.
    again = (docs.join(ids.where("_n > 1"), docs["id"] == F.col("_id"), "left_semi")
             .unionByName(docs.where(F.col("id").isNull())))
    # Both joins take the same two columns, so the rows are shuffled once for both.
    row = (fingerprints(again.select(F.struct("row", "id").alias("all"), text), shingle, "all", "text")
           .select("fp", "all.*").select("fp", "row", "id", text))
    owner = labels.join(best, "_c").select(F.col("fp").alias("_fp"), "_c", "_id")
    first = Window.partitionBy("_c").orderBy(F.col("text").asc_nulls_first())
    again = (row.join(owner, (F.col("fp") == F.col("_fp")) & F.col("id").eqNullSafe(F.col("_id")))
             .withColumn("_k", F.row_number().over(first)).where("_k = 1").select("row"))
    return once.select("row").unionByName(again).select(*(F.col(f"row._{i}").alias(c) for i, c in enumerate(columns)))


def hex_digits(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
