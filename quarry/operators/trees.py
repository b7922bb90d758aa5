"""Decision trees and random forests with exact thresholds, grown level by level.

All trees grow together. For a level, each Arrow batch sends its rows down the
trees so far (a small table in the closure) and counts weight, label weight and
rows for each (tree, open node, drawn feature, value); these partial counts are
summed by Spark. Windows over the sums turn them into running class counts,
every cut between neighbouring values is rated by Gini impurity, and one row for
each open node comes back. So a level takes one job (a second one where all drawn
features of a node are constant), whatever the number of trees and rows.

Random choices are MD5 values: the order in which a node draws features, and
for a forest the number of times a tree takes a row (Poisson with mean 1, the limit
of drawing rows with replacement).

The counts hold one row per value that a feature takes in a node: meant for
counts and other columns with few values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dense import column, matrix, predicted
from .sampling import md5_key

# Share of a Poisson(1) variable at or below 0, 1, 2, ..., in 65,536ths.
POISSON = [int(65536 * sum(1 / np.prod(np.arange(1.0, i + 1)) for i in range(k + 1)) / np.e) for k in range(8)]
DRAWS = 8                   # 16-bit draws in one MD5
TOTAL = -1                  # stands for a feature: a node's totals
DIGITS = 9                  # of the gain; equal to so many places is a tie


@dataclass
class Trees:
    """Nodes of all trees by (tree, node): the root is 1, children 2n and 2n + 1."""

    trees: int
    splits: dict[tuple[int, int], tuple[int, float]] = field(default_factory=dict)
    share: dict[tuple[int, int], float] = field(default_factory=dict)     # of label 1

    def nodes(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The node in which each row ends."""
        at = np.ones(len(x), np.int64)
        level = [1]
        while level:
            after = []
            for n in level:
                if (tree, n) in self.splits:
                    f, cut = self.splits[tree, n]
                    here = at == n
                    at[here] = 2 * n + (x[here, f] > cut)
                    after += [2 * n, 2 * n + 1]
            level = after
        return at

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of label 1 over the trees, less a half."""
        total = np.zeros(len(x))
        for t in range(self.trees):
            at = self.nodes(x, t)
            for n in np.unique(at).tolist():
                total[at == n] += self.share.get((t, n), 0.0)
        return np.round(total / max(self.trees, 1), DIGITS) - 0.5


def weights(key: str, trees: int, seed) -> Column:
    """Bytes from which ``_taken`` reads how often each tree takes a row."""
    return F.unhex(F.concat(*[md5_key(f"{seed}|{i}", key) for i in range(-(-trees // DRAWS))]))


def _taken(batch: pa.RecordBatch, trees: int) -> np.ndarray:
    if batch.column("draws").null_count:
        return np.ones((batch.num_rows, trees), np.int64)
    draws = np.stack([np.frombuffer(b, ">u2")[:trees] for b in batch.column("draws").to_pylist()])
    return np.searchsorted(np.array(POISSON), draws, side="right")


def _order(tree: int, node: int, width: int, seed) -> list[int]:
    """Features in the order in which a node draws them."""
    return sorted(range(width), key=lambda f: hashlib.md5(f"{seed}|{tree}|{node}|{f}".encode()).hexdigest())


def _counted(rows: DataFrame, grown: Trees, asked: dict[tuple[int, int], list[int]]) -> DataFrame:
    """``(t, n, r, f, v, w, p, c)`` for the nodes and features asked for: r is the
    feature's place in the node's draw; w, p, c count weight, weight of label 1, rows."""
    names = ["t", "n", "r", "f", "v", "w", "p", "c"]
    by_tree: dict[int, list] = {}
    for (t, n), drawn in asked.items():
        by_tree.setdefault(t, []).append((n, drawn))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y, taken = matrix(b), column(b, "label").astype(np.int64), _taken(b, grown.trees)
            values, codes = zip(*(np.unique(x[:, f], return_inverse=True) for f in range(x.shape[1])))
            out: list[list[np.ndarray]] = [[] for _ in names]
            for t, nodes in by_tree.items():
                at = grown.nodes(x, t)
                for n, drawn in nodes:
                    here = np.flatnonzero((at == n) & (taken[:, t] > 0))
                    if not len(here):
                        continue
                    w, yes = taken[here, t], taken[here, t] * y[here]
                    for r, f in enumerate(drawn):
                        code = codes[f][here] if f != TOTAL else np.zeros(len(here), np.int64)
                        rows_of = np.bincount(code)
                        got = np.flatnonzero(rows_of)
                        v = values[f][got] if f != TOTAL else np.zeros(1)
                        fixed = [np.full(len(got), k, np.int64) for k in (t, n, r, f)]
                        for o, a in zip(out, [*fixed, v + 0.0, np.bincount(code, w)[got].astype(np.int64),
                                              np.bincount(code, yes)[got].astype(np.int64), rows_of[got]]):
                            o.append(a)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=names)

    return (rows.mapInArrow(part, "t long, n long, r long, f long, v double, w long, p long, c long")
            .groupBy("t", "n", "r", "f", "v").agg(*[F.sum(k).alias(k) for k in "wpc"]))


def _best(counts: DataFrame, min_leaf: int, draw: int) -> DataFrame:
    """One row per node: its totals, and the best cut or null."""
    feature = Window.partitionBy("t", "n", "f")
    run = feature.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (counts.where(F.col("f") != TOTAL)
            .select("*", *[F.sum(k).over(run).alias(f"l{k}") for k in "wpc"],
                    *[F.sum(k).over(feature).alias(f"a{k}") for k in "wpc"],
                    F.lead("v").over(feature.orderBy("v")).alias("next"), F.count("v").over(feature).alias("values")))

    def purity(w, p):
        return (p * p + (w - p) * (w - p)).cast("double") / w

    rw, rp = F.col("aw") - F.col("lw"), F.col("ap") - F.col("lp")
    gain = F.round(purity(F.col("lw"), F.col("lp")) + purity(rw, rp), DIGITS)
    moving = F.when(F.col("values") > 1, F.col("r"))
    # The first features drawn; if all of them are constant, the first that is not.
    first = F.min(moving).over(Window.partitionBy("t", "n"))
    cuts = cuts.withColumn("limit", F.greatest(F.lit(draw - 1), first))
    ok = F.col("next").isNotNull() & (F.col("r") <= F.col("limit")) & (F.col("lc") >= min_leaf) & (
        F.col("ac") - F.col("lc") >= min_leaf)
    best = F.min(F.when(ok, F.struct((-gain).alias("loss"), "r", ((F.col("v") + F.col("next")) / 2).alias("cut"), "f",
                                     "lw", "lp", "lc", "aw", "ap", "ac"))).alias("best")
    return cuts.groupBy("t", "n").agg(best, F.max(F.col("values")).alias("values"))


def grow(train: DataFrame, width: int, trees: int, depth: int, draw: int, min_split: int = 2, min_leaf: int = 1,
         seed=0) -> Trees:
    """Trees over ``train (label, x, draws)``; ``draws`` is ``weights`` or null (each
    row once). ``draw``: features a node looks at. A node with fewer than
    ``min_split`` rows, of one class, or without a cut that leaves ``min_leaf`` rows on
    both sides, is a leaf."""
    grown = Trees(trees)
    rows = train.select("label", "x", "draws")
    open_nodes = [(t, 1) for t in range(trees)]
    found = {(r["t"], r["n"]): r for r in _counted(rows, grown, {k: [TOTAL] for k in open_nodes}).collect()}
    state = {k: (r["w"], r["p"], r["c"]) for k, r in found.items()}
    for k, (w, p, _) in state.items():
        grown.share[k] = p / w
    for _ in range(depth):
        ready = {k: s for k, s in state.items() if 0 < s[1] < s[0] and s[2] >= min_split}
        orders = {k: _order(*k, width, seed) for k in ready}
        got = _cuts(rows, grown, {k: o[:draw] for k, o in orders.items()}, min_leaf, draw)
        still = {k: orders[k] for k in ready if got.get(k) is None or got[k]["values"] < 2}
        if still and draw < width:
            got |= _cuts(rows, grown, still, min_leaf, draw)
        state = {}
        for (t, n), r in got.items():
            b = r["best"]
            if b is None:
                continue
            grown.splits[t, n] = (b["f"], b["cut"])
            left = (b["lw"], b["lp"], b["lc"])
            right = tuple(a - x for a, x in zip((b["aw"], b["ap"], b["ac"]), left))
            for child, (w, p, c) in ((2 * n, left), (2 * n + 1, right)):
                grown.share[t, child] = p / w
                state[t, child] = (w, p, c)
        if not state:
            break
    return grown


def _cuts(rows: DataFrame, grown: Trees, asked: dict, min_leaf: int, draw: int) -> dict:
    if not asked:
        return {}
    best = _best(_counted(rows, grown, asked), min_leaf, draw)
    return {(r["t"], r["n"]): r for r in best.collect()}


def forest(train: DataFrame, test: DataFrame, width: int, key: str, trees: int = 100, depth: int = 3,
           seed=0) -> DataFrame:
    """Predictions of a random forest: each tree on its own draw of the rows, each
    node on sqrt(width) features; the mean share of the leaves decides."""
    rows = train.withColumn("draws", weights(key, trees, seed))
    grown = grow(rows, width, trees, depth, max(1, int(np.sqrt(width))), seed=seed)
    return predicted(test, key, grown.score)


def tree(train: DataFrame, test: DataFrame, width: int, key: str, depth: int = 2, draw: int = 2, min_split: int = 5,
         min_leaf: int = 5, seed=0) -> DataFrame:
    """Predictions of one tree on all rows."""
    rows = train.withColumn("draws", F.lit(None).cast("binary"))
    return predicted(test, key, grow(rows, width, 1, depth, draw, min_split, min_leaf, seed).score)
