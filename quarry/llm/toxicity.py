"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

* Words: ASCII lower case, ASCII punctuation is a separator. Features of a
  text are the *distinct* hashes of its words, its word pairs and its pairs
  with one word skipped (``skips``), in a space of 2**40, so that unrelated
  n-grams practically never share a weight.
* Training reads a bounded sample of labelled rows (``max_rows``, taken in
  hash order of the id), dealt to tasks of about ``shard_rows`` rows. Each runs
  FTRL-proximal (per-coordinate rates, L1 in proportion to its rows); the
  non-zero weights, a few hundred, are averaged by feature in Spark. Averaging
  shrinks them, so one scale and the bias are refitted on the sample's scores
  (Platt). Only weights and (score, label) pairs reach the driver; their
  number is bounded by the sample.
* Scoring is one map over all rows: no shuffle of texts.

Defined results: a null text is the empty text, whose score is that of the
bias alone; a null id is scored but never trained on; repeated rows are each
scored; several labels of one id count as the largest; null labels are
ignored; without any training row every score is 0.0. Extra columns of the
inputs are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, release, slices, text_bytes, text_slices, word_hashes

# A-Z to a-z, other ASCII bytes that are no letter or digit to a blank.
_WORD_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or chr(i).isalnum() else 32
                    for i in range(256))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
HASH_BITS = 40
BIAS = -1


@dataclass(frozen=True)
class Params:
    max_rows: int = 16_000      # bound of the labelled sample
    shard_rows: int = 2_000
    epochs: int = 8
    skips: tuple[int, ...] = (0, 1)   # words skipped inside a pair; 0 is the plain pair
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 0.005           # per row of the shard
    l2: float = 0.1
    min_rows: int = 3           # a feature must stand in so many rows of its shard


@dataclass(frozen=True)
class Model:
    """``keys`` sorted feature hashes, ``weights`` alike, ``bias`` None if untrained."""
    keys: np.ndarray
    weights: np.ndarray
    bias: float | None


def features(texts: list[bytes], skips: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every word, pair and skip pair, with repeats."""
    h, sizes = word_hashes(texts, _WORD_BYTES)
    n = len(h)
    doc = np.repeat(np.arange(len(texts)), sizes)
    shift = np.uint64(64 - HASH_BITS)
    docs, keys = [doc], [(h * _MIX[0]) >> shift]
    for s in skips:
        k = s + 1
        if n <= k:
            continue
        same = doc[k:] == doc[:-k]
        left, right = h[:-k][same], h[k:][same]
        docs.append(doc[:-k][same])
        keys.append(((left * _MIX[1] + np.uint64(s)) ^ (right * _MIX[2])) * _MIX[0] >> shift)
    return np.concatenate(docs), np.concatenate(keys).astype(np.int64)


def _ftrl(texts: list[bytes], labels: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, float]:
    """Non-zero weights of one shard: (feature, weight) and the bias."""
    found = [features(texts[i:j], p.skips) for i, j in slices(texts)]
    starts = [i for i, _ in slices(texts)]
    doc = np.concatenate([d + s for (d, _), s in zip(found, starts)])
    uniq, inv = np.unique(np.concatenate([k for _, k in found]), return_inverse=True)
    del found
    pair = np.unique(doc * len(uniq) + inv) if len(uniq) else np.zeros(0, np.int64)
    doc, inv = np.divmod(pair, max(len(uniq), 1))
    keep = np.bincount(inv, minlength=len(uniq)) >= p.min_rows
    local = np.cumsum(keep) - 1
    used = keep[inv]
    doc, inv, uniq = doc[used], local[inv[used]], uniq[keep]
    ptr = np.searchsorted(doc, np.arange(len(texts) + 1))
    z, q = np.zeros(len(uniq) + 1), np.zeros(len(uniq) + 1)      # the last place is the bias

    l1 = p.l1 * len(texts)

    def weight(zi, qi):
        return np.where(np.abs(zi) <= l1, 0.0,
                        -(zi - np.sign(zi) * l1) / ((p.beta + np.sqrt(qi)) / p.alpha + p.l2))

    order = np.arange(len(texts))
    for epoch in range(p.epochs):
        for i in np.random.default_rng(epoch).permutation(order):
            idx = np.append(inv[ptr[i]:ptr[i + 1]], len(uniq))
            zi, qi = z[idx], q[idx]
            w = weight(zi, qi)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            root = np.sqrt(qi + g * g)
            z[idx] = zi + g - (root - np.sqrt(qi)) / p.alpha * w
            q[idx] = qi + g * g
    w = weight(z, q)
    nz = np.flatnonzero(w[:-1])
    return uniq[nz], w[nz], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, params: Params = Params(),
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from rows of ``docs`` whose id meets ``trainable`` and has a label."""
    lab = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & trainable)
           .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("double").alias("_y")))
    ids = docs.select(F.col(id_col).alias("_id")).distinct()
    sample = lab.join(ids, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(params.max_rows)
    sample = materialise(sample, "labelled")
    shards = max(1, -(-sample.count() // params.shard_rows))
    # The sample holds at most max_rows rows of 16 bytes: a proven broadcast bound.
    rows = (docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_t"))
            .join(F.broadcast(sample), "_id")
            .groupBy("_id").agg(F.min("_t").alias("_t"), F.max("_y").alias("_y"))
            .withColumn("_s", F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(shards))))
    rows = materialise(rows, "labelled-texts")

    def train(group):
        group = group.sort_values("_id")
        keys, w, bias = _ftrl(group["_t"].tolist(), group["_y"].to_numpy(), params)
        import pandas as pd
        return pd.DataFrame({"key": np.append(keys, BIAS), "w": np.append(w, bias)})

    got = (rows.groupBy("_s").applyInPandas(train, "key long, w double")
           .groupBy("key").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).toPandas())
    bias = got[got["key"] == BIAS]
    if not len(bias):
        return Model(np.zeros(0, np.int64), np.zeros(0), None)
    n = int(bias["n"].iloc[0])                     # shards that had rows
    got = got[got["key"] != BIAS].sort_values("key")
    model = Model(got["key"].to_numpy(np.int64), got["w"].to_numpy() / n, float(bias["w"].iloc[0]) / n)
    skips = params.skips

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_logits(b.column(0).to_pylist(), model, skips)), b.column(1)], ["x", "y"])

    pairs = rows.select("_t", "_y").mapInArrow(scored, "x double, y double").toPandas()
    scale, shift = _platt(pairs["x"].to_numpy() - model.bias, pairs["y"].to_numpy(), model.bias)
    return Model(model.keys, model.weights * scale, shift)


def _platt(x: np.ndarray, y: np.ndarray, shift: float) -> tuple[float, float]:
    """Scale and shift of logit scores by Newton steps on a slightly ridged log loss."""
    theta = np.array([1.0, shift])
    a = np.stack([x, np.ones(len(x))], axis=1)
    prior = np.array([1.0, shift])
    for _ in range(50):
        q = 1.0 / (1.0 + np.exp(-np.clip(a @ theta, -35, 35)))
        grad = a.T @ (q - y) + (theta - prior) * 0.5
        step = np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a + 0.5 * np.eye(2), grad)
        theta = theta - np.clip(step, -1.0, 1.0)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def score_texts(texts: list[bytes], model: Model, skips: tuple[int, ...]) -> np.ndarray:
    """Probability of label 1 for each text."""
    if model.bias is None:
        return np.zeros(len(texts))
    return 1.0 / (1.0 + np.exp(-np.clip(_logits(texts, model, skips), -35, 35)))


def _logits(texts: list[bytes], model: Model, skips: tuple[int, ...]) -> np.ndarray:
    mask = (1 << 20) - 1
    maybe = np.zeros(mask + 1, dtype=bool)         # most features stop here
    maybe[model.keys & mask] = True
    logits = np.full(len(texts), model.bias)
    for i, j in slices(texts):
        doc, key = features(texts[i:j], skips)
        hit = maybe[key & mask]
        doc, key = doc[hit], key[hit]
        at = np.minimum(np.searchsorted(model.keys, key), max(len(model.keys) - 1, 0))
        hit = model.keys[at] == key if len(model.keys) else np.zeros(len(key), bool)
        pair = np.unique(doc[hit] * len(model.keys) + at[hit])
        doc, at = np.divmod(pair, max(len(model.keys), 1))
        logits[i:j] += np.bincount(doc, model.weights[at], minlength=j - i)
    return logits


def score(docs: DataFrame, model: Model, params: Params = Params(),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, a null text scored as the empty one."""
    skips = params.skips

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, texts in text_slices(b.column(1)):
                s = score_texts(texts, model, skips)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, len(texts)), pa.array(s)], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col), text_bytes(text_col).alias("_t"))
            .mapInArrow(run, f"`{id_col}` {kind}, score double"))


def reject(docs: DataFrame, model: Model, params: Params = Params(),
           text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score is below 0.5, all columns kept."""
    skips = params.skips

    @F.pandas_udf("double")
    def toxic(texts):
        import pandas as pd
        got = pd.Series(score_texts(texts.tolist(), model, skips))
        release()
        return got

    return docs.where(toxic(text_bytes(text_col)) < 0.5)
