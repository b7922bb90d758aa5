"""The corpus pipeline and its stages, against plain versions on a small corpus."""

import math
import zlib

import numpy as np
import pytest

import corpus_pipeline
from quarry.llm import mixing, packing, simhash, toxicity
from quarry.llm.common import crc_mod5
from tests.llm.helpers import awkward_rows, words
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.test_toxicity import BAD

# Names that the stages use inside, as columns of the documents.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp long, _id long, _c long, _k long, "
          "_copies int, row string, id long, uid long, _t string, _row string, _min long, copies long, _fp long")


def corpus():
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i, r in enumerate(awkward_rows()):
        rows.append((*r[:5], 77, 78, 79, 80, 81, "r", 82, 83, "t", "w", 84, 85, 86))
    for i in range(1000, 1400):
        w = words(rng, int(rng.integers(8, 60)), vocab=3000).split()
        if i % 6 == 0:
            w.insert(int(rng.integers(len(w))), BAD[i % 3])
        rows.append((i, " ".join(w), "en", f"s{i % 3}", 1, 77, 78, 79, 80, 81, "r", 82, 83, "t", "w", 84, 85, 86))
        labels.append((i, 1, int(i % 6 == 0)))
    return rows, labels


@pytest.fixture()
def tables(spark, tmp_dir):
    rows, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    return tmp_dir, rows


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_and_whole_run(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, stages = zip(*corpus_pipeline.STAGES)
    assert names == ("toxicity", "simhash_near_dedup", "mixing", "packing")

    # 1. toxicity: planted words go, the rest stays, every column as it was
    clean = as_rows(stages[0](spark, docs, folder))
    bad = {r[0] for r in rows if r[0] and r[0] >= 1000 and r[0] % 6 == 0}
    assert set(clean) <= set(rows) and not {r[0] for r in clean} & bad
    assert len(clean) >= len(rows) - len(bad) - 4
    docs = spark.createDataFrame(clean, SCHEMA)

    # 2. near-duplicates: one row of each component of all rows
    kept = as_rows(stages[1](spark, docs, folder))
    order = sorted(clean, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    label = brute_components([brute_fp(r[1], 4) for r in order], 4)
    assert sorted(((r[0], r[1]) for r in kept), key=str) == sorted(
        ((order[i][0], order[i][1]) for i in set(label)), key=str)
    assert set(kept) <= set(clean)
    docs = spark.createDataFrame(kept, SCHEMA)

    # 3. mixing: rows as often as their copies, budgets by the closed form
    mixed = as_rows(stages[2](spark, docs, folder))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, repeats=corpus_pipeline.REPEATS).collect()}
    assert all(mixed.count(r) == copies[r[0]] >= 1 for r in kept)
    tokens = {}
    for r in kept:
        tokens[r[3]] = tokens.get(r[3], 0) + len((r[1] or "").split())
    top, low = max(tokens.values()), min(v for v in tokens.values() if v)
    a = max(0.0, 1 - math.log(corpus_pipeline.REPEATS) / math.log(top / low))
    for s, t in tokens.items():
        used = sum(len((r[1] or "").split()) for r in mixed if r[3] == s)
        longest = max(len((r[1] or "").split()) for r in kept if r[3] == s)
        assert t * (t / top) ** (a - 1) - longest - 1 < used <= t * (t / top) ** (a - 1) + 1
    docs = spark.createDataFrame(mixed, SCHEMA)

    # 4. packing: every token of every row once, gapless sequences of at most 2,048
    packed = stages[3](spark, docs, folder).collect()
    plain = packing.pieces(docs, 2048, 0).collect()
    key = lambda r: (r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, packed)) == sorted(map(key, plain))
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r["length"] for r in packed) // 2048) + 1

    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_no_documents(spark, tmp_dir):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_toxicity_equals_a_plain_loop(spark):
    """One shard: the weights of plain FTRL-proximal over the same order of rows."""
    rng = np.random.default_rng(9)
    texts = [words(rng, 20, 60).encode() for _ in range(80)]
    labels = np.array([float(i % 4 == 0) for i in range(80)])
    texts = [t + (b" grotten" if y else b"") for t, y in zip(texts, labels)]
    p = toxicity.Params()
    keys, weights, bias = toxicity._ftrl(texts, labels, p)
    feats = []
    for t in texts:
        feats.append(set(toxicity.features([t], p.skips)[1].tolist()))
    seen = {}
    for f in feats:
        for k in f:
            seen[k] = seen.get(k, 0) + 1
    z, q, l1 = {}, {}, p.l1 * len(texts)

    def weight(k):
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((p.beta + math.sqrt(q[k])) / p.alpha + p.l2)

    for epoch in range(p.epochs):
        for i in np.random.default_rng(epoch).permutation(np.arange(len(texts))):
            used = [k for k in feats[i] if seen[k] >= p.min_rows] + ["bias"]
            w = {k: weight(k) for k in used}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - labels[i]
            for k in used:
                root = math.sqrt(q.get(k, 0.0) + g * g)
                z[k] = z.get(k, 0.0) + g - (root - math.sqrt(q.get(k, 0.0))) / p.alpha * w[k]
                q[k] = q.get(k, 0.0) + g * g
    want = {k: weight(k) for k in z if k != "bias" and weight(k)}
    assert dict(zip(keys.tolist(), weights)) == pytest.approx(want, abs=1e-9)
    assert bias == pytest.approx(weight("bias"), abs=1e-9)


def test_very_long_text_is_scored_whole():
    model = toxicity.Model(np.sort(toxicity.features([b"grotten"], ())[1]), np.array([9.0]), -4.0)
    text = b"fine words " * 300_000
    assert toxicity.score_texts([text, text + b"grotten"], model, (0, 1)).round().tolist() == [0, 1]


def test_ids_of_the_folds_are_crc32(spark):
    got = spark.range(50).select("id", crc_mod5("id").alias("m")).collect()
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 5 for r in got)
