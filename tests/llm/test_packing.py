import zlib
from collections import defaultdict

import numpy as np

from quarry.llm import packing
from quarry.llm.common import WordTokenizer
from tests.llm.helpers import awkward_rows, docs


def reference_ids(text):
    return WordTokenizer().full.encode(text or "", add_special_tokens=False).ids


def check_sequences(rows, capacity):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_pieces_and_sequences(spark):
    p = packing.Params(capacity=64, cell_items=40)
    rows = packing.pack_documents(docs(spark), end_id=0, params=p).collect()
    want = []
    for r in awkward_rows():
        ids = np.array(reference_ids(r[1]) + [0], "<u4")
        want += [(r[0], i // 64, i, len(ids[i:i + 64]), zlib.crc32(ids[i:i + 64].tobytes()))
                 for i in range(0, len(ids), 64)]
    key = lambda t: tuple((x is None, x or 0) for x in t)
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    n = check_sequences(rows, 64)
    total = sum(r["length"] for r in rows)
    assert n <= 1.05 * total / 64 + 3


def test_as_few_sequences_as_possible(spark):
    rng = np.random.default_rng(0)
    sizes = np.clip(rng.exponential(150, 3000), 1, 500).astype(int).tolist() + [512] * 5
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "uid long, length long")
    p = packing.Params(capacity=512, cell_items=1000)
    got = packing.pack(items, p).join(items, "uid").collect()
    assert sorted(r["uid"] for r in got) == list(range(len(sizes)))
    n = check_sequences(got, 512)
    assert n <= 1.005 * sum(sizes) / 512 + 2
    again = {(r["uid"], r["sequence_id"]) for r in packing.pack(items.repartition(5), p).collect()}
    assert again == {(r["uid"], r["sequence_id"]) for r in got}


def test_hard_sizes_are_packed_as_well_as_by_best_fit_decreasing_over_all(spark):
    sizes = np.random.default_rng(1).integers(1, 500, 2000)
    items = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "uid long, length long")
    n = check_sequences(packing.pack(items, packing.Params(capacity=512, cell_items=1000))
                        .join(items, "uid").collect(), 512)
    plain = packing.best_fit(sizes, np.argsort(-sizes, kind="stable"), np.full(len(sizes), -1), 512)
    assert n <= 1.01 * (plain.max() + 1)


def test_best_fit_takes_the_tightest_bin():
    lengths = np.array([6, 5, 4, 5, 3])
    bins = packing.best_fit(lengths, np.arange(5), np.full(5, -1), 10)
    assert bins.tolist() == [0, 1, 0, 1, 2]


def test_crossover_and_generations_never_lose_items():
    rng = np.random.default_rng(4)
    lengths = rng.integers(20, 300, 800)
    p = packing.Params(capacity=512, generations=6)
    first = packing._evolve(lengths, [], packing.Params(capacity=512, generations=0), [1])
    later = packing._evolve(lengths, first, p, [2])
    assert packing.fitness(lengths, later[0]) <= packing.fitness(lengths, first[0])
    for m in later:
        assert len(m) == len(lengths) and (np.bincount(m, lengths) <= 512).all()
    child = packing._crossover(lengths, first[0], first[1], p, rng)
    assert (child >= 0).all() and (np.bincount(child, lengths) <= 512).all()


def test_empty_and_blank(spark):
    assert packing.pack_documents(docs(spark, []), end_id=0).count() == 0
    blank = docs(spark, [(1, None, "", "a", 0, 1, 1, "", 1, 0.0)] * 2)
    rows = packing.pack_documents(blank, end_id=0).collect()
    assert [(r["length"], r["piece"]) for r in rows] == [(1, 0)] * 2
    assert len({r["sequence_id"] for r in rows}) == 1 and {r["offset"] for r in rows} == {0, 1}
