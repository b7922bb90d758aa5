import numpy as np
import xxhash

from quarry.llm import simhash
from quarry.llm.components import components
from tests.llm.helpers import awkward_rows, docs

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_fp(text, shingle):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def brute_components(fps, distance):
    """Smallest index reachable over links of at most ``distance`` bits."""
    n = len(fps)
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if (int(fps[i]) ^ int(fps[j])).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_and_components_match_brute_force(spark):
    rows = awkward_rows()
    got = simhash.near_duplicates(docs(spark, rows), 4, 4).collect()
    assert len(got) == len(rows)
    fps = {r[0]: brute_fp(r[1], 4) for r in rows}
    ids = sorted((i for i in fps if i is not None), key=int) + [None]
    label = brute_components([fps[i] for i in ids], 4)
    want = {i: ids[k] for i, k in zip(ids, label)}
    for r in got:
        assert r["fp"] & (2**64 - 1) == fps[r["doc_id"]]
        assert r["component_id"] == want[r["doc_id"]]
    assert fps[20] == fps[21] == 0


def test_links_of_random_near_fingerprints_at_every_distance(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = [int(b) for b in base]
    for b in base:                              # chains of small changes, and unrelated ones
        for _ in range(8):
            x = int(fps[rng.integers(len(fps))])
            for bit in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(bit)
            fps.append(x)
    fps = list(dict.fromkeys(fps))
    signed = [(int(np.uint64(x).view(np.int64)), i) for i, x in enumerate(fps)]
    classes = spark.createDataFrame(signed, "fp long, rep long")
    for distance in (0, 1, 3, 4, 7):
        found = {r["node"]: r["component"] for r in components(simhash.links(classes, distance)).collect()}
        assert [found.get(i, i) for i in range(len(fps))] == brute_components(fps, distance), distance


def test_crowded_value_is_cut_and_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 16)
    fps = [sum(1 << (i * 7 + j) % 64 for j in range(i % 3)) ^ (i << 40) for i in range(90)]
    fps = list(dict.fromkeys(fps))
    signed = [(int(np.uint64(x).view(np.int64)), i) for i, x in enumerate(fps)]
    classes = spark.createDataFrame(signed, "fp long, rep long")
    edges = simhash.links(classes, 4)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert [found.get(i, i) for i in range(len(fps))] == brute_components(fps, 4)


def test_forest_spans_without_all_pairs():
    fp = np.arange(64, dtype=np.uint64)
    edges = simhash._forest(fp, np.arange(64), 6)
    assert len(edges) == 63


def test_thresholds_add_up_and_groups_cover_all_bits():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (500, 64)).astype(float)
    x[:, 9] = x[:, 40]
    together = x.T @ x
    for m in range(1, 6):
        groups = simhash.group_bits(500, together, m)
        assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({9, 40} <= set(g) for g in simhash.group_bits(500, together, 5))
    for d in range(6):
        parts = simhash.plan(500, together, d)
        assert sum(t + 1 for _, t in parts) == d + 1


def test_keep_one_and_empty_table(spark):
    rows = awkward_rows()
    d = docs(spark, rows)
    label = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(d, 4, 4).collect()}
    kept = simhash.keep_one(d, 4, 4)
    assert kept.columns == d.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i in label if i is not None and label[i] == i})
    assert ids.count(None) == 1
    empty = docs(spark, [])
    assert simhash.near_duplicates(empty, 4, 4).count() == 0
    assert simhash.keep_one(empty, 4, 4).count() == 0


def test_long_chain_settles(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(1, n + 1)}
    assert components(edges.where("a < 0")).count() == 0


def test_keep_one_with_null_and_repeated_ids(spark):
    rng = np.random.default_rng(8)
    a, b, c, d, e, f = (" ".join(f"v{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(6))
    rows = [(3, a), (5, a), (5, b), (8, b),            # 5 stands for b, 3 for a
            (9, c), (None, c), (None, c),              # copies without id of a kept document
            (None, d), (None, d),                      # copies of each other
            (12, e), (12, f), (12, f), (13, None), (None, "")]
    got = simhash.keep_one(docs(spark, [(i, x, "en", "s", 1, 1, 2, "v", 3, 0.5) for i, x in rows]), 4, 4).collect()
    assert sorted((r["doc_id"] or 99, r["text"] or "") for r in got) == sorted(
        [(3, a), (5, b), (9, c), (99, d), (12, e), (12, f), (13, "")])
    assert {(r["lang"], r["rep"], r["score"]) for r in got} == {("en", 3, 0.5)}


def test_rows_without_id_link_others(spark):
    """Texts 1 and 9 are near only through a third text, with or without an id."""
    rng = np.random.default_rng(0)
    texts = [" ".join(f"u{x}" for x in rng.integers(0, 10**6, 400))]
    apart = lambda a, b: (brute_fp(a, 4) ^ brute_fp(b, 4)).bit_count()
    for i in range(400):                        # change a few words until the third is far from the first
        if len(texts) == 3:
            break
        w = texts[-1].split()
        for at in rng.integers(0, len(w), 3):
            w[at] = f"n{i}x{at}"
        new = " ".join(w)
        if apart(texts[-1], new) in (3, 4) and (len(texts) < 2 or apart(texts[0], new) > 4):
            texts.append(new)
    assert (brute_fp(texts[0], 4) ^ brute_fp(texts[2], 4)).bit_count() > 4
    for middle in (5, None):
        rows = [(i, t, "en", "s", 1, 1, 2, "v", 3, 0.5) for i, t in zip((1, middle, 9), texts)]
        got = simhash.near_duplicates(docs(spark, rows), 4, 4).collect()
        assert [r["component_id"] for r in got] == [1, 1, 1]
        assert simhash.keep_one(docs(spark, rows), 4, 4).collect()[0]["doc_id"] == 1
    alone = [(None, texts[0], "en", "s", 1, 1, 2, "v", 3, 0.5)] * 2
    assert {r["component_id"] for r in simhash.near_duplicates(docs(spark, alone), 4, 4).collect()} == {None}
