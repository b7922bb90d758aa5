"""The conversation trie against a dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, key string, sizes string, base long, h long, pid long"
COLS = [x.split()[0] for x in prefixtrie.NODE.split(", ")]


def brute(rows, step=5, spread=9):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, mark, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % spread
        base = c - (abs(c) % step) * (1 if c > 0 else -1)
        seq = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for s in nodes:
        if s:
            kids[s[:-1]].append(s)
    out = []
    below = {}
    for s in sorted(nodes, key=len, reverse=True):
        leaves = sum(below[k][0] for k in kids[s]) or 1
        saved = sum(below[k][1] for k in kids[s]) + ((len(nodes[s]) - 1) * len(s[-1][1].encode()) if s else 0)
        below[s] = leaves, saved
        out.append((min(nodes[s]), len(s), min(nodes[s[:-1]]) if s else None, len(nodes[s]), len(kids[s]), leaves,
                    saved, hashlib.sha256(",".join(map(str, sorted(ends.get(s, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "k", "s", 1, 2, 3) for r in rows], SCHEMA)
    return sorted((tuple(r[c] for c in COLS) for r in prefixtrie.conversation_trie(df).collect()), key=str)


def random_rows(seed, n=160, words=3):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.permutation(n).tolist():
        for t in range(int(rng.integers(0, 7))):
            rows.append((c, t, ["user", "assistant"][t % 2], f"é{rng.integers(words)}" if t else "hello"))
    return rows


@pytest.mark.parametrize("seed,words", [(1, 3), (2, 1), (3, 50)])
def test_equals_brute_force(spark, seed, words):
    rows = random_rows(seed, words=words)
    assert run(spark, rows) == brute(rows)


def test_merging_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "FAN", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    small = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    kept = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        copies = [(c, t, "user", x) for c in range(1000, 1400) for t, x in enumerate(("same", "again", "end"))]
        longer = [(c, t, "user", x) for c in range(2000, 2040) for t, x in enumerate(("same", "again", "end", f"{c % 4}", "x"))]
        rows = random_rows(5, words=2) + copies + longer
        assert run(spark, rows) == brute(rows)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_nulls_repeats_long_texts_and_odd_ids(spark):
    rows = [(0, None, None, None), (0, None, "user", None), (0, 3, "user", "a" * 300_000), (0, 3, "user", "a" * 300_000),
            (1, 0, "user", ""), (1, 1, "", "x,y"), (7, 0, "user", "only"), (-3, 1, "user", "b"), (-5, 0, "user", "c"),
            (None, 0, "user", "no id"), (12, None, "user", "b"), (12, None, "user", "a"), (10, 9, "user", "9")]
    rows += [(40, t, "user", str(t)) for t in range(300)] + [(41, t, "user", str(t)) for t in range(300)]
    assert run(spark, rows) == brute(rows)


def test_one_conversation_and_none(spark):
    rows = [(5, 0, "user", "hi")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
