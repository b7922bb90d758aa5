import re
from collections import Counter
from dataclasses import replace
from math import log10

import pytest

from quarry.llm import lm
from quarry.llm.common import crc_mod5
from tests.llm.helpers import awkward_rows, docs

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, trained, order, min_count=1, d=0.75):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(LOWER)) + ["\n"] for r in rows]
    count = [Counter() for _ in range(order + 1)]
    for r, t in zip(rows, texts):
        if trained(r[0]):
            for k in range(1, order + 1):
                count[k].update(tuple(t[i:i + k]) for i in range(len(t) - k + 1))
    n, v = sum(count[1].values()), len(count[1])
    kept, types = Counter(), Counter()
    for k in range(2, order + 1):
        for g, c in count[k].items():
            if c >= min_count:
                kept[g[:-1]] += c
                types[g[:-1]] += 1
    out = []
    for t in texts:
        base = score = 0.0
        for i, w in enumerate(t):
            p = (count[1][(w,)] + 0.5) / (n + 0.5 * (v + 1))
            base += log10(p)
            for k in range(2, order + 1):
                ctx = tuple(t[i - k + 1:i])
                if i < k - 1 or count[k - 1][ctx] < min_count:
                    continue
                c = count[k][ctx + (w,)]
                arc = (c - d) / count[k - 1][ctx] if c >= min_count else 0.0
                p = arc + (1 - (kept[ctx] - d * types[ctx]) / count[k - 1][ctx]) * p
            score += log10(p)
        out.append((len(t), sum(count[1][(w,)] > 0 for w in t), n, base, score))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


@pytest.mark.parametrize("order,min_count", [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2)])
def test_scores_match_brute_force(spark, order, min_count):
    import zlib
    rows = awkward_rows(80)
    trained = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 != 1
    p = replace(lm.Params(), order=order, min_count=min_count, block_tokens=700, range_tokens=900)
    got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                 for r in lm.score(docs(spark, rows).repartition(3), crc_mod5() != 1, p).collect()
                 if r["doc_id"] is not None)
    want = sorted((r[0], *b) for r, b in zip(rows, brute(rows, trained, order, min_count)) if r[0] is not None)
    assert len(got) == len(want) == len(rows) - 1
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], abs=1e-8)


def test_arcs_after_every_state_sum_to_one(spark):
    """Score all one-word continuations of a context; the unknown word takes the rest."""
    train = [(i, "a b a c a b a d", "", "", 0, 1, 1, "", 1, 0.0) for i in (0, 2, 3)]
    words = ["a", "b", "c", "d", "\n"]
    probe = [(100 + i, f"a {w}", "", "", 0, 1, 1, "", 1, 0.0) for i, w in enumerate(words[:-1])]
    probe += [(200, "a", "", "", 0, 1, 1, "", 1, 0.0), (201, "a zzz", "", "", 0, 1, 1, "", 1, 0.0)]
    got = {r["doc_id"]: r["score"] for r in
           lm.score(docs(spark, train + probe), crc_mod5().isNotNull() & (lm.F.col("doc_id") < 100)).collect()}
    want = {r[0]: b[4] for r, b in zip(train + probe, brute(train + probe, lambda i: i < 100, 2))}
    assert got == pytest.approx(want)
    first = lambda x: 10 ** x
    # p("a") is common to all probes; "a" alone ends at once: its second factor is p(end | a)
    single = brute([(0, "a", 0)] + train, lambda i: True, 1)
    assert all(first(x) <= 1 for x in got.values()) and single


def test_nothing_to_learn_from_and_empty(spark):
    d = docs(spark)
    rows = lm.score(d, lm.F.lit(False)).collect()
    assert len(rows) == len(awkward_rows())
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == 0 for r in rows)
    assert lm.score(docs(spark, []), crc_mod5() != 1).count() == 0
