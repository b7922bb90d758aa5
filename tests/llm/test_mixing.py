from math import log

import numpy as np
import pytest

from quarry.llm import mixing
from tests.llm.helpers import awkward_rows, docs


def by_source(rows):
    out = {}
    for r in rows:
        s = out.setdefault(r["source"], {"tokens": 0, "used": 0, "longest": 0, "weight": r["weight"], "budget": r["budget"]})
        s["tokens"] += r["n_tokens"]
        s["used"] += r["n_tokens"] * r["copies"]
        s["longest"] = max(s["longest"], r["n_tokens"])
    return out


def test_repetition_limit_budgets_and_no_row_lost(spark):
    rows = mixing.mix(docs(spark), repeats=2.0).collect()
    assert len(rows) == len(awkward_rows())
    assert all(r["copies"] >= 1 for r in rows)
    src = by_source(rows)
    t = {s: v["tokens"] for s, v in src.items()}
    top, low = max(t.values()), min(t.values())
    a = 1 - log(2.0) / log(top / low)
    z = sum((v / sum(t.values())) ** a for v in t.values())
    for s, v in src.items():
        assert v["weight"] == pytest.approx((t[s] / sum(t.values())) ** a / z)
        assert v["budget"] == pytest.approx(t[s] * (t[s] / top) ** (a - 1), abs=1)
        assert v["budget"] - v["longest"] < v["used"] <= v["budget"]
    assert max(v["budget"] / v["tokens"] for v in src.values()) == pytest.approx(2.0, rel=1e-3)


def test_entropy_target_and_fixed_budget(spark):
    d = docs(spark)
    rows = mixing.count_words(d)
    sources = mixing.source_totals(rows.select("source", "n_tokens"))
    p = np.array([r["share"] for r in sources.collect() if r["share"] > 0])
    entropy = lambda a: (lambda w: -(w * np.log(w)).sum())(p ** a / (p ** a).sum())
    target = (entropy(0) + entropy(1)) / 2
    a = mixing.exponent(sources, entropy=target)
    assert entropy(a) == pytest.approx(target, abs=1e-9)
    assert mixing.exponent(sources, entropy=entropy(1) - 0.1) == 1.0
    assert mixing.exponent(sources, entropy=entropy(0) + 0.1) == 0.0
    budget = 3000
    src = by_source(mixing.mix(d, entropy=target, budget=budget).collect())
    for v in src.values():
        assert v["budget"] == pytest.approx(v["weight"] * budget, abs=1.01)
        assert v["budget"] - v["longest"] < v["used"] <= v["budget"]


def test_blocks_and_seeds(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    monkeypatch.setattr(mixing, "SUPER", 2)
    d = docs(spark)
    one = by_source(mixing.mix(d, repeats=1.7, seed=1).collect())
    for v in one.values():
        assert v["budget"] - v["longest"] < v["used"] <= v["budget"]
    picks = [{(r["doc_id"], r["copies"]) for r in mixing.mix(d, repeats=1.7, seed=s).collect()} for s in (1, 1, 2)]
    assert picks[0] == picks[1] != picks[2]


def test_apply_repeats_rows_and_empty(spark):
    d = docs(spark)
    want = {}
    for r in mixing.mix(d, repeats=1.5).collect():
        want[r["doc_id"]] = max(want.get(r["doc_id"], 0), r["copies"])
    rows = [r[0] for r in awkward_rows()]
    mixed = mixing.apply(d, repeats=1.5)
    assert mixed.columns == d.columns
    got = [r["doc_id"] for r in mixed.collect()]
    for i in set(rows):
        assert got.count(i) == want[i] * rows.count(i)
    empty = docs(spark, [])
    assert mixing.apply(empty, repeats=1.5).count() == 0
    blank = docs(spark, [(1, None, "", "a", 0, 1, 1, "", 1, 0.0), (2, "", "", None, 0, 1, 1, "", 1, 0.0)])
    assert sorted(r["copies"] for r in mixing.mix(blank, repeats=2.0).collect()) == [1, 1]
    with pytest.raises(ValueError):
        mixing.mix(d)
