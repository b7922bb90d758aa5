"""Conversation repair against a search over whole edit sequences."""

import functools
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import repair

SCHEMA = ("conv_id long, turn long, role string, text string, h string, copies long, last string, audit string, "
          "_k long, cost long")
COLS = [x.split()[0] for x in repair.RESULT.split(", ")]
NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damage(rows):
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield c, t, "user" if kind == 4 else role, text, {0: 0, 3: 2}.get(kind, 1)


def cheapest(rows):
    """(cost, audit) by trying every edit at every place."""
    @functools.lru_cache(None)
    def go(i, q, inserted):
        best = [(0, "")] if i == len(rows) and q in "0a" else []
        if inserted < 3:
            for c in "ua":
                if (q, c) in NEXT:
                    cost, s = go(i, NEXT[q, c], inserted + 1)
                    best.append((cost + 3, "I" + s))
        if i < len(rows):
            initial, fault = rows[i]
            cost, s = go(i + 1, q, 0)
            best.append((cost + 4, "D" + s))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                for c, price, letter in ((initial, 0, "K"), ("u", 3, "R"), ("a", 3, "R")):
                    if (q, c) in NEXT:
                        cost, s = go(i + 1, NEXT[q, c], 0)
                        best.append((cost + price + more, letter + s))
        return min(best) if best else (10 ** 9, "")
    return go(0, "0", 0)


def repaired(rows, audit):
    q, i, out = "0", 0, []
    for e in audit:
        if e in "IR":
            q = "a" if q == "u" else "u"
            out.append({"u": "user", "a": "assistant"}[q] + ":" + (rows[i][1] if e == "R" else ""))
        elif e == "K":
            q = NEXT[q, rows[i][0][:1]]
            out.append(f"{rows[i][0]}:{rows[i][1]}")
        i += e != "I"
    assert i == len(rows)
    return "\n".join(out)


def brute(rows, planted=True):
    convs = defaultdict(list)
    done = damage(rows) if planted else [(c, t, " " if r is None else r, " " if x is None else x, 1) for c, t, r, x in rows]
    for c, t, role, text, copies in done:
        mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
        convs[c] += [(t is not None, t or 0, role.encode(), mark, role, text)] * copies
    out = []
    for c, v in convs.items():
        v.sort()
        seen, faults = set(), []
        for *_, role, text in v:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else
                          "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [x[1] for x in v if x[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [x[4][:1] for x in v]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(tuple(zip(initials, faults)))
        text = repaired([x[4:] for x in v], audit)
        out.append((c, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
                    cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, planted=True):
    df = spark.createDataFrame([(*r, "h", 7, "l", "a", 1, 2) for r in rows], SCHEMA)
    return sorted((tuple(r[c] for c in COLS) for r in repair.repair(df, damage=planted).collect()), key=str)


def random_rows(seed, n=150):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, 9))):
            role = ["user", "assistant", "system", "tool", "ux", "User", ""][min(int(rng.zipf(1.6)) - 1, 6)]
            text = ["Fine.", "cut off", " \t\n\x0b", "What?  ", "", "日本!", "x "][int(rng.integers(7))] + (
                str(rng.integers(3)) + "." if rng.random() < 0.5 else "")
            rows.append((c, t + int(rng.integers(3) == 0), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("planted", [True, False])
def test_equals_brute_force(spark, seed, planted):
    rows = random_rows(seed)
    assert run(spark, rows, planted) == brute(rows, planted)


def test_nulls_repeats_long_and_empty(spark):
    rows = [(1, None, None, None), (1, None, "user", "a."), (1, 2, "assistant", None), (None, 1, "user", "q."),
            (None, None, "assistant", "r."), (2, 5, "user", "x" * 400_000), (2, 5, "user", "x" * 400_000), (2, 5, "user", "\0"),
            (-4, -9, "assistant", "only one."), (-4, 9, "system", "late."), (9, 0, "\0", ".")]
    rows += [(77, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(150)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_all_rows_dropped(spark):
    rows = [(c, t, "user", "a.") for c in range(60) for t in range(2)
            if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = run(spark, rows)
    assert got and got == brute(rows)
    assert all(r[1:-1] == (0, 0, 0, 0, 0, 0, "") and r[-1] == hashlib.sha256(b"").hexdigest() for r in got)


def test_batches_cut_conversations(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        rows = random_rows(4, 60) + [(900, t, "user", f"{t}.") for t in range(40)]
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set(key, before)
