import re

import numpy as np
import pytest

from quarry.llm import quotes
from quarry.llm.quotes import reply_order

SCHEMA = "conv_id long, turn long, role string, text string, uid long, hash string, pos int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", 2) for r in rows], SCHEMA)


def run(spark, rows):
    return {(r["conv_id"], r["turn"]): r for r in reply_order(table(spark, rows)).collect()}


def test_nested_quotes_partial_quotes_and_order(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?"),
        (1, 1, "assistant", "> hello   THERE.\n> How are you?\nFine."),
        (1, 2, "user", "Another topic\n\nwith a second paragraph"),
        (1, 3, "assistant", "On Monday X wrote:\n> Fine.\n>> How are you?\n\nglad\n"),
        (1, 4, "user", "> with a second paragraph\nyes"),
        (2, 0, "user", ">Another topic\nI saw that elsewhere"),
        (2, 1, "user", "> never said by anyone\nno"),
    ]
    got = run(spark, rows)
    parent = {k: (r["reply_conv"], r["reply_turn"]) for k, r in got.items()}
    assert parent == {(1, 0): (None, None), (1, 1): (1, 0), (1, 2): (None, None), (1, 3): (1, 1),
                      (1, 4): (1, 2), (2, 0): (1, 2), (2, 1): (None, None)}
    assert [got[k]["text"] for k in sorted(got)] == [
        rows[0][3], "Fine.", rows[2][3], "glad", "yes", "I saw that elsewhere", "no"]
    assert [got[(1, t)]["position"] for t in range(5)] == [0, 1, 3, 2, 4]
    assert got[(1, 3)]["depth"] == 2 and got[(1, 3)]["root_turn"] == 0 and got[(1, 3)]["quoted"] == 2
    assert got[(1, 3)]["linked"] == 2 and got[(2, 1)]["quoted"] == 1 and got[(2, 1)]["linked"] == 0
    assert got[(1, 1)]["formatted"] == "<|im_start|>assistant\nFine.<|im_end|>\n"


def test_last_earlier_message_wins_across_turn_buckets(spark, monkeypatch):
    monkeypatch.setattr(quotes, "TURNS", 4)
    rows = [(7, t, "user", "same words" if t in (1, 2, 9) else f"other {t}") for t in range(30)]
    rows[6] = (7, 6, "user", "> same words\nsix")
    rows[20] = (7, 20, "user", "> Same  words\ntwenty")
    rows[0] = (7, 0, "user", "> same words\nzero")        # nothing earlier
    got = run(spark, rows)
    assert got[(7, 6)]["reply_turn"] == 2 and got[(7, 20)]["reply_turn"] == 9
    assert got[(7, 0)]["reply_turn"] is None


def test_long_reply_chain_and_hot_conversation(spark):
    rows = [(3, 0, "user", "start 0")]
    rows += [(3, t, "user", f"> start {t - 1}\nstart {t}") for t in range(1, 40)]
    rows += [(4, t, "user", "hi") for t in range(500)]
    got = run(spark, rows)
    assert all(got[(3, t)]["depth"] == t and got[(3, t)]["root_turn"] == 0 for t in range(40))
    assert [got[(3, t)]["position"] for t in range(40)] == list(range(40))
    assert [got[(4, t)]["position"] for t in range(500)] == list(range(500))


def test_awkward_rows(spark):
    long = "\n".join(f"> line {i}" for i in range(3000)) + "\n" + "> " * 5000 + "deep\nend"
    rows = [(1, 0, None, None), (1, 1, "user", ""), (1, 1, "user", ""), (None, 2, "user", "> x\ny"),
            (1, None, "user", "x"), (5, 0, "user", long), (5, 1, "user", "\r\n> line 3\r\n> line 4\r\nok")]
    out = reply_order(table(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sorted(r["position"] for r in out if r["conv_id"] == 1) == [0, 1, 2, 3]
    by = {(r["conv_id"], r["turn"]): r for r in out}
    assert by[(5, 0)]["text"] == "end" and by[(5, 1)]["text"] == "ok" and by[(None, 2)]["text"] == "y"
    assert by[(1, 0)]["text"] == "" and by[(1, 0)]["formatted"] == "<|im_start|>\n<|im_end|>\n"
    assert reply_order(table(spark, [])).count() == 0


def test_plain_conversations_keep_texts_and_turns(spark):
    rng = np.random.default_rng(0)
    rows = [(c, t, "user", f"m {rng.integers(99)}\n\n a > b") for c in range(9) for t in range(int(rng.integers(1, 9)))]
    got = run(spark, rows)
    for c, t, _, text in rows:
        assert got[(c, t)]["text"] == text and got[(c, t)]["position"] == t


def test_original_in_a_conversation_with_a_larger_id(spark):
    rows = [
        (1, 0, "user", "> only said later\na"),
        (1, 1, "user", "> said in many\nb"),
        (5, 3, "user", "> said in many\nc"),
        (5, 4, "user", "said in many"),               # its own conversation, but not earlier
        (7, 2, "user", "said in many"),
        (8, 0, "user", "said in many"),
        (9, 6, "user", "only said later"),
        (9, 7, "user", "only said later"),
        (9, 8, "user", "> said by me\n> said in many"),
    ]
    got = run(spark, rows)
    parent = {k: (r["reply_conv"], r["reply_turn"]) for k, r in got.items() if r["linked"]}
    assert parent == {(1, 0): (9, 6), (1, 1): (5, 4), (5, 3): (7, 2), (9, 8): (5, 4)}
    assert all(r["depth"] == 0 and r["root_turn"] == k[1] for k, r in got.items())


def test_quotes_across_two_conversations_in_both_directions(spark):
    rows = [(1, 0, "user", "one"), (1, 1, "user", "> two\nagain"), (2, 0, "user", "two"), (2, 1, "user", "> again\nmore")]
    rows.append((1, 2, "user", "> more\nend"))
    got = run(spark, rows)
    assert [(got[k]["reply_conv"], got[k]["reply_turn"]) for k in ((1, 1), (2, 1), (1, 2))] == [(2, 0), (1, 1), (2, 1)]
    assert [got[(1, t)]["position"] for t in range(3)] == [0, 1, 2]


def test_rewrapped_quote_of_some_paragraphs(spark):
    one, two, three = "alpha beta gamma delta", "epsilon zeta\neta theta", "iota kappa"
    rows = [
        (1, 0, "user", f"{one}\n\n{two}\n \t\n{three}"),
        (1, 1, "user", "> alpha beta\n> gamma delta\n>\n> epsilon\n> zeta eta theta\nyes"),
        (1, 2, "user", "> kappa\n>\n> iota\n> kappa lambda\nno"),                     # no paragraph or line
        (2, 0, "user", "omega one two\r\n\r\nomega three\r\nfour\r\n\r\nrest"),
        (2, 1, "user", "short"),
        (2, 2, "user", "> omega three four\n>\n> short\n> of\n> rest words\nyes"),      # paragraph before line
        (2, 3, "user", "alpha\nbeta"),
        (2, 4, "user", "> alpha beta\n> gamma delta\n> \n> alpha\n> beta\n> chi\nwell"),
    ]
    got = run(spark, rows)
    parent = {k: (r["reply_conv"], r["reply_turn"]) for k, r in got.items()}
    assert parent == {(1, 0): (None, None), (1, 1): (1, 0), (1, 2): (None, None), (2, 0): (None, None),
                      (2, 1): (None, None), (2, 2): (2, 0), (2, 3): (None, None), (2, 4): (1, 0)}
    assert got[(1, 1)]["root_turn"] == 0 and got[(1, 1)]["depth"] == 1 and got[(1, 1)]["text"] == "yes"
    assert [got[(1, t)]["position"] for t in range(3)] == [0, 1, 2]


def test_whole_match_goes_before_paragraphs(spark):
    rows = [(1, 0, "user", "one two\n\nthree four"), (1, 1, "user", "one two"),
            (1, 2, "user", "> one two\n>\n> three\n> four\nyes")]
    assert run(spark, rows)[(1, 2)]["reply_turn"] == 0


def test_one_common_line_is_no_quotation(spark):
    rows = [(1, 0, "user", "Hi,\nthe first message"), (2, 0, "user", "> Hi,\n> unheard of words here\n> and more never said\nok"),
            (1, 1, "user", "> Hi,\n> the first message\n> added by hand\nwell"),
            (3, 0, "user", "Hi,\nlong line of the original text\nend"),
            (3, 1, "user", "Hi,"), (3, 2, "user", "> Hi,\n> long line of the original text\n> not said\nyes")]
    got = run(spark, rows)
    parent = {k: (r["reply_conv"], r["reply_turn"]) for k, r in got.items() if r["linked"]}
    assert parent == {(1, 1): (1, 0), (3, 2): (3, 0)}


# ------------------------------------------------------------- brute force
def norm(x):
    return re.sub(r"\s+", " ", x.lower()).strip(" ")


def kinds(text):
    cut = [[text], re.split(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)", text), re.split(r"\r\n|\r|\n", text)]
    return [list(dict.fromkeys(x for x in map(norm, c) if x)) for c in cut]


def taken_apart(text):
    """Own text and passages (level, text) of a message."""
    lines = []
    for x in re.split(r"\r\n|\r|\n", text):
        mark = re.match(r"[ \t>]*>", x)
        body = x[len(mark.group()):] if mark else x
        lines.append((mark.group().count(">") if mark else 0, body[1:] if body.startswith(" ") else body))
    if not any(n for n, _ in lines):
        return text, []
    lines = [(n, b) for i, (n, b) in enumerate(lines)
             if not (n == 0 and re.match(r"\s*On .* wrote:\s*$", b) and i + 1 < len(lines) and lines[i + 1][0])]
    runs = []
    for n, b in lines:
        if runs and runs[-1][0] == n:
            runs[-1][1].append(b)
        else:
            runs.append((n, [b]))
    own = "\n".join(b for n, b in lines if n == 0).strip()
    return own, [(n, "\n".join(b)) for n, b in runs if n]


def brute_parents(rows):
    own, passages, have = {}, {}, {}
    for c, t, _, text in rows:
        own[c, t], passages[c, t] = taken_apart(text)
        for u in {x for k in kinds(own[c, t]) for x in k}:
            have.setdefault(u, set()).add((c, t))

    def original(c, t, unit):
        mine = [m for m in have.get(unit, ()) if m[0] == c and m[1] < t]
        others = [m for m in have.get(unit, ()) if m[0] != c]
        return (max(mine), 1) if mine else (min(others), 0) if others else None

    out = {}
    for (c, t), quoted in passages.items():
        links = []
        for level, passage in quoted:
            best = []
            for whole, pieces in zip((2, 1, 0), kinds(passage)):
                covered = {}
                for x in pieces:
                    got = original(c, t, x)
                    if got:
                        covered[got] = covered.get(got, 0) + len(x)
                best += [(whole, n, same, m[1], m[0]) for (m, same), n in covered.items()
                         if whole or 2 * n > sum(map(len, pieces))]
            if best:
                links.append((-level, max(best)[2], max(best)[3], max(best)[4]))
        top = max(((lv, int(oc == c), ot, oc) for lv, _, ot, oc in links), default=None)
        out[c, t] = (own[c, t], len(links), (top[3], top[2]) if top else (None, None))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_threads_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    common = ["Hi,", "thanks", "see below", "bye"]

    def line():
        return common[rng.integers(4)] if rng.random() < 0.3 else " ".join(f"w{x}" for x in rng.integers(0, 40, rng.integers(1, 6)))

    rows = []
    for c in range(14):
        mine = []
        for t in range(int(rng.integers(1, 9))):
            parts = []
            for _ in range(int(rng.integers(0, 3))):
                pool = mine if mine and rng.random() < 0.8 else [r[3] for r in rows] or ["nothing"]
                said = taken_apart(pool[rng.integers(len(pool))])[0].split("\n")
                some = [x for x in said if rng.random() < 0.8] + [line() for _ in range(int(rng.integers(0, 2)))]
                mark = ["> ", ">", ">> ", "> > "][rng.integers(4)]
                if rng.random() < 0.3:
                    parts.append("On some day X wrote:")
                parts += [mark + x for x in some]
                parts += ["", line()] if rng.random() < 0.7 else [""]
            paragraphs = ["\n".join(line() for _ in range(int(rng.integers(1, 4)))) for _ in range(int(rng.integers(1, 4)))]
            text = "\n".join(parts + ["\n\n".join(paragraphs)])
            rows.append((c, t, "user", text))
            mine.append(text)
    got, want = run(spark, rows), brute_parents(rows)
    linked = 0
    for k, (own, n, parent) in want.items():
        assert (got[k]["text"], got[k]["linked"], (got[k]["reply_conv"], got[k]["reply_turn"])) == (own, n, parent), k
        linked += n
    assert linked > 5
