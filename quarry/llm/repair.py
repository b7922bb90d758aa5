"""Repair of conversation structure: cheapest edits by dynamic programming, the
least of the cheapest audits by prefix doubling.

A node is (rows used, state of the role automaton ``(s?(ua)+)?``); an arc is one
edit with its cost and letter. A pass from the end gives each node its cost to
the end; arcs that keep that cost are optimal. Nodes are then ranked by the
first 1, 2, 4, ... letters of their optimal paths, each round from the ranks at
both halves while pointers double; with the letters of one node's arcs all
different, its least optimal arc begins its least path. The doubled pointers then
give the n-th node of a path without walking it, and nodes of equal rank have equal
audits, so each different audit is written out once.

Two passes over rows sorted by conversation. The first carries a few bytes a row
and finds the edits of many conversations at once; the second carries the
texts, with each conversation's edits ahead of them, and streams them into the
digest. So no task holds a conversation's texts; it holds some 100 bytes a row
of one conversation in the first pass and its audit, a cell of the result, in
the second.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

# Fixed values of the task.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LETTERS = "DIKR"                                # in ASCII order
FAULTS = ("blank", "duplicate", "truncated")
INITIALS = "sua"
LEGAL = ("su", "ua", "au")

# States: 0 start, 1 after s, 2 after u, 3 after a. Number of the next state, -1: none.
_AFTER = np.array([[1, 2, -1], [-1, 2, -1], [-1, -1, 3], [-1, 2, -1]])
_FORCED = np.array([2, 2, 3, 2])                # by an inserted or reroled turn
_NAMES = {2: "user", 3: "assistant"}
_END = np.array([True, False, False, True])
_FAR = 1 << 40

STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
RESULT = f"conv_id long, {STATS}, repaired_sha256 string"


# -------------------------------------------------------------------- damage
def damaged(conversations: DataFrame, kinds: int = 20) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` after damage chosen by crc32 of
    ``conv_id:turn``: copies 0 stands for a dropped row, 2 for a repeated one."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(kinds))
    text = F.coalesce("text", blank)
    return conversations.select("conv_id", "turn", "role", "text").withColumn("_k", kind).select(
        "conv_id", "turn",
        F.when(F.col("_k") == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(F.col("_k") == 1, F.lit("")).when(F.col("_k") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.when(F.col("_k") == 0, 0).when(F.col("_k") == 3, 2).otherwise(1).alias("copies"))


def _order() -> list[Column]:
    """Rows of a conversation by turn, null first; equal turns by role and MD5 of the text."""
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h")]


def _last_char() -> Column:
    """A full stop if the last character that is not white space ends a sentence,
    x if it does not, empty if there is none."""
    last = F.right(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), F.lit(1))
    return F.when(last == "", "").when(last.isin(".", "!", "?"), ".").otherwise("x")


# ---------------------------------------------------------------- first pass
def _costs(role: np.ndarray, banned: np.ndarray, cut: np.ndarray, n: np.ndarray, first: np.ndarray):
    """Cost to the end, letter of the least optimal arc and its head, for the nodes
    4 * place + state of all conversations. ``first``: each one's first place; a
    conversation of n rows has n + 1 places."""
    places = int(first[-1] + n[-1] + 1)
    cost = np.full((places, 4), _FAR, np.int64)
    letter = np.full((places, 4), -1, np.int8)
    head = np.arange(4 * places, dtype=np.int64).reshape(places, 4)
    row_of = np.arange(places) - np.repeat(np.arange(len(n)), n + 1)
    longest_first = np.argsort(-n, kind="stable")
    sizes = n[longest_first]
    for back in range(int(n.max()) + 1):        # places counted from each end
        conv = longest_first[:np.searchsorted(-sizes, -back, side="right")]
        at = first[conv] + n[conv] - back
        options = np.full((4, len(at), 4), _FAR, np.int64)       # by letter
        heads = np.zeros((4, len(at), 4), np.int64)
        if back == 0:
            best = np.where(_END, 0, _FAR)[None, :].repeat(len(at), 0)
        else:
            row, nxt = row_of[at], at + 1
            after = cost[nxt]
            options[0] = DELETE + after
            heads[0] = 4 * nxt[:, None] + np.arange(4)
            free = ~banned[row]
            extra = np.where(cut[row], TRUNCATED, 0)[:, None]
            options[3] = np.where(free[:, None], REROLE + extra + after[:, _FORCED], _FAR)
            heads[3] = 4 * nxt[:, None] + _FORCED
            goes = np.where((role[row] >= 0)[:, None], _AFTER[:, role[row]].T, -1)
            legal = free[:, None] & (goes >= 0)
            options[2] = np.where(legal, KEEP + extra + np.take_along_axis(after, np.maximum(goes, 0), 1), _FAR)
            heads[2] = 4 * nxt[:, None] + np.maximum(goes, 0)
            best = options.min(0)
        for _ in range(3):                      # from any state three insertions reach every other
            best = np.minimum(best, INSERT + best[:, _FORCED])
        options[1] = INSERT + best[:, _FORCED]
        heads[1] = 4 * at[:, None] + _FORCED
        least = np.argmax(options == best, axis=0)
        open_end = (options == best).any(0)
        cost[at] = best
        letter[at] = np.where(open_end, least, -1)
        head[at] = np.where(open_end, np.take_along_axis(heads, least[None], 0)[0],
                            4 * at[:, None] + np.arange(4))
    return cost.ravel(), letter.ravel(), head.ravel()


def _audits(letter: np.ndarray, head: np.ndarray, starts: np.ndarray) -> list[str]:
    """The audit of each start: ranks and pointers doubled until paths end."""
    rank = np.unique(letter, return_inverse=True)[1].astype(np.int64)
    jump, jumps, length = head, [head], (letter >= 0).astype(np.int64)
    while (letter[jump] >= 0).any():
        pair = rank * (rank.max() + 1) + rank[jump]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        length = length + length[jump]
        jump = jump[jump]
        jumps.append(jump)
    _, one, which = np.unique(rank[starts], return_index=True, return_inverse=True)
    begin, size = starts[one], length[starts[one]]
    ends = np.cumsum(size)
    step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
    node = np.repeat(begin, size)
    for k, j in enumerate(jumps):
        node = np.where(step >> k & 1, j[node], node)
    text = np.frombuffer(LETTERS.encode(), np.uint8)[letter[node]].tobytes().decode()
    got = [text[e - s:e] for s, e in zip(size.tolist(), ends.tolist())]
    return [got[i] for i in which.ravel().tolist()]


def _solve(conv, turn, known, role, last, h, copies) -> pa.RecordBatch:
    """Statistics and audit of whole conversations, given their rows in order."""
    new = np.ones(len(conv), bool)
    new[1:] = [a != b for a, b in zip(conv[1:], conv[:-1])]
    number = np.cumsum(new) - 1
    ids = [conv[i] for i in np.flatnonzero(new).tolist()]
    take = np.repeat(np.arange(len(conv)), copies)
    number, turn, known = number[take], turn[take], known[take]
    role, last, h = role[take], last[take], h[take]
    k = len(ids)
    n = np.bincount(number, minlength=k)
    blank = last == ""
    order = np.lexsort((np.arange(len(h)), h, number))
    same = np.zeros(len(h), bool)
    same[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (number[order[1:]] == number[order[:-1]])
    twice = same & ~blank
    cut = ~blank & ~twice & (last != ".")
    pair = np.char.add(role[:-1], role[1:]) if len(role) else role
    inside = number[1:] == number[:-1]
    illegal = np.bincount(number[1:][inside & ~np.isin(pair, LEGAL)], minlength=k)
    gaps = np.zeros(k, np.int64)
    if known.any():
        t, who = turn[known], number[known]
        order = np.lexsort((t, who))
        t, who = t[order], who[order]
        begin = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        end = np.append(begin[1:], len(who)) - 1
        step = np.concatenate([[True], (who[1:] != who[:-1]) | (t[1:] != t[:-1])])
        gaps[who[begin]] = t[end] - t[begin] + 1 - np.bincount(who[step], minlength=k)[who[begin]]
    code = np.full(len(role), -1, np.int64)
    for i, c in enumerate(INITIALS):
        code[role == c] = i
    first = np.cumsum(n + 1) - (n + 1)
    cost, letter, head = _costs(code, blank | twice, cut, n, first)
    audit = _audits(letter, head, 4 * first)
    count = [np.bincount(number[x], minlength=k) for x in (blank, twice, cut)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (gaps, *count, illegal, cost[4 * first])),
         pa.array(audit, pa.string())],
        names=["conv_id", "gaps", *FAULTS, "illegal", "cost", "audit"])


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows in order to whole conversations; the last one waits for more."""
    held: list[pa.RecordBatch] = []

    def solve(rows: pa.Table):
        get = {c: rows.column(c) for c in rows.column_names}
        return _solve(get["conv_id"].to_pylist(),
                      get["turn"].fill_null(0).to_numpy().astype(np.int64),
                      get["turn"].is_valid().to_numpy(),
                      np.array(get["initial"].to_pylist(), dtype="U1"), np.array(get["last"].to_pylist(), dtype="U1"),
                      np.array(get["h"].to_pylist(), dtype="S16"), get["copies"].to_numpy())

    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_pylist()
        cut = next((i for i in range(len(conv) - 1, 0, -1) if conv[i - 1] != conv[-1]), 0)
        if held and held[-1].column("conv_id")[held[-1].num_rows - 1].as_py() != conv[0]:
            yield solve(pa.Table.from_batches(held))
            held = []
        if cut:
            yield solve(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield solve(pa.Table.from_batches(held))


# --------------------------------------------------------------- second pass
class _Rewrite:
    """One conversation's rows through its edits into a digest."""

    def __init__(self, head: dict):
        self.head, self.state, self.at = head, 0, 0
        self.sha, self.any = hashlib.sha256(), False

    def _line(self, role: str, text: str) -> None:
        self.sha.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode())
        self.any = True

    def _inserted(self) -> None:
        audit = self.head["audit"]
        while self.at < len(audit) and audit[self.at] == "I":
            self.state = int(_FORCED[self.state])
            self._line(_NAMES[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.head["audit"][self.at]
        self.at += 1
        if edit == "K":
            self.state = int(_AFTER[self.state, INITIALS.index(role[0])])
            self._line(role, text)
        elif edit == "R":
            self.state = int(_FORCED[self.state])
            self._line(_NAMES[self.state], text)

    def done(self) -> dict:
        self._inserted()
        return self.head | {"repaired_sha256": self.sha.hexdigest()}


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RESULT.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names)

    now, ready = None, []
    for batch in batches:
        for i in range(0, batch.num_rows, 2000):
            for r in batch.slice(i, 2000).to_pylist():
                if r["h"] is None:
                    if now:
                        ready.append(now.done())
                    now = _Rewrite({c: r[c] for c in names[:-1]})
                else:
                    for _ in range(r["copies"]):
                        now.row(r["role"], r["text"])
            if len(ready) > 2000:
                yield out(ready)
                ready = []
    if now:
        ready.append(now.done())
    yield out(ready)


def repair(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """One row for each conv_id (null is one of them): faults, the cost and audit
    of the cheapest repair and the digest of the repaired rows. ``damage``: with
    the planted damage, else the rows as they are (null role or text: one space).
    Repeated rows count as repeats, turns that are equal stand by role and MD5 of
    the text, other columns are ignored; no rows, no result."""
    if damage:
        rows = damaged(conversations)
    else:
        rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                    F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))
    rows = rows.withColumn("h", F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
                                              .cast("binary"))))
    slim = rows.select("conv_id", "turn", "role", "h", F.left("role", F.lit(1)).alias("initial"),
                       _last_char().alias("last"), "copies")
    plans = materialise(slim.repartition("conv_id").sortWithinPartitions(*_order())
                        .drop("role").mapInArrow(_plan, f"conv_id long, {STATS}"), "repair-plans")
    heads = plans.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("turn", "long"), ("role", "string"), ("text", "string"), ("copies", "int"), ("h", "binary"))])
    body = rows.where("copies > 0").select(
        "conv_id", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in STATS.split(", "))],
        F.col("turn").cast("long").alias("turn"), "role", "text", "copies", "h")
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("h").isNotNull(), F.col("turn").asc_nulls_first(), "role", "h")
    return both.mapInArrow(_rewrite, RESULT)
