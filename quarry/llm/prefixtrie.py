"""Prefix trie of conversations: union-find over sorted-neighbour LCP edges.

Every conversation becomes one binary key, 16 bytes (MD5 of role and text) for
each turn. The keys are range-sorted with their ids. Inside a range, edges
between sorted neighbours, weighted by their longest common prefix (LCP), are
taken in descending depth; a union joins two components at a branching node and
the unbranched turns below it become that node's chain. Nodes that cannot
reach over a border of the range are final. Those that can are prefixes of its
first or last key: this contracted forest (two spines with what was folded into
them) goes up, and neighbouring ranges are merged, some at a time, by the same
union-find until one forest is left.

What a task holds: one range of distinct keys; in merging, ``FAN`` pairs of keys
with one entry a turn. Copies of one conversation may fill many ranges: a range
adds them up while reading, and only ids of its first and last key travel on
(as text in pieces), since a SHA-256 is a chain over all of them. A key is one
row, so a single conversation is bounded by what one row can hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

FAN = 64                    # neighbouring forests merged by one task
PIECE = 1 << 20             # characters of ids in one piece on their way to a digest
TURN = 16                   # bytes a turn in a key
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
# kind 0: a node; 1: a forest's two spines; 2: a piece of ids.
ROW = ("kind int, " + NODE + ", hash binary, parent_hash binary, refs array<long>, pid long, "
       "first binary, last binary, first_bytes binary, last_bytes binary, parts binary, "
       "part_refs binary, part_digests array<string>, piece long, ids string")
_FIELDS = [x.split()[0] for x in ROW.split(", ")]
_ARROW = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
                         "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}[t])
                    for n, t in (x.split() for x in ROW.split(", "))])


# ------------------------------------------------------------------- the turns
def keyed(conversations: DataFrame) -> DataFrame:
    """``(conv_id, key, sizes)``: the key of a conversation's turns and the UTF-8
    bytes of each text. Turns stand in the order of ``turn``, null first, equal
    ones in the order of their MD5. Rows without conv_id are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn").isNotNull().alias("given"), F.coalesce(F.col("turn"), F.lit(0)).alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("h"),
        F.octet_length(text).cast("long").alias("size"))
    seq = (conversations.where(F.col("conv_id").isNotNull())
           .select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("s")))
    return seq.select("conv_id", F.unhex(F.array_join(F.col("s.h"), "")).alias("key"), F.col("s.size").alias("sizes"))


def regrafted(seqs: DataFrame, step: int = 5, spread: int = 9) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation
    c - c % step instead (all, if that has fewer; none, if it is absent), h being
    crc32 of the decimal id modulo ``spread``."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(spread)).cast("int")
    most = spread - 1
    heads = (seqs.where(F.col("conv_id") % step == 0)
             .select(F.col("conv_id").alias("base"), F.substring("key", 1, TURN * most).alias("head"),
                     F.slice("sizes", 1, most).alias("head_sizes")))
    own = seqs.withColumn("base", F.col("conv_id") - F.col("conv_id") % step).withColumn("h", h)
    no_bytes = F.lit("").cast("binary")
    head = F.coalesce(F.expr(f"substring(head, 1, {TURN} * h)"), no_bytes)
    tail = F.expr(f"substring(key, {TURN} * h + 1)")
    none = F.array().cast("array<bigint>")
    return own.join(heads, "base", "left").select(
        "conv_id", F.concat(head, tail).alias("key"),
        F.concat(F.coalesce(F.expr("slice(head_sizes, 1, h)"), none),
                 F.expr("slice(sizes, h + 1, size(sizes))")).alias("sizes"))


# ------------------------------------------------------------- one union-find
def _lcp(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common."""
    n = min(len(a), len(b)) // TURN
    if a[:n * TURN] == b[:n * TURN]:
        return n
    low = 0                                     # equal up to low, not up to n
    while n - low > 1:
        mid = (low + n) // 2
        if a[low * TURN:mid * TURN] == b[low * TURN:mid * TURN]:
            low = mid
        else:
            n = mid
    return low


class _Part:
    """What is known at one node: members, least id, children, childless nodes
    and saved bytes below it, and its own ends."""

    __slots__ = ("n", "least", "children", "leaves", "saved", "refs", "digest", "kids")

    def __init__(self, n=0, least=None, children=0, leaves=0, saved=0, refs=None, digest=None, kids=None):
        self.n, self.least, self.children, self.leaves, self.saved = n, least, children, leaves, saved
        self.refs, self.digest, self.kids = refs or [], digest, kids or []

    def add(self, o: "_Part") -> None:
        self.n += o.n
        if self.least is None or (o.least is not None and o.least < self.least):
            self.least = o.least
        self.children += o.children
        self.leaves += o.leaves
        self.saved += o.saved
        self.refs = self.refs + o.refs if o.refs else self.refs
        self.digest = self.digest or o.digest
        if len(o.kids) > len(self.kids):
            self.kids, o.kids = o.kids, self.kids
        self.kids.extend(o.kids)


class _Component:
    __slots__ = ("key", "sizes", "depth", "top", "above", "first", "last")

    def __init__(self, key, sizes, parts, first, last):
        self.key, self.sizes, self.depth = key, sizes, len(key) // TURN
        self.above = dict(parts)
        self.top = self.above.pop(self.depth, None) or _Part()
        self.first, self.last = first, last


class Forest:
    """Nodes of a sorted run of entries ``(key, sizes, {depth: _Part})``.

    ``whole``: the run has no neighbours, so every node is final. Else nodes on
    the way to the first or last entry stay open, in ``spines``."""

    def __init__(self, entries: list, whole: bool, hashed: bool):
        self.rows: list[dict] = []
        self.spines: tuple[dict, dict] = ({}, {})
        self.hashed = hashed                    # give each node its prefix hash
        n = len(entries)
        if not n:
            return
        comps = [_Component(*e, not whole and i == 0, not whole and i == n - 1) for i, e in enumerate(entries)]
        root = list(range(n))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        lcps = np.fromiter((_lcp(entries[i][0], entries[i + 1][0]) for i in range(n - 1)), np.int64, n - 1)
        for i in np.argsort(-lcps, kind="stable").tolist():
            depth, a, b = int(lcps[i]), find(i), find(i + 1)
            self._lift(comps[a], depth)
            self._lift(comps[b], depth)
            self._union(comps[a], comps[b])
            comps[b] = None
            root[b] = a
        self._lift(comps[find(0)], -1)

    @staticmethod
    def _union(a: _Component, b: _Component) -> None:
        a.top.add(b.top)
        small, large = sorted((a.above, b.above), key=len)
        for d, part in small.items():
            if d in large:
                large[d].add(part)
            else:
                large[d] = part
        a.above = large
        a.first, a.last = a.first or b.first, a.last or b.last

    def _lift(self, c: _Component, depth: int) -> None:
        """Close the nodes of the component's chain down to ``depth`` + 1."""
        while c.depth > depth:
            d, top = c.depth, c.top
            if c.first or c.last:
                mark = _prefix_hash(c.key, d)
                for row in top.kids:
                    row["parent_hash"] = mark
                top.kids = []
                self.spines[0 if c.first else 1][d] = top
                c.top = _Part()
            else:
                leaves = top.leaves if top.children else 1
                saved = top.saved + ((top.n - 1) * int(c.sizes[d - 1]) if d else 0)
                row = {"kind": 0, "conv_id": top.least, "depth": d, "n_convs": top.n, "n_children": top.children,
                       "n_leaves": leaves, "saved_tokens": saved, "refs": top.refs or None,
                       "ends_sha256": None if top.refs else top.digest or EMPTY_SHA}
                if self.hashed:
                    row["hash"] = _prefix_hash(c.key, d)
                for kid in top.kids:
                    kid["parent_conv_id"] = top.least
                self.rows.append(row)
                c.top = _Part(top.n, top.least, 1, leaves, saved, kids=[row])
            c.depth -= 1
            more = c.above.pop(c.depth, None)
            if more:
                c.top.add(more)

    def segment(self, pid: int, entries: list) -> dict:
        """The two spines as a row."""
        parts, refs, digests = [], [], []
        for side, spine in enumerate(self.spines):
            for d, p in spine.items():
                refs += [(len(parts), r) for r in p.refs]
                digests += [f"{len(parts)} {p.digest}"] if p.digest else []
                parts.append((side, d, p.n, p.least is not None, p.least or 0, p.children, p.leaves, p.saved))
        (first, first_bytes, _), (last, last_bytes, _) = entries[0], entries[-1]
        return {"kind": 1, "pid": pid, "first": first, "last": last,
                "first_bytes": np.asarray(first_bytes, "<i8").tobytes(),
                "last_bytes": np.asarray(last_bytes, "<i8").tobytes(),
                "parts": np.array(parts, "<i8").reshape(-1, 8).tobytes(),
                "part_refs": np.array(refs, "<i8").reshape(-1, 2).tobytes(), "part_digests": digests}


def _prefix_hash(key: bytes, depth: int) -> bytes:
    return hashlib.blake2b(key[:depth * TURN], digest_size=16).digest()


def _entries(segment) -> list:
    """The entries that a row of two spines stands for."""
    sides: tuple[dict, dict] = ({}, {})
    got = []
    for side, d, n, known, least, children, leaves, saved in np.frombuffer(segment.parts, "<i8").reshape(-1, 8).tolist():
        part = _Part(n, least if known else None, children, leaves, saved)
        sides[side][d] = part
        got.append(part)
    for i, r in np.frombuffer(segment.part_refs, "<i8").reshape(-1, 2).tolist():
        got[i].refs.append(r)
    for i, digest in (x.split(" ") for x in segment.part_digests):
        got[int(i)].digest = digest
    out = [(segment.first, np.frombuffer(segment.first_bytes, "<i8"), sides[0])]
    if segment.last != segment.first or sides[1]:
        out.append((segment.last, np.frombuffer(segment.last_bytes, "<i8"), sides[1]))
    return out


# -------------------------------------------------------------------- in tasks
def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(f.name) for r in rows], f.type) for f in _ARROW], schema=_ARROW)


def _batches(rows, at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), at_once):
        yield _batch(rows[i:i + at_once])


def _pieces(texts: list[str]) -> Iterator[str]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t) + 1
        if size >= PIECE:
            yield ",".join(held)
            held, size = [], 0
    if held:
        yield ",".join(held)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one sorted range."""
    pid = TaskContext.get().partitionId()
    entries: list = []
    ids: list[str] = []                         # pieces of the current key's ids
    before: list[str] = []                      # those of the first key

    def done():
        nonlocal ids, before
        part = entries[-1][2][len(entries[-1][0]) // TURN]
        if len(entries) == 1:
            part.refs, before = [2 * pid], ids
        else:
            sha = hashlib.sha256()
            for i, t in enumerate(ids):
                sha.update(("," + t if i else t).encode())
            part.digest = sha.hexdigest()
        ids = []

    for batch in batches:
        keys, convs = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if not entries or keys[a] != entries[-1][0]:
                if entries:
                    done()
                sizes = np.array(batch.column("sizes")[a].as_py(), np.int64)
                entries.append((keys[a], sizes, {len(keys[a]) // TURN: _Part(0, convs[a])}))
            entries[-1][2][len(keys[a]) // TURN].n += b - a
            ids.append(",".join(map(str, convs[a:b])))
    if not entries:
        return
    last, part = ids, entries[-1][2][len(entries[-1][0]) // TURN]
    if len(entries) == 1:
        before, last, part.refs = ids, [], [2 * pid]
    else:
        part.refs = [2 * pid + 1]
    forest = Forest(entries, False, False)
    yield from _batches(forest.rows)
    yield _batch([forest.segment(pid, entries)])
    for ref, texts in ((2 * pid, before), (2 * pid + 1, last)):
        for k, t in enumerate(_pieces(texts)):
            yield _batch([{"kind": 2, "pid": ref, "piece": k, "ids": t}])


def _merge(whole: bool):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pid")
        entries = [e for s in pdf.itertuples() for e in _entries(s)]
        forest = Forest(entries, whole, True)
        rows = forest.rows
        if not whole:
            rows.append(forest.segment(int(pdf["pid"].iloc[0]) // FAN, entries))
        return pd.DataFrame([{f: r.get(f) for f in _FIELDS} for r in rows], columns=_FIELDS).astype(
            {f.name: "Int64" for f in _ARROW if f.type in (pa.int64(), pa.int32())})
    return merge


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order."""
    node, sha, out = None, None, []
    for batch in batches:
        for h, text in zip(batch.column("hash").to_pylist(), batch.column("ids").to_pylist()):
            if h != node:
                if node is not None:
                    out.append((node, sha.hexdigest()))
                node, sha = h, hashlib.sha256()
                sha.update(text.encode())
            else:
                sha.update(b"," + text.encode())
    if node is not None:
        out.append((node, sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()),
                                      pa.array([x[1] for x in out], pa.string())], names=["hash", "sha"])


# ------------------------------------------------------------------ the trie
def trie(seqs: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the keys in ``seqs (conv_id, key,
    sizes)``, the root included: ``conv_id`` (least member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``. No conversations: no rows, not even a
    root. ``conv_id`` must be distinct."""
    spark = seqs.sparkSession
    runs = (materialise(seqs.select("conv_id", "key", "sizes"), "trie-keys")
            .repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id"))
    found = materialise(runs.mapInArrow(_ranges, ROW), "trie-ranges")
    inner, pieces, spines = found.where("kind = 0"), found.where("kind = 2"), found.where("kind = 1")
    outer: list[DataFrame] = []
    left = spines.count()
    while left:
        whole = left <= FAN
        merged = materialise(spines.withColumn("_g", F.lit(0) if whole else F.floor(F.col("pid") / FAN))
                             .groupBy("_g").applyInPandas(_merge(whole), ROW), "trie-merged")
        outer.append(merged.where("kind = 0"))
        spines = merged.where("kind = 1")
        left = 0 if whole else spines.count()
    if not outer:
        return spark.createDataFrame([], NODE)
    border = outer[0]
    for more in outer[1:]:
        border = border.unionByName(more)
    cut = border.where("refs is not null").select("hash", F.explode("refs").alias("pid"))
    shas = (cut.join(pieces.select("pid", "piece", "ids"), "pid").repartition("hash")
            .sortWithinPartitions("hash", "pid", "piece").select("hash", "ids")
            .mapInArrow(_digests, "hash binary, sha string"))
    border = border.join(shas, "hash", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "sha"))
    nodes = inner.unionByName(border.drop("sha"))
    parents = border.select(F.col("hash").alias("parent_hash"), F.col("conv_id").alias("outer_parent"))
    # The root's children, which may be nearly all nodes, need no join.
    least = border.where("depth = 0").first()["conv_id"]
    known = (nodes.where("parent_hash is null or depth = 1")
             .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.col("parent_conv_id"))))
    asked = (nodes.where("parent_hash is not null and depth > 1").join(parents, "parent_hash")
             .withColumn("parent_conv_id", F.col("outer_parent")))
    names = [x.split()[0] for x in NODE.split(", ")]
    return known.select(names).unionByName(asked.select(names))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the regrafted conversations. Null role or text is the empty
    text, a null turn comes first, rows without conv_id are left out, repeated
    rows are repeated turns; other columns are ignored."""
    cols = conversations.select("conv_id", "turn", "role", "text")
    return trie(regrafted(materialise(keyed(cols), "trie-turns")))
