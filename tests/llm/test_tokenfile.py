import zlib

import numpy as np

from quarry.llm import lengths, tokenfile
from quarry.llm.common import WordTokenizer
from quarry.session import scratch_path
from tests.llm.helpers import awkward_rows, docs


def ids_of(rows, end):
    """Ids of every row in the order of the files: null ids first, then by id and text."""
    tok = WordTokenizer().full
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    return [(r[0], tok.encode(r[1] or "", add_special_tokens=False).ids + [end]) for r in rows]


def test_one_file_answers_everything():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.zipf(1.4, 5000) % 700, [0, 49407, 49407]]).astype(np.uint16)
    file = tokenfile.build(x, np.array([4, 9]), np.array([1, 0]), np.array([4000, len(x)]), 16)
    w = tokenfile.WaveletMatrix(file)
    assert (w.tokens() == x).all()
    for i in [0, 1, 511, 512, 513, 4999, len(x) - 1, *rng.integers(0, len(x), 60)]:
        assert w.access(int(i)) == x[i]
    for t in (0, 1, 2, 17, 600, 49407, 65535, 1 << 20):
        assert (w.places(t) == np.flatnonzero(x == t)).all()
        lo, hi = sorted(rng.integers(0, len(x), 2).tolist())
        assert w.count(t) == (x == t).sum() and w.count(t, lo, hi) == (x[lo:hi] == t).sum()
    assert len(file) < 2.3 * len(x) + 400


def test_round_trip_through_files(spark):
    rows = awkward_rows()
    want, at = [], 0
    for doc, ids in ids_of(rows, 1):
        a = np.array(ids, "<u4")
        want.append((doc, at, len(a), zlib.crc32(a.tobytes())))
        at += len(a)
    path = scratch_path(spark, "files")
    tokenfile.write_files(docs(spark, rows), path, end_id=1, shard_tokens=500)
    files = tokenfile.open_files(spark, path)
    assert files.count() > 5
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.documents(files).collect())
    assert [(d, s, n, c) for s, d, n, c in got] == want
    places = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["place"])
                    for r in tokenfile.occurrences(files, 1).collect())
    assert places == sorted(((d is not None, d or 0), n - 1) for d, _, n, _ in want)


def test_empty_table(spark):
    assert tokenfile.encode_and_read(docs(spark, []), end_id=1).count() == 0
    assert lengths.context_limits(lengths.histogram(docs(spark, []))).count() == 0


def test_word_cache_equals_the_tokenizer():
    odd = ["", "  ", "É É İstanbul ǅ ß ſ K K Å", "don't it's'S 'LL x's. I'm.",
           "<|endoftext|> A <|ENDOFTEXT|>", "a b　c\x85d\x1cE", "日本語、",
           "12.5, 3,4 .. ,, a., b.,", "éÀ. ñ,", "́a ́", "ﬁ.", "ªº. a‍b"]
    odd += [r[1] or "" for r in awkward_rows()]
    tok = WordTokenizer(cap=40)                      # forgets in between
    for _ in range(2):
        got = [x.tolist() for x in tok.encode([o.encode() for o in odd])]
        assert tok.lengths([o.encode() for o in odd]).tolist() == [len(x) for x in got]
        assert got == [tok.full.encode(o, add_special_tokens=False).ids for o in odd]


def test_length_histogram_against_brute_force(spark):
    n = sorted(len(ids) for _, ids in ids_of(awkward_rows(), 1))
    limits = lengths.context_limits(lengths.histogram(docs(spark), extra=1))
    rows = {r["n_tokens"]: r for r in limits.collect()}
    assert sorted(rows) == sorted(set(n))
    for length, r in rows.items():
        assert r["n_docs"] == n.count(length)
        assert r["docs_longer"] == sum(x > length for x in n)
        assert r["tokens_longer"] == sum(x for x in n if x > length)
        assert r["truncated_tokens"] == sum(min(x, length) for x in n)
        assert r["total_tokens"] == sum(n)
    for limit in (0, 1, 5, 77, 4096, 10**6):
        assert lengths.truncated_total(limits, limit) == sum(min(x, limit) for x in n)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        k = max(0, int(np.ceil(q * len(n))) - 1)
        assert lengths.quantile(limits, q) == n[k]
