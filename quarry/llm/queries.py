"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (lengths, lm, maintext, mixing, packing, prefixtrie, quotes, repair, search, simhash, tokenfile,
               toxicity, vptree)
from .common import crc_mod5, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql.strip()
        return fn
    return deco


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, crc_mod5() != 0)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(crc_mod5() == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP2_SQL = """
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''),
             '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS n_tokens FROM documents),
s AS (SELECT source, count(*) AS n_rows, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
t AS (SELECT sum(tokens)::DOUBLE AS total FROM s),
p AS (SELECT s.*, CASE WHEN tokens > 0 THEN ln(tokens / total) END AS lp FROM s, t),
m AS (SELECT min(lp) AS lo, max(lp) AS hi, greatest(0.0, 1 - ln(2.0) / nullif(max(lp) - min(lp), 0)) AS a0
      FROM p WHERE tokens > 0),
e AS (SELECT lo, hi, coalesce(a0, 1.0) AS a FROM m),
z AS (SELECT sum(exp(lp * a)) AS z FROM p, e WHERE tokens > 0),
b AS (SELECT source, n_rows, tokens, exp(lp * a) / z AS weight,
        greatest(tokens, round(exp(lp * (a - 1)) * exp(-(a - 1) * hi) * tokens)::BIGINT) AS budget,
        ceil(n_rows / 512.0)::BIGINT AS n_blocks FROM p, e, z),
h AS (SELECT d.*, b.tokens, b.weight, b.budget, b.n_blocks, budget % tokens AS rest,
        ('0x' || substr(md5('1|' || doc_id), 1, 15))::BIGINT AS h FROM d JOIN b USING (source)),
k AS (SELECT *, h % n_blocks AS block, ('0x' || substr(md5('2|' || (h % n_blocks)), 1, 15))::BIGINT AS o FROM h),
o AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source
        ORDER BY (o >> 30) % ceil(n_blocks / 256.0)::BIGINT, o, block, h, doc_id
        ROWS UNBOUNDED PRECEDING) AS run FROM k)
SELECT doc_id, source, n_tokens, round(weight, 9) AS weight, budget,
       budget // tokens + CASE WHEN rest > 0 AND run <= rest THEN 1 ELSE 0 END AS copies FROM o
"""


@register("op2_mixing", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No source repeated over twice, none cut."""
    return (mixing.mix(table(spark, sf_dir, "documents"), repeats=2.0)
            .select("doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"),
                    "budget", "copies"))


OP3_SQL = """
WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS term FROM documents),
t AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM w GROUP BY ALL),
l AS (SELECT d.doc_id, coalesce(sum(tf), 0) AS len FROM documents d LEFT JOIN t USING (doc_id) GROUP BY 1),
n AS (SELECT count(*)::DOUBLE AS n, sum(len) / count(*) AS mean FROM l),
f AS (SELECT term, count(*)::DOUBLE AS df FROM t GROUP BY term),
p AS (SELECT t.doc_id, t.term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
        / (tf + 1.2 * (0.25 + 0.75 * len / mean)) AS weight FROM t JOIN l USING (doc_id) JOIN f USING (term), n),
s AS (SELECT q.doc_id AS query_id, p.doc_id, round(sum(p.weight), 9) AS s
      FROM t q JOIN p USING (term) WHERE q.doc_id % 20 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, doc_id, round(s, 6) AS score FROM r WHERE rank <= 10
"""


@register("op3_top_k_search", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 20, as a whole, against all."""
    docs = table(spark, sf_dir, "documents")
    got = search.top_k(docs, docs.where("doc_id % 20 = 0"))
    return got.withColumn("score", F.round("score", 6))


@register("op4_lm_score")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lm.score(table(spark, sf_dir, "documents"), crc_mod5() != 1)
    return got.select("doc_id", F.coalesce(crc_mod5() == 1, F.lit(True)).alias("held_out"), "n_tokens",
                      "n_known", "train_tokens", "base_score", "score")


@register("op5_token_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.encode_and_read(table(spark, sf_dir, "documents"), end_id=1)


@register("op6_quotation_linking")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


@register("op7_length_histogram")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every length as a context limit, one end token per document."""
    return lengths.context_limits(lengths.histogram(table(spark, sf_dir, "documents"), extra=1))


@register("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), end_id=0)


OP9_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)
        / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS s
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, round(s, 12) AS score FROM r WHERE rank <= 5
"""


@register("op9_nearest_vectors", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor one: exact, the recall is one. Twelve places hide the last bits,
    in which two ways of summing differ."""
    got = vptree.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, factor=1.0)
    return got.withColumn("score", F.round("score", 12))


@register("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return got.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def crc32_sql(text: str) -> str:
    """DuckDB has no crc32: bit by bit over the ASCII characters of ``text``."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({text}, ''),
      lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""


OP11_SQL = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
           WHERE conv_id IS NOT NULL),
k AS (SELECT c, turn, md5(strlen(role) || ':' || role || text) AS k, strlen(text)::BIGINT AS nb FROM t),
o AS (SELECT c, k, nb, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) - 1 AS pos FROM k),
h AS (SELECT c, {crc32_sql('c::VARCHAR')} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT h.c, 0 AS own, pos, k, nb FROM h JOIN o ON o.c = h.c - h.c % 5 AND pos < h
      UNION ALL SELECT h.c, 1, pos, k, nb FROM h JOIN o ON o.c = h.c AND pos >= h),
d AS (SELECT c, k, nb, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d FROM r),
p AS (SELECT c, d, nb, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS node FROM d
      UNION ALL SELECT c, 0, 0, '' FROM h),
l AS (SELECT c, max(d) AS len FROM p GROUP BY c),
n AS (SELECT node, d, any_value(nb) AS nb, min(c) AS conv, count(*) AS n,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = len), '')) AS ends
      FROM p JOIN l USING (c) GROUP BY node, d),
f AS (SELECT n.*, up.node AS up FROM n LEFT JOIN p up ON up.c = n.conv AND up.d = n.d - 1),
c AS (SELECT up AS node, count(*) AS kids FROM f WHERE up IS NOT NULL GROUP BY up),
g AS (SELECT f.*, coalesce(kids, 0) AS kids FROM f LEFT JOIN c USING (node)),
s AS (SELECT p.node, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * g.nb) AS saved
      FROM g JOIN p ON p.c = g.conv AND p.d <= g.d GROUP BY p.node)
SELECT g.conv AS conv_id, g.d::BIGINT AS depth, up.conv AS parent_conv_id, g.n::BIGINT AS n_convs,
       g.kids::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, g.ends AS ends_sha256
FROM g JOIN s USING (node) LEFT JOIN n up ON up.node = g.up
"""


@register("op11_conversation_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


OP12_SQL = """
WITH b AS (SELECT page_id, url, list_transform(regexp_split_to_array(
             regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</?(p|h1|br)>'),
             lambda x: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'),
               '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '[ \\t\\n\\r\\f]+', ' ', 'g'))) AS blocks FROM pages),
t AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, coalesce(text, '') AS text, coalesce(length(text), 0)::BIGINT AS n_chars FROM t
"""


@register("op12_html_extraction", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL reads the given pages' only article by its tags."""
    return maintext.extract(table(spark, sf_dir, "pages"))


def _least_sql(state: int) -> str:
    """The cheapest edit, then ASCII-least audit, of the first row from ``state`` of the role
    automaton (0 start, 1 after s, 2 after u, 3 after a), given s0 .. s3 of what follows: nine
    digits of cost, then letters."""
    def step(to: int, cost: str, letter: str) -> str:
        return f"lpad((left(s{to}, 9)::INT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr(s{to}, 10)"

    goes = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
    forced = goes.get("u", goes.get("a"))
    keep = " ".join(f"WHEN initial = '{c}' THEN {step(to, 'IF(cut, 3, 0)', 'K')}" for c, to in goes.items())
    return (f"least({step(state, '4', 'D')}, CASE WHEN gone THEN 'x' {keep} ELSE 'x' END, "
            f"CASE WHEN gone THEN 'x' ELSE {step(forced, 'IF(cut, 6, 3)', 'R')} END)")


def _inserted_sql(inner: str, keep: str) -> str:
    """s0 .. s3 once more, with up to three insertions ahead."""
    for _ in range(3):
        add = lambda q: f"lpad((left(s{q}, 9)::INT + 3)::VARCHAR, 9, '0') || 'I' || substr(s{q}, 10)"
        inner = (f"SELECT {keep}, least(s0, {add(2)}) AS s0, least(s1, {add(2)}) AS s1, least(s2, {add(3)}) AS s2, "
                 f"least(s3, {add(2)}) AS s3 FROM ({inner})")
    return inner


OP13_SQL = f"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
c AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM o)),
d AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN ''
        WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM o JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id),
r AS (SELECT *, md5(strlen(role) || ':' || role || text) AS h, regexp_extract(text, '([^ \t\n\x0B\f\r])[ \t\n\x0B\f\r]*$', 1) AS last,
        left(role, 1) AS initial FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, h, copy) AS i,
        row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM r),
f AS (SELECT *, last = '' AS blank, last <> '' AND again AS twice, last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS cut,
        last = '' OR again AS gone, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair FROM n),
g AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
        count_if(twice) AS duplicate, count_if(cut) AS truncated,
        count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY c),
e AS (SELECT c, coalesce(n, 0) AS n FROM c LEFT JOIN g USING (c)),
b AS ({_inserted_sql("SELECT c, n AS i, '000000000' AS s0, 'x' AS s1, 'x' AS s2, '000000000' AS s3 FROM e", "c, i")
       .replace("left(s1, 9)::INT", "try_cast(left(s1, 9) AS INT)").replace("left(s2, 9)::INT", "try_cast(left(s2, 9) AS INT)")}
  UNION ALL
  {_inserted_sql("SELECT b.c, b.i - 1 AS i, " + ", ".join(f"{_least_sql(q)} AS s{q}" for q in range(4))
                 + " FROM b JOIN f ON f.c = b.c AND f.i = b.i", "c, i")}),
a AS (SELECT c, left(s0, 9)::BIGINT AS cost, substr(s0, 10) AS audit FROM b WHERE i = 0),
w AS (SELECT c, 1 AS p, 0 AS i, 0 AS q, '' AS text FROM a
  UNION ALL
  SELECT c, p + 1, i + (e <> 'I')::INT, q, text || CASE WHEN e = 'D' THEN '' ELSE IF(text = '', '', chr(10)) || line END FROM (
    SELECT w.c, p, w.i, substr(audit, p, 1) AS e, w.text,
      CASE WHEN e = 'D' THEN q WHEN e = 'K' THEN CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
        WHEN q = 2 THEN 3 ELSE 2 END AS q,
      CASE WHEN e = 'K' THEN f.role ELSE CASE WHEN w.q = 2 THEN 'assistant' ELSE 'user' END END || ':'
        || CASE WHEN e = 'I' THEN '' ELSE f.text END AS line
    FROM w JOIN a USING (c) LEFT JOIN f ON f.c = w.c AND f.i = w.i + 1 WHERE p <= length(audit)))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost, audit, sha256(w.text) AS repaired_sha256
FROM c LEFT JOIN g USING (c) JOIN a USING (c) JOIN w ON w.c = c.c AND w.p = length(audit) + 1
"""


@register("op13_conversation_repair", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
