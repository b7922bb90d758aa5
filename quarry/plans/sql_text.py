"""DuckDB SQL of the text jobs that take more than a line: stemming, features,
naive Bayes, trees. Stated from the definitions, step by step, and not from the
way the Spark jobs work: masks of vowels and consonants instead of a scan, dense
cells instead of sparse sums, joins instead of a walk down a tree.
"""

from __future__ import annotations

from ..functions.porter import IRREGULAR, STEP2, STEP3, STEP4
from ..operators.trees import DRAWS, POISSON


def _mask(w: str) -> str:
    """v for vowels, c for consonants; y is a vowel after a consonant."""
    return (f"list_reduce(list_prepend('', string_split({w}, '')), lambda a, x: a || CASE WHEN x IN "
            "('a','e','i','o','u') OR (x = 'y' AND ends_with(a, 'c')) THEN 'v' ELSE 'c' END)")


def _measure(n: str) -> str:
    return f"((length(left(m, {n})) - length(replace(left(m, {n}), 'vc', ''))) // 2)"


def _cvc(n: str) -> str:
    return f"({n} >= 3 AND substr(m, {n} - 2, 3) = 'cvc' AND substr(w, {n}, 1) NOT IN ('w','x','y'))"


def _cut(k: int) -> str:
    return f"(length(w) - {k})"


def _bare(k: int) -> str:
    n = _cut(k)
    return f"""CASE WHEN NOT contains(left(m, {n}), 'v') THEN w
      WHEN right(left(w, {n}), 2) IN ('at', 'bl', 'iz') THEN left(w, {n}) || 'e'
      WHEN {n} >= 2 AND substr(w, {n}, 1) = substr(w, {n} - 1, 1) AND substr(m, {n}, 1) = 'c'
        AND substr(w, {n}, 1) NOT IN ('l','s','z') THEN left(w, {n} - 1)
      WHEN {_measure(n)} = 1 AND {_cvc(n)} THEN left(w, {n}) || 'e' ELSE left(w, {n}) END"""


def _rules(rules, least: int, also=None) -> str:
    whens = []
    for suffix, put in sorted(rules, key=lambda r: -len(r[0])):
        n = _cut(len(suffix))
        more = f" AND right(left(w, {n}), 1) IN ('s', 't')" if suffix == also else ""
        whens.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {_measure(n)} > {least}{more} "
                     f"THEN left(w, {n}) || '{put}' ELSE w END")
    return "CASE " + " ".join(whens) + " ELSE w END"


_IE = f"CASE WHEN length(w) = 4 THEN left(w, {_cut(1)}) ELSE left(w, {_cut(2)}) END"
_STEPS = [
    f"CASE WHEN ends_with(w, 'sses') THEN left(w, {_cut(2)}) WHEN ends_with(w, 'ies') THEN {_IE} "
    f"WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN left(w, {_cut(1)}) ELSE w END",
    f"CASE WHEN ends_with(w, 'ied') THEN {_IE} WHEN ends_with(w, 'eed') THEN CASE WHEN {_measure(_cut(3))} > 0 "
    f"THEN left(w, {_cut(1)}) ELSE w END WHEN ends_with(w, 'ed') THEN {_bare(2)} "
    f"WHEN ends_with(w, 'ing') THEN {_bare(3)} ELSE w END",
    f"CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND substr(m, length(w) - 1, 1) = 'c' "
    f"THEN left(w, {_cut(1)}) || 'i' ELSE w END",
    _rules(STEP2, 0), _rules(STEP3, 0), _rules([(s, "") for s in STEP4], 1, also="ion"),
    f"CASE WHEN ends_with(w, 'e') AND ({_measure(_cut(1))} > 1 OR ({_measure(_cut(1))} = 1 AND NOT {_cvc(_cut(1))})) "
    f"THEN left(w, {_cut(1)}) ELSE w END",
    f"CASE WHEN ends_with(w, 'll') AND {_measure('length(w)')} > 1 THEN left(w, {_cut(1)}) ELSE w END",
]


def stems(words: str) -> str:
    """CTEs ending in ``stems (term, stem)`` for the distinct terms of ``words``."""
    out = [f"st0 AS (SELECT term, term AS w, {_mask('term')} AS m FROM (SELECT DISTINCT term FROM {words}))"]
    for i, step in enumerate(_STEPS):
        out.append(f"st{i + 1} AS (SELECT term, w, {_mask('w')} AS m FROM (SELECT term, {step} AS w FROM st{i}))")
    odd = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    out.append(f"stems AS MATERIALIZED (SELECT term, CASE term {odd} ELSE CASE WHEN length(term) <= 2 THEN term ELSE w END "
               f"END AS stem FROM st{len(_STEPS)})")
    return ",\n".join(out)


# ------------------------------------------------------------------- features
FEATURES = """
dset AS (SELECT doc_id, liked, 'train' AS split FROM bal
         UNION ALL SELECT doc_id, liked, split FROM sp WHERE split = 'test'),
fc AS (SELECT d.doc_id, d.split, stem, count(*) AS n FROM ut JOIN stems USING (term) JOIN dset d USING (doc_id)
       WHERE length(stem) >= 2 GROUP BY ALL),
fv AS (SELECT stem, sum(n) AS cn FROM fc WHERE split = 'train' GROUP BY stem ORDER BY cn DESC, stem LIMIT 200),
vo AS (SELECT stem, row_number() OVER (ORDER BY stem) - 1 AS j FROM fv),
den AS (SELECT d.doc_id, d.split, d.liked AS y, vo.j, coalesce(fc.n, 0)::DOUBLE AS n
        FROM dset d CROSS JOIN vo LEFT JOIN fc ON fc.doc_id = d.doc_id AND fc.stem = vo.stem),
lh AS (SELECT j, min(n) AS lo, max(n) AS hi FROM den WHERE split = 'train' GROUP BY j),
x AS MATERIALIZED (SELECT doc_id, split, y, j, CASE WHEN hi = lo THEN 0.0 ELSE (n - lo) / (hi - lo) END AS v
                   FROM den JOIN lh USING (j))"""

# --------------------------------------------------------------- naive Bayes
BAYES = """
nc AS (SELECT liked AS y, count(*)::DOUBLE AS n FROM dset WHERE split = 'train' GROUP BY liked),
nt AS (SELECT sum(n) AS total FROM nc),
mo AS (SELECT y, j, sum(v) AS s, sum(v * v) AS q FROM x WHERE split = 'train' GROUP BY y, j),
ep AS (SELECT 1e-9 * max(greatest(q / total - (s / total) ** 2, 0)) AS e
       FROM (SELECT j, sum(s) AS s, sum(q) AS q FROM mo GROUP BY j), nt),
pa AS (SELECT y, j, s / n AS mu, greatest(q / n - (s / n) ** 2, 0) + e AS va, ln(n / total) AS lp
       FROM mo JOIN nc USING (y), nt, ep),
sc AS (SELECT x.doc_id, x.y AS label, pa.y AS c, any_value(lp) + sum(-0.5 * ln(va) - 0.5 * (v - mu) ** 2 / va) AS l
       FROM x JOIN pa USING (j) WHERE split = 'test' GROUP BY ALL),
nb AS (SELECT doc_id, label, arg_max(c, (l, -c)) AS prediction FROM sc GROUP BY doc_id, label)"""


# ---------------------------------------------------------------------- trees
def trees(name: str, n: int, depth: int, draw: str, min_split: int, min_leaf: int, seed: int, poisson: bool) -> str:
    """CTEs ending in ``<name> (doc_id, label, prediction)``, named after ``name``."""
    p = name
    if poisson:
        u = (f"('0x' || substr(md5('{seed}|' || (t // {DRAWS}) || '|' || doc_id), "
             f"(t % {DRAWS}) * 4 + 1, 4))::INT")
        weight = "(" + " + ".join(f"({u} >= {c})::INT" for c in POISSON) + ")"
    else:
        weight = "1"
    out = [f"{p}w AS MATERIALIZED (SELECT t, doc_id, liked AS y, split, 1 AS node, "
           f"CASE WHEN split = 'train' THEN {weight} ELSE 0 END AS w FROM dset CROSS JOIN range({n}) g(t))"]
    rows = f"{p}w"
    for d in range(depth):
        k = f"{p}{d}"
        out.append(f"""
{k}n AS (SELECT t, node FROM {rows} WHERE w > 0 GROUP BY t, node
         HAVING count(*) >= {min_split} AND sum(w * y) > 0 AND sum(w * y) < sum(w)),
{k}c AS (SELECT t, node, j, v, sum(w) AS w, sum(w * r.y) AS p, count(*) AS c
         FROM {rows} r JOIN {k}n USING (t, node) JOIN x USING (doc_id) WHERE w > 0 GROUP BY t, node, j, v),
{k}o AS (SELECT t, node, j, row_number() OVER (PARTITION BY t, node
           ORDER BY md5('{seed}|' || t || '|' || node || '|' || j)) AS r FROM {k}n CROSS JOIN vo),
{k}s AS (SELECT c.*, r, count(*) OVER f > 1 AS moves, lead(v) OVER (PARTITION BY t, node, j ORDER BY v) AS nx,
           sum(w) OVER g AS lw, sum(p) OVER g AS lp, sum(c) OVER g AS lc, sum(w) OVER f AS aw, sum(p) OVER f AS ap,
           sum(c) OVER f AS ac FROM {k}c c JOIN {k}o USING (t, node, j)
         WINDOW f AS (PARTITION BY t, node, j), g AS (PARTITION BY t, node, j ORDER BY v ROWS UNBOUNDED PRECEDING)),
{k}l AS (SELECT t, node, greatest({draw}, min(r)) AS lim FROM {k}s WHERE moves GROUP BY t, node),
{k}g AS (SELECT t, node, j, r, (v + nx) / 2 AS cut, round((lp * lp + (lw - lp) * (lw - lp))::DOUBLE / lw
           + ((ap - lp) * (ap - lp) + (aw - lw - ap + lp) * (aw - lw - ap + lp))::DOUBLE / (aw - lw), 9) AS gain
         FROM {k}s JOIN {k}l USING (t, node)
         WHERE r <= lim AND nx IS NOT NULL AND lc >= {min_leaf} AND ac - lc >= {min_leaf}),
{k}b AS (SELECT t, node, j, cut FROM {k}g
         QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, r, cut) = 1),
{k}w AS MATERIALIZED (SELECT r.t, r.doc_id, r.y, r.split, r.w, CASE WHEN b.j IS NULL THEN r.node
           ELSE 2 * r.node + (x.v > b.cut)::INT END AS node
         FROM {rows} r LEFT JOIN {k}b b USING (t, node) LEFT JOIN x ON x.doc_id = r.doc_id AND x.j = b.j)""")
        rows = f"{k}w"
    out.append(f"""
{p}l AS (SELECT t, node, sum(w * y)::DOUBLE / sum(w) AS share FROM {rows} WHERE w > 0 GROUP BY t, node),
{p} AS (SELECT r.doc_id, r.y AS label, (round(sum(coalesce(share, 0)) / {n}, 9) - 0.5 > 0)::INTEGER AS prediction
        FROM {rows} r LEFT JOIN {p}l USING (t, node) WHERE split = 'test' GROUP BY r.doc_id, r.y)""")
    return ",\n".join(out)


DRAW_ALL = "(SELECT greatest(1, floor(sqrt(count(*)))::INT) FROM vo)"
TREE = trees("dt", 1, 2, "2", 5, 5, 0, False)
FOREST = trees("rf", 100, 3, DRAW_ALL, 2, 1, 0, True)


# ------------------------------------------------------------------- logistic
def newton(points: str, rounds: int) -> str:
    """CTEs ``nr1 .. nr<rounds> (a, b, c)`` of logistic regression on ``points (u, v,
    y)``: penalty (a^2 + b^2) / 2, free intercept c, full Newton steps from zero."""
    out = ["nr0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c)"]
    for i in range(rounds):
        out.append(f"""
np{i} AS (SELECT u, v, y, 1 / (1 + exp(-(a * u + b * v + c))) AS p FROM {points}, nr{i}),
ns{i} AS (SELECT sum((p - y) * u) AS g1, sum((p - y) * v) AS g2, sum(p - y) AS g3, sum(p * (1 - p) * u * u) AS h11,
   sum(p * (1 - p) * u * v) AS h12, sum(p * (1 - p) * u) AS h13, sum(p * (1 - p) * v * v) AS h22,
   sum(p * (1 - p) * v) AS h23, sum(p * (1 - p)) AS h33 FROM np{i}),
nq{i} AS (SELECT a, b, c, g1 + a AS g1, g2 + b AS g2, g3, h11 + 1 AS h11, h12, h13, h22 + 1 AS h22, h23, h33 FROM ns{i}, nr{i}),
nd{i} AS (SELECT *, h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h23 * h13) + h13 * (h12 * h23 - h22 * h13) AS det FROM nq{i}),
nr{i + 1} AS (SELECT
   a - (g1 * (h22 * h33 - h23 * h23) - h12 * (g2 * h33 - h23 * g3) + h13 * (g2 * h23 - h22 * g3)) / det AS a,
   b - (h11 * (g2 * h33 - h23 * g3) - g1 * (h12 * h33 - h23 * h13) + h13 * (h12 * g3 - g2 * h13)) / det AS b,
   c - (h11 * (h22 * g3 - g2 * h23) - h12 * (h12 * g3 - g2 * h13) + g1 * (h12 * h23 - h22 * h13)) / det AS c FROM nd{i})""")
    return ",\n".join(out)


# ---------------------------------------------- models found by plain descent
# The Spark jobs take Newton steps; here the same objectives are minimised by
# accelerated gradient steps of a fixed length.
DENSE = """
xr AS MATERIALIZED (SELECT doc_id, split, y, list(v ORDER BY j) AS f, list_append(list(v ORDER BY j), 1.0) AS f1
                    FROM x GROUP BY doc_id, split, y)"""


def logistic(rounds: int = 500) -> str:
    """CTEs ending in ``lg (doc_id, label, prediction)``: |w|^2 / 2 + log losses, free intercept."""
    return f"""
lc AS (SELECT l, (sqrt(l) - 1) / (sqrt(l) + 1) AS th FROM (
  SELECT 1 + 0.25 * sum(list_dot_product(f1, f1)) AS l FROM xr WHERE split = 'train')),
lw AS (SELECT 0 AS i, list_transform(f1, lambda q: 0.0::DOUBLE) AS w, list_transform(f1, lambda q: 0.0::DOUBLE) AS u
       FROM (SELECT any_value(f1) AS f1 FROM xr)
  UNION ALL
  SELECT i + 1, nw, list_transform(nw, lambda q, k: q + th * (q - w[k])) FROM (
    SELECT i, w, th, list_transform(u, lambda q, k: q - (g[k] + CASE WHEN k < len(u) THEN q ELSE 0 END) / l) AS nw
    FROM lw, lc, (SELECT list(s ORDER BY j) AS g FROM (SELECT j, sum(r * v) AS s FROM (
      SELECT unnest(f1) AS v, generate_subscripts(f1, 1) AS j, 1 / (1 + exp(-list_dot_product(f1, u))) - y AS r
      FROM xr, lw WHERE split = 'train') GROUP BY j))
    WHERE i < {rounds})),
lg AS (SELECT doc_id, y AS label, (list_dot_product(f1, w) > 0)::INTEGER AS prediction
       FROM xr, (SELECT w FROM lw WHERE i = {rounds}) WHERE split = 'test')"""


def svm(rounds: int = 3000, corner: float = 0.01) -> str:
    """CTEs ending in ``sv (doc_id, label, prediction)``: |f|^2 / 2 + hinge losses over the
    functions that kernels at the training rows span, free intercept."""
    return f"""
ga AS (SELECT CASE WHEN var_pop(v) > 0 THEN 1 / (count(DISTINCT j) * var_pop(v)) ELSE 1 END AS gamma FROM x WHERE split = 'train'),
kr AS MATERIALIZED (SELECT a.doc_id, a.split, a.y, list(exp(-gamma * list_distance(a.f, b.f) ** 2) ORDER BY b.doc_id) AS q
  FROM xr a, xr b, ga WHERE b.split = 'train' GROUP BY a.doc_id, a.split, a.y),
kt AS MATERIALIZED (SELECT q, 2.0 * y - 1 AS s, doc_id FROM kr WHERE split = 'train'),
sc0 AS (SELECT l, (sqrt(l) - 1) / (sqrt(l) + 1) AS th, z FROM (
  SELECT 1 + (max(list_sum(q)) + count(*)) / {corner} AS l, list_transform(any_value(q), lambda e: 0.0::DOUBLE) AS z FROM kt)),
sw AS (SELECT 0 AS i, z AS a, 0.0::DOUBLE AS b, z AS ua, 0.0::DOUBLE AS ub FROM sc0
  UNION ALL
  SELECT i + 1, na, nb, list_transform(na, lambda q, k: q + th * (q - a[k])), nb + th * (nb - b) FROM (
    SELECT i, a, b, th, list_transform(ua, lambda q, k: q - (q + d[k]) / l) AS na, ub - list_sum(d) / l AS nb
    FROM sw, sc0, (SELECT list(-s * least(greatest((1 - m) / {corner}, 0), 1) ORDER BY doc_id) AS d FROM (
      SELECT doc_id, s, s * (list_dot_product(q, ua) + ub) AS m FROM kt, sw))
    WHERE i < {rounds})),
sv AS (SELECT doc_id, y AS label, (list_dot_product(q, a) + b > 0)::INTEGER AS prediction
       FROM kr, (SELECT a, b FROM sw WHERE i = {rounds}) WHERE split = 'test')"""


def network(steps: int, hidden: int = 100, parts: int = 2, rate: float = 0.01, alpha: float = 1e-4) -> str:
    """CTEs ending in ``ml (doc_id, label, prediction)``: one hidden ReLU layer, Adam. A
    parameter is (kind, j, k): w from input j to unit k, b and v of unit k, c."""
    drawn = "(2 * (('0x' || substr(md5('0|' || kind || '|' || i), 1, 13))::BIGINT / 4503599627370496.0) - 1)"
    forward = """SELECT h.doc_id, h.k, greatest(h.a + b.theta, 0) AS h, v.theta AS v FROM (
        SELECT doc_id, k, sum(x.v * p.theta) AS a FROM x JOIN {net} p ON p.kind = 'w' AND p.j = x.j {who} GROUP BY doc_id, k) h
      JOIN {net} b ON b.kind = 'b' AND b.k = h.k JOIN {net} v ON v.kind = 'v' AND v.k = h.k"""
    return f"""
nd AS (SELECT count(*) AS d FROM vo),
np AS (SELECT 'w' AS kind, i // {hidden} AS j, i % {hidden} AS k, i FROM range((SELECT d * {hidden} FROM nd)) r(i)
  UNION ALL SELECT kind, 0, i, i FROM range({hidden}) r(i), (VALUES ('b'), ('v')) o(kind) UNION ALL SELECT 'c', 0, 0, 0),
nx AS MATERIALIZED (SELECT doc_id, liked AS y, ('0x' || substr(md5('0|' || doc_id), 1, 8))::BIGINT % {parts} AS part
                    FROM dset WHERE split = 'train'),
net AS (SELECT 0 AS t, kind, j, k, {drawn} * CASE WHEN kind IN ('w', 'b') THEN sqrt(6.0 / (d + {hidden}))
          ELSE sqrt(6.0 / ({hidden} + 1)) END AS theta, 0.0::DOUBLE AS m, 0.0::DOUBLE AS s FROM np, nd
  UNION ALL
  SELECT t + 1, kind, j, k, theta - {rate} * sqrt(1 - 0.999 ** (t + 1)) / (1 - 0.9 ** (t + 1)) * nm / (sqrt(ns) + 1e-8), nm, ns
  FROM (SELECT t, kind, j, k, theta, 0.9 * m + 0.1 * g AS nm, 0.999 * s + 0.001 * g * g AS ns FROM (
    WITH mine AS (SELECT doc_id, y FROM nx WHERE part = (SELECT any_value(t) FROM net) % {parts}),
    fw AS ({forward.format(net='net', who='WHERE doc_id IN (SELECT doc_id FROM mine)')}),
    er AS (SELECT doc_id, 1 / (1 + exp(-(z + c.theta))) - y AS e FROM (SELECT doc_id, sum(h * v) AS z FROM fw GROUP BY doc_id)
           JOIN mine USING (doc_id), (SELECT theta FROM net WHERE kind = 'c') c),
    bk AS (SELECT doc_id, k, CASE WHEN h > 0 THEN e * v ELSE 0 END AS r, e * h AS o, e FROM fw JOIN er USING (doc_id)),
    gr AS (SELECT 'w' AS kind, j, k, sum(x.v * r) AS g FROM x JOIN bk USING (doc_id) GROUP BY j, k
      UNION ALL SELECT 'b', 0, k, sum(r) FROM bk GROUP BY k UNION ALL SELECT 'v', 0, k, sum(o) FROM bk GROUP BY k
      UNION ALL SELECT 'c', 0, 0, sum(e) FROM er)
    SELECT p.*, (coalesce(gr.g, 0) + CASE WHEN kind IN ('w', 'v') THEN {alpha} * theta ELSE 0 END)
      / (SELECT count(*) FROM mine) AS g FROM net p LEFT JOIN gr USING (kind, j, k) WHERE p.t < {steps}))),
ne AS MATERIALIZED (SELECT * FROM net WHERE t = {steps}),
nf AS ({forward.format(net='ne', who="WHERE split = 'test'")}),
ml AS (SELECT f.doc_id, d.liked AS label, (sum(h * v) + (SELECT theta FROM ne WHERE kind = 'c') > 0)::INTEGER AS prediction
       FROM nf f JOIN dset d USING (doc_id) GROUP BY f.doc_id, d.liked)"""
