"""TEXT keys: labelled documents as reviews; sampling keys on orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH
from ..operators import sampling as sm
from ..operators import text as tx
from ..session import shared_dir
from . import bindings as b
from . import sql_text as sq
from .catalog import register

RV = "WITH " + b.REVIEWS_SQL


def _labelled(spark, d):
    return tx.label_reviews(b.reviews(spark, d))


def _split_keys(spark, d):
    """``(doc_id, liked, split)``, written once: every later step reads it."""
    shared_dir(spark)
    keys = _labelled(spark, d).select("doc_id", "liked").checkpoint()
    return sm.split_train_test(keys, "doc_id", 0.1, seed=42).checkpoint()


def _with_text(spark, d, keys):
    """The review texts of ``keys``, which may hold part of the reviews."""
    text = b.table(spark, d, "documents", "doc_id", F.col("text").alias("review"))
    return text.join(keys, "doc_id")


@register("label_reviews", RV + " SELECT doc_id, liked FROM lr")
def q_label_reviews(spark, d):
    return _labelled(spark, d).select("doc_id", "liked")


@register("class_balance", RV + " SELECT liked, CAST(count(*) AS BIGINT) AS n FROM lr GROUP BY liked")
def q_class_balance(spark, d):
    return tx.class_balance(_labelled(spark, d))


@register("split_train_test", RV + " SELECT doc_id, liked, split FROM sp")
def q_split_train_test(spark, d):
    return _split_keys(spark, d).select("doc_id", "liked", "split")


BAL_SQL = RV + """,
tr AS (SELECT * FROM sp WHERE split = 'train'),
cn AS (SELECT liked, count(*) AS n FROM tr GROUP BY liked),
mn AS (SELECT min(n) AS m FROM cn),
rk AS (SELECT tr.*, row_number() OVER (PARTITION BY liked ORDER BY md5('0|' || CAST(doc_id AS VARCHAR))) AS r
       FROM tr),
bal AS (SELECT doc_id, liked FROM rk WHERE r <= (SELECT m FROM mn))"""


def _balanced(keys):
    return sm.undersample_majority(keys.where(F.col("split") == "train"), "doc_id", "liked", seed=0)


@register("undersample_majority", BAL_SQL + """
SELECT doc_id, liked FROM bal WHERE liked IN (SELECT liked FROM cn WHERE n > (SELECT m FROM mn))""")
def q_undersample_majority(spark, d):
    tr = _split_keys(spark, d).where(F.col("split") == "train")
    return sm.cut_majority(tr, "doc_id", "liked", seed=0).select("doc_id", "liked")


@register("concat_balanced", BAL_SQL + " SELECT doc_id, liked FROM bal")
def q_concat_balanced(spark, d):
    """The cut majority class put together with the whole minority class."""
    tr = _split_keys(spark, d).where(F.col("split") == "train").select("doc_id", "liked").checkpoint()
    major = sm.cut_majority(tr, "doc_id", "liked", seed=0)
    rest = tr.join(major.select("liked").distinct(), "liked", "left_anti")
    return major.select("doc_id", "liked").unionByName(rest.select("doc_id", "liked"))


def _clean_split(spark, d):
    """Cleaned balanced-train and test reviews: ``(doc_id, liked, split, clean)``."""
    sp = _split_keys(spark, d)
    keys = (_balanced(sp).unionByName(sp.where(F.col("split") == "test"))
            .select("doc_id", "liked", "split").checkpoint())
    cleaned = tx.clean_text(_with_text(spark, d, keys), "doc_id", "review")
    return keys.join(cleaned, "doc_id").checkpoint()


TK_SQL = r"""
tk AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(regexp_replace(
         coalesce(review, 'nan'), '[^a-zA-Z]', ' ', 'g')), '\s+', ' ', 'g')), ' '),
         lambda w: w <> '' AND NOT list_contains([""" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + r"""], w)) AS t
       FROM rv)"""
STEMMED_SQL = TK_SQL + """,
ut AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM tk),
""" + sq.stems("ut")
CLF_SQL = BAL_SQL.replace("WITH", "WITH RECURSIVE", 1) + "," + STEMMED_SQL + "," + sq.FEATURES + ","


# The SQL of each classifier: CTEs and the one that holds its predictions.
CLASSIFIERS = {
    "GaussianNB": ([sq.BAYES], "nb"), "RandomForestClassifier": ([sq.FOREST], "rf"),
    "DecisionTreeClassifier": ([sq.TREE], "dt"), "LogisticRegression": ([sq.DENSE, sq.logistic()], "lg"),
    "SVC": ([sq.DENSE, sq.svm()], "sv"), "MLPClassifier": ([sq.network(2 * 40)], "ml")}


@register("compare_classifiers", CLF_SQL + ",".join(dict.fromkeys(c for ctes, _ in CLASSIFIERS.values() for c in ctes)) + """,
pr AS (""" + " UNION ALL ".join(f"SELECT '{k}' AS name, label, prediction FROM {t}" for k, (_, t) in CLASSIFIERS.items()) + """),
mc AS (SELECT name, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) AS n, avg((label = prediction)::INT) AS accuracy
  FROM pr GROUP BY name)
SELECT name, round(accuracy, 6) AS accuracy, tn, fp, fn, tp,
  round(CASE WHEN fn + tp = 0 THEN NULL WHEN tp + fp IN (0, n) THEN ((fn + tp) / n + 1) / 2
    ELSE (1 - tp / (fn + tp)) * ((fn + tp) / n + tp / (tp + fp)) / 2 + tp / (fn + tp) * (tp / (tp + fp) + 1) / 2 END, 6) AS pr_auc,
  row_number() OVER (ORDER BY accuracy DESC, name) AS rank FROM mc""")
def q_compare_classifiers(spark, d):
    """The report over all six classifiers on the cleaned reviews."""
    from ..operators import classify as cf
    c = _clean_split(spark, d)
    got = cf.compare_classifiers(c.where(F.col("split") == "train"), c.where(F.col("split") == "test"))
    return got.select("name", F.round("accuracy", 6).alias("accuracy"), "tn", "fp", "fn", "tp",
                      F.round("pr_auc", 6).alias("pr_auc"), "rank")


def _clf_key(model):
    def q(spark, d):
        from ..operators import classify as cf
        c = _clean_split(spark, d)
        return cf.fit_predict(c.where(F.col("split") == "train"),
                              c.where(F.col("split") == "test"), model)
    q.__doc__ = f"{model} fitted on the balanced cleaned training reviews, test predictions."
    return q


for _key, _model in [("clf_gaussian_nb", "GaussianNB"), ("clf_random_forest", "RandomForestClassifier"),
                     ("clf_decision_tree", "DecisionTreeClassifier"),
                     ("clf_logistic", "LogisticRegression"), ("clf_svm", "SVC"),
                     ("clf_mlp", "MLPClassifier")]:
    _ctes, _name = CLASSIFIERS[_model]
    register(_key, CLF_SQL + ",".join(_ctes) + f" SELECT doc_id, label, prediction FROM {_name}")(_clf_key(_model))


@register("logistic_steps", """
WITH pt AS (SELECT l_quantity / 50.0 AS u, l_discount * 10 AS v, (l_returnflag = 'R')::INT AS y FROM lineitem),""" +
          sq.newton("pt", 3) + " UNION ALL ".join(
    f" SELECT {i}::INTEGER AS round, round(a, 6) AS w_quantity, round(b, 6) AS w_discount, round(c, 6) AS intercept FROM nr{i}"
    for i in (1, 2, 3)))
def q_logistic_steps(spark, d):
    """Three Newton rounds of logistic regression on the lines: returned, by quantity and discount."""
    from ..operators import newton
    li = b.table(spark, d, "lineitem", "l_quantity", "l_discount", "l_returnflag")
    rows = li.select((F.col("l_returnflag") == "R").cast("double").alias("label"),
                     F.array(F.col("l_quantity").cast("double") / 50.0, F.col("l_discount").cast("double") * 10).alias("x"))
    got = newton.newton_rounds(rows, 2, 3)
    return spark.createDataFrame([(i + 1, *(round(v, 6) for v in w)) for i, w in enumerate(got)],
                                 "round int, w_quantity double, w_discount double, intercept double")


@register("rank_models", """
WITH pr AS (SELECT l_returnflag || l_linestatus AS name, l_returnflag = 'R' AS label,
                   l_discount >= 0.05 AS prediction FROM lineitem),
ac AS (SELECT name, avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM pr GROUP BY name)
SELECT name, round(accuracy, 6) AS accuracy,
       CAST(row_number() OVER (ORDER BY accuracy DESC, name) AS BIGINT) AS rank FROM ac""")
def q_rank_models(spark, d):
    """Models ranked by accuracy, ties by name; the lines of each flag and
    status stand for one model's predictions."""
    from ..operators.answers import rank_by_score
    li = b.table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_discount")
    right = ((F.col("l_returnflag") == "R") == (F.col("l_discount") >= 0.05)).cast("double")
    acc = li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("name")).agg(F.avg(right).alias("accuracy"))
    return rank_by_score(acc, "accuracy", "name").select("name", F.round("accuracy", 6).alias("accuracy"), "rank")


@register("clean_text", RV + "," + STEMMED_SQL + """
SELECT tk.doc_id, coalesce(string_agg(stem, ' ' ORDER BY pos), '') AS clean
FROM tk LEFT JOIN ut USING (doc_id) LEFT JOIN stems USING (term) GROUP BY tk.doc_id""")
def q_clean_text(spark, d):
    """All reviews cleaned and stemmed."""
    return tx.clean_text(b.reviews(spark, d), "doc_id", "review").select("doc_id", "clean")


@register("clean_text_unstemmed", RV + "," + TK_SQL + """
SELECT doc_id, array_to_string(t, ' ') AS clean, CAST(len(t) AS BIGINT) AS n_tokens FROM tk""")
def q_clean_text_unstemmed(spark, d):
    """All reviews cleaned, before stemming."""
    c = tx.clean_text(b.reviews(spark, d), "doc_id", "review", stem=False)
    return c.select("doc_id", "clean", F.size("tokens").cast("bigint").alias("n_tokens"))


TC_SQL = RV + r""",
tt AS (SELECT doc_id, split, unnest(regexp_extract_all(lower(review), '[\p{L}\p{N}_]{2,}')) AS term FROM sp),
tc AS (SELECT doc_id, split, term, count(*) AS n FROM tt GROUP BY doc_id, split, term),
vt AS (SELECT term, sum(n) AS corpus_n FROM tc WHERE split = 'train' GROUP BY term
       ORDER BY corpus_n DESC, term LIMIT 200),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index, corpus_n FROM vt)"""


FEATURES_SQL = TC_SQL + """
SELECT tc.doc_id, tc.split, CAST(v.term_index AS BIGINT) AS term_index, tc.term, CAST(tc.n AS BIGINT) AS n
FROM tc JOIN vocab v ON tc.term = v.term"""


def term_counts(spark, d):
    """``(doc_id, split, term, n)`` of all reviews, written once."""
    sp = _split_keys(spark, d)
    tc = tx.term_counts(_with_text(spark, d, sp), "doc_id", "review").join(sp.select("doc_id", "split"), "doc_id")
    return tc.checkpoint()


def features(spark, d):
    tc = term_counts(spark, d)
    vocab = tx.vocabulary(tc.where(F.col("split") == "train"), 200)
    return (tc.join(F.broadcast(vocab.select("term", "term_index")), "term")     # 200 rows
            .select("doc_id", "split", "term_index", "term", "n"))


@register("bag_of_words", FEATURES_SQL)
def q_bag_of_words(spark, d):
    """Vocabulary of 200 fitted on the training reviews, applied to both
    parts; long-form counts."""
    return features(spark, d)


@register("vocabulary", TC_SQL + """
SELECT term, CAST(term_index AS BIGINT) AS term_index, CAST(corpus_n AS BIGINT) AS corpus_n FROM vocab""")
def q_vocabulary(spark, d):
    return tx.vocabulary(term_counts(spark, d).where(F.col("split") == "train"), 200) \
        .select("term", "term_index", "corpus_n")


MM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_SPLIT_SQL = """WITH li AS (SELECT """ + b.LINE_ID_SQL + """ AS row_id, l_quantity,
  l_extendedprice, l_discount, l_tax FROM lineitem),
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(row_id AS VARCHAR)))
                      <= ceil(0.1 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM li)"""


@register("minmax_scale", LI_SPLIT_SQL + """,
mm AS (SELECT """ + ", ".join(
    f"min({c}) FILTER (WHERE split = 'train') AS {c}_lo, max({c}) FILTER (WHERE split = 'train') AS {c}_hi"
    for c in MM_COLS) + """ FROM sp)
SELECT row_id, """ + ", ".join(
    f"round(CASE WHEN {c}_hi = {c}_lo THEN 0.0 ELSE ({c} - {c}_lo) / ({c}_hi - {c}_lo) END, 6) AS {c}"
    for c in MM_COLS) + """, split
FROM sp, mm""")
def q_minmax_scale(spark, d):
    """Scaler fitted on the training lines, applied to both parts."""
    shared_dir(spark)
    li = b.table(spark, d, "lineitem", *b.LINE_KEY, *MM_COLS).withColumn("row_id", b.line_id())
    sp = sm.split_train_test(li.select("row_id", *MM_COLS), "row_id", 0.1, seed=42).checkpoint()
    fit = tx.minmax_fit(sp.where(F.col("split") == "train"), MM_COLS)
    return tx.minmax_apply(sp, fit, MM_COLS).select("row_id", *[F.round(c, 6).alias(c) for c in MM_COLS], "split")


PRED_SQL = """WITH pr AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
  CAST(l_discount >= 0.05 AS INTEGER) AS prediction FROM lineitem)"""


def _pred(spark, d):
    li = b.table(spark, d, "lineitem", "l_returnflag", "l_discount")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                     (F.col("l_discount") >= 0.05).cast("int").alias("prediction"))


@register("confusion_matrix", PRED_SQL + """
SELECT t.label, p.prediction, CAST(count(pr.label) AS BIGINT) AS n
FROM (VALUES (0), (1)) t(label) CROSS JOIN (VALUES (0), (1)) p(prediction)
LEFT JOIN pr ON pr.label = t.label AND pr.prediction = p.prediction
GROUP BY t.label, p.prediction""")
def q_confusion_matrix(spark, d):
    return tx.confusion_counts(_pred(spark, d))


@register("accuracy", PRED_SQL + """
SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM pr""")
def q_accuracy(spark, d):
    return tx.accuracy(_pred(spark, d)).select(F.round("accuracy", 6).alias("accuracy"))


@register("pr_auc_hard", PRED_SQL + """,
a AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1) AS pos, count(*) AS n,
             count(DISTINCT prediction) AS k FROM pr),
b AS (SELECT *, pos / n AS pi, tp / pos AS r, tp / (tp + fp) AS p FROM a)
SELECT round(CASE WHEN pos = 0 THEN NULL WHEN k < 2 THEN (pi + 1) / 2
                  ELSE (1 - r) * (pi + p) / 2 + r * (p + 1) / 2 END, 6) AS pr_auc FROM b""")
def q_pr_auc_hard(spark, d):
    return tx.pr_auc_hard(_pred(spark, d)).select(F.round("pr_auc", 6).alias("pr_auc"))


# ------------------------------------------------------------ sampling on orders
ORD_SQL = """WITH od AS (SELECT o_orderkey FROM orders),
rk AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('0|' || CAST(o_orderkey AS VARCHAR))) AS r,
              count(*) OVER () AS n FROM od),
s3 AS (SELECT o_orderkey, CASE WHEN r <= floor(0.7 * n) THEN 'train'
                               WHEN r <= floor(0.7 * n) + floor(0.1 * n) THEN 'eval'
                               ELSE 'test' END AS split FROM rk)"""


def _orders_split(spark, d):
    od = b.table(spark, d, "orders", "o_orderkey")
    return sm.split_train_eval_test(od, "o_orderkey", 0.7, 0.1, seed=0)


@register("split_train_eval_test", ORD_SQL + " SELECT o_orderkey, split FROM s3")
def q_split_train_eval_test(spark, d):
    return _orders_split(spark, d)


@register("test_remainder", ORD_SQL + """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s3 WHERE split = 'train')""")
def q_test_remainder(spark, d):
    sp = _orders_split(spark, d)
    return sm.remainder(b.table(spark, d, "orders", "o_orderkey"),
                        sp.where(F.col("split") == "train"), "o_orderkey")


@register("few_shot_sample", ORD_SQL + """,
st AS (SELECT s3.o_orderkey, g.step FROM s3, range(10) g(step) WHERE split = 'train'),
sr AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY md5(CAST(step AS VARCHAR) || '|' ||
       CAST(o_orderkey AS VARCHAR))) AS rn FROM st)
SELECT CAST(step AS INTEGER) AS step, o_orderkey FROM sr WHERE rn <= 3""")
def q_few_shot_sample(spark, d):
    """Three training rows per optimisation step (10 steps), seeded by step."""
    tr = _orders_split(spark, d).where(F.col("split") == "train").select("o_orderkey")
    return sm.few_shot_sample(tr, "o_orderkey", 10, 3).select(F.col("step").cast("int"), "o_orderkey")


@register("dedup_by_md5", """
WITH seen AS (SELECT DISTINCT md5(text) AS md5 FROM documents JOIN labels USING (doc_id))
SELECT DISTINCT md5(text) AS md5 FROM documents WHERE md5(text) NOT IN (SELECT md5 FROM seen)""")
def q_dedup_by_md5(spark, d):
    """Document texts not already in the labelled set, each once."""
    docs = b.table(spark, d, "documents", "doc_id", "text")
    seen = docs.join(b.table(spark, d, "labels", "doc_id"), "doc_id", "left_semi") \
        .select(F.md5("text").alias("md5"))
    return sm.dedup_by_md5(docs, "text", seen).select("md5")
