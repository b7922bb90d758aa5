"""Review classifiers: featurise once, fit six models, report.

Cleaned text -> tokens of >= 2 word characters -> counts over a 200-term
vocabulary fitted on the training rows only (fix: the reference re-fits on the
test rows) -> min-max scaling fitted on train (a constant column maps to 0 as in
the reference's scaler) -> each model -> accuracy, 2x2 confusion counts, PR-AUC of
the hard predictions -> ranked by accuracy (descending), name (ascending).

The models are those of the reference, each by its own definition:
* GaussianNB(var_smoothing=1e-9): ``bayes``, closed form
* RandomForest(100 trees, depth 3): ``trees``, exact thresholds, MD5 draws
* DecisionTree(depth 2, leaf >= 5, split >= 5, 2 features per split): ``trees``
* LogisticRegression(C=1, L2): ``newton``
* SVC (RBF kernel, C=1, gamma 'scale'): ``svm``, over all training rows
* MLP(100 ReLU units, Adam): ``neural``; batches are parts of the whole table, so
  steps are fewer and larger (rate 0.01 instead of 0.001)
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bayes, neural, newton, trees
from . import text as tx
from .dense import stored

VOCAB = 200
EPOCHS = 40

# Each: (train, test, number of features, key column) -> (key, label, prediction).
MODELS: dict[str, Callable[[DataFrame, DataFrame, int, str], DataFrame]] = {
    "GaussianNB": bayes.gaussian_nb,
    "RandomForestClassifier": trees.forest,
    "DecisionTreeClassifier": trees.tree,
    "LogisticRegression": newton.logistic,
    "SVC": newton.rbf_svm,
    "MLPClassifier": partial(neural.network, max_epochs=EPOCHS, patience=EPOCHS),     # a fixed number of steps
}


def features(train: DataFrame, test: DataFrame, key: str = "doc_id", text: str = "clean",
             label: str = "liked") -> tuple[DataFrame, DataFrame, int]:
    """Train and test rows ``(key, label, x)`` and the length of x. Vocabulary and
    scale come from ``train``; the vocabulary breaks ties by term, so the columns do
    not depend on the order of the rows."""
    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=tx.TOKEN_PATTERN, gaps=False, toLowercase=True)
    words = tok.transform(train).select(F.explode("_tok").alias("term"))
    terms = (words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "term").limit(VOCAB).orderBy("term").collect())
    vocabulary = [r["term"] for r in terms] or ["_"]
    cv = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_tok", outputCol="_cnt")

    def counted(df):
        return cv.transform(tok.transform(df)).select(
            key, F.col(label).cast("double").alias("label"), vector_to_array("_cnt").alias("c"))

    both = stored(counted(train).withColumn("split", F.lit("train"))
                  .unionByName(counted(test).withColumn("split", F.lit("test"))), "review-counts")
    ends = (both.where("split = 'train'").select(F.posexplode("c").alias("i", "v")).groupBy("i")
            .agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("i").collect())
    lo = F.array(*[F.lit(r["lo"]) for r in ends] or [F.lit(0.0)])
    span = F.array(*[F.lit(r["hi"] - r["lo"]) for r in ends] or [F.lit(0.0)])
    scaled = F.zip_with(F.zip_with("c", lo, lambda c, a: c - a), span,
                        lambda d, s: F.when(s == 0, 0.0).otherwise(d / s))
    rows = both.select(key, "label", scaled.alias("x"), "split")
    return (stored(rows.where("split = 'train'").drop("split"), "review-train"),
            stored(rows.where("split = 'test'").drop("split"), "review-test"), len(vocabulary))


def fit_predict(train: DataFrame, test: DataFrame, model: str, key: str = "doc_id",
                text: str = "clean", label: str = "liked") -> DataFrame:
    """One model: fit on ``train``, predict ``test`` -> ``(key, label, prediction)``."""
    tr, te, width = features(train, test, key, text, label)
    return MODELS[model](tr, te, width, key)


def report(predictions: DataFrame) -> DataFrame:
    """``(name, accuracy, tn, fp, fn, tp, pr_auc, rank)`` from stored predictions
    ``(name, label, prediction)``, all models in one aggregate."""
    cells = {f"{'t' if t == p else 'f'}{'p' if p else 'n'}": (t, p) for t in (0, 1) for p in (0, 1)}
    n = predictions.groupBy("name").agg(*[F.count_if((F.col("label") == t) & (F.col("prediction") == p)).alias(k)
                                          for k, (t, p) in cells.items()])
    rows = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    pos, hit = F.col("fn") + F.col("tp"), F.col("tp") + F.col("fp")
    share, recall = pos / rows, F.try_divide(F.col("tp"), pos)
    precision = F.try_divide(F.col("tp"), hit)
    auc = (F.when(pos == 0, F.lit(None).cast("double"))
           .when((hit == 0) | (hit == rows), (share + 1) / 2)
           .otherwise((1 - recall) * (share + precision) / 2 + recall * (precision + 1) / 2))
    from .answers import rank_by_score
    scored = n.select("name", ((F.col("tp") + F.col("tn")) / rows).alias("accuracy"),
                      *[F.col(k).cast("long").alias(k) for k in ("tn", "fp", "fn", "tp")], auc.alias("pr_auc"))
    return rank_by_score(scored, "accuracy", "name")


def compare_classifiers(train: DataFrame, test: DataFrame, key: str = "doc_id", text: str = "clean",
                        label: str = "liked") -> DataFrame:
    """One row per model: every model's predictions are written, then reported."""
    tr, te, width = features(train, test, key, text, label)
    out = None
    for name, predict in MODELS.items():
        got = predict(tr, te, width, key).select(F.lit(name).alias("name"), "label", "prediction")
        out = got if out is None else out.unionByName(got)
    return report(stored(out, "predictions"))
