"""TEXT: labelling, cleaning with stemming, scaling, hard-label metrics."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import porter
from quarry.functions.stopwords import ENGLISH
from quarry.operators import text as tx
from conftest import rows


def test_clean_text_fixture(spark):
    df = spark.createDataFrame([(1, "I LOVED this magazine!! 10/10"), (2, "the and of"), (3, None)],
                               "doc_id long, review string")
    out = {r.doc_id: r.clean for r in tx.clean_text(df).collect()}
    assert out[1] == "love magazin"
    assert out[2] == ""          # only stopwords: empty, but the row stays
    assert out[3] == "nan"       # str(None) -> 'nan' as the reference does


def test_stopwords_before_stemming(spark):
    # "doing" is a stopword and removed; "does" too; "goes" is stemmed
    df = spark.createDataFrame([(1, "doing goes does")], "doc_id long, review string")
    assert tx.clean_text(df).first().clean == "goe"


def test_stopword_list_is_the_classic_one():
    assert len(ENGLISH) == 179 and {"ll", "ve", "re", "m", "o", "y", "ain", "aren"} <= set(ENGLISH)


@pytest.mark.parametrize("w,s", [("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"),
                                 ("hopping", "hop"), ("happy", "happi"), ("relational", "relat"),
                                 ("generalization", "gener"), ("dying", "die"), ("by", "by")])
def test_porter(w, s):
    assert porter.stem(w) == s


def test_label_reviews_null_rules(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 3.0), (3, "c", 5.0), (4, "d", None),
                                (5, None, 5.0)], "doc_id long, review string, overall double")
    assert rows(tx.label_reviews(df), "doc_id", "liked") == [(1, 0), (3, 1), (4, 0)]


def test_minmax(spark):
    tr = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, c double")
    te = spark.createDataFrame([(1.0, 7.0), (3.0, 9.0), (5.0, 1.0)], "a double, c double")
    out = rows(tx.minmax_apply(te, tx.minmax_fit(tr, ["a", "c"]), ["a", "c"]))
    assert out == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]


def test_hard_label_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "label int, prediction int")
    assert tx.accuracy(df).first().accuracy == 0.5
    cm = {(r.label, r.prediction): r.n for r in tx.confusion_counts(df).collect()}
    assert cm == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 1}
    assert tx.pr_auc_hard(df).first().pr_auc == pytest.approx(0.625)
    one = spark.createDataFrame([(1, 0), (0, 0), (0, 0), (0, 0)], "label int, prediction int")
    assert tx.pr_auc_hard(one).first().pr_auc == pytest.approx((0.25 + 1) / 2)
    cm1 = {(r.label, r.prediction): r.n for r in tx.confusion_counts(one).collect()}
    assert cm1[(1, 1)] == 0 and cm1[(0, 1)] == 0


def test_vocabulary_ties_and_index(spark):
    df = spark.createDataFrame([(1, "bb aa cc a"), (2, "bb aa dd"), (3, "ee")], "doc_id long, t string")
    v = tx.vocabulary(tx.term_counts(df, "doc_id", "t"), 3)
    assert rows(v, "term", "term_index", "corpus_n") == [("aa", 0, 2), ("bb", 1, 2), ("cc", 2, 1)]


def test_vocabulary_fitted_on_train_only(spark):
    train = spark.createDataFrame([(1, "aa bb"), (2, "aa")], "doc_id long, t string")
    test = spark.createDataFrame([(3, "cc cc aa")], "doc_id long, t string")
    out = rows(tx.bag_of_words(train, "doc_id", "t", 5, apply_to=test), "doc_id", "term", "n")
    assert out == [(3, "aa", 1)]  # "cc" is not in the training vocabulary
