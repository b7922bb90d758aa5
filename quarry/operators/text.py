"""Review sentiment data work: labelling, cleaning, bag of words, scaling and
hard-label metrics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import porter
from ..functions.stopwords import ENGLISH

# Python's \w\w+ between word boundaries: maximal runs of >= 2 Unicode letters,
# digits or underscores. Stated as a class so Java and RE2 agree.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def label_reviews(df: DataFrame, text: str = "review", overall: str = "overall") -> DataFrame:
    """Drop neutral (== 3.0) reviews and NULL texts; ``liked`` = overall > 3.

    A NULL ``overall`` is kept and labelled 0 (the reference's ``!=`` keeps
    it), hence the null-safe comparison.
    """
    return (df.where(~F.col(overall).eqNullSafe(3.0)).where(F.col(text).isNotNull())
            .withColumn("liked", F.coalesce(F.col(overall) > 3, F.lit(False)).cast("int")))


def class_balance(df: DataFrame, label: str = "liked") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def _raw_tokens(text_col):
    """Letters only, lower case, split on whitespace, stopwords removed (in
    that order: stopwords are tested before stemming)."""
    letters = F.lower(F.regexp_replace(text_col, "[^a-zA-Z]", " "))
    toks = F.split(F.trim(letters), r"\s+")
    toks = F.filter(toks, lambda t: t != "")
    return F.filter(toks, lambda t: ~t.isin(*ENGLISH))      # a hash set


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stem_udf(tokens: pd.Series) -> pd.Series:
    """Stems of token arrays; each distinct word of a batch is stemmed once."""
    stems = {w: porter.stem(w) for w in {w for t in tokens for w in t}}
    return tokens.map(lambda t: [stems[w] for w in t])


def clean_text(df: DataFrame, key: str = "doc_id", text: str = "review",
               stem: bool = True) -> DataFrame:
    """``(key, tokens, clean)``: cleaned token list and its space-joined text.

    One map-only pass: the tokens are cut in the JVM, and an Arrow-batched
    pandas UDF stems the distinct words of each batch. Nothing is shuffled.
    Documents without tokens keep an empty text.
    """
    base = df.select(key, _raw_tokens(F.coalesce(F.col(text), F.lit("nan"))).alias("tokens"))
    if stem:
        base = base.withColumn("tokens", _stem_udf("tokens"))
    return base.select(key, "tokens", F.array_join("tokens", " ").alias("clean"))


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Long-form document-term counts ``(key, term, n)`` with the vectorizer's
    tokenization: lower case, maximal word runs of at least two characters."""
    toks = df.select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)),
                                                         F.lit(TOKEN_PATTERN), 0)).alias("term"))
    return toks.groupBy(key, "term").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def vocabulary(tc: DataFrame, size: int = 200) -> DataFrame:
    """The ``size`` most frequent terms over the corpus (ties by term), with
    the vectorizer's column index: alphabetical position among them.

    The per-term totals are a partial aggregate; the top-k is a bounded
    TakeOrdered, so the final indexing window sees ``size`` rows only.
    """
    tot = tc.groupBy("term").agg(F.sum("n").cast("bigint").alias("corpus_n"))
    top = tot.orderBy(F.desc("corpus_n"), F.asc("term")).limit(size)
    return top.withColumn("term_index",
                          (F.row_number().over(Window.orderBy("term")) - 1).cast("bigint"))


def bag_of_words(train: DataFrame, key: str, text: str, size: int = 200,
                 apply_to: DataFrame | None = None) -> DataFrame:
    """Fit the vocabulary on ``train`` only and return the long-form counts
    ``(key, term_index, term, n)`` of ``apply_to`` (default: train).

    Fix: the reference re-fits on the test set; here the train vocabulary is
    applied (transform).
    """
    vocab = vocabulary(term_counts(train, key, text), size)
    target = apply_to if apply_to is not None else train
    tc = term_counts(target, key, text)
    return tc.join(F.broadcast(vocab.select("term", "term_index")), "term") \
        .select(key, "term_index", "term", "n")


def minmax_fit(train: DataFrame, cols: list[str]) -> DataFrame:
    """One row: min and max of each column over the training rows."""
    return train.agg(*[F.min(c).alias(f"{c}__min") for c in cols],
                     *[F.max(c).alias(f"{c}__max") for c in cols])


def minmax_apply(df: DataFrame, fit: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min); a constant training column gives 0 (not
    Spark's MinMaxScaler 0.5). Test values may leave [0, 1]. The one row of
    bounds is taken once and put into the projection."""
    row = fit.first()
    out = df
    for c in cols:
        lo, hi = F.lit(row[f"{c}__min"]), F.lit(row[f"{c}__max"])
        out = out.withColumn(c, F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo)))
    return out


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """All four cells of the 2x2 matrix, zeros included, from one aggregate."""
    cells = [(t, p) for t in (0, 1) for p in (0, 1)]
    agg = df.agg(*[F.count_if((F.col(label) == t) & (F.col(pred) == p)).alias(f"c{t}{p}")
                   for t, p in cells])
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("label"), F.lit(p).alias("prediction"),
                                        F.col(f"c{t}{p}").cast("bigint").alias("n"))
                               for t, p in cells]))
    return agg.select(rows.alias("r")).select("r.*")


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def pr_auc_hard(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Area under the precision-recall curve of HARD 0/1 predictions (the
    reference feeds predictions, not scores, to the curve).

    With prevalence pi, recall r and precision p the curve is
    (1, pi) -> (r, p) -> (0, 1) and the trapezoid area is
    (1 - r)(pi + p)/2 + r(p + 1)/2; with one predicted class it is
    (pi + 1)/2. No positives -> NULL.
    """
    a = df.agg(F.count_if((F.col(label) == 1) & (F.col(pred) == 1)).alias("tp"),
               F.count_if((F.col(label) == 0) & (F.col(pred) == 1)).alias("fp"),
               F.count_if(F.col(label) == 1).alias("pos"),
               F.count(F.lit(1)).alias("n"),
               F.countDistinct(pred).alias("k"))
    pi = F.try_divide(F.col("pos").cast("double"), F.col("n"))
    r = F.try_divide(F.col("tp").cast("double"), F.col("pos"))
    p = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    two = (1 - r) * (pi + p) / 2 + r * (p + 1) / 2
    one = (pi + 1) / 2
    return a.select(F.when(F.col("pos") == 0, F.lit(None).cast("double"))
                    .when(F.col("k") < 2, one).otherwise(two).alias("pr_auc"))
