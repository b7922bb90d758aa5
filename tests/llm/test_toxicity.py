import numpy as np

from pyspark.sql import functions as F

from quarry.llm import toxicity
from quarry.llm.common import crc_mod5
from tests.llm.helpers import awkward_rows, docs, words

BAD = ["grotten", "schuft", "lump"]


def corpus(n=600):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 7 == 0
        w = words(rng, int(rng.integers(5, 80))).split()
        if toxic:
            w.insert(int(rng.integers(len(w))), BAD[i % 3].upper() + ".")
        rows.append((i, " ".join(w), "en", "src0", 1, 1, 2, "v", 3, 0.5))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_clean_documents(spark):
    rows, labels = corpus()
    d = docs(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, lab, crc_mod5() != 0)
    got = (toxicity.score(d, model).join(lab, "doc_id").where(crc_mod5() == 0).collect())
    wrong = [r for r in got if (r["score"] >= 0.5) != (r["toxic"] == 1)]
    assert len(got) > 80 and len(wrong) <= 0.03 * len(got)
    assert not [r for r in wrong if r["toxic"] == 0]
    kept = toxicity.reject(d, model)
    assert kept.columns == d.columns
    n_toxic = sum(y for _, _, y in labels)
    assert len(rows) - n_toxic <= kept.count() <= len(rows) - n_toxic + 8
    assert 0 < len(model.keys) < 2000           # sparse


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = corpus(200)
    d = docs(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    flipped = lab.withColumn("toxic", F.when(crc_mod5() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    a, b = (toxicity.fit(d, x, crc_mod5() != 0) for x in (lab, flipped))
    assert a.bias == b.bias and (a.keys == b.keys).all() and (a.weights == b.weights).all()


def test_awkward_rows_and_missing_labels(spark):
    d = docs(spark)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, empty, crc_mod5() != 0)
    assert {r["score"] for r in toxicity.score(d, model).collect()} == {0.0}
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(60)] + [(None, 1, 1), (3, 1, None), (4, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, labels, crc_mod5() != 0)
    got = toxicity.score(d, model).collect()
    assert len(got) == len(awkward_rows())
    assert all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(v) == 1 for v in by.values()) and by[20] == by[21] == by[22]
    assert toxicity.score(docs(spark, []), model).count() == 0


def test_skip_pairs_and_texts_do_not_run_together():
    doc, key = toxicity.features([b"a b c", b"b", b""], (0, 1))
    assert [int((doc == i).sum()) for i in range(3)] == [3 + 2 + 1, 1, 0]
    again = toxicity.features([b"A, b. C!"], (0, 1))[1]
    assert sorted(again) == sorted(key[doc == 0])
