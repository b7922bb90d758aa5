"""Splits and samples: sizes, disjointness, balance, determinism."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import sampling as sm


def test_split_sizes_disjoint_cover(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    s = sm.split_train_test(df, "k", 0.1, seed=42)
    c = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert c == {"test": math.ceil(100.1), "train": 1001 - math.ceil(100.1)}
    s3 = sm.split_train_eval_test(df, "k", 0.7, 0.1, seed=0)
    c3 = {r.split: r["count"] for r in s3.groupBy("split").count().collect()}
    assert c3 == {"train": 700, "eval": 100, "test": 201}
    assert s3.select("k").distinct().count() == 1001


def test_undersample_balances_and_tie_keeps_both(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") < 30).cast("int").alias("y"))
    bal = sm.undersample_majority(df, "k", "y")
    c = {r.y: r["count"] for r in bal.groupBy("y").count().collect()}
    assert c == {0: 30, 1: 30}
    assert sm.cut_majority(df, "k", "y").count() == 30
    eq = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    assert sm.undersample_majority(eq, "k", "y").count() == 10


def test_few_shot_and_dedup(spark):
    tr = spark.range(50).withColumnRenamed("id", "k")
    fs = sm.few_shot_sample(tr, "k", 4, 3)
    assert sorted(r["count"] for r in fs.groupBy("step").count().collect()) == [3, 3, 3, 3]
    texts = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "t string")
    seen = spark.createDataFrame([("c",)], "t string").select(F.md5("t").alias("md5"))
    assert sorted(r.t for r in sm.dedup_by_md5(texts, "t", seen).collect()) == ["a", "b"]


@pytest.mark.parametrize("digits", [1, 3])
def test_kth_smallest_equals_sorting(spark, monkeypatch, digits):
    monkeypatch.setattr(sm, "DIGITS", digits)
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("g"))
    want = {g: sorted(hashlib.md5(f"5|{i}".encode()).hexdigest() for i in range(3000) if (i % 7 == 0) == g) for g in (0, 1)}
    asked = [(0, 1), (0, 17), (0, 2571), (1, 0), (1, 200), (1, 429), (2, 5)]
    totals, cuts = sm.kth_smallest(df, sm.md5_key(5, "k"), lambda n: asked, "g")
    assert totals == {g: len(v) for g, v in want.items()}
    for (g, k), cut in zip(asked, cuts):
        assert sum(h <= cut for h in want.get(g, [])) == min(k, len(want.get(g, [])))


def test_equal_keys_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0)] * 6 + [(2, 1), (None, None)], "k long, y int")
    parts = {r.split: r["count"] for r in sm.split_train_test(df, "k", 0.5).groupBy("split").count().collect()}
    assert sum(parts.values()) == 8 and parts["test"] >= 4
    assert sm.undersample_majority(df, "k", "y").count() == 8      # six equal rows stay together
    none = df.limit(0)
    assert sm.split_train_test(none, "k").count() == sm.split_train_eval_test(none, "k").count() == 0
    assert sm.undersample_majority(none, "k", "y").count() == 0


def test_splits_move_no_rows(spark):
    plan = sm.split_train_test(spark.range(1000), "id")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan
