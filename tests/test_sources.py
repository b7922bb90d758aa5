"""File readers and sinks on small hand-written fixtures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.sources import readers as rd
from quarry.sources import sinks as sk
from conftest import rows


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_ratings_carry_header_across_files(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.txt"), "1:\n10,5,2005-01-02\n20,3,2004-12-31\n2:\n10,5,2005-01-01\n\n")
    write(os.path.join(tmp_dir, "b.txt"), "20,4,2005-03-01\n3:\n20,5,2003-05-05\n")
    r = rd.read_ratings(spark, tmp_dir)
    assert rows(r, "movie_id", "user_id", "rate", "rated_on") == [
        (1, 10, 5, "2005-01-02"), (1, 20, 3, "2004-12-31"), (2, 10, 5, "2005-01-01"),
        (2, 20, 4, "2005-03-01"), (3, 20, 5, "2003-05-05")]
    from quarry.operators import ratings as rt
    p = rt.profile(r).first()
    assert (p.n_ratings, p.n_users, p.first_date, p.last_date) == (5, 2, "2003-05-05", "2005-03-01")
    fav = rows(rt.lowest_user_favourites(r, 2), "user_id", "movie_id")
    assert fav == [(10, 1), (10, 2)]
    assert rows(rt.lowest_user_favourites(r, 3), "user_id", "movie_id") == [(20, 3)]


def test_ratings_with_tiny_splits(spark, tmp_dir):
    lines = []
    expect = []
    for m in range(1, 40):
        lines.append(f"{m}:")
        for u in range(m % 7 + 1):
            lines.append(f"{100 + u},{u % 5 + 1},2001-01-0{u % 9 + 1}")
            expect.append((m, 100 + u))
    write(os.path.join(tmp_dir, "dump.txt"), "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        assert rd._lines(spark, tmp_dir).rdd.getNumPartitions() > 5
        r = rd.read_ratings(spark, tmp_dir)
        assert rows(r, "movie_id", "user_id") == sorted(expect)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_titles_latin1_commas_last_wins(spark, tmp_dir):
    write(os.path.join(tmp_dir, "t.csv"), "1,2003,Café, Part 2\n2,NULL,Plain\n1,2004,Café, Part 3\n",
          encoding="iso-8859-1")
    t = rd.read_titles(spark, tmp_dir)
    assert rows(t, "movie_id", "year", "title") == [(1, 2004, "Café, Part 3"), (2, None, "Plain")]


def test_adjacency_missing_list(spark, tmp_dir):
    write(os.path.join(tmp_dir, "adj.txt"), "0\t1,2\n7\n9\t\n")
    a = rd.read_adjacency(spark, tmp_dir)
    assert rows(a.select("user_id", F.size("friends").alias("n"))) == [(0, 2), (7, 0), (9, 0)]
    assert rows(rd.adjacency_edges(a)) == [(0, 1), (0, 2)]


def test_baskets_and_points(spark, tmp_dir):
    write(os.path.join(tmp_dir, "b.csv"), "ketchup, butter, diapers\nbread, beer\n\nbeer,  bread ,\n")
    b = rd.read_baskets(spark, os.path.join(tmp_dir, "b.csv"))
    from quarry.operators import basket as bk
    assert bk.item_cardinality(b).first().n_items == 5
    assert b.select("basket_id").distinct().count() == 3
    write(os.path.join(tmp_dir, "p.txt"), "1.5,-2.25\n3,4\n")
    p = rd.read_points(spark, os.path.join(tmp_dir, "p.txt"))
    assert sorted(tuple(r.features) for r in p.collect()) == [(1.5, -2.25), (3.0, 4.0)]


def test_k_itemsets(spark):
    from quarry.operators import basket as bk
    b = spark.createDataFrame([(1, "ham"), (1, "cheese"), (1, "bread")], "basket_id long, item string")
    assert rows(bk.k_itemsets(b, 2).select("i1", "i2")) == [("bread", "cheese"), ("bread", "ham"), ("cheese", "ham")]
    assert bk.k_itemsets(b, 4).count() == 0
    assert bk.k_itemsets(b, 0).count() == 1
    assert rows(bk.k_itemsets(b, 3, hub_size=1).select("i1", "i2", "i3")) == [("bread", "cheese", "ham")]


def test_reviews_qa_options_bbh(spark, tmp_dir):
    write(os.path.join(tmp_dir, "r.json"), json.dumps({"reviewText": "ok", "overall": 5.0, "x": 1}) + "\n")
    assert rows(rd.read_reviews_json(spark, os.path.join(tmp_dir, "r.json"))) == [("ok", 5.0)]
    write(os.path.join(tmp_dir, "r.tsv"), 'Review\tLiked\nWow "good"\t1\nbad\t0\n')
    assert rows(rd.read_reviews_tsv(spark, os.path.join(tmp_dir, "r.tsv"))) == [("Wow \"good\"", 1), ("bad", 0)]
    write(os.path.join(tmp_dir, "qa.tsv"), "What is 2+2?\t4\nWhat is 3+3?\t6\n")
    assert rows(rd.read_qa_tsv(spark, os.path.join(tmp_dir, "qa.tsv")), "question", "answer") == [
        ("What is 2+2?", "4"), ("What is 3+3?", "6")]
    write(os.path.join(tmp_dir, "aq.json"), json.dumps({"question": "q", "options": ["A)1", "B)2"]}) + "\n")
    o = rd.read_jsonl_options(spark, os.path.join(tmp_dir, "aq.json")).first()
    assert o.options == ["A)1", "B)2"]
    bbh = os.path.join(tmp_dir, "bbh")
    os.makedirs(bbh)
    write(os.path.join(bbh, "navigate.json"),
          json.dumps({"examples": [{"input": "a", "target": "Yes"}, {"input": "b", "target": 3}]}) + "\nignored\n")
    write(os.path.join(bbh, "skip.v2.json"), json.dumps({"examples": [{"input": "z", "target": "z"}]}) + "\n")
    got = rows(rd.read_bbh_examples(spark, bbh))
    assert got == [("navigate", "a", "Yes"), ("navigate", "b", "3")]


def test_sinks(spark, tmp_dir):
    recs = spark.createDataFrame([(1, 1, 4, 2), (3, 1, 2, 2), (3, 2, 4, 1)],
                                 "user_id long, rec_rank long, rec_id long, mutual long")
    sk.write_recommendations(recs, os.path.join(tmp_dir, "out"))
    assert sorted(r.value for r in spark.read.text(os.path.join(tmp_dir, "out")).collect()) == ["1\t4", "3\t2,4"]
    res = spark.createDataFrame([("m1", "r1", 1.0), ("m2", "r1", 0.0)], "ins_md5 string, row_id string, accuracy double")
    sk.write_eval_results(res, os.path.join(tmp_dir, "ev"))
    assert all(f.endswith(".csv.gz") for _, _, names in os.walk(os.path.join(tmp_dir, "ev")) for f in names if f.startswith("part-"))
    names = os.listdir(os.path.join(tmp_dir, "ev"))
    assert "ins_md5=m1" in names and "ins_md5=m2" in names


def test_favourites_keep_repeats_and_numeric_lowest(spark, tmp_dir):
    # user "9" < "10" numerically (not as text); a movie rated twice shows twice
    write(os.path.join(tmp_dir, "d.txt"), "1:\n9,5,2001-01-01\n10,5,2001-01-01\n1:\n9,5,2001-01-02\n10,1,2001-01-02\n")
    from quarry.operators import ratings as rt
    r = rd.read_ratings(spark, tmp_dir)
    assert rows(rt.lowest_user_favourites(r, 2), "user_id", "movie_id") == [(9, 1), (9, 1)]
    empty = rt.lowest_user_favourites(r, 3)
    assert empty.count() == 0


def test_eval_results_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Few instructions are written as their rows come; more than the open files are sorted, none is lost."""
    from pyspark.sql import DataFrameWriter
    from quarry.sources import sinks as sk
    key, csv, during = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.csv, []
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, p: during.append(int(spark.conf.get(key))) or csv(self, p))
    for n in (3, 21):
        df = spark.range(0, 400, numPartitions=2).selectExpr(
            f"concat('m', id % {n}) AS ins_md5", "string(id) AS row_id", "concat(repeat('a, \"b\"\n', 3), 'c') AS raw_prompt")
        for fmt in ("csv", "parquet"):
            path = str(tmp_path / f"{fmt}{n}")
            sk.write_eval_results(df, path, fmt)
            back = spark.read.schema("row_id string, raw_prompt string, ins_md5 string")
            back = back.parquet(path) if fmt == "parquet" else back.option("header", "true").option(
                "multiLine", "true").option("escape", "\"").csv(path)
            assert sorted((r.ins_md5, r.row_id, r.raw_prompt) for r in back.collect()) == \
                sorted((r.ins_md5, r.row_id, r.raw_prompt) for r in df.collect())
    assert min(during) > 3 and spark.conf.get(key) == before
