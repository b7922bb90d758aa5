"""EVAL answers: normalisation, matching and ledger cases of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import answer_rules as ar
from quarry.operators import answers as an
from conftest import rows

NORMALIZE = [
    ("The answer is 5,600 pounds.", "5600"), ("#### 42", "42"), ("42 is the answer", "42"),
    ("The answer is $18. Q: next", "18"), ("total is: 5", "5"), ("7 - 2 = 5 apples", "5"),
    ("2.5", "2"), ("3.5", "4"), ("(A) apple", "(a)"), ("sixteen", "6"), ("eighty", "8"),
    ("thirteen", "13"), ("It costs 12 often.", "10"), ("cost: 5", ""), (None, ""),
    ("Step-by-Step Answer: 7 apples", "7"),
    ("Antwort: 3", "2"),  # text before ":" is "antwort"; its "two" becomes "2"
]


MULTI_LINE = [("The answer is 42\n7 apples", "42"), ("12\n13", "12"),
              ("The total is $12.\n\n13th", "12"), ("The answer is\nfoo 3\n4", "3"),
              ("word " * 100_000 + "42", "42"), ("x" * 200_000 + " 5", "5"),
              ("The answer is " + "1_" * 50_000 + "1", None)]


def test_long_and_multi_line_answers(spark):
    """Nothing overflows the regex engine's stack, and the number comes from
    the first line that has one."""
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(MULTI_LINE)], "i int, s string")
    out = dict(rows(ar.with_normalized_answer(df, "s", "n"), "i", "n"))
    for i, (_, want) in enumerate(MULTI_LINE):
        assert want is None or out[i] == want
    cases = [("0.123456789", "0.1234567891"), ("0.123456789", "0.12355"), (None, "3"), ("2.5", "2.5000001 m")]
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(cases)], "i int, t string, p string")
    out = dict(rows(ar.with_number_included_correct(df, "t", "p", "ok"), "i", "ok"))
    assert [out[i] for i in range(4)] == [1, 0, 0, 1]


def test_prediction_without_question_and_no_threshold(spark):
    preds = spark.createDataFrame([("m", "q", 0, "3"), ("m", "gone", 0, "3")],
                                  "ins_md5 string, row_id string, decode_no int, raw_answer string")
    qa = spark.createDataFrame([("q", "question", "3")], "row_id string, question string, answer string")
    assert an.number_included_accuracy(preds, qa).first().accuracy == pytest.approx(50.0)
    ledger = spark.createDataFrame([("a", 0.05, 1), ("b", 0.5, 2)], "ins_md5 string, score double, step int")
    assert an.best_instructions(ledger, threshold=None).count() == 2
    assert an.best_instructions(ledger).count() == 1


def test_normalize_answer(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(NORMALIZE)], "i int, s string")
    out = dict(rows(ar.with_normalized_answer(df, "s", "n"), "i", "n"))
    assert [out[i] for i in range(len(NORMALIZE))] == [e for _, e in NORMALIZE]


MATCH = [("18", "18", 1), ("18", "18.0", 0), ("1,000", "1000", 1), ("5", "-5", 1),
         ("15", "1.5", 1), ("yes", "1", 1), ("no", "1", 0), ("no", "0", 1), ("(B)", "b", 1),
         (None, "3", 0)]


def test_answer_correct(spark):
    df = spark.createDataFrame([(i, t, p) for i, (t, p, _) in enumerate(MATCH)], "i int, t string, p string")
    out = dict(rows(ar.with_answer_correct(df, "t", "p", "a"), "i", "a"))
    assert [out[i] for i in range(len(MATCH))] == [e for _, _, e in MATCH]


def test_number_included(spark):
    cases = [("The answer is 2.50", "2.499 units", 1), ("#### 7", "seven", 1), ("18", "18.0", 1),
             ("1,000", "1000", 0), ("abc", "abc", 0)]  # letters are stripped from predictions
    df = spark.createDataFrame([(i, t, p) for i, (t, p, _) in enumerate(cases)], "i int, t string, p string")
    out = dict(rows(ar.with_number_included_correct(df, "t", "p", "ok"), "i", "ok"))
    assert [out[i] for i in range(len(cases))] == [e for _, _, e in cases]


def test_multi_decode_list_accuracy(spark):
    preds = spark.createDataFrame([("m", "q", i, a) for i, a in enumerate("AABCC")],
                                  "ins_md5 string, row_id string, decode_no int, raw_answer string")
    qa = spark.createDataFrame([("q", "question", "A")], "row_id string, question string, answer string")
    r = an.multi_decode_accuracy(preds, qa, parse=False).first()
    assert r.accuracy == pytest.approx(0.4)


def test_prompts_all_positions(spark):
    q = spark.createDataFrame([("Q1?", "Do it."), ("Q2?", "")], "q string, i string")
    def render(qa, pos):
        return [r.p for r in q.select(ar.render_prompt(F.col("q"), F.col("i"), qa, pos).alias("p")).collect()]
    assert render(True, "Q_begin") == ["Q: Do it.\nQ1?\n\nA:", "Q: Q2?\n\nA:"]
    assert render(True, "before_Q") == ["Do it.\nQ: Q1?\n\nA:", "Q: Q2?\n\nA:"]
    assert render(True, "Q_end") == ["Q: Q1?\nDo it.\n\nA:", "Q: Q2?\n\nA:"]
    assert render(True, "A_begin") == ["Q: Q1?\n\nA: Do it.", "Q: Q2?\n\nA:"]
    assert render(False, "Q_begin") == ["Do it.\nQ1?", "Q2?"]
    assert render(False, "Q_end") == ["Q1?\nDo it.", "Q2?"]
    with pytest.raises(ValueError):
        ar.render_prompt(F.col("q"), F.col("i"), False, "A_begin")


def test_choices_and_choice_text(spark):
    df = spark.createDataFrame([("Sun rises?", ["west", "east", "north", "south"], ["A)1", "B)2"])],
                               "q string, o array<string>, a array<string>")
    r = df.select(ar.render_choices(F.col("q"), F.col("o"), "mmlu").alias("m"),
                  ar.render_choices(F.col("q"), F.col("a"), "aqua").alias("a")).first()
    assert r.m == "Sun rises?\n(A) west\n(B) east\n(C) north\n(D) south\nWhat's the answer in (A) (B) (C) (D)?"
    assert r.a == "Sun rises?\n(A)1\n(B)2\nWhat's the answer in (A) (B) (C) (D) (E)?"
    t = spark.createDataFrame([("From where? (A) west (B) east (C) north (D) south", "(B)")], "t string, s string")
    assert t.select(ar.choice_text(F.col("t"), F.col("s")).alias("c")).first().c == "east"


def test_small_text_rules(spark):
    df = spark.createDataFrame([("x [a b] [c]", "  **think** step  ", ": 12\nQ: x", r"so \boxed{42} ok")],
                               "a string, b string, c string, d string")
    r = df.select(ar.extract_bracketed(F.col("a")).alias("a"), ar.polish(F.col("b"), True).alias("b"),
                  ar.first_segment(F.col("c")).alias("c"), ar.boxed_answer(F.col("d")).alias("d"),
                  ar.strip_punctuation(F.lit("a-b.c!")).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == ("a b", "Think step.", "12", "42", "abc")


def test_ledger_report(spark):
    led = spark.createDataFrame([("a", "a", .40, 0), ("b", "b", .05, 1), ("c", "c", .72, 2),
                                 ("d", "d", .72, 3)], "ins_md5 string, instruction string, score double, step int")
    out = rows(an.best_instructions(led, max_num=3, threshold=0.1, buckets=100), "instruction", "score_shown")
    assert out == [("a", 40.0), ("c", 72.0), ("d", 72.0)]
    assert [r[0] for r in rows(an.eval_schedule(led), "instruction")] == ["a", "d"]


def test_curate_candidates(spark):
    outs = spark.createDataFrame([("[Think step by step.]",), ("[Use 2 steps.]",), ("[Put INS here]",),
                                  ("[" + "x" * 501 + "]",), ("[think step by step.]",), ("[Be brief.]",)],
                                 "out string")
    ledger = spark.createDataFrame([(an.md5_text("Be brief."),)], "ins_md5 string")
    got = [r.instruction for r in an.curate_candidates(outs, "out", ledger).collect()]
    assert got == ["Think step by step."]


def test_multiple_choice_branch(spark):
    q = ("From which direction does the sun rise in the morning? "
         "(A) west (B) east (C) north (D) south")
    cases = [("(B)", "east", 1), ("(B)", "(A)", 0), ("(B)", "b", 1), ("B", "(b)", 1),
             ("(B)", "the sun rises in the east", 1), ("(B)", "east or west", 0),
             ("east", "east", 0),  # with a prompt the truth must be a choice letter
             ("(B)", "East.", 1)]  # contains "east", no other choice text
    df = spark.createDataFrame([(i, t, p, q) for i, (t, p, _) in enumerate(cases)],
                               "i int, t string, p string, q string")
    out = dict(rows(ar.with_answer_correct(df, "t", "p", "a", input_col="q"), "i", "a"))
    assert [out[i] for i in range(len(cases))] == [e for _, _, e in cases]
    # list accuracy over decodes with the prompt (A,A,B,C,C vs truth B -> 0.2)
    df2 = spark.createDataFrame([(i, "(B)", a, q) for i, a in enumerate("AABCC")], "i int, t string, p string, q string")
    r = ar.with_answer_correct(df2, "t", "p", "a", input_col="q").agg(F.avg("a")).first()[0]
    assert r == pytest.approx(0.2)


def test_choice_info_precomputed_equals_inline(spark):
    q = "Pick one. (A) red (B) blue (C) green"
    df = spark.createDataFrame([(i, t, p, q) for i, (t, p) in enumerate(
        [("(A)", "red"), ("(C)", "I like green"), ("(B)", "red or blue"), ("(B)", "c")])],
        "i int, t string, p string, q string")
    inline = rows(ar.with_answer_correct(df, "t", "p", "a", input_col="q"), "i", "a")
    pre = df.withColumn("ci", ar.choice_info(F.col("q")))
    shared = rows(ar.with_answer_correct(pre, "t", "p", "a", input_col="q", info_col="ci"), "i", "a")
    assert inline == shared == [(0, 1), (1, 1), (2, 0), (3, 0)]


def test_number_words_hidden_in_tokens(spark):
    """Only the token taken has its number words replaced; a token that holds one is
    not alphabetic, whichever side the search comes from. Long texts too."""
    texts = ["The answer is of often seen xx", "so ninety apples yy", "it was seventeen. then zz", "none",
             "the answer is word word", "alpha beta", "one  ", "the answer is a $5,0 b", "x weighty y=some fiftyone z: 4",
             "word " * 6000 + "forty two", "word " * 6000 + "seventeen", "the answer is " + "word " * 6000 + "threes"]
    want = ["10", "9", "7", "1", "", "", "1", "50", "501", "2", "7", "3"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw_answer string")
    assert [r.parsed_answer for r in an.parse_answers(df).orderBy("i").collect()] == want


def test_answers_are_not_shuffled(spark, tmp_dir):
    """Questions are dealt out before their answers exist."""
    from quarry.plans import q_answers as qa
    spark.createDataFrame([(1, 2, 3, 4, 5.0)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
                          "l_quantity double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    plan = qa.predictions(spark, tmp_dir, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression")


def test_long_texts_are_searched_only_where_needed(spark):
    """Replacing number words in 30,000 characters took 28 searches of each text."""
    from quarry.functions import answer_rules as ar
    df = spark.createDataFrame([("x",)], "raw_answer string")
    taken = ar.with_answer_token(df, "raw_answer", "tok", keep_stages=True).select("_p10_pick")
    assert "replace(" not in taken._jdf.queryExecution().optimizedPlan().toString()


def test_answer_rules_are_fused_in_methods_that_can_be_compiled(spark, tmp_path):
    """No stage of the decode accuracy is longer than HotSpot compiles, else it is given up."""
    from quarry.plans import q_answers
    from quarry.session import COMPILED
    spark.createDataFrame([(1, 1, 2, 3, 5.0)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = q_answers.q_multi_decode_accuracy(spark, str(tmp_path))._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) <= int(COMPILED["spark.sql.codegen.hugeMethodLimit"])
