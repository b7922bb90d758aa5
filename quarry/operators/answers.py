"""Instruction evaluation as table jobs.

The reference calls a language model per prompt; here model outputs arrive as
a table ``(ins_md5, row_id, decode_no, raw_answer)`` and everything around the
call is DataFrame work: rendering prompts (instruction x question), parsing
and scoring answers, aggregating scores per instruction and question, and
curating new candidate instructions against the ledger of scored ones.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import answer_rules as ar


def md5_text(s: str) -> str:
    return hashlib.md5(s.encode("utf-8")).hexdigest()


def _instruction_array(instructions: list[str]):
    """The instruction list, a job parameter, as a literal array: a generator
    over it needs neither a join nor a cross product."""
    return F.array(*[F.struct(F.lit(i).alias("ins_idx"), F.lit(s).alias("instruction"),
                              F.lit(md5_text(s)).alias("ins_md5"))
                     for i, s in enumerate(instructions)])


def build_eval_prompts(qa: DataFrame, instructions: list[str], include_qa: bool = True,
                       position: str = "Q_begin") -> DataFrame:
    """Every instruction x every QA row -> ``(ins_md5, row_id, prompt)``."""
    rows = qa.select("row_id", "question", F.explode(_instruction_array(instructions)).alias("i"))
    return rows.select(F.col("i.ins_md5").alias("ins_md5"), "row_id",
                       ar.render_prompt(F.col("question"), F.col("i.instruction"),
                                        include_qa, position).alias("prompt"))


def parse_answers(preds: DataFrame, num_decimals: int = 0, gpt_boxed: bool = False) -> DataFrame:
    """Adds ``parsed_answer``: P10 normalisation (or the first ``\\boxed{}``
    for GPT-style outputs) then the first-segment cut (P17)."""
    p = ar.with_normalized_answer(preds, "raw_answer", "_norm", num_decimals)
    norm = F.col("_norm")
    if gpt_boxed:
        norm = F.coalesce(ar.boxed_answer(F.col("raw_answer")), norm)
    return p.withColumn("parsed_answer", ar.first_segment(norm)).drop("_norm")


def score_predictions(preds: DataFrame, qa: DataFrame, instructions: list[str],
                      include_qa: bool = True, position: str = "Q_begin") -> DataFrame:
    """Evaluation rows: ``(ins_md5, row_id, raw_prompt, raw_answer,
    parsed_answer, true_answer, accuracy)``.

    Predictions are matched to their question by ``row_id`` (left join: a
    missing question scores 0). With several decodes per question the
    accuracy is their mean (A22) and the first decode's texts are shown.
    One aggregate per (question, instruction) gives the mean and the first
    decode's texts; at scale the question join's hash partitioning on
    ``row_id`` already satisfies it.
    """
    ins = F.explode(_instruction_array(instructions)).alias("i")
    names = preds.sparkSession.range(1).select(ins).select("i.ins_md5", "i.instruction")
    p = parse_answers(preds)
    j = p.join(qa.select("row_id", "question", F.col("answer").alias("true_answer")),
               "row_id", "left")
    j = ar.with_answer_correct(j, "true_answer", "parsed_answer", "acc")
    texts = F.struct("raw_answer", "parsed_answer", "true_answer", "question")
    first = (j.groupBy("row_id", "ins_md5").agg(F.avg(F.col("acc").cast("double")).alias("accuracy"),
                                                F.min_by(texts, "decode_no").alias("_f"))
             .select("row_id", "ins_md5", "accuracy", "_f.*")
             .join(F.broadcast(names), "ins_md5", "left"))   # as long as the parameter list
    prompt = ar.render_prompt(F.col("question"), F.col("instruction"), include_qa, position)
    return first.select("ins_md5", "row_id", prompt.alias("raw_prompt"), "raw_answer",
                        "parsed_answer", "true_answer", "accuracy")


def instruction_score(results: DataFrame) -> DataFrame:
    """Mean accuracy per instruction."""
    return results.groupBy("ins_md5").agg(F.avg("accuracy").alias("score"),
                                          F.count(F.lit(1)).cast("bigint").alias("n"))


def wrong_question_counts(results: DataFrame) -> DataFrame:
    """How many instructions got each question wrong."""
    return (results.where(F.col("accuracy") == 0).groupBy("row_id")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_wrong")))


def multi_decode_accuracy(preds: DataFrame, qa: DataFrame, parse: bool = True,
                          input_col: str | None = None) -> DataFrame:
    """Per (instruction, question) the mean 0/1 over all decodes.
    ``parse=False`` scores ``raw_answer`` as already-parsed answers; with
    ``input_col`` (a column of ``qa`` holding the prompt with its choices)
    the multiple-choice rules apply."""
    p = parse_answers(preds) if parse else preds.withColumn("parsed_answer", F.col("raw_answer"))
    cols = ["row_id", F.col("answer").alias("t")]
    if input_col:   # choice texts once per question, not once per decode
        cols += [input_col, ar.choice_info(F.col(input_col)).alias("_choices")]
    p = p.join(qa.select(*cols), "row_id", "left")
    p = ar.with_answer_correct(p, "t", "parsed_answer", "acc", input_col=input_col,
                               info_col="_choices" if input_col else None)
    return p.groupBy("ins_md5", "row_id").agg(F.avg(F.col("acc").cast("double")).alias("accuracy"))


def number_included_accuracy(preds: DataFrame, qa: DataFrame) -> DataFrame:
    """Percent of predictions numerically right after normalising both
    target and prediction; the second figure repeats the first, as there. A
    prediction without a question counts as wrong."""
    p = preds.join(qa.select("row_id", F.col("answer").alias("t")), "row_id", "left")
    p = ar.with_number_included_correct(p, "t", "raw_answer", "ok")
    return p.groupBy("ins_md5").agg((F.avg(F.col("ok").cast("double")) * 100).alias("accuracy")) \
        .withColumn("accuracy_with_calc", F.col("accuracy"))


def best_instructions(ledger: DataFrame, max_num: int = 20, threshold: float | None = 0.1,
                      buckets: int | None = 100) -> DataFrame:
    """T4: the ``max_num`` best-scored instructions, those at or above the
    threshold (all without one), with the score shown as round(score * buckets) (half to even)
    or to 3 decimals when unbounded.

    Fix: the reference ignores the passed threshold (``0.1 or x``); the
    argument is used here. Ties keep the later step (stable ascending sort,
    last ``max_num`` taken).
    """
    top = ledger.orderBy(F.desc("score"), F.desc("step")).limit(max_num)
    shown = (F.bround(F.col("score") * buckets, 0).cast("bigint").cast("double") if buckets
             else F.bround("score", 3))
    if threshold:
        top = top.where(F.col("score") >= threshold)
    return top.withColumn("score_shown", shown)


def eval_schedule(ledger: DataFrame, every: int = 3) -> DataFrame:
    """Instructions whose step is evaluated on the held-out rows."""
    return ledger.where(F.col("step") % every == 0)


def curate_candidates(raw_outputs: DataFrame, text: str, ledger: DataFrame) -> DataFrame:
    """New candidate instructions ``(ins_md5, instruction)``: the first
    bracketed text of each output, polished, not in the ledger (by MD5),
    each once, then the filter (<= 500 chars, no digit, no 'INS').

    Fix: the whole ledger is the seen-set, initial instructions included.
    """
    c = raw_outputs.select(ar.polish(ar.extract_bracketed(F.col(text))).alias("instruction"))
    c = c.withColumn("ins_md5", F.md5("instruction"))
    c = c.join(ledger.select("ins_md5"), "ins_md5", "left_anti").dropDuplicates(["ins_md5"])
    return c.where(ar.candidate_ok(F.col("instruction"))).select("ins_md5", "instruction")


def rank_by_score(df: DataFrame, score: str, name: str) -> DataFrame:
    """T5: rows by score descending, name ascending, with the rank."""
    w = Window.orderBy(F.desc(score), F.asc(name))
    return df.withColumn("rank", F.row_number().over(w).cast("bigint"))
