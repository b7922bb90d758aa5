"""Quotation linking: conversations in reply order, without quotes.

All steps are DataFrame functions.

* A line's quote level is the number of ``>`` in its leading marks. Only
  messages that hold such a line are taken apart into lines; runs of lines of
  one level are passages. A line "On ... wrote:" just before a quote goes with it.
* Passages are normalised (lower case, white space collapsed) and hashed, as
  are every message's own text, its paragraphs and its lines. A passage links to
  the last earlier message of its conversation that has the hash, else to the
  first one, by conversation and turn, of any other conversation (a conversation
  id is no time; reply chains stay inside a conversation, so they never form a
  circle). A passage without a whole match is linked by its paragraphs, to the
  message that most of their characters lead to; else by its lines, to the message
  that more than half of all their characters lead to (one common line is no
  quotation). Ties go to the own conversation, then to the latest message.
* A message replies to the message its lowest-level linked passage names. Roots
  of reply chains are found by pointer doubling; inside a conversation messages
  are ordered by (turn of the root, turn), so replies follow what they answer.
* Nothing gathers a conversation: the last earlier turn is found in buckets of
  turns and then over buckets, positions by one range sort over all messages.

Defined results: null texts are empty; messages without conversation or turn
stay, unlinked and placed by nulls first; repeated rows stay, each with a
place of its own; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

TURNS = 1024          # turns of a bucket
MARK = r"(?m)^[ \t>]*>"
ATTRIBUTION = r"^\s*On [^\n]* wrote:\s*$"
PARAGRAPH = r"(?>\r\n|\r|\n)[ \t]*(?>\r\n|\r|\n)"      # blank lines, of any line end
MAX_ROUNDS = 64       # doubling covers 2**64 steps


def normalised(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def _messages(conversations: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return materialise(conversations.select(
        F.monotonically_increasing_id().alias("uid"), F.col("conv_id").alias("conv"), "turn", "role",
        text.alias("text"), text.rlike(MARK).alias("quotes")), "messages")


def lines(messages: DataFrame) -> DataFrame:
    """``(uid, conv, turn, pos, level, body)``: lines of messages with quotes."""
    raw = (messages.where("quotes")
           .select("uid", "conv", "turn", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("pos", "line"))
           .withColumn("mark", F.regexp_extract("line", r"^[ \t>]*>", 0))
           .withColumn("level", F.length(F.regexp_replace("mark", "[^>]", "")))
           .withColumn("body", F.regexp_replace(F.expr("substring(line, length(mark) + 1)"), "^ ", "")))
    here = Window.partitionBy("uid").orderBy("pos")
    head = ((F.col("level") == 0) & F.col("body").rlike(ATTRIBUTION)
            & (F.coalesce(F.lead("level").over(here), F.lit(0)) > 0))
    return raw.withColumn("head", head).where("not head").select("uid", "conv", "turn", "pos", "level", "body")


def _joined(order: str, value: str) -> Column:
    """The group's values in order, one per line; a group is part of one message."""
    both = F.sort_array(F.collect_list(F.struct(order, value)))
    return F.array_join(F.transform(both, lambda x: x[value]), "\n")


def _own_texts(messages: DataFrame, parts: DataFrame) -> DataFrame:
    """``(uid, conv, turn, own)`` of every message."""
    cut = parts.where("level = 0").groupBy("uid").agg(_joined("pos", "body").alias("own"))
    plain = messages.where("not quotes").select("uid", "conv", "turn", F.col("text").alias("own"))
    quoting = (messages.where("quotes").select("uid", "conv", "turn").join(cut, "uid", "left")
               .select("uid", "conv", "turn", F.trim(F.regexp_replace(
                   F.coalesce("own", F.lit("")), r"^\s+|\s+$", "")).alias("own")))
    return plain.unionByName(quoting)


def _passages(parts: DataFrame) -> DataFrame:
    """``(uid, run, conv, turn, level, passage)``."""
    here = Window.partitionBy("uid").orderBy("pos")
    new = (F.col("level") != F.coalesce(F.lag("level").over(here), F.lit(-1))).cast("int")
    runs = parts.withColumn("new", new).withColumn("run", F.sum("new").over(here))
    return (runs.where("level > 0").groupBy("uid", "run", "conv", "turn", "level")
            .agg(_joined("pos", "body").alias("passage")))


def _pieces(text: Column) -> list[Column]:
    """A text itself, its paragraphs and its lines, as arrays of normalised pieces."""
    cut = [F.array(text), F.split(text, PARAGRAPH), F.split(text, r"\r\n|\r|\n")]
    return [F.filter(F.transform(c, normalised), lambda x: x != "") for c in cut]


def _units(text: Column) -> Column:
    """Distinct normalised pieces of a text: itself, its paragraphs, its lines."""
    return F.array_distinct(F.concat(*_pieces(text)))


def _asked(passages: DataFrame) -> DataFrame:
    """``(uid, run, level, conv, turn, whole, total, hash, chars)``: hashes to look up;
    ``whole`` is 2 for the passage, 1 for its distinct paragraphs, 0 for its distinct
    lines; ``chars`` is a piece's length, ``total`` that of all pieces of its kind."""
    keep = ["uid", "run", "level", "conv", "turn"]
    whole, paragraphs, lines = map(F.array_distinct, _pieces(F.col("passage")))

    def kind(rank: int, pieces: Column) -> Column:
        total = F.aggregate(pieces, F.lit(0).cast("long"), lambda n, x: n + F.length(x))
        return F.struct(F.lit(rank).alias("whole"), total.alias("total"), pieces.alias("pieces"))

    kinds = passages.select(*keep, F.inline(F.array(kind(2, whole), kind(1, paragraphs), kind(0, lines))))
    return (kinds.select(*keep, "whole", "total", F.explode("pieces").alias("piece"))
            .select(*keep, "whole", "total", F.md5("piece").alias("hash"), F.length("piece").alias("chars")))


def _found(asked: DataFrame, units: DataFrame) -> DataFrame:
    """``asked`` with ``o_conv, o_turn, same`` of its original; unlinked rows go."""
    units = units.join(asked.select("hash").distinct(), "hash", "left_semi")
    bucket = F.floor(F.col("turn") / TURNS)
    both = (units.select("conv", "hash", "turn", F.col("turn").alias("o"))
            .unionByName(asked.select("conv", "hash", "turn").distinct()
                         .withColumn("o", F.lit(None).cast("long"))).withColumn("b", bucket))
    before = lambda *by: (Window.partitionBy(*by[:-1]).orderBy(by[-1])
                          .rangeBetween(Window.unboundedPreceding, -1))
    tops = (both.groupBy("conv", "hash", "b").agg(F.max("o").alias("m"))
            .withColumn("carry", F.max("m").over(before("conv", "hash", "b"))).drop("m"))
    near = (both.withColumn("in", F.max("o").over(before("conv", "hash", "b", "turn"))).where("o is null")
            .join(tops, ["conv", "hash", "b"])
            .select("conv", "hash", "turn", F.coalesce("in", "carry").alias("near")))
    # The first turn in each of a hash's two smallest conversations: one of them is another one.
    place = F.row_number().over(Window.partitionBy("hash").orderBy("conv"))
    firsts = (units.groupBy("hash", "conv").agg(F.min("turn").alias("turn")).withColumn("k", place).where("k <= 2")
              .groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("first"),
                                   F.max(F.struct("conv", "turn")).alias("second")))
    other = F.when(F.col("first.conv") != F.col("conv"), F.col("first")).when(
        F.col("second.conv") != F.col("conv"), F.col("second"))
    return (asked.join(near, ["conv", "hash", "turn"], "left").join(firsts, "hash", "left")
            .withColumn("other", other).withColumn("same", F.col("near").isNotNull().cast("int"))
            .withColumn("o_conv", F.when(F.col("same") == 1, F.col("conv")).otherwise(F.col("other.conv")))
            .withColumn("o_turn", F.when(F.col("same") == 1, F.col("near")).otherwise(F.col("other.turn")))
            .where("o_turn is not null").drop("near", "first", "second", "other"))


def link_passages(messages: DataFrame, parts: DataFrame, own: DataFrame) -> DataFrame:
    """``(uid, run, level, conv, turn, o_conv, o_turn)``: one original per linked passage."""
    units = (own.where("conv is not null and turn is not null")
             .select("conv", "turn", F.explode(_units(F.col("own"))).alias("u"))
             .select("conv", "turn", F.md5("u").alias("hash")).distinct())
    asked = materialise(_asked(_passages(parts).where("conv is not null and turn is not null")), "quoted")
    passage = ["uid", "run", "level", "conv", "turn"]
    covered = (_found(asked, units).groupBy(*passage, "whole", "total", "same", "o_turn", "o_conv")
               .agg(F.sum("chars").alias("covered"))
               .where((F.col("whole") > 0) | (2 * F.col("covered") > F.col("total"))))
    best = F.max(F.struct("whole", "covered", "same", "o_turn", "o_conv")).alias("best")
    return (covered.groupBy(*passage).agg(best)
            .select("uid", "run", "level", "conv", "turn", "best.o_conv", "best.o_turn"))


def _roots(parents: DataFrame) -> DataFrame:
    """``(conv, turn, up, depth)``: the top of each reply chain inside a conversation."""
    cur = materialise(parents, "replies")
    for _ in range(MAX_ROUNDS):
        step = cur.select(F.col("conv").alias("_c"), F.col("turn").alias("_t"),
                          F.col("up").alias("_up"), F.col("depth").alias("_d"))
        nxt = materialise(
            cur.join(step, (F.col("conv") == F.col("_c")) & (F.col("up") == F.col("_t")), "left")
            .select("conv", "turn", F.coalesce("_up", "up").alias("up"),
                    (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
                    F.col("_up").isNotNull().alias("moved")), "replies")
        cur = nxt.drop("moved")
        if not nxt.where("moved").limit(1).count():
            return cur
    raise RuntimeError("reply chains did not settle")


def _positions(rows: DataFrame) -> DataFrame:
    """``(uid, position)`` from 0 in each conversation, by one range sort: places
    in a range plus the ranges before, less the conversation's first place."""
    order = ["conv", "root_turn", "turn", "uid"]
    placed = materialise(rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("n", F.monotonically_increasing_id()), "reply-order")
    part = F.shiftright("n", 33)                    # the id holds the partition above bit 33
    placed = placed.withColumn("part", part).withColumn("n", F.col("n") - F.shiftleft(part, 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    run = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("part", F.coalesce(F.sum("size").over(run), F.lit(0)).alias("skip"))
    places = placed.join(offset, "part").withColumn("place", F.col("n") + F.col("skip"))
    first = places.groupBy(F.col("conv").alias("_conv")).agg(F.min("place").alias("first"))
    return (places.join(first, F.col("conv").eqNullSafe(F.col("_conv")))
            .select("uid", (F.col("place") - F.col("first")).alias("position")))


def chat(role: Column, text: Column) -> Column:
    """One message of a chat transcript."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"), text,
                    F.lit("<|im_end|>\n"))


def reply_order(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position, turn, role, text, quoted, linked, reply_conv,
    reply_turn, root_turn, depth, formatted)`` of every message of
    ``conversations (conv_id, turn, role, text)``; ``text`` has no quotes left."""
    messages = _messages(conversations)
    parts = materialise(lines(messages), "quote-lines")
    own = _own_texts(messages, parts)
    links = materialise(link_passages(messages, parts, own), "quote-links")
    quoted = _passages(parts).groupBy("uid").agg(F.count(F.lit(1)).alias("quoted"))
    parent = (links.groupBy("uid", "conv", "turn")
              .agg(F.count(F.lit(1)).alias("linked"), F.max(F.struct(
                  (-F.col("level")).alias("l"), (F.col("o_conv") == F.col("conv")).alias("same"),
                  "o_turn", "o_conv")).alias("p"))
              .select("uid", "conv", "turn", "linked", F.col("p.o_conv").alias("reply_conv"),
                      F.col("p.o_turn").alias("reply_turn")))
    parent = materialise(parent, "reply-parents")
    inside = (parent.where("reply_conv = conv").groupBy("conv", "turn")
              .agg(F.max("reply_turn").alias("up")).withColumn("depth", F.lit(1).cast("long")))
    roots = _roots(inside)
    roots = (parent.where("reply_conv = conv").select("uid", "conv", "turn")
             .join(roots, ["conv", "turn"]).select("uid", "up", "depth"))
    replies = (messages.select("uid", "conv", "turn").join(roots, "uid", "left")
               .select("uid", "conv", "turn", F.coalesce("up", "turn").alias("root_turn"),
                       F.coalesce("depth", F.lit(0)).cast("long").alias("depth")))
    replies = materialise(replies, "reply-roots")
    text = own.select("uid", F.col("own").alias("text"))
    return (messages.select("uid", F.col("conv").alias("conv_id"), "turn", "role")
            .join(text, "uid").join(_positions(replies), "uid")
            .join(replies.select("uid", "root_turn", "depth"), "uid")
            .join(quoted, "uid", "left")
            .join(parent.select("uid", "linked", "reply_conv", "reply_turn"), "uid", "left")
            .select("conv_id", "position", "turn", "role", "text",
                    F.coalesce("quoted", F.lit(0)).cast("long").alias("quoted"),
                    F.coalesce("linked", F.lit(0)).cast("long").alias("linked"),
                    "reply_conv", "reply_turn", "root_turn", "depth",
                    chat(F.col("role"), F.col("text")).alias("formatted")))
