"""Readers for the reference's file formats, each returning a typed DataFrame.

Text formats are read with Spark's own sources (text, CSV, JSON) so files are
split and read in parallel; declared schemas prune columns in the source.
Where a record depends on earlier lines (the rating dump's movie headers),
the dependency is resolved per split plus a carry-in table with one row per
split, never by reading a file in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def _lines(spark: SparkSession, paths) -> DataFrame:
    """Lines with their file, split start and a position that increases in
    read order within a task (one split is always read by one task)."""
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"))


def read_baskets(spark: SparkSession, paths) -> DataFrame:
    """One basket per line, items split on ',', stripped, empty items
    dropped. Exploded: ``(basket_id, item)``; basket_id = line position."""
    lines = _lines(spark, paths)
    items = F.filter(F.transform(F.split("value", ","), lambda x: F.trim(x)), lambda x: x != "")
    return lines.select(F.col("pos").alias("basket_id"), F.explode(items).alias("item"))


def forward_fill_headers(lines: DataFrame, header: F.Column) -> DataFrame:
    """Carry the last header value down to the following lines, across
    split and file borders (files in name order), as one sequential reader
    would.

    One pass reads each split in order, carries headers down inside it and closes it
    with a marker row that holds its last header; lines stay in the task that read
    them. The pass is written to the shared folder, so the input is read once. A table
    with one row per split (the markers) gives each split its carry-in, which only
    the lines above a split's first header have to look up.
    Adds ``hdr`` (this line's own header or NULL) and ``current``.
    """
    d = lines.withColumn("hdr", header)
    names = d.columns
    kind = d.schema["hdr"].dataType
    schema = T.StructType([*d.schema.fields, T.StructField("current", kind), T.StructField("_mark", T.BooleanType())])

    def carry(batches):
        split, value, shape = None, None, None

        def marker():
            at = {"file": split[0], "block": split[1], "current": value, "_mark": True}
            return pa.RecordBatch.from_arrays([pa.array([at.get(f.name)], f.type) for f in shape], schema=shape)

        for b in batches:
            if not b.num_rows:
                continue
            if shape is None:
                shape = b.schema.append(pa.field("current", b.column("hdr").type)).append(pa.field("_mark", pa.bool_()))
            file = b.column("file").dictionary_encode()
            block = b.column("block").to_numpy()
            code = file.indices.to_numpy()
            cuts = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                some = b.slice(i, j - i)
                here = (file.dictionary[int(code[i])].as_py(), int(block[i]))
                if here != split:
                    if split is not None:
                        yield marker()
                    split, value = here, None
                own = some.column("hdr")
                last = np.maximum.accumulate(np.where(own.is_valid().to_numpy(zero_copy_only=False), np.arange(j - i), -1))
                current = own.take(pa.array(np.maximum(last, 0)))
                if (last < 0).any():
                    head = int((last < 0).sum())
                    current = pa.concat_arrays([pa.array([value] * head, own.type), current.slice(head)])
                yield pa.RecordBatch.from_arrays([*some.columns, current, pa.nulls(j - i, pa.bool_())], schema=shape)
                value = current[j - i - 1].as_py()
        if split is not None:
            yield marker()

    path = scratch_path(d.sparkSession, "carried")
    d.mapInArrow(carry, schema).write.parquet(path)
    done = d.sparkSession.read.schema(schema).parquet(path)
    rows = done.where("_mark is null")
    per_split = done.where("_mark").select("file", "block", F.col("current").alias("_last"))
    above = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.last("_last", ignorenulls=True).over(above(Window.partitionBy("file").orderBy("block")))
    per_file = per_split.groupBy("file").agg(
        F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("block"))).alias("_flast"))
    files = per_file.select("file", F.last("_flast", ignorenulls=True).over(
        above(Window.orderBy("file"))).alias("_before"))
    carried = (per_split.withColumn("_in", inside).join(files, "file")
               .select("file", "block", F.coalesce("_in", "_before").alias("_carry")))
    top = (rows.where("current is null").join(carried, ["file", "block"])
           .withColumn("current", F.col("_carry")))
    return rows.where("current is not null").select(*names, "current").unionByName(top.select(*names, "current"))


def read_ratings(spark: SparkSession, paths) -> DataFrame:
    """S2 + P1: a line with ':' is a movie header; other lines are
    ``user,rate,date`` ratings of the current movie. The movie id carries
    over file borders (files in name order), as in the reference.
    Fix: blank lines are dropped (the reference counts then fails on them).
    Returns ``(movie_id, user_id, rate, rated_on)``; dates stay ISO text."""
    lines = _lines(spark, paths).where(F.trim("value") != "")
    parts = F.split("value", ",")
    rating = F.when(~F.col("value").contains(":"), F.struct(
        F.trim(parts[0]).cast("bigint").alias("user_id"), F.trim(parts[1]).cast("int").alias("rate"),
        F.trim(parts[2]).alias("rated_on")))
    hdr = F.when(F.col("value").contains(":"),
                 F.trim(F.substring_index("value", ":", 1)).cast("bigint"))
    parsed = lines.select("file", "block", rating.alias("r"), hdr.alias("head"))
    filled = forward_fill_headers(parsed, F.col("head"))
    return filled.where("r is not null").select(F.col("current").alias("movie_id"), "r.user_id", "r.rate", "r.rated_on")


def read_titles(spark: SparkSession, paths) -> DataFrame:
    """S3: ``id,year,title`` in ISO-8859-1; the title keeps its commas (split
    with limit 3); stripped; a duplicate id keeps its last line."""
    raw = (spark.read.option("encoding", "ISO-8859-1").option("sep", "\u0001")
           .option("quote", "").option("header", "false").schema("value string").csv(paths)
           .select("value", F.col("_metadata.file_path").alias("file"),
                   F.monotonically_increasing_id().alias("pos")))
    p = F.split("value", ",", 3)
    t = raw.where(F.size(p) == 3).select(
        F.trim(p[0]).cast("bigint").alias("movie_id"),
        F.trim(p[1]).try_cast("int").alias("year"),
        F.trim(p[2]).alias("title"), "file", "pos")
    last = F.struct("file", "pos")
    return t.groupBy("movie_id").agg(F.max_by("year", last).alias("year"),
                                     F.max_by("title", last).alias("title"))


def read_adjacency(spark: SparkSession, paths) -> DataFrame:
    """``user<whitespace>f1,f2,...``; a missing list is empty.
    Returns the line form ``(user_id, friends array<bigint>)``; use
    ``adjacency_edges`` for the edge table."""
    lines = spark.read.text(paths).where(F.trim("value") != "")
    p = F.split(F.trim("value"), r"\s+", 2)
    friends = F.when(F.size(p) > 1,
                     F.transform(F.filter(F.split(p[1], ","), lambda x: F.trim(x) != ""),
                                 lambda x: F.trim(x).cast("bigint")))
    return lines.select(p[0].cast("bigint").alias("user_id"),
                        F.coalesce(friends, F.array().cast("array<bigint>")).alias("friends"))


def adjacency_edges(adj: DataFrame) -> DataFrame:
    """Edge table ``(src, dst)`` of adjacency lines (lines stay one row each
    until here; an empty list yields no edge)."""
    return adj.select(F.col("user_id").alias("src"), F.explode("friends").alias("dst"))


def read_points(spark: SparkSession, paths) -> DataFrame:
    """Comma-separated floats per line -> ``(id, features)``."""
    lines = _lines(spark, paths).where(F.trim("value") != "")
    return lines.select(F.col("pos").alias("id"),
                        F.transform(F.split("value", ","), lambda x: F.trim(x).cast("double"))
                        .alias("features"))


REVIEW_JSON_SCHEMA = "reviewText string, overall double"


def read_reviews_json(spark: SparkSession, paths) -> DataFrame:
    """JSON lines; only the two needed fields are decoded."""
    return spark.read.schema(REVIEW_JSON_SCHEMA).json(paths)


def read_reviews_tsv(spark: SparkSession, paths) -> DataFrame:
    """TSV with header, quoting off."""
    return (spark.read.option("sep", "\t").option("header", "true").option("quote", "")
            .schema("Review string, Liked int").csv(paths))


def read_qa_tsv(spark: SparkSession, paths) -> DataFrame:
    """question/answer TSV without header -> ``(row_id, question,
    answer)``, row_id in read order."""
    return (spark.read.option("sep", "\t").option("header", "false")
            .schema("question string, answer string").csv(paths)
            .withColumn("row_id", F.monotonically_increasing_id())
            .select("row_id", "question", "answer"))


def read_jsonl_options(spark: SparkSession, paths) -> DataFrame:
    """Multiple-choice JSON lines (question, options[], ...)."""
    return spark.read.schema(
        "question string, options array<string>, rationale string, correct string").json(paths)


def read_bbh_examples(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON object per task file; only the file's first line is
    used (kept by the task that reads it: nothing is grouped or shuffled); its ``examples`` are exploded to ``(task, input, target)`` with
    both fields as text. Tasks are file stems without a further dot."""
    raw = (spark.read.option("pathGlobFilter", "*.json").text(folder)
           .select("value", F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_path").alias("path"),
                   F.col("_metadata.file_block_start").alias("block"))
           .where("block = 0"))

    def first_lines(batches):
        path = None
        for b in batches:
            paths = b.column("path").to_pylist()
            new = [i for i, p in enumerate(paths) if p != (paths[i - 1] if i else path)]
            path = paths[-1] if paths else path
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(new, pa.int64())) for c in ("value", "name")],
                                             names=["value", "name"])

    first = raw.mapInArrow(first_lines, "value string, name string")
    task = F.substring_index("name", ".json", 1)
    first = first.where(~task.contains(".")).withColumn("task", task)
    ex = F.from_json("value", "examples array<struct<input string, target string>>")
    return (first.select("task", F.explode(ex["examples"]).alias("e"))
            .select("task", F.col("e.input").alias("input"), F.col("e.target").alias("target")))
