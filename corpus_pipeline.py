"""The corpus pipeline: toxicity filter, near-duplicate removal, source mixing,
packing. Each stage is written as Parquet and read again as the next one's
documents, so a lost executor never reaches back over a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import mixing, packing, simhash, toxicity
from quarry.llm.common import crc_mod5, materialise, table

# SQL has neither the classifier, XXH64 fingerprints nor the tokenizer.
ORACLE_SQL = None
# A source may be repeated so often to level the mix; none is cut.
REPEATS = 1.25


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod5() != 0)
    return toxicity.reject(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources repeated."""
    return mixing.apply(docs, repeats=REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their sequences."""
    return packing.pack_documents(docs, end_id=0)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
