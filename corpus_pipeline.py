"""Corpus pipeline: toxicity, near duplicates, benchmark passages, source mixing, sharding.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and works on all rows of
``docs``; what it returns is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``documents``, in their order; other columns are dropped on entry, so
their names cannot clash. Every stage keeps rows that it has no reason to drop: null ids and texts,
empty texts, repeated rows. Empty tables go through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import decontamination, minhash, mixing, scoring, sharding, toxicity
from glossa.llm.plan import discard, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; labels of held-out rows are not learned from.

    Null and empty texts get the model's base score, repeated rows the same score each; a null id is
    scored as any other; ties at the threshold go; without labels fixed weights hold.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs.select(*COLUMNS), labels, ~scoring.in_part(F.col("doc_id"), 3, 1))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id.

    Rows without words are in no group and stay; rows that repeat an id and its text share their fate;
    of an id with two texts each text has its own; a row without an id goes where its group has ids.
    """
    return minhash.keep_one(docs.select(*COLUMNS))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that hold little else go.

    Null and empty texts, and documents without a hit, pass as they are; n_chars follows the text;
    repeated rows are cut alike; an empty benchmark cuts nothing.
    """
    return decontamination.remove_spans(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, as often as it takes them (rounded up to whole documents).

    Rows without words stay once; a null source is a source of its own; rows that are alike are taken
    alike; ties in the seeded order go by id.
    """
    return mixing.apply_mixture(docs.select(*COLUMNS))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot; null texts weigh 16 bytes, and copies of a text stay together unless they fill much of a shard."""
    return sharding.shard_rows(docs.select(*COLUMNS), keep=COLUMNS[1:])


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", cut_benchmark), ("mixing", mix_sources), ("sharding", shard)]

#: The first stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, done = staged(stage(spark, docs, sf_dir), name), before
        before = docs
        if done is not None:
            discard(done)
    return STAGES[-1][1](spark, docs, sf_dir)
