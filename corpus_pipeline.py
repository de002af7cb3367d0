"""The corpus pipeline: stages that turn `documents` into a training mix.

Every stage calls one operator of `staylens.llm` on everything its predecessor
kept. Its result is written as Parquet and read again as the next stage's
documents, so a lost executor repeats one stage at most. Empty input passes
through every stage; null texts are rejected by the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import decontaminate, jaccard, langid, mixing, substrings
from staylens.llm.common import table, written

WINDOW = 35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language is not recognised: no letters, or a
    probability under the calibrated limit. Learns from the labelled ones."""
    return langid.keep_known(docs, langid.learn_from(docs, F.lit(True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by shingle similarity >= 0.8."""
    return jaccard.keep_one(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated word windows out of the texts; `n_chars` follows the text."""
    cut = substrings.remove_repeats(docs, n=WINDOW)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark, word for word or
    paraphrased."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Weighted fair queueing over what is left: one row per copy taken, the
    columns of documents and `copy`."""
    return mixing.mixture(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", remove_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SQL cannot express the trained and the recursive stages; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
