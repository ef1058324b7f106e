"""Corpus pipeline: five stages over ``documents``, each calling one training-data operator.

Language ID -> toxicity -> near duplicates -> benchmark decontamination -> byte-level BPE. Every stage
works on all rows that its predecessor kept and returns all columns as they are; the last one returns the
token counts and digests of what remains. Each stage's result is written as Parquet to the shared folder
that ``spark.checkpoint.dir`` names and read again as the next stage's documents, so a lost executor costs
a task, not a stage.

Defined results: see the operators. In short, null, empty and letterless texts go at the language stage;
rows without doc_id pass every stage; repeated rows of one doc_id become one at the near-duplicate stage;
an empty table passes as an empty table; further columns of any name stay.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statlayer.llm import bpe, decontaminate, langid, near_dup, toxicity
from statlayer.llm.common import release_executors, stored, table
from statlayer.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language."""
    return langid.keep_known(docs, langid.train(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity score reaches the threshold."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group."""
    return near_dup.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""
    return decontaminate.keep_unleaked(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes they decode to."""
    coded = bpe.encode(docs, *tokenizer(), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def released(stage):
    """The stage, started once the executors have given back what its predecessor left."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_executors(spark)
        return stage(spark, docs, sf_dir)
    return run


STAGES = [
    ("language_id", language),
    ("toxicity", released(toxic)),
    ("near_duplicates", released(near_duplicates)),
    ("decontamination", released(decontaminated)),
    ("byte_bpe", released(encoded)),
]

# The stages learn models and run merges that SQL cannot express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return stored(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
