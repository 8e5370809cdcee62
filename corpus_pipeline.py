"""The training-data pipeline: documents through quality rules, exact and near deduplication, source mixing and BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet in the shared checkpoint
folder and reads it again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from contestlab.llm.bpe import bpe_encode
from contestlab.llm.exact_dedup import drop_copies
from contestlab.llm.mixing import mixed
from contestlab.llm.ngram_join import one_of_each_class
from contestlab.llm.quality_rules import quality_filter
from contestlab.session import materialize_scratch
from contestlab.sources.tables import read_table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_encode(docs, VOCABULARY)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing sources", mixing), ("BPE", encode)]

#: The trained rules, the draws of the sample and the merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize_scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
