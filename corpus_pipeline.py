"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's rows as Parquet in
the folder all executors share and reads them again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import Scratch
from tessera.llm.exact import drop_exact
from tessera.llm.mixing import mixed_texts
from tessera.llm.near import drop_near
from tessera.llm.packing import pack_documents
from tessera.llm.quality import keep_good
from tessera.llm.tokens import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of equal texts."""
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near copies (five words, similarity 0.8)."""
    return drop_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share; a source below its share is repeated, up to three times."""
    return mixed_texts(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixing", mixing), ("packing", packing)]

#: No SQL: the classifier, the tokenizer and the near-copy search can't be told in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    before = None
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
