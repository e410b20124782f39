"""The training-data pipeline: documents through five operators, each stage written and read again.

toxicity     documents that the scorer rejects go
exact_dedup  of texts that are equal without blanks the longest stays
near_dedup   of each group of near duplicates the document with the smallest id stays
mixing       documents are taken as often as the mix of sources wants, none to three times
encoding     byte-level BPE of what is left: ids, their digest, and the decoded bytes' digest

Stages take and return the columns of ``documents``; the last returns one row
per document of the mix.  Rows with null texts pass as empty texts, empty tables
give empty tables, further columns are carried along.
"""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession

from chronoloom.llm import exact_dedup, merge_replay, minhash, mixing, toxicity
from chronoloom.llm.common import read_table, written


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, read_table(spark, sf_dir, "labels"))


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.unique_rows(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def _encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return merge_replay.encoded(docs, vocabularies.path("byte_bpe_multi_50k.tiktoken"), vocabularies.PATTERN, with_ids=True)


STAGES = [("toxicity", _toxicity), ("exact_dedup", _exact), ("near_dedup", _near), ("mixing", _mixing), ("encoding", _encoding)]

#: The scorer, the random order of the mix and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
