"""The training-data pipeline: toxicity, exact dedup, near dedup, mixing, token ids.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame.  ``run`` applies them in order to
``documents``, each stage written as Parquet in the shared folder and read
again as the next one's input.  All stages but the last return the columns of
``documents``.

1. ``toxicity``: documents whose whole text scores 0.3 or more go.
2. ``exact_dedup``: of identical texts the row with the largest id stays.
3. ``near_dedup``: of each group linked by five-word shingles (Jaccard 0.8)
   the row with the smallest id stays.
4. ``mixing``: sources are mixed to their target weights; a row for each copy
   that the mix takes, in training order.  Rows without words take no part.
5. ``bpe``: every row is encoded and decoded: ``doc_id, n_tokens,
   ids_sha256, decoded_sha256``.

Each operator's module states what it does with nulls, empty and long texts,
ties, repeated rows, empty tables and extra columns; the stages add nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshard.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from lakeshard.llm.common import prepare, stored
from lakeshard.llm.queries import WORD_BPE
from lakeshard.sources.tables import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.reject(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.keep_first(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.digests(docs, WORD_BPE)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_dedup_stage), ("near_dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: the classifier of the first stage is trained, and the tokenizer of the last is no SQL; tests hold both against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
