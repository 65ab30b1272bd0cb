"""A corpus from documents to tokens: five stages, each working on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commuta.llm import bpe, decontaminate, exact, jaccard, toxicity
from commuta.llm.batches import bounded
from commuta.operators.lineage import written_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Words and pieces a worker remembers in a stage, and bytes of a batch: less than for an operator on its own, since executors
#: keep what their heaps have grown to from stage to stage.
REMEMBERED = 40_000
BATCH_BYTES = 2 << 20


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold; the model is fitted to labelled rows outside the held-out third."""
    bounded(spark, BATCH_BYTES)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels), remembered=REMEMBERED)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each distinct text: the one with the largest id."""
    return exact.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, for each class of near-duplicates: five-word shingles, exact Jaccard similarity 0.8 and more.

    SimHash tries propose links and each is verified; a join of shared shingles finds those of more differing bits.
    """
    bounded(spark, BATCH_BYTES)
    return jaccard.drop_near_duplicates(docs, size=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is verbatim benchmark text."""
    bounded(spark, BATCH_BYTES)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """The documents, ``text`` now decoded from their tokens, with ``ids`` and ``n_tokens``."""
    bounded(spark, BATCH_BYTES)
    return bpe.round_trip(docs, tokenizer, decoded="text", remembered=REMEMBERED).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: Neither a fitted machine nor byte-pair merges can be said in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
