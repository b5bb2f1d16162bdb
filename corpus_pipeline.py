"""A training-data pipeline over ``documents``: five stages, each one of the corpus operators.

Every stage works on all that its predecessor kept; its result is written as Parquet to the shared folder and read
again as the next stage's input.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecospark.llm import near_duplicates, quality_embeddings, secrets, sentencepiece_codec, soft_mixing
from ecospark.llm.common import materialize, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Documents below this quality score go.
LEAST_QUALITY = 0.3
#: Wanted tokens of each label domain as a multiple of what is there: clean text stays as it is.
MIX_FACTORS = {"quality1_toxic0": 1.0, "quality1_toxic1": 0.1, "quality0_toxic0": 0.1, "quality0_toxic1": 0.0}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_embeddings.keep_good(docs, table(spark, sf_dir, "labels"), LEAST_QUALITY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_duplicates.keep_first(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced, encoded ones included; n_chars follows."""
    return secrets.redact_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate under the wanted domain totals rounds to, by a hash of its id: totals
    meet the targets in expectation; a document above rate one may come twice."""
    return soft_mixing.keep_mixed(docs, table(spark, sf_dir, "labels"), ["quality", "toxic"], MIX_FACTORS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and whether decoding gives the text back."""
    return sentencepiece_codec.with_ids(docs, PIECE_MODEL)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup), ("secret scans", hide_secrets),
          ("mixing to target weights", mixing), ("SentencePiece encoding", encode)]

#: The classifier, the decoding worklist and the tokenizer are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
