"""From raw documents to token ids: five stages, each written and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
``documents``, or, the last one, the encoded documents. Toxic documents, near duplicates
and documents with benchmark passages go; repeated lines are cut out of the others.

Null and empty texts are clean, repeat nothing and are encoded as the end id; very long
texts are read whole; of rows with one id and text, near-duplicate removal keeps one; an
empty table stays empty, with its columns, until the last stage, whose columns are its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_dedup, minmax_dedup, sentencepiece_codec, toxicity
from tidemark.llm.common import ship
from tidemark.llm.components import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on their labels, scores below 0.5."""
    network = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, network)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of windows that stand earlier; ``n_chars`` follows the text."""
    cleaned = line_dedup.remove_repeated_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that is alike in 0.8 of its five-word shingles."""
    ship(spark)
    return minmax_dedup.drop_near_duplicates(docs, shingle=5, percent=80)


def without_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with the benchmark."""
    return decontamination.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and the digests of ids and decoded text."""
    ship(spark)
    columns = ("n_tokens", "token_ids", "ids_sha256", "decoded_sha256")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.encode_and_decode(docs, model, columns)


STAGES = [
    ("toxicity", without_toxic_documents),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark_passages),
    ("SentencePiece encoding and decoding", encoded),
]

#: A trained network and an encoder are no SQL. The operators are tested one by one, the run by what its stages keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded documents that all stages keep."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
