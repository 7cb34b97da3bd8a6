"""One query per operator, with its production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    html_extraction,
    line_dedup,
    minmax_dedup,
    oracles,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    sharding,
    substring_dedup,
    token_alignment,
    token_files,
    toxicity,
)
from tidemark.llm.common import let, ship

Query = Callable[[SparkSession, str], DataFrame]

BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_words", "n_removed", "kept_sha256")
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), columns=columns)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.find_leaks(docs, benchmark, columns)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_tokens", "ids_sha256", "decoded_sha256")
    return sentencepiece_codec.encode_and_decode(_table(spark, sf_dir, "documents"), PIECES, columns)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_lines(
        _table(spark, sf_dir, "documents"), lines_col="n_lines", removed_col="n_removed"
    ).select("doc_id", "n_lines", "n_removed", "text")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files.read_documents(*token_files.write_token_files(docs, BYTE_PAIRS, end_id=2))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *base, "base_failed", "kept")


def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


#: 16 shards of equal weight: two regions of two racks of four.
TREE = sharding.even_tree(regions=2, racks=2, shards=4)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents"), TREE)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_text(_table(spark, sf_dir, "pages"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, _table(spark, sf_dir, "labels")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the documents repeat some of their words up to their end.

    With h the CRC of the id and g = h div 10, those with h mod 10 = 0 and n > 0 words have,
    from word a = g mod n on, the p words there over and over, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(x: Column) -> Column:
        words, n, g = x["words"], F.size(x["words"]), x["g"]
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), lambda i: words[at(i)]))

    planted = let(F.struct(found.alias("words"), F.floor(h / 10).alias("g")), lambda x: F.when(F.size(x["words"]) > 0, repeated(x)))
    return docs.select("doc_id", F.coalesce(F.when(h % 10 == 0, planted), "text").alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return periodic_runs.find_runs(with_planted_runs(_table(spark, sf_dir, "documents")), columns)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return token_alignment.align_and_rate(_table(spark, sf_dir, "documents"), BYTE_PAIRS, PIECES, columns)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_files": op5_token_files,
    "op6_quality_rules": op6_quality_rules,
    "op7_minmax_dedup": op7_minmax_dedup,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING,
    "op2_decontamination": oracles.LEAKS,
    "op4_line_dedup": oracles.LINES,
    "op6_quality_rules": oracles.quality(
        quality_rules.RULES, quality_rules.STOP_WORDS, quality_rules.SYMBOLS
    ),
    "op7_minmax_dedup": oracles.NEAR,
}
