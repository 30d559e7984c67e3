"""Registered queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renalis.llm import (
    bytebpe,
    hard_negatives,
    host_reputation,
    langid,
    merkle,
    near_dedup,
    oracle,
    pii,
    sentencepiece,
    sharding,
    tiling,
    token_counts,
    warc,
    winnowing,
)
from renalis.llm.common import table
from renalis.session import Workspace, tune

SHARDS = 40


def op1_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op2_virtual_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS, Workspace(spark))


def op3_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.prove(public_tokenizers.path("word_bpe_49k.json"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op4_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.round_trip(table(spark, sf_dir, "documents"), model)


def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (table(spark, sf_dir, name) for name in ("pages", "labels"))
    return host_reputation.judge(pages, labels, host_reputation.RULES, Workspace(spark))


def op6_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark)
    return warc.archive(table(spark, sf_dir, "pages"), work.folder("warc"), work)


def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return tiling.contaminated(docs, items)


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprints(table(spark, sf_dir, "documents"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark))


def op11_kronecker_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, Workspace(spark))


def op12_pointer_jumping_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"), Workspace(spark))


def op13_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bytebpe.encode(table(spark, sf_dir, "documents"), ranks, Workspace(spark))
    return bytebpe.digests(bytebpe.decode(encoded, ranks))


_QUERIES = [
    op1_crf_language_id,
    op2_virtual_slot_sharding,
    op3_whole_token_counts,
    op4_suffix_array_pieces,
    op5_host_reputation,
    op6_deobfuscated_pii,
    op7_warc_revisits,
    op8_string_tiling,
    op9_winnowing,
    op10_hyperminhash,
    op11_kronecker_hard_negatives,
    op12_pointer_jumping_proofs,
    op13_distinct_word_bpe,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def tuned(query: Callable) -> Callable:
        return lambda spark, sf_dir: query(tune(spark), sf_dir)

    return {query.__name__: tuned(query) for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
