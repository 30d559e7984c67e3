"""A corpus from raw documents to piece ids, in stages that each read what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renalis.llm import langid, near_dedup, pii, sentencepiece, tiling
from renalis.llm.common import table
from renalis.session import Workspace, tune

# Below this share of one language in the words of a text, none is the text's language.
MIN_SCORE = 0.3
SHINGLE, SIMILARITY = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters, or in no learned one, go."""
    tune(spark)
    return langid.keep_identified(docs, MIN_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    tune(spark)
    return near_dedup.keep_first(docs, Workspace(spark), SHINGLE, SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return tiling.clean(docs, table(tune(spark), sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, and n_chars that of the new text."""
    tune(spark)
    masked = pii.mask(docs)
    if "n_chars" in masked.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids."""
    tune(spark)
    return sentencepiece.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_personal_data", mask_personal_data),
    ("encode", encode),
]

# No stage can be said in SQL: a trained model, tiling, transducers and byte-pair encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    work = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.cut(stage(spark, docs, sf_dir), name)
    return docs
