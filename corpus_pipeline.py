"""A corpus pipeline over ``documents``: every stage applies one operator of ``layerflow.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerflow.llm import language_id, mixing, piece_codec, simhash, substring_dedup
from layerflow.llm.common import table, written
from layerflow.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; those without letters, or like none of them, go."""
    return language_id.recognised(docs, language_id.learn(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints (4-word shingles) within 4 bits of each other."""
    return simhash.one_of_each(docs, distance=4, shingle=4)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that start earlier; emptied documents go."""
    return substring_dedup.without_repeats(docs, chars_col="n_chars" if "n_chars" in docs.columns else None)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it (a document taken twice is two rows)."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix, as digests, and of the text they decode to."""
    return piece_codec.codec_digest(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language),
    ("simhash_dedup", near_copies),
    ("substring_dedup", passages),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: Language models, hash draws and tokenizers are not SQL; ``tests/llm`` holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
