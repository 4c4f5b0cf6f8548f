"""Documents to token shards: toxicity, near-duplicates, benchmark leaks, source mix, token output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rhapsode.llm import decontam, mixing, simhash, tokenio, toxicity
from rhapsode.llm.common import load, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.without_toxic(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.without_leaks(docs, load(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token shards; what the files hold of each document."""
    return tokenio.read_tokens(tokenio.write_tokens(docs, tokenio.tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("leaks", leaks),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: Nearest-neighbour votes and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
