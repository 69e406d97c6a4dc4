"""Training-data pipeline over the documents table: filter, deduplicate, mask, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrears.llm import pivotal_mix, prefix_bpe, risk_rules, simhash_balls, skip_chain
from arrears.llm.common import materialise, read_table
from arrears.llm.settings import PATTERN, RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs.

    Null and empty texts go, as they have no words; repeated rows stay or go
    together; a null language is a stratum; an empty table gives an empty one.
    """
    return risk_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id.

    A group without any id keeps one row; null and empty texts have one
    fingerprint and so are one group; an empty table gives an empty one.
    """
    return simhash_balls.keep_one(docs, shingle=3, radius=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked.

    Null texts stay null, and every row stays a row; an empty table gives an empty one.
    """
    return skip_chain.mask_personal_data(docs, skip_chain.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Sources are those of what is left by now, null one of them; documents without
    words take nothing from a target; an empty table gives an empty one.
    """
    return pivotal_mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with hashes of the ids and of what they decode to.

    A null or empty text has no ids; repeated rows stay apart; an empty table gives an empty one.
    """
    return prefix_bpe.encode_texts(docs, RANKS, PATTERN, keep_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Random rounding, label propagation and BPE are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again; the last is left to the caller."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
