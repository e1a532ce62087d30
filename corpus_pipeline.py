"""From raw documents to token files: five stages, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crashlake.llm.common import documents, store
from crashlake.llm.decontaminate import drop_leaks
from crashlake.llm.minhash import drop_near_duplicates
from crashlake.llm.mixing import mixed_documents
from crashlake.llm.quality import keep_good
from crashlake.llm.token_files import token_digest
from crashlake.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle similarity 0.8 or more."""
    return drop_near_duplicates(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return drop_leaks(docs, documents(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in the token files written of them."""
    return token_digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("source_mix", source_mix), ("token_output", token_output)]

#: Robust estimates, signatures and the tokenizer have no SQL form; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    configure(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
