"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``: the first two drop the rows they reject, the
next two keep one row of each group of copies, the last packs what is left.

A null text has no language, so it goes in the first stage, as do texts without a
letter. Null ids are no obstacle: such rows are never learnt from, and are judged and
kept as others. Of rows that repeat an id and a text one stays; rows that repeat an
id with different texts are told apart by their texts. Extra columns pass unchanged,
and empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fluviant.llm import langid, toxicity
from fluviant.llm.exact_dup import drop_exact_duplicates
from fluviant.llm.near_dup import drop_near_duplicates
from fluviant.llm.packing import pack_documents
from fluviant.session import release, scratch, written_tables


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose main language is known and holds three tenths of the letters."""
    return langid.keep_identified(docs, langid.learn(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score 0.3 or more."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of texts that share 0.8 of their 5-word shingles."""
    return drop_near_duplicates(docs, percent=80, width=5)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("language", language), ("toxicity", toxic), ("exact dedup", exact), ("near dedup", near), ("packing", packing)]

#: The first stages learn models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one keeps is written and read by the next, and
    the tables of the stages before are deleted then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = written_tables(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        release(spark, before, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
