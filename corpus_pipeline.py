"""Corpus pipeline: raw documents to packed training sequences.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir), calls one operator of
:mod:`adcredit.llm` on all that its predecessor kept, and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result as Parquet in the
shared folder and reads it back as the next stage's ``docs``, so a lost executor never costs more
than the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adcredit.llm import contamination, exact_dedup, near_dedup, packing, toxicity
from adcredit.llm.common import discard, table, written
from adcredit.llm.queries import held_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.drop_toxic(docs, lexicon)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Token ids and learned weights have no SQL form; tests compare ``run`` with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
