"""The corpus pipeline: five stages over ``documents``.

Each stage works on all rows that the one before it kept, as they were written
and read again, and all but the last return the columns of documents.

1. language_id: documents without a letter go, and those of 64 bytes or more in
   which no learned language reaches the least score that an eighth of the
   training sample, put aside, sets.
2. near_duplicates: of each SimHash component (shingles of 3 words, 3 bits) the
   row with the smallest id stays.
3. decontamination: documents that hold a benchmark item go.
4. secrets: reported spans are masked; no document goes.
5. packing: the remaining texts become sequences of at most 2048 tokens.

Null texts go in stage 1 (no letter), and repeated rows in stage 2; other nulls
and extra columns are carried along; empty tables give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchforge.llm import decontam, lang_cnn, packing, secrets_scan, simhash_bk
from pitchforge.llm.common import materialize, prepare, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = lang_cnn.train(docs.where(~lang_cnn.held_out(F.col("doc_id"))), aside=1 / 8)
    return lang_cnn.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_bk.keep_one(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", pack)]

#: A trained network and a tokenizer decide: SQL can't express the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
