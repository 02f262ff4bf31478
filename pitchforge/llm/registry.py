"""Queries opN_<name> over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, feast_whitening, improbable_digest, lang_cnn, license_scan, maxscore, oracles, packing, period_runs,
               quality_bayes, secrets_scan, simhash_bk, suffix_dedup, token_files)
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.span_digest(secrets_scan.find_secrets(table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are the hosts of documents, and a source's languages its paths."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_bayes.classify(docs, quality_bayes.train(docs, labels))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.summary(license_scan.find_licences(docs, license_scan.train(docs)))


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, k=5)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(spark, table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bk.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", simhash_bk.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "similarity")


def language_model(spark: SparkSession, sf_dir: str) -> lang_cnn.ByteCNN | None:
    """Trained on the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return lang_cnn.train(docs.where(~lang_cnn.held_out(F.col("doc_id"))))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_cnn.identify(table(spark, sf_dir, "documents"), language_model(spark, sf_dir))
    return found.select("doc_id", lang_cnn.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_runs.run_digest(period_runs.find_runs(period_runs.tile_words(table(spark, sf_dir, "documents"))))


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feast_whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op13_improbable_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return improbable_digest.edit_trial(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_quality, op3_license_scan, op4_maxscore, op5_best_fit_packing, op6_suffix_dedup, op7_token_files, op8_simhash,
    op9_decontamination, op10_language_id, op11_period_runs, op12_feast_whitening, op13_improbable_digest)}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = oracles.SQL
