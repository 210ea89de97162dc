"""Registered queries of the operators: each reads its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import decontamination, filter_audit, interval_dedup, language_model, license_scan, merkle, mixing, near_duplicates, quality, secret_scan, tables, token_counts, token_files
from shelfwise.llm.substring_dedup import substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = substring_dedup(tables.documents(spark, folder))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.documents(spark, folder)
    held_out = language_model.is_held_out(F.col("doc_id"))
    model = language_model.train(docs.where(~held_out))
    scored = language_model.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score", "perplexity")


@query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.secret_scan(tables.documents(spark, folder))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"))


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    scores = token_counts.zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(tables.documents(spark, folder), scores)


@query
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = token_files.write_token_files(tables.documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, path)


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(tables.documents(spark, folder)).drop(*quality.FENCES, "text_key")


ORACLES["op7_quality"] = quality.SQL


@query
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(tables.documents(spark, folder))


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    source = F.col("sources")[0]
    return mixing.mix(tables.documents(spark, folder)).select(
        "doc_id", "size", source["size"].alias("source_size"), source["target"].alias("target"), "taken")


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.documents(spark, folder)
    found = license_scan.license_scan(docs, license_scan.fit(docs))
    return found.select("doc_id", "family", F.size("licenses").cast("bigint").alias("n_statements"), "licenses")


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontaminate(tables.documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet")).drop("text_key")


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(tables.documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


ORACLES["op12_filter_audit"] = filter_audit.SQL


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(tables.documents(spark, folder))


ORACLES["op13_merkle_manifest"] = merkle.SQL


@query
def op11_interval_dedup(spark: SparkSession, folder: str) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return interval_dedup.interval_dedup(tables.documents(spark, folder)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), "kept_sha256")
