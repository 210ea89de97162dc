"""From raw documents to token files: quality, near duplicates, benchmark passages, source mix, tokens.

Each stage takes what the one before kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.llm import tables
from shelfwise.llm.decontamination import decontaminate
from shelfwise.llm.mixing import mix
from shelfwise.llm.near_duplicates import near_duplicates
from shelfwise.llm.quality import quality
from shelfwise.llm.token_files import read_token_files, write_token_files

TOKENIZER, END_ID = "word_bpe_49k.json", 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality(docs, keep=docs.columns).where("kept")
    return judged.select(*[F.col(f"_keep_{c}").alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each class; of rows that repeat an id one stays; rows without an id all stay."""
    first = near_duplicates(docs).where("doc_id = class_id").select("doc_id").distinct()
    stays = docs.join(first.hint("merge"), "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy(*[F.col(c) for c in docs.columns if c != "doc_id"])
    stays = stays.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(*docs.columns)
    return stays.unionByName(docs.where("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage was found."""
    return tables.matching(docs, decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    kept = [c for c in docs.columns if c != "doc_id"]
    mixed = mix(docs, keep=kept).where("copies > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return mixed.select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back: a row per document in them."""
    return read_token_files(spark, write_token_files(docs, public_tokenizers.path(TOKENIZER), END_ID))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("source mix", source_mix),
    ("token files", token_output),
]
# Classes, latent search, the seeded mix and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = tables.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
