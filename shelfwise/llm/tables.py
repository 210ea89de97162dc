"""Input columns, staged tables and sizes shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.session import shared_dir


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of ``text`` (null: empty); every other column is dropped."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it survives lost executors."""
    path = run_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts of :func:`texts`."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def text_key(text_col: str = "text") -> Column:
    """Tells texts apart where rows share an id or have none; the same for null and empty texts."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))


def matching(docs: DataFrame, rows: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that have (``left_semi``) or lack (``left_anti``) their id and text key among ``rows``."""
    keys = rows.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct().hint("merge")
    keyed = docs.withColumn("_own", text_key(text_col))
    return keyed.join(keys, keyed[id_col].eqNullSafe(keys["_id"]) & (keyed["_own"] == keys["_key"]), how).select(*docs.columns)
