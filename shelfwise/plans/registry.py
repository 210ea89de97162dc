"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from shelfwise.plans.bridge import Bridge, with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, dates as text, quantities in thousandths."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name == "min_qty":
            cols.append((c * 1000).cast("bigint").alias("qty_milli"))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            cols.append(c.cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(c.cast("string").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a function of a :class:`Bridge` under ``name``."""

    def register(fn: Callable[[Bridge], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Bridge(spark, folder)))

        run.__doc__ = fn.__module__.rpartition(".")[2]
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql, *needs)
        return fn

    return register
