"""The latest row of every key, kept from micro-batch to micro-batch in hash buckets.

A batch reads and writes only the buckets its keys fall into. Every batch writes its buckets to a folder of its own and then
one small list that says which batch wrote each bucket last, so a batch that is tried again replaces itself, and readers see
a batch whole or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.streaming.jobs import merge_latest

LIST = "bucket int, written bigint"


@dataclass
class LatestTable:
    """Rows of ``schema`` under ``root``; of two rows of a key the later stays, at equal times that of the greater values.

    ``buckets`` never changes over the life of a table: choose it so that a bucket of the grown table suits a task.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: list[str]
    at: str
    buckets: int = 256

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def batches(self) -> list[int]:
        """Numbers of the batches whose list is complete."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/log")
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(folder):
            return []
        done = lambda p: store.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return sorted(int(s.getPath().getName().partition("=")[2]) for s in store.listStatus(folder) if done(s.getPath()))

    def versions(self, before: int | None = None) -> dict[int, int]:
        """The batch that wrote each bucket last, as of the last batch before ``before``; at most ``buckets`` entries."""
        numbers = [n for n in self.batches() if before is None or n < before]
        if not numbers:
            return {}
        rows = self.spark.read.schema(LIST).json(f"{self.root}/log/batch={numbers[-1]}").collect()
        return {r["bucket"]: r["written"] for r in rows}

    def _read(self, versions: dict[int, int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/rows/batch={n}/bucket={k}" for k, n in sorted(versions.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._read(self.versions())

    def merge(self, batch: DataFrame, number: int) -> list[int]:
        """Merge a micro-batch in and return the buckets written, each of them once."""
        nothing = self.spark.createDataFrame([], self.schema)
        fresh = merge_latest(nothing, batch, self.keys, self.at).withColumn("bucket", self.bucket()).persist()
        try:
            touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
            before = self.versions(before=number)
            old = self._read({k: n for k, n in before.items() if k in set(touched)})
            merged = merge_latest(old, fresh.drop("bucket"), self.keys, self.at).select(*self.schema.names, self.bucket().alias("bucket"))
            merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(
                f"{self.root}/rows/batch={number}")
        finally:
            fresh.unpersist()
        now = {**before, **dict.fromkeys(touched, number)}
        self.spark.createDataFrame(sorted(now.items()), LIST).coalesce(1).write.mode("overwrite").json(f"{self.root}/log/batch={number}")
        return touched

    def vacuum(self, keep: int = 2) -> int:
        """Remove buckets and lists that none of the last ``keep`` batches needs; returns how many folders went."""
        path, numbers, gone = self.spark._jvm.org.apache.hadoop.fs.Path, self.batches(), 0
        last = numbers[-keep:]
        needed = {(n, k) for b in last for k, n in self.versions(before=b + 1).items()}
        for n in numbers:
            folder = path(f"{self.root}/rows/batch={n}")
            store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for s in store.listStatus(folder) if store.exists(folder) else []:
                name = s.getPath().getName()
                if name.startswith("bucket=") and (n, int(name[7:])) not in needed and n not in last:
                    gone += bool(store.delete(s.getPath(), True))
            if n not in last:
                gone += bool(store.delete(path(f"{self.root}/log/batch={n}"), True))
        return gone

    def follow(self, feed: DataFrame, checkpoint: str) -> StreamingQuery:
        """Merge everything a stream has, batch by batch."""
        return feed.select(*self.schema.names).writeStream.foreachBatch(lambda batch, number: self.merge(batch, number) and None).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
