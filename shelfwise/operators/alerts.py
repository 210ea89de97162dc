"""New offers on favourite products, remembered in a ledger."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions import money
from shelfwise.operators.catalog import resolve_scans
from shelfwise.operators.offers import READ_TERMS
from shelfwise.operators.prices import ITEM_KEY
from shelfwise.operators.numbering import number_rows
from shelfwise.operators.spread import FEW_KEYS_WAYS, fits_broadcast, lookup_join, many_first
from shelfwise.session import cut_lineage

# Fixed value: an offer without an end.
OPEN_END = "9999-12-31"
TERMS = ["chain_id", "barcode", "club", "coupon", "min_qty", "agorot"]
MARKS = 1024
ROUNDS = 4


def is_current(built_at: Column, today: str) -> Column:
    """Was the mart built today? Nothing is announced from an older one."""
    return F.substring(built_at.cast("string"), 1, 10) == today


def _mark(*names: str) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(MARKS)).cast("smallint")


def _by_users(*tables: DataFrame) -> list[tuple[DataFrame, ...]]:
    """``tables`` with a ``user_id``, cut into ``ROUNDS`` by it unless they are small.

    The marks go with every favourite, more than all other rows together; a round holds those of its users on disk, and no more.
    """
    if fits_broadcast(tables[0]):
        return [tables]
    turn = F.pmod(F.xxhash64("user_id"), F.lit(ROUNDS))
    return [tuple(t.filter(turn == k) for t in tables) for k in range(ROUNDS)]


def candidate_alerts(favourites: DataFrame, shops: DataFrame, offers: DataFrame, links: DataFrame,
                     base: DataFrame, today: str) -> DataFrame:
    """Live offers on each user's favourites at branches the user shops at.

    ``favourites``: user_id, barcode. ``shops``: user_id, chain_id, store_id.
    ``offers`` and ``links`` are on read terms. Adds ``implausible`` for offers
    too cheap to believe and the first such branch.
    """
    asked = favourites.select(F.col("barcode").alias("raw")).distinct()
    forms = resolve_scans(asked, offers.select("barcode").distinct(), variants=True).filter("barcode is not null")
    wanted = favourites.select("user_id", F.col("barcode").alias("raw")).join(forms, "raw").select(
        "user_id", "barcode").distinct()
    day = F.lit(today).cast("date")
    live = offers.filter((F.col("ends").isNull() | (F.col("ends") >= day))
                         & (F.col("starts").isNull() | (F.col("starts") <= day)))
    # Pairs of a favourite and an offer's branch are judged where they are made, by the marks of the user's branches: those of
    # other branches never reach a shuffle. Marks are few numbers, so some pass by chance; the semi join decides.
    running = cut_lineage(links.join(live.select(*READ_TERMS), many_first(READ_TERMS), "left_semi").select(*READ_TERMS, "store_id").withColumn(
        "_mark", _mark("chain_id", "store_id")))
    marks = shops.groupBy("user_id").agg(F.collect_set(_mark("chain_id", "store_id")).alias("_marks"))

    def met(wanted: DataFrame, marks: DataFrame, shops: DataFrame) -> DataFrame:
        near = lookup_join(wanted.join(marks, "user_id"), running, ["barcode"], ["user_id"], "inner").filter(F.array_contains("_marks", F.col("_mark")))
        return near.select("user_id", *READ_TERMS, "store_id").join(shops, ["user_id", "chain_id", "store_id"], "left_semi")

    turns = _by_users(cut_lineage(wanted), cut_lineage(marks), shops)
    at = met(*turns[0]) if len(turns) == 1 else reduce(DataFrame.unionByName, [cut_lineage(met(*t)) for t in turns])
    branch = at.groupBy("user_id", *READ_TERMS).agg(F.min("store_id").alias("store_id"))
    found = branch.join(live, READ_TERMS)
    shelf = base.select(*ITEM_KEY, F.col("agorot").alias("shelf"))
    out = lookup_join(found, shelf, ITEM_KEY, ["user_id"])
    return out.withColumns({
        "implausible": money.implausible(F.col("unit_agorot"), F.col("shelf")).cast("int"),
        "offer_key": money.offer_key(*[F.col(c) for c in TERMS]),
    })


def suppressed(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count_if(F.col("implausible") == 1).alias("suppressed"))


def compare_ledger(live: DataFrame, ledger: DataFrame, today: str, keys: list[str]) -> DataFrame:
    """Ledger and live offers side by side, one row per key.

    Live rows are reduced to one per key first. ``outcome`` is new, seen or
    absent; the row already carries the ledger's next values.
    """
    day = F.lit(today).cast("date")
    now = live.groupBy(*keys).agg(F.max(F.coalesce("ends", F.lit(OPEN_END).cast("date"))).alias("_ends"))
    old = ledger.select(*keys, "ends", "first_seen", "last_seen")
    both = now.join(old, keys, "full_outer")
    outcome = F.when(F.col("first_seen").isNull(), "new").when(F.col("_ends").isNotNull(), "seen").otherwise("absent")
    return both.select(
        *keys, outcome.alias("outcome"), F.greatest("ends", "_ends").alias("ends"),
        F.coalesce("first_seen", day).alias("first_seen"),
        F.when(F.col("_ends").isNotNull(), day).otherwise(F.col("last_seen")).alias("last_seen"))


def new_alerts(compared: DataFrame, live: DataFrame, keys: list[str], seed: bool = False) -> DataFrame:
    """Live rows whose key is new; seeding records them without announcing."""
    fresh = compared.filter(F.lit(not seed) & (F.col("outcome") == "new")).select(*keys)
    return live.join(fresh, keys, "left_semi")


def next_ledger(compared: DataFrame, today: str, keys: list[str]) -> DataFrame:
    """Ledger rows to keep: refreshed and new ones, less those that ended."""
    return sweep(compared.select(*keys, "ends", "first_seen", "last_seen"), today)


def sweep(ledger: DataFrame, today: str) -> DataFrame:
    """Rows that have not ended; a row without an end never does."""
    return ledger.filter(F.col("ends").isNull() | (F.col("ends") >= F.lit(today).cast("date")))


def empty_ledger(ledger: DataFrame) -> DataFrame:
    """Starting over: every live offer counts as new."""
    return ledger.filter("false")


def commit_delivered(alerts: DataFrame, ledger: DataFrame, alerts_path: str, ledger_path: str, run: str) -> None:
    """Write the alerts of a run, and only then the ledger that records them.

    Both go to folders named by the run, so a repeated run replaces its own
    output; the mark that puts the ledger in force is written last, so a failed
    run leaves the earlier one in force (see :func:`current_ledger`).
    """
    alerts.write.mode("overwrite").parquet(f"{alerts_path}/run={run}")
    ledger.write.mode("overwrite").parquet(f"{ledger_path}/run={run}")
    mark = ledger.sparkSession.createDataFrame([(run, time.time_ns())], "run string, at bigint")
    mark.coalesce(1).write.mode("append").json(f"{ledger_path}/committed")


def current_ledger(spark: SparkSession, ledger_path: str, schema: str) -> DataFrame:
    """The ledger in force: that of the last run whose commit was recorded; empty before the first."""
    try:
        runs = spark.read.schema("run string, at bigint").json(f"{ledger_path}/committed")
        last = runs.orderBy(F.desc("at")).first()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{ledger_path}/run={last['run']}")


def display_order(alerts: DataFrame, tie: list[str]) -> DataFrame:
    """Add ``position``: chain with the cheapest offer first, then by unit price, barcode and ``tie``.

    The order is a column, so that it outlives joins and writes. ``tie`` makes rows of one barcode different.
    """
    least = alerts.groupBy("chain_id").agg(F.min("unit_agorot").alias("_least"))
    ranked = lookup_join(alerts, least, ["chain_id"], ["barcode"], "inner", FEW_KEYS_WAYS)
    return number_rows(ranked, [], ["_least", "chain_id", "unit_agorot", "barcode", *tie], "position").drop("_least")
