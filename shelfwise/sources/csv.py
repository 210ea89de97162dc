"""CSV exports whose empty cells mean "same as the row above"."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.operators.spread import lookup_join
from shelfwise.session import cut_lineage

# Fixed value: the cell text that stands for a real empty string.
EXPLICIT_EMPTY = "''"


def find_exports(spark: SparkSession, folder: str, file_type: str) -> DataFrame | None:
    """Masked rows of ``<type>_*.csv``, else of the squashed spelling."""
    squashed = file_type.lower().replace("_file", "").replace("_", "")
    for stem in (file_type.lower(), squashed):
        found = read_masked(spark, folder, f"{stem}_*.csv")
        if found is not None:
            return found
    return None


def _lines(spark: SparkSession, path, glob: str) -> DataFrame:
    """Lines with the file, the split and the place in the split they come from."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), "value")


def headers(lines: DataFrame) -> DataFrame:
    """``_file`` and ``_header``: the first line of every file; only the files' first splits are looked at."""
    first = F.min(F.when(F.trim("value") != "", F.struct("_row", "value")))
    return lines.filter("_block = 0").groupBy("_file").agg(first["value"].alias("_header")).filter("_header is not null")


def read_masked(spark: SparkSession, path, glob: str = "*.csv") -> DataFrame | None:
    """Rows of all files of a folder by header name, with masked cells filled; None when there is no file.

    Files may differ in their columns. One job over first lines gives the different headers, of which there are few however many
    files there are; all files are then parsed in one read, a cell found by the place its name has in the file's
    header, null where it has none. A line equal to its file's header is one. ``_file``, ``_block`` and ``_row`` give the order
    inside the data. A quoted cell does not span lines.
    """
    lines = _lines(spark, path, glob)
    # Stored, so that first lines are looked for once; what joins is the file and the number of its header.
    heads = cut_lineage(headers(lines))
    kinds = sorted(r["_header"] for r in heads.select("_header").distinct().collect())
    if not kinds:
        return None
    cells = [_names(kind) for kind in kinds]
    names = sorted({n for own in cells for n in own})
    width = max(len(own) for own in cells)
    number = F.create_map(*[x for k, kind in enumerate(kinds) for x in (F.lit(kind), F.lit(k))])
    known = lookup_join(lines, heads.select("_file", number[F.col("_header")].alias("_kind")), ["_file"], ["_block", "_row"], "inner")
    header = F.get(F.array(*[F.lit(kind) for kind in kinds]), F.col("_kind"))
    body = known.filter((F.trim("value") != "") & (F.col("value") != header))
    parsed = body.withColumn("_c", F.from_csv("value", ", ".join(f"c{k} string" for k in range(width))))
    array = F.array(*[F.col(f"_c.c{k}") for k in range(width)])
    place = lambda n: F.array(*[F.lit(own.index(n) if n in own else None).cast("int") for own in cells])
    located = parsed.withColumn("_a", array).select(
        "_file", "_block", "_row", "_kind", *[F.get("_a", F.get(place(n), F.col("_kind"))).alias(n) for n in names])
    filled = unmask(located, names, ["_kind"])
    return filled.select("_file", "_block", "_row", *[F.when(F.get(place(n), F.col("_kind")).isNotNull(), F.col(n)).alias(n) for n in names])


def _names(header: str) -> list[str]:
    """Column names of a header line, lower case; of a repeated name the first counts."""
    [row] = csv.reader([header.removeprefix("\ufeff")])
    return [n.strip().lower() for n in row]


def unmask(rows: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Fill each masked cell from the nearest row above in the same file; columns of ``keep`` stay as they are.

    Cells are filled inside each split of a file; the last value of every split
    (one row per split) then tells the next one what to carry in. So no task
    holds more than one split, however large the file.
    """
    place = ["_file", "_block", "_row", *(keep or [])]
    cells = rows.select(*place, *[
        F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).alias(c) for c in columns])
    above = Window.partitionBy("_file", "_block").orderBy("_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = cells.select(*place, *[
        F.last(c, ignorenulls=True).over(above).alias(c) for c in columns])

    ends = cells.groupBy("_file", "_block").agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct("_row", c))).alias(c) for c in columns])
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_file", "_block", *[
        F.last(F.col(f"{c}.{c}"), ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns])
    joined = filled.join(carried, ["_file", "_block"], "left")
    value = lambda c: F.coalesce(F.col(c), F.col(f"_in_{c}"), F.lit(""))
    return joined.select(*place, *[
        F.when(value(c) == EXPLICIT_EMPTY, "").otherwise(value(c)).alias(c) for c in columns])
