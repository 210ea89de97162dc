"""Payload work that columns cannot express: unpacking and tree walks.

Two small per-file helpers run inside ``mapInPandas``; Spark lists, splits and
shuffles the files and everything after the first rows.
"""

from __future__ import annotations

import gzip
import xml.etree.ElementTree as ET
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions import text
from shelfwise.operators.spread import max_by_order

GZIP_MAGIC = b"\x1f\x8b"
UTF8_MARK = b"\xef\xbb\xbf"
UTF16_MARKS = (b"\xff\xfe", b"\xfe\xff")


def read_files(spark: SparkSession, path, glob: str = "*") -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", glob).load(path).select(F.col("path").alias("_file"), "content")


def unpack(raw: bytes) -> tuple[str, bytes | None]:
    """Kind of payload by its first bytes, and the plain XML bytes."""
    kind = "xml"
    if raw[:2] == GZIP_MAGIC:
        try:
            raw, kind = gzip.decompress(raw), "gzip"
        except (OSError, EOFError):
            return "unreadable", None
    head = raw[:64].removeprefix(UTF8_MARK).lstrip()
    if head.startswith(b"<") or raw[:2] in UTF16_MARKS:
        return kind, raw
    return "other", None


def decode(raw: bytes) -> str | None:
    """XML bytes to text in their declared encoding, declaration removed."""
    try:
        return ET.tostring(ET.fromstring(raw), encoding="unicode")
    except ET.ParseError:
        return None


def sniffed_texts(files: DataFrame) -> DataFrame:
    """``_file``, ``kind``, ``content`` text for every payload, by content."""

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, raw in zip(batch["_file"], batch["content"]):
                kind, plain = unpack(bytes(raw))
                rows.append((name, kind, None if plain is None else decode(plain)))
            yield pd.DataFrame(rows, columns=["_file", "kind", "content"])

    return files.select("_file", "content").mapInPandas(per_batch, "_file string, kind string, content string")


# Bytes handed to the parser at once.
CHUNK = 1 << 16
# Rows after which a task hands on what it has parsed.
FRAME_ROWS = 10_000


def spread_files(files: DataFrame) -> DataFrame:
    """Files over all shuffle partitions: parsing takes far longer than their bytes suggest, by which Spark would put many into one task."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_file")


def _tag(name: str) -> str:
    return name.rpartition("}")[2].lower()


def walk(raw: bytes) -> Iterator[tuple[int, list[str], dict[str, str]]]:
    """Elements of a document as they end: their number in order of their starts, the tags from the root, the direct fields.

    Memory holds the open elements and the fields of each, never the tree. Raises ``ParseError`` at the first fault.
    """
    parser = ET.XMLPullParser(("start", "end"))
    path: list[str] = []
    fields: list[dict[str, str]] = []
    opened: list[tuple[int, ET.Element]] = []
    started = 0
    for at in range(0, len(raw) or 1, CHUNK):
        parser.feed(raw[at:at + CHUNK])
        if at + CHUNK >= len(raw):
            parser.close()
        for event, element in parser.read_events():
            if event == "start":
                path.append(_tag(element.tag))
                fields.append({})
                opened.append((started, element))
                started += 1
                continue
            number, _ = opened.pop()
            yield number, path, fields.pop()
            tag = path.pop()
            if fields:
                fields[-1][tag] = (element.text or "").strip()
                opened[-1][1].remove(element)


def branches_of(raw: bytes) -> list[tuple]:
    """Branch records of a store file of any shape: every outermost element with a StoreID, under its nearest named sub-chain."""
    found: list[list] = []
    top: dict[str, str] = {}
    for number, path, own in walk(raw):
        inside = len(found)
        while inside and found[inside - 1][0] > number:
            inside -= 1
        if own.get("storeid"):
            found[inside:] = [[number, "", own["storeid"], own.get("storename"), own.get("city"), own.get("address")]]
        elif path[-1] == "subchain" and own.get("subchainid"):
            for record in found[inside:]:
                record[1] = record[1] or own["subchainid"]
        if len(path) == 1:
            top = own
    return [(top.get("chainid", ""), top.get("chainname"), *r[1:]) for r in found]


def store_branches(files: DataFrame) -> DataFrame:
    """Raw branch rows of store files of any shape, packing or encoding; a file that does not parse gives none."""
    schema = ("_file string, chain_id string, chain_name string, subchain_id string, store_id string, "
              "store_name string, city string, address string")
    names = [c.split()[0] for c in schema.split(", ")]

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for name, raw in zip(batch["_file"], batch["content"]):
                _, plain = unpack(bytes(raw))
                try:
                    rows += [(name, *r) for r in branches_of(plain)] if plain else []
                except ET.ParseError:
                    continue
                # A frame for many files, since most have few branches.
                if len(rows) >= FRAME_ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return spread_files(files.select("_file", "content")).mapInPandas(per_batch, schema)


def tag_paths(files: DataFrame) -> DataFrame:
    """``path`` (tags below the root, joined by ``/``) and ``n``, of all elements of the files that parse.

    Paths are counted while a file is parsed, and counts are added up: what travels are a file's different paths.
    """

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter[str] = Counter()
            for raw in batch["content"]:
                _, plain = unpack(bytes(raw))
                own: Counter[str] = Counter()
                try:
                    own.update("/".join(path[1:]) for _, path, _ in walk(plain or b"") if len(path) > 1)
                except ET.ParseError:
                    continue
                total.update(own)
            yield pd.DataFrame(sorted(total.items()), columns=["path", "n"])

    return files.select("content").mapInPandas(per_batch, "path string, n bigint").groupBy("path").agg(F.sum("n").alias("n"))


def unknown_paths(files: DataFrame, known: list[str]) -> DataFrame:
    """Paths that are neither known nor lead to a known one, with their counts."""
    leading = sorted({"/".join(k.split("/")[:n]) for k in known for n in range(1, k.count("/") + 2)})
    return tag_paths(files).filter(~F.col("path").isin(leading))


def latest_branches(branches: DataFrame) -> DataFrame:
    """One row per branch; the file that sorts last wins."""
    rows = branches.withColumns({
        "chain_id": text.digits(F.col("chain_id")), "store_id": text.store_code(F.col("store_id")),
    }).filter("chain_id <> ''")
    values = ["subchain_id", "chain_name", "store_name", "city", "address"]
    return max_by_order(rows, ["chain_id", "store_id"], [F.col("_file")], values)
