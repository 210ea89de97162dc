"""Small reference files: id maps, category tables, taxonomies, favourites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def json_map(spark: SparkSession, path: str, field: str, value_type: str = "string") -> DataFrame:
    """``key``, ``value`` of a JSON object's map field; a missing file is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], f"key string, value {value_type}")
    doc = spark.read.schema(f"{field} map<string,{value_type}>").option("multiLine", True).json(path)
    return doc.select(F.explode(field).alias("key", "value"))


def branch_ids(spark: SparkSession, path: str) -> DataFrame:
    ids = json_map(spark, path, "ids")
    parts = F.split("key", r"\|")
    return ids.select(F.get(parts, F.lit(0)).alias("chain_id"), F.get(parts, F.lit(1)).alias("store_id"),
                      F.col("value").alias("branch_uid"))


def branch_locations(spark: SparkSession, path: str) -> DataFrame:
    point = "struct<lat:double,lon:double,city:string,method:string,precision:string>"
    rows = json_map(spark, path, "locations", point)
    return rows.select(F.col("key").alias("branch_uid"), "value.*", F.col("value").isNotNull().alias("resolved"))


def categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id int, slug string, name_he string, parent_id int").option(
        "multiLine", True).json(path)


def product_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("barcode string, category_id int, source_chain string").option("sep", "\t").csv(path)


def decided_names(spark: SparkSession, path: str) -> DataFrame:
    """``barcode``, ``name`` of usable entries; a file of another shape raises."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "barcode string, name string")
    text = spark.read.option("wholetext", True).text(path)
    entry = F.from_json("value", "products array<string>")
    checked = text.select(F.when(
        entry["products"].isNull(), F.raise_error(F.lit("expected an object with a products array"))
    ).otherwise(entry["products"]).alias("products"))
    rows = checked.select(F.explode("products").alias("e")).select(
        F.trim(F.get_json_object("e", "$.barcode")).alias("barcode"),
        F.trim(F.get_json_object("e", "$.name")).alias("name"))
    return rows.filter("coalesce(barcode, '') <> '' and coalesce(name, '') <> ''")


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """``chain``, ``barcode``, ``path``, ``name``, ``second_level`` of dumps."""
    item = "struct<path:string,name:string,second_level:string>"
    doc = spark.read.schema(f"chain string, products map<string,{item}>").option("multiLine", True).json(path)
    rows = doc.select("chain", F.explode("products").alias("barcode", "p"))
    return rows.select("chain", "barcode", "p.*")


def produce_units(spark: SparkSession, path: str) -> DataFrame:
    schema = "slug string, kind string, chain_id string, chain_name string, barcode string, price double"
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


def favourites(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Favourite barcodes, and the (chain, store) pairs shopped at."""
    doc = spark.read.schema("barcodes array<string>, stores array<array<string>>").option(
        "multiLine", True).json(path)
    pairs = doc.select(F.explode("stores").alias("s"))
    return (doc.select(F.explode("barcodes").alias("barcode")),
            pairs.select(F.get("s", F.lit(0)).alias("chain_id"), F.get("s", F.lit(1)).alias("store_id")))


def snapshot_stores(spark: SparkSession, path: str) -> DataFrame:
    """Third-party store list: id, lat, lon, chain, city, address, name."""
    item = "struct<_id:string,location:array<double>,chainName:string,city:string,address:string,name:string>"
    rows = json_map(spark, path, "stores", item)
    return rows.select(
        F.col("key").alias("id"), F.get("value.location", F.lit(1)).alias("lat"),
        F.get("value.location", F.lit(0)).alias("lon"), F.col("value.chainName").alias("chain_name"),
        F.trim(F.coalesce("value.city", F.lit(""))).alias("city"), "value.address", "value.name")
