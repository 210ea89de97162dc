"""Where stores are: nearby search, filling, checking and merging locations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions import geo, text
from shelfwise.operators.spread import FEW_KEYS_WAYS, lookup_join
from shelfwise.session import cut_lineage

# Fixed value.
SANITY_KM = 20.0


def nearby(stores: DataFrame, chains: DataFrame, lat: float, lon: float, radius_km: float = 5.0) -> DataFrame:
    """Stores within a radius, nearest first, without position or distance.

    Only stores placed by address count. A radius above the limit is an error.
    """
    if not 0 < radius_km <= geo.MAX_RADIUS_KM:
        raise ValueError(f"radius must be above 0 and at most {geo.MAX_RADIUS_KM} km")
    dlat, dlon = geo.box_degrees(lat, radius_km)
    box = stores.filter(
        (F.col("precision") == "address") & F.col("lat").between(lat - dlat, lat + dlat)
        & F.col("lon").between(lon - dlon, lon + dlon))
    km = geo.haversine_km(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))
    near = box.withColumn("_km", km).filter(F.col("_km") <= radius_km)
    names = chains.select("chain_id", F.col("name").alias("chain_name"))
    named = lookup_join(near, names, ["chain_id"], ["store_id"])
    return named.orderBy("_km", "chain_id", "store_id").select(
        "chain_id", "store_id", "chain_name", "store_name", F.col("city_name").alias("city"),
        F.col("address").alias("raw_address"))


def nearby_many(origins: DataFrame, stores: DataFrame, radius_km: float = 5.0) -> DataFrame:
    """(origin_id, chain_id, store_id, km) for every origin and near store.

    Both sides are cut into grid cells as wide as the radius; an origin asks
    its own and the eight cells around it. Positions shared by many origins are
    searched once.
    """
    dlat = radius_km / geo.KM_PER_LAT_DEGREE * geo.BOX_SLACK
    # Cells are widest in degrees where the stores are furthest from the equator.
    dlon = radius_km / (geo.KM_PER_LON_DEGREE * max(math.cos(math.radians(geo.COUNTRY_BOX["lat_max"])), 0.01)) * geo.BOX_SLACK
    placed = stores.filter(F.col("precision") == "address").select(
        "chain_id", "store_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"),
        geo.cell(F.col("lat"), dlat).alias("_y"), geo.cell(F.col("lon"), dlon).alias("_x"))
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    spots = origins.select("lat", "lon").distinct()
    asked = spots.withColumn("_y", F.explode(F.transform(around, lambda d: geo.cell(F.col("lat"), dlat) + d)))
    asked = asked.withColumn("_x", F.explode(F.transform(around, lambda d: geo.cell(F.col("lon"), dlon) + d)))
    pairs = lookup_join(asked, placed, ["_y", "_x"], ["lat", "lon"], "inner")
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))
    near = pairs.withColumn("km", km).filter(F.col("km") <= radius_km)
    found = near.select("lat", "lon", "chain_id", "store_id", "km")
    return origins.select("origin_id", "lat", "lon").join(found, ["lat", "lon"]).select(
        "origin_id", "chain_id", "store_id", "km")


# --- filling and checking ----------------------------------------------------


def _one_per_key(rows: DataFrame, key: str, cols: list[str], side: str) -> DataFrame:
    """Rows per key and, for a key with one row, that row's columns."""
    first = F.min(F.struct(*cols))
    return rows.filter(F.col(key) != "").groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{side}_rows"), first.alias(side))


def fill_by_address(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Match unplaced branches to a third-party list by exact address key.

    ``ours``: branch_uid, address, city; ``theirs``: id, address, city, lat,
    lon. Only one-to-one matches count; both sides are reduced to one row per
    key before they meet. ``status`` is accepted (same city), review, or
    ambiguous (several on a side; see :func:`ambiguous_addresses`).
    """
    named = ours.filter(text.has_address(F.col("address")))
    left = named.select(text.address_key(F.col("address")).alias("key"), "branch_uid",
                        F.trim(F.coalesce("city", F.lit(""))).alias("city"))
    right = theirs.select(text.address_key(F.col("address"), F.col("city")).alias("key"), "id",
                          F.trim(F.coalesce("city", F.lit(""))).alias("city"), "lat", "lon")
    pairs = _one_per_key(left, "key", ["branch_uid", "city"], "our").join(
        _one_per_key(right, "key", ["id", "city", "lat", "lon"], "their"), "key")
    several = (F.col("our_rows") > 1) | (F.col("their_rows") > 1)
    same = (F.col("our.city") != "") & (F.col("our.city") == F.col("their.city"))
    status = F.when(several, "ambiguous").when(same, "accepted").otherwise("review")
    single = lambda c: F.when(~several, F.col(c))
    return pairs.select(
        "key", status.alias("status"), "our_rows", "their_rows",
        single("our.branch_uid").alias("branch_uid"), single("their.id").alias("their_id"),
        single("their.city").alias("city"), single("their.lat").alias("lat"), single("their.lon").alias("lon"))


def ambiguous_addresses(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Keys with several rows on a side, one row per (``key``, ``side``, ``id``), for review."""
    named = ours.filter(text.has_address(F.col("address")))
    both = named.select(text.address_key(F.col("address")).alias("key"), F.lit("ours").alias("side"), F.col("branch_uid").alias("id")).unionByName(
        theirs.select(text.address_key(F.col("address"), F.col("city")).alias("key"), F.lit("theirs").alias("side"), "id")).filter("key <> ''")
    mine = F.count_if(F.col("side") == "ours")
    several = both.groupBy("key").agg(mine.alias("our_rows"), F.count_if(F.col("side") == "theirs").alias("their_rows")).filter(
        "our_rows > 0 and their_rows > 0 and our_rows + their_rows > 2").select("key")
    return lookup_join(both, several, ["key"], ["id"], "left_semi")


# Cells of each level of the reference tree are eight times as wide as those below; the top one spans the earth.
TREE_BITS, TREE_LEVELS = 3, 6
TREE_KEY = ["city", "_level", "_y", "_x"]


def reference_tree(spots: DataFrame, cell_size: float) -> DataFrame:
    """Occupied cells of all levels, per city: bounds, and one of the points inside (``city``, ``_lat``, ``_lon``)."""
    cells = spots.withColumns({"_y": geo.cell(F.col("_lat"), cell_size), "_x": geo.cell(F.col("_lon"), cell_size)}).groupBy("city", "_y", "_x").agg(
        F.min("_lat").alias("_s"), F.max("_lat").alias("_n"), F.min("_lon").alias("_w"), F.max("_lon").alias("_e"), F.min(F.struct("_lat", "_lon")).alias("_one"))
    up = lambda c, k: F.shiftright(F.col(c).cast("bigint"), TREE_BITS * k)
    levels = F.array(*[F.struct(F.lit(k).alias("_level"), up("_y", k).alias("_y"), up("_x", k).alias("_x")) for k in range(TREE_LEVELS)])
    every = cells.select("city", F.explode(levels).alias("_c"), "_s", "_n", "_w", "_e", "_one").select("city", "_c.*", "_s", "_n", "_w", "_e", "_one")
    return every.groupBy(*TREE_KEY).agg(
        F.min("_s").alias("_s"), F.max("_n").alias("_n"), F.min("_w").alias("_w"), F.max("_e").alias("_e"), F.min("_one").alias("_one"))


def _bounds() -> tuple[Column, Column]:
    """Least and greatest km from (``lat``, ``lon``) to the nearest point of a tree cell."""
    # True lower bounds: the latitude gap, and the longitude gap at the higher latitude.
    lat_gap = F.greatest(F.col("_s") - F.col("lat"), F.col("lat") - F.col("_n"), F.lit(0.0))
    lon_gap = F.greatest(F.col("_w") - F.col("lon"), F.col("lon") - F.col("_e"), F.lit(0.0))
    narrow = F.cos(F.radians(F.col("lat"))) * F.least(F.cos(F.radians("_s")), F.cos(F.radians("_n")))
    lon_km = F.lit(2 * geo.EARTH_KM) * F.asin(F.sqrt(narrow) * F.sin(F.radians(F.least(lon_gap, F.lit(180.0))) / 2))
    low = F.greatest(F.radians(lat_gap) * geo.EARTH_KM, lon_km) - 1e-6
    return low, geo.haversine_km(F.col("lat"), F.col("lon"), F.col("_one._lat"), F.col("_one._lon"))


def nearest_reference_km(points: DataFrame, refs: DataFrame, cell_size: float = 0.02) -> DataFrame:
    """Add ``km`` to the nearest reference point of the same ``city``; null if none.

    References lie in a tree of cells. A point first asks the ring of cells around it on every level: any point found bounds
    the distance. It then opens the cells within that bound, on the level where these are few, and goes down: at each level a
    cell stays only if it may hold something nearer than the best bound so far. Every join is on a cell, none on the city.
    ``points``: branch_uid, city, lat, lon.
    """
    spots = refs.filter("city <> '' and lat is not null and lon is not null").select(
        "city", F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).distinct()
    # The tree and the open cells of a level are read more than once, so both are kept.
    tree, point = cut_lineage(reference_tree(spots, cell_size)), ["city", "lat", "lon"]
    asked = points.select(*point).filter("city <> '' and lat is not null and lon is not null").distinct()
    cell = lambda c: geo.cell(c, cell_size).cast("bigint")
    low, high = _bounds()
    level = lambda c, k: F.call_function("shiftright", c, k * TREE_BITS)
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    rings = asked.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(TREE_LEVELS - 1))))
    rings = rings.withColumn("_y", F.explode(F.transform(around, lambda d: level(cell(F.col("lat")), F.col("_level")) + d)))
    rings = rings.withColumn("_x", F.explode(F.transform(around, lambda d: level(cell(F.col("lon")), F.col("_level")) + d)))
    met = lookup_join(rings, tree, TREE_KEY, ["lat", "lon"], "inner", FEW_KEYS_WAYS)
    reach = met.groupBy(*point).agg(F.min(high).alias("_reach"))
    # The level on which a bound is about two cells wide, and the cells within the bound there.
    dlat = F.col("_reach") / geo.KM_PER_LAT_DEGREE * geo.BOX_SLACK
    dlon = dlat / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("lat")) + dlat, F.lit(89.0)))), F.lit(0.01))
    wide = F.ceil(F.log2(F.greatest(dlon / (2 * cell_size), F.lit(1.0))) / TREE_BITS).cast("int")
    opened = reach.withColumns({"_dlat": dlat, "_dlon": dlon, "_level": F.least(wide, F.lit(TREE_LEVELS - 1))})
    span = lambda c, d: F.sequence(level(cell(F.col(c) - F.col(d)), F.col("_level")), level(cell(F.col(c) + F.col(d)), F.col("_level")))
    opened = opened.withColumn("_y", F.explode(span("lat", "_dlat"))).withColumn("_x", F.explode(span("lon", "_dlon"))).drop("_dlat", "_dlon")
    cells = lookup_join(opened, tree, TREE_KEY, ["lat", "lon"], "inner", FEW_KEYS_WAYS)
    cells = cut_lineage(cells)
    best, top = Window.partitionBy(*point), cells.agg(F.max("_level")).first()[0] or 0
    for k in range(top, -1, -1):
        near = cells.withColumns({"_low": low, "_reach": F.least(F.col("_reach"), F.min(high).over(best))}).filter("_low <= _reach")
        cells = cut_lineage(near.drop("_low"))
        if k == 0:
            break
        here, rest = cells.filter(F.col("_level") == k), cells.filter(F.col("_level") < k)
        parent = tree.filter(F.col("_level") == k - 1).withColumns({
            "_py": level(F.col("_y"), F.lit(1)), "_px": level(F.col("_x"), F.lit(1))})
        down = here.select(*point, "_reach", F.col("_y").alias("_py"), F.col("_x").alias("_px"))
        opened = lookup_join(down, parent, ["city", "_py", "_px"], ["lat", "lon"], "inner", FEW_KEYS_WAYS).drop("_py", "_px")
        cells = opened.unionByName(rest)
    located = spots.withColumns({"_y": cell(F.col("_lat")), "_x": cell(F.col("_lon"))})
    pairs = lookup_join(cells.select(*point, "_y", "_x"), located, ["city", "_y", "_x"], ["lat", "lon"], "inner", FEW_KEYS_WAYS)
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))
    found = pairs.groupBy(*point).agg(F.min(km).alias("km"))
    return points.join(found, point, "left")


def sanity_check(locations: DataFrame, refs: DataFrame, near_cell: float = 0.1) -> DataFrame:
    """Locations outside the country, or far from every known point of their city.

    A location that shares a cell narrower than the limit with a reference of
    its city cannot be far, so only the others have their distance measured.
    """
    placed = locations.filter("lat is not null and lon is not null").withColumn(
        "city", F.trim(F.coalesce("city", F.lit(""))))
    inside = geo.inside_country(F.col("lat"), F.col("lon"))
    outside = placed.filter(~inside).select(
        "branch_uid", F.lit("outside_country").alias("reason"), F.lit(None).cast("double").alias("km"))
    cells = lambda df: df.withColumns({"_y": geo.cell(F.col("lat"), near_cell), "_x": geo.cell(F.col("lon"), near_cell)})
    known = cells(refs.filter("city <> '' and lat is not null")).select("city", "_y", "_x").distinct()
    doubtful = cells(placed.filter(inside)).join(known, ["city", "_y", "_x"], "left_anti").drop("_y", "_x")
    far = nearest_reference_km(doubtful.select("branch_uid", "city", "lat", "lon"), refs).filter(
        F.col("km") > SANITY_KM)
    return outside.unionByName(far.select("branch_uid", F.lit("far_from_city").alias("reason"), "km"))


def withdraw(locations: DataFrame, flagged: DataFrame) -> DataFrame:
    """Flagged locations become unplaced; nothing is removed."""
    marked = locations.join(flagged.select("branch_uid", F.lit(True).alias("_bad")), "branch_uid", "left")
    clear = lambda c: F.when(F.col("_bad").isNull(), F.col(c)).alias(c)
    return marked.select(*[clear(c) if c in ("lat", "lon", "method", "precision") else F.col(c) for c in locations.columns])


def merge_passes(branches: DataFrame, passes: list[DataFrame]) -> DataFrame:
    """Location of each branch: the earliest pass that placed it.

    Passes (branch_uid, status, lat, lon, city, method) are merged anew each
    time, so a hit that a pass no longer reports goes back to null.
    """
    out, hits = branches.select("branch_uid"), []
    for i, one in enumerate(passes):
        hit = one.filter("status = 'geocoded'").select(
            "branch_uid", F.struct("lat", "lon", "city", "method").alias(f"_p{i}"))
        out = out.join(hit, "branch_uid", "left")
        hits.append(F.col(f"_p{i}"))
    return out.select("branch_uid", F.coalesce(*hits).alias("at")).select("branch_uid", "at.*")


def classify(branches: DataFrame) -> DataFrame:
    """Add ``status``: no address, resolved, or no result."""
    status = F.when(~text.has_address(F.col("address")), "no_address").when(
        F.col("lat").isNotNull(), "resolved").otherwise("no_result")
    return branches.withColumn("status", status)


def chain_coverage(classified: DataFrame) -> DataFrame:
    one = lambda s: F.count_if(F.col("status") == s)
    return classified.groupBy("chain_id").agg(
        F.count(F.lit(1)).alias("total"), one("resolved").alias("resolved"),
        one("no_result").alias("unresolved"), one("no_address").alias("no_address"))


def rule_counts(recovered: DataFrame) -> DataFrame:
    """How often each cleanup rule and each stage took part in a recovery."""
    rules = recovered.select(F.explode("rules").alias("name")).groupBy("name").count()
    stages = recovered.groupBy(F.col("stage").alias("name")).count()
    return rules.withColumn("kind", F.lit("rule")).unionByName(stages.withColumn("kind", F.lit("stage")))
