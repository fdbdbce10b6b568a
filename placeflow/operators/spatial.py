"""Points to regions, region boxes and their neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.scratch import save

BOX = ("min_lat", "min_lon", "max_lat", "max_lon")
#: Pairs of cell and region that may be sent to all tasks (about 10 MB).
BROADCAST_CELLS = 100_000


def box(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(prefix + c) for c in BOX)


def region_cells(regions: DataFrame) -> DataFrame:
    """A row for each cell that a region's box touches; regions without a box have none."""
    return regions.where(F.col("min_lat").isNotNull()).withColumn("cell", F.explode(X.bbox_cells(*box())))


def _codes(regions: DataFrame, kind: str) -> Column:
    """A region's codes: the array column <kind>_codes, or the one code of <kind>_code."""
    return X.norm_codes(F.col(f"{kind}_codes") if f"{kind}_codes" in regions.columns else F.array(f"{kind}_code"))


def _with_boxes(points: DataFrame, regions: DataFrame, *columns: Column, how: str = "inner") -> DataFrame:
    """Valid points with `inside`: an array of the regions (region_id and columns) whose box contains them. With how left all points, null where no box is near or the place isn't valid.

    The regions of a cell are one row, so points meet them by an equi-join on the cell and stay one row each. The
    table of cells is sent to the points if it is small; configurations are.
    """
    box_ = F.struct("region_id", *BOX, *columns)
    cells = region_cells(regions).groupBy("cell").agg(F.array_sort(F.collect_list(box_)).alias("boxes"))
    if region_cells(regions).limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    ok = X.valid_coord(F.col("lat"), F.col("lon"))
    valid = (points.where(ok) if how == "inner" else points).withColumn("cell", F.when(ok, X.grid_cell(F.col("lat"), F.col("lon"))))
    inside = F.filter("boxes", lambda r: X.bbox_contains(F.col("lat"), F.col("lon"), *(r[c] for c in BOX)))
    return valid.join(cells, "cell", how).withColumn("inside", inside).drop("cell", "boxes")


def spatial_candidates(points: DataFrame, regions: DataFrame) -> DataFrame:
    """Each valid point (lat, lon) with the region_id of each region whose box contains it."""
    found = _with_boxes(points, regions)
    return found.withColumn("region_id", F.explode("inside.region_id")).drop("inside")


def _decided(points: DataFrame, regions: DataFrame, how: str = "inner") -> DataFrame:
    """Valid points (with how left: all) with `inside` as an array of the regions that they go to.

    Among several boxes a two-letter country code decides, else regions without codes, else all; among what is left
    the subdivision decides, again only after a two-letter country code. No shuffle: all of a point's boxes are in its row.
    """
    found = _with_boxes(points, regions, _codes(regions, "country").alias("countries"), _codes(regions, "subdivision").alias("subdivisions"), how=how)
    country, sub = F.upper(X.clean(F.col("country"))), X.qualify_subdivision(F.col("country"), F.col("state"))
    iso = country.rlike("^[A-Z]{2}$")
    some = lambda test, among, other: F.when(F.exists(among, test), F.filter(among, test)).otherwise(other)
    all_ = F.col("inside")
    first = some(lambda r: F.array_contains(r["countries"], country), all_, some(lambda r: F.size(r["countries"]) == 0, all_, all_))
    left = found.withColumn("inside", F.when(iso & (F.size(all_) > 1), first).otherwise(all_))
    second = some(lambda r: F.array_contains(r["subdivisions"], sub), all_, all_)
    return left.withColumn("inside", F.when(iso & (F.size(all_) > 1) & (X.clean(F.col("state")) != ""), second).otherwise(all_))


def placed(points: DataFrame, regions: DataFrame) -> DataFrame:
    """All points (lat, lon, country, state and any others) with `inside`: the ids of the regions that they go to; null where there is none."""
    return _decided(points, regions, "left").withColumn("inside", F.col("inside.region_id"))


def routed_rows(placed: DataFrame) -> DataFrame:
    """placed points with region_id, a row for each region they go to."""
    return placed.withColumn("region_id", F.explode("inside")).drop("inside")


def routed(points: DataFrame, regions: DataFrame) -> DataFrame:
    """points (lat, lon, country, state and any others) with region_id, a row for each region they go to."""
    return _decided(points, regions).withColumn("region_id", F.explode("inside.region_id")).drop("inside")


def route_points(points: DataFrame, regions: DataFrame) -> DataFrame:
    """(point_id, region_id) by the rules of routed()."""
    return routed(points, regions).select("point_id", "region_id")


def region_counts(routed: DataFrame, regions: DataFrame) -> DataFrame:
    """Points of each region, regions without any included."""
    return regions.select("region_id").join(routed.groupBy("region_id").agg(F.count("*").alias("n")), "region_id", "left").select("region_id", F.coalesce("n", F.lit(0)).alias("n"))


def partition_stats(points: DataFrame, regions: DataFrame) -> DataFrame:
    """One row: rows_read, normalized (valid), unmatched, writes and writes for each row read.

    unmatched: valid rows that no region takes. Rows are counted where they are routed, each for itself, whatever ids
    they share, and only sums are shuffled.
    """
    return placed_stats(placed(points, regions))


def placed_stats(placed: DataFrame) -> DataFrame:
    """partition_stats of placed points, which are read once."""
    ok = X.valid_coord(F.col("lat"), F.col("lon"))
    n = F.coalesce(F.when(F.col("inside").isNotNull(), F.size("inside")), F.lit(0))
    counted = placed.agg(F.count("*").alias("rows_read"), F.count_if(ok).alias("normalized"), F.count_if(ok & (n == 0)).alias("unmatched"), F.coalesce(F.sum(n), F.lit(0)).alias("writes"))
    return counted.select("*", (F.col("writes") / F.greatest("rows_read", F.lit(1))).alias("amplification"))


def region_neighbors(regions: DataFrame, margin: float = 0.02, overlap: float = 0.8) -> DataFrame:
    """(region_id, neighbor_id) and the neighbour's widened box, both ways, for boxes that touch within the margin but don't cover the same ground.

    Regions that want no roads (road_indexes false) have no neighbours. Candidates share a grid cell of their widened
    boxes; only pairs of such regions are compared.
    """
    wanted = F.coalesce("road_indexes", F.lit(True)) if "road_indexes" in regions.columns else F.lit(True)
    wide = regions.where(F.col("min_lat").isNotNull() & wanted).select("region_id", *BOX)
    grown = X.expand_bbox(*box(), 2 * margin)
    cells = wide.withColumn("g", grown).withColumn("cell", F.explode(X.bbox_cells(*(F.col(f"g.{c}") for c in BOX)))).drop("g")
    a, b = cells.select("cell", *(F.col(c).alias(f"a_{c}") for c in ("region_id", *BOX))), cells.select("cell", *(F.col(c).alias(f"b_{c}") for c in ("region_id", *BOX)))
    pairs = a.join(b, "cell").where("a_region_id < b_region_id").drop("cell").distinct()
    A, B = box("a_"), box("b_")
    lat = (A[0] - margin <= B[2]) & (B[0] - margin <= A[2])
    lon = F.exists(X.widened_intervals(A[1], A[3], margin), lambda i: F.exists(X.widened_intervals(B[1], B[3], margin), lambda j: (i["lo"] <= j["hi"]) & (j["lo"] <= i["hi"])))
    smaller = F.least(X.bbox_area(*A), X.bbox_area(*B))
    same = F.when(smaller > 0, X.bbox_intersection_area(A, B) / smaller).otherwise(0.0) >= overlap
    kept = pairs.where(lat & lon & ~same)
    one = lambda x, y, Y: kept.select(F.col(f"{x}_region_id").alias("region_id"), F.col(f"{y}_region_id").alias("neighbor_id"), X.expand_bbox(*Y, margin).alias("box"))
    return one("a", "b", B).unionByName(one("b", "a", A)).select("region_id", "neighbor_id", *(F.col(f"box.{c}").alias(c) for c in BOX))


def geometry_positions(features: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """(key, lon, lat) of a GeoJSON geometry kept as VARIANT, whatever its depth: arrays are opened, level by level, until only pairs of numbers are left."""
    spark = features.sparkSession
    now = features.select(F.col(key), F.variant_get(F.col(geometry), "$.coordinates", "variant").alias("v")).where("v is not null")
    out = None
    while True:
        number_first = F.try_variant_get("v", "$[0]", "double").isNotNull()
        leaf = now.where(number_first).select(key, F.try_variant_get("v", "$[0]", "double").alias("lon"), F.try_variant_get("v", "$[1]", "double").alias("lat"))
        out = leaf if out is None else out.unionByName(leaf)
        opened = spark.sql("select w.*, e.value as e from {w} w, lateral variant_explode(w.v) e", w=now.where(~number_first))
        now = save(opened.where("schema_of_variant(e) like 'ARRAY%'").select(key, F.col("e").alias("v")), "geometry")
        if now.isEmpty():
            return out


def coverage_bbox(positions: DataFrame, key: str) -> DataFrame:
    """The least box of each key's positions (lat, lon): longitudes leave out their largest gap, also over the antimeridian.

    Positions with an impossible latitude stay out; a key without any left isn't in the result.
    """
    ok = positions.where(F.col("lat").between(-90, 90) & F.col("lon").isNotNull()).select(key, "lat", X.normalize_lon(F.col("lon")).alias("lon"))
    lats = ok.groupBy(key).agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"))
    # Gaps within a degree, dealt by degree; then gaps between the at most 360 degrees of a key.
    lons = ok.select(key, F.floor("lon").alias("degree"), "lon").distinct()
    inner = lons.withColumn("next", F.lead("lon").over(W.partitionBy(key, "degree").orderBy("lon")))
    gap = lambda a, b: F.struct((b - a).alias("gap"), (-a).alias("west"), a.alias("lon"), b.alias("next"))
    bins = inner.groupBy(key, "degree").agg(F.min("lon").alias("first"), F.max("lon").alias("last"), F.max(F.when(F.col("next").isNotNull(), gap(F.col("lon"), F.col("next")))).alias("inner"))
    of = W.partitionBy(key)
    after = F.coalesce(F.lead("first").over(of.orderBy("degree")), F.min("first").over(of) + 360)
    widest = bins.select(key, "inner", gap(F.col("last"), after).alias("outer")).groupBy(key).agg(F.greatest(F.max("inner"), F.max("outer")).alias("g"))
    whole = 360 - F.col("g.gap") >= 359.999999
    r = X.round_coord
    return lats.join(widest, key).select(
        key,
        r(F.col("min_lat")).alias("min_lat"),
        F.when(whole, -180.0).otherwise(r(X.normalize_lon(F.col("g.next")))).alias("min_lon"),
        r(F.col("max_lat")).alias("max_lat"),
        F.when(whole, 180.0).otherwise(r(X.normalize_lon(F.col("g.lon")))).alias("max_lon"),
    )
