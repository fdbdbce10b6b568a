"""Address enrichment: which sources apply, duplicates, postal groups, the enriched corpus, job catalogs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.functions import exprs as X


def normalized(records: DataFrame, normalize: Callable[[DataFrame], DataFrame] | None = None, keep: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Records after the caller's normaliser and predicate; by default valid coordinates, and street and number or, for postal codes, a postcode."""
    if normalize is None:
        has = lambda c: X.clean(F.col(c)) != ""
        whole = F.when(F.col("kind") == "postal_code", has("postcode")).otherwise(has("house_number") & has("street"))
        out = records.where(X.valid_coord(F.col("lat"), F.col("lon")) & whole)
    else:
        out = normalize(records)
    return out if keep is None else out.where(keep(out))


def applicable_sources(sources: DataFrame, regions: DataFrame) -> DataFrame:
    """(source_id, region_id). sources: arrays include_ids, include_groups, exclude_ids, exclude_groups and partition_ids, null or empty for none; regions: region_id, groups.

    Both tables are configuration, a row for each region or source.
    """
    some = lambda c: F.coalesce(c, F.expr("cast(array() as array<string>)"))
    ids, groups = some(F.col("include_ids")), some(F.col("include_groups"))
    listed = ((F.size(ids) == 0) & (F.size(groups) == 0)) | F.array_contains(ids, F.col("region_id")) | F.arrays_overlap(groups, F.col("groups"))
    left_out = F.array_contains(some(F.col("exclude_ids")), F.col("region_id")) | F.arrays_overlap(some(F.col("exclude_groups")), F.col("groups"))
    parts = some(F.col("partition_ids"))
    return sources.join(regions, listed & ~left_out & ((F.size(parts) == 0) | F.array_contains(parts, F.col("region_id")))).select("source_id", "region_id")


def filter_allowed(records: DataFrame, field: str, allowed: list[str]) -> DataFrame:
    """Records whose field is one of the allowed values, whatever the case and the blanks around."""
    return records.where(F.upper(X.clean(F.col(field))).isin([a.strip().upper() for a in allowed]))


def _tidy(c: str) -> Column:
    """Upper case, single spaces, none around."""
    return F.regexp_replace(F.upper(X.clean(F.col(c))), r"\s+", " ")


def civic_key(units: bool = False) -> Column:
    """Country, postcode, street and house number (and unit) with upper case and single spaces."""
    return F.concat_ws("|", *(_tidy(c) for c in ("country", "postcode", "street", "house_number", *(["unit"] if units else []))))


def suppress_duplicates(corpus: DataFrame, addresses: DataFrame, units: bool = False) -> DataFrame:
    """Addresses whose civic key neither the corpus nor an earlier source has; addresses: priority and addr_id settle which one stays.

    The first of each key is an aggregate, so a key that many rows share is combined before the shuffle.
    """
    keyed = addresses.withColumn("civic_key", civic_key(units))
    known = corpus.select(civic_key(units).alias("civic_key")).distinct()
    first = keyed.groupBy("civic_key").agg(F.min_by(F.struct(*addresses.columns), F.struct("priority", "addr_id")).alias("r"))
    return first.join(known, "civic_key", "left_anti").select("r.*")


def group_postal(addresses: DataFrame) -> DataFrame:
    """A row for each country and postcode, both as civic_key writes them, so that case and blanks make no groups of their own: centroid, bounds, most frequent locality (first by name among equals), all localities, samples, addresses and sources.

    Samples are all records, addresses those whose kind (where there is such a column) isn't postal_code; sources are the
    configured places (priority) of the sources that the group comes from.
    """
    own = addresses.where(X.clean(F.col("postcode")) != "").withColumns({"country": _tidy("country"), "postcode": _tidy("postcode"), "city": X.clean(F.col("city"))})
    keys = ["country", "postcode"]
    places = own.where("city <> ''").groupBy(*keys, "city").agg(F.count("*").alias("n"))
    names = places.groupBy(*keys).agg(F.min_by("city", F.struct(-F.col("n"), F.col("city"))).alias("locality"), F.array_sort(F.collect_set("city")).alias("localities"))
    is_address = ~F.col("kind").eqNullSafe("postal_code") if "kind" in own.columns else F.lit(True)
    origin = [F.array_sort(F.collect_set("priority")).alias("sources")] if "priority" in own.columns else []
    spots = own.groupBy(*keys).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.min("lat").alias("min_lat"), F.min("lon").alias("min_lon"), F.max("lat").alias("max_lat"), F.max("lon").alias("max_lon"), F.count("*").alias("samples"), F.count_if(is_address).alias("addresses"), *origin)
    return spots.join(names, keys, "left")


def enrich_corpus(corpus: DataFrame, addresses: DataFrame) -> DataFrame:
    """corpus with the addresses that it lacks and a document for each postal group; kind tells them apart (place, address, postal_code)."""
    new = suppress_duplicates(corpus, addresses)
    place = corpus.select(F.col("id"), F.lit("place").alias("kind"), "country", "postcode", "lat", "lon")
    extra = new.select(F.concat(F.lit("a"), F.col("addr_id")).alias("id"), F.lit("address").alias("kind"), "country", "postcode", "lat", "lon")
    postal = group_postal(addresses).select(F.concat_ws("-", F.lit("p"), "country", "postcode").alias("id"), F.lit("postal_code").alias("kind"), "country", "postcode", "lat", "lon")
    return place.unionByName(extra).unionByName(postal)


def enrichment_counters(enriched: DataFrame) -> DataFrame:
    """One row: addresses_written, postal_docs and total_docs of an enriched corpus."""
    return enriched.agg(F.count_if(F.col("kind") == "address").alias("addresses_written"), F.count_if(F.col("kind") == "postal_code").alias("postal_docs"), F.count("*").alias("total_docs"))


def lane_filter(enriched: DataFrame, lane: str) -> DataFrame:
    """Imported addresses stay out of ranked text, suggestions and the map; other lanes see all."""
    return enriched.where(F.col("kind") != "address") if lane in ("text", "suggest", "map") else enriched


def read_job_catalog(jobs: DataFrame) -> DataFrame:
    """Usable jobs with their key, in order of source, name and job: output, job id and source known, layer addresses. A catalog without any fails the job."""
    usable = jobs.where(F.coalesce("output", F.lit(False)) & F.col("job").isNotNull() & F.col("source").isNotNull() & (F.col("layer") == "addresses")).withColumn("job_key", X.job_key(F.col("job"), F.col("updated")))
    if usable.isEmpty():
        raise ValueError("the job catalog has no usable job")
    return usable.orderBy("source", "name", "job")


def catalog_identity(catalog: DataFrame) -> DataFrame:
    """jobs, bytes, snapshot: a hash of the jobs' sources, names, keys and sizes."""
    size = F.greatest("size", F.lit(0))
    row = F.concat_ws("|", "source", "name", "job_key", size.cast("string"))
    return catalog.agg(F.count("*").alias("jobs"), F.sum(size).cast("long").alias("bytes"), X.sum_digest(row).alias("snapshot"))


def pending_jobs(catalog: DataFrame, completed: DataFrame) -> DataFrame:
    return catalog.join(completed.select("job_key"), "job_key", "left_anti")


def workload(parts: DataFrame) -> DataFrame:
    return parts.groupBy("region_id").agg(F.sum(F.greatest("bytes", F.lit(0))).alias("bytes"), F.sum(F.greatest("records", F.lit(0))).alias("records"))


def way_anchors(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """way_id, lat, lon, refs: the mean of a way's distinct node places. ways: way_id, node_id; nodes: node_id, lat, lon."""
    return ways.select("way_id", "node_id").distinct().join(nodes, "node_id").groupBy("way_id").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count("*").alias("refs"))
