"""Identities of ordered lists, as one hash for each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.functions import exprs as X


def list_identity(rows: DataFrame, group: list[str], order: list[str], value: Column, name: str = "identity") -> DataFrame:
    """A hash of each group's values and their places (order), combined in every task, so that no list is gathered."""
    return rows.groupBy(*group).agg(X.sum_digest(F.concat_ws(";", *order, value)).alias(name))


def routing_fingerprint(regions: DataFrame, schema: int) -> DataFrame:
    """One row: regions (region_id, content) and the schema of the routing tables; equal means they can be used again."""
    return list_identity(regions, [], ["region_id"], F.concat_ws("=", "region_id", "content")).select(F.sha2(F.concat(F.lit(f"{schema}:"), "identity"), 256).alias("fingerprint"))


def partition_identity(source: str, schema: int, regions: DataFrame) -> DataFrame:
    """One row: schema, source and the regions' boxes and codes."""
    row = F.concat_ws("|", "region_id", *(F.col(c).cast("string") for c in ("min_lat", "min_lon", "max_lat", "max_lon")), "country_code", "subdivision_code")
    return list_identity(regions, [], ["region_id"], row).select(F.sha2(F.concat(F.lit(f"{schema}:{source}:"), "identity"), 256).alias("identity"))


def reusable_partitions(prior: DataFrame, now: DataFrame, listing: DataFrame) -> DataFrame:
    """(source_id, reusable): whether a source's partitions can be used again: their identity is today's and the output of every region that isn't empty exists.

    prior: source_id, identity, path, n, a row for each region written; now: source_id, identity; listing: path.
    """
    lost = prior.where(F.coalesce("n", F.lit(0)) > 0).join(listing.select("path"), "path", "left_anti").groupBy("source_id").agg(F.lit(True).alias("lost"))
    before = prior.groupBy("source_id").agg(F.max("identity").alias("before"))
    both = now.select("source_id", "identity").join(before, "source_id", "left").join(lost, "source_id", "left")
    return both.select("source_id", (F.coalesce(F.col("before") == F.col("identity"), F.lit(False)) & F.col("lost").isNull()).alias("reusable"))


def region_source_identity(sources: DataFrame) -> DataFrame:
    """(region_id, identity) of (region_id, ord, source_id, identity) lists in configured order."""
    return list_identity(sources, ["region_id"], ["ord"], F.concat_ws("=", "source_id", "identity"))
