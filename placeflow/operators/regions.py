"""Region sets: hierarchy, expansion by size, names, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.scratch import save


def coverage_conflicts(regions: DataFrame, exempt: tuple[str, ...] = ()) -> DataFrame:
    """(code, owners): country codes that more than one region lists. regions: region_id, codes."""
    each = regions.select("region_id", F.explode(X.norm_codes(F.col("codes"))).alias("code")).where(~F.col("code").isin(*exempt) if exempt else F.lit(True))
    return each.groupBy("code").agg(F.array_sort(F.collect_set("region_id")).alias("owners")).where(F.size("owners") > 1)


def region_ancestors(features: DataFrame) -> DataFrame:
    """(id, ancestor, depth): by parent pointers, level after level until none is left; a circle of parents fails the job. features: id, parent."""
    up = features.select(F.col("id").alias("ancestor"), F.col("parent").alias("next"))
    level = features.where("parent is not null").select("id", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    out, depth = level, 1
    while True:
        depth += 1
        level = save(level.join(up, "ancestor").where("next is not null").select("id", F.col("next").alias("ancestor"), F.lit(depth).alias("depth")), "ancestors")
        n, circles = level.agg(F.count("*"), F.count_if(F.col("id") == F.col("ancestor"))).first()
        if circles:
            raise ValueError("parents of regions run in a circle")
        if not n:
            break
        out = out.unionByName(level)
    return out.groupBy("id", "ancestor").agg(F.min("depth").alias("depth"))


def inherited_codes(features: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Own codes, or those of the nearest ancestor that has some. features: id, codes."""
    coded = features.where(F.size("codes") > 0).select(F.col("id").alias("ancestor"), "codes")
    near = ancestors.join(coded, "ancestor").groupBy("id").agg(F.min_by("codes", "depth").alias("inherited"))
    return features.select("id", "codes").join(near, "id", "left").select("id", F.when(F.size("codes") > 0, F.col("codes")).otherwise(F.coalesce("inherited", "codes")).alias("codes"))


def prefix_ancestors(features: DataFrame) -> DataFrame:
    """(id, ancestor): all paths above an id, whatever its parent."""
    parts = F.split("id", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return features.where(F.size(parts) > 1).select("id", F.explode(above).alias("ancestor"))


def united_codes(features: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(id, codes): own codes and those of all ancestors by pointer and by path, each once, in order. features: id, codes."""
    every = ancestors.select("id", "ancestor").union(prefix_ancestors(features)).union(features.select("id", F.col("id").alias("ancestor"))).distinct()
    each = every.join(features.select(F.col("id").alias("ancestor"), F.explode("codes").alias("code")), "ancestor")
    found = each.groupBy("id").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return features.select("id").join(found, "id", "left").select("id", F.coalesce("codes", F.expr("cast(array() as array<string>)")).alias("codes"))


def region_groups(features: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(id, groups): labels of a region's groups: the first part of a longer path, then the last parts of its ancestors by pointer from the nearest, each once."""
    chain = ancestors.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "ancestor"))), lambda a: X.basename(a["ancestor"])).alias("chain"))
    none = F.expr("cast(array() as array<string>)")
    first = F.when(F.col("id").contains("/"), F.array(F.split("id", "/")[0])).otherwise(none)
    return features.select("id").join(chain, "id", "left").select("id", F.array_distinct(F.concat(first, F.coalesce("chain", none))).alias("groups"))


def region_children(features: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """(parent, id): by pointer, or by an id anywhere below the parent's path; each pair once, without excluded ids."""
    pointed = features.where("parent is not null").select("parent", "id")
    below = prefix_ancestors(features).select(F.col("ancestor").alias("parent"), "id").join(features.select(F.col("id").alias("parent")), "parent", "left_semi")
    out = pointed.union(below).distinct()
    return out if exclude is None else out.join(exclude.select("id"), "id", "left_anti").select("parent", "id")


def expand_regions(selected: DataFrame, sizes: DataFrame, children: DataFrame, most: int, rounds: int = 3) -> DataFrame:
    """Ids after replacing, at most `rounds` times, each region larger than `most` that has children by these."""
    now = selected.select("id").distinct()
    large = sizes.where(F.col("size") > most).select("id").join(children.select(F.col("parent").alias("id")), "id", "left_semi")
    for _ in range(rounds):
        out = now.join(large, "id", "left_semi").select(F.col("id").alias("parent")).join(children, "parent").select("id")
        now = save(now.join(large, "id", "left_anti").union(out).distinct(), "expanded")
    return now


def short_region_id(features: DataFrame) -> DataFrame:
    """(id, short_id): the last part of the path, or the whole path with '-' where that part isn't unique. Two regions that still come to one short id fail the job."""
    last = X.basename(F.col("id"))
    n, again = F.count("*").over(W.partitionBy("last")), F.count("*").over(W.partitionBy("short_id"))
    named = features.select("id", last.alias("last")).select("id", F.when(n > 1, F.replace("id", F.lit("/"), F.lit("-"))).otherwise(F.col("last")).alias("short_id"))
    return named.select("id", F.when(again > 1, F.raise_error(F.concat(F.lit("duplicate region id: "), F.col("short_id"))).cast("string")).otherwise(F.col("short_id")).alias("short_id"))


def refresh_coverage(regions: DataFrame, features: DataFrame) -> DataFrame:
    """regions with box and codes of the feature of the same path; a region without feature or box fails the job. features: path, codes and a box."""
    new = features.select("path", F.col("codes").alias("new_codes"), *(F.col(c).alias(f"new_{c}") for c in ("min_lat", "min_lon", "max_lat", "max_lon")))
    joined = regions.join(new, "path", "left")
    checked = F.when(F.col("new_min_lat").isNull(), F.raise_error(F.concat(F.lit("no coverage for "), F.col("region_id"))).cast("double")).otherwise(F.col("new_min_lat"))
    return joined.select("region_id", "path", checked.alias("min_lat"), *(F.col(f"new_{c}").alias(c) for c in ("min_lon", "max_lat", "max_lon")), X.norm_codes(F.col("new_codes")).alias("codes"))
