"""Status of a run and the published root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.functions import exprs as X


def status_snapshot(state: DataFrame, roads: DataFrame, run: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """One row. state: region_id, acquired, built, has_manifest, uploaded, docs, modified; roads: built, has_manifest, uploaded; run: one row, status.

    What is built has a manifest; an upload counts if it is of what is built; only a failed run makes the phase failed.
    published: the root as it was published, one row (region_ids, shards, documents; each may be null) or none. What it
    states holds for published, documents and, by its regions, data_time; without it these come from the uploads.
    """
    root = state.sparkSession.createDataFrame([(None, None, None)], "region_ids array<string>, shards long, documents long")
    if published is not None:
        given = published.agg(F.first("region_ids").alias("region_ids"), F.first("shards").alias("shards"), F.first("documents").alias("root_documents"))
    else:
        given = root.withColumnRenamed("documents", "root_documents")
    is_built = F.coalesce((F.col("built") != "") & F.col("has_manifest"), F.lit(False))
    is_up = is_built & F.col("uploaded").eqNullSafe(F.col("built"))
    # One row of configuration beside every region.
    with_root = state.join(F.broadcast(given))
    shown = F.coalesce(F.array_contains("region_ids", F.col("region_id")), is_up)
    a = with_root.agg(
        F.count("*").alias("regions"), F.count_if("acquired").alias("acquired"), F.count_if(is_built).alias("built"),
        F.coalesce(F.max("shards"), F.max(F.size("region_ids")).cast("long"), F.count_if(is_up)).alias("published"),
        F.coalesce(F.max("root_documents"), F.sum(F.when(is_up, F.col("docs"))), F.lit(0)).alias("documents"), F.max(F.when(shown, F.col("modified"))).alias("data_time"),
    )
    there = F.coalesce("has_manifest", F.lit(False))
    r = roads.agg(F.count_if(is_built).alias("road_built"), F.count_if(there & F.col("uploaded").eqNullSafe(F.col("built"))).alias("road_uploaded"), F.count_if(F.coalesce(F.col("built") != "", F.lit(False)) & ~there).alias("road_unavailable"))
    phase = F.when(F.col("status") == "failed", "failed").when(F.col("acquired") < F.col("regions"), "acquiring").when(F.col("built") < F.col("regions"), "building").when(F.col("published") < F.col("regions"), "publishing").otherwise("ready")
    both = a.join(r).join(run.select("status"))
    return both.select("*", phase.alias("phase"), *(X.pct(F.col(c), F.col("regions")).alias(f"{c}_percent") for c in ("acquired", "published")))


def next_pending(state: DataFrame, k: int = 10) -> DataFrame:
    """The first k regions not acquired, in configuration order (ord)."""
    return state.where(~F.col("acquired")).orderBy("ord").limit(k).select("ord", "region_id")


def next_pending_roads(rows: DataFrame, k: int = 10) -> DataFrame:
    """The first k pairs of region and profile without a road index, in configuration order (ord, profile_ord)."""
    return rows.where(F.coalesce("built", F.lit("")) == "").orderBy("ord", "profile_ord").limit(k).select("ord", "region_id", "profile")


def root_summary(built: DataFrame, stats: DataFrame) -> DataFrame:
    """(region_id, path, groups, bbox, docs, total): the configured box, else that of the documents; total: documents of all regions, the same in each row."""
    rows = built.join(stats, "region_id", "left").withColumn("docs", F.coalesce("docs", F.lit(0)))
    groups = F.col("groups") if "groups" in built.columns else F.expr("cast(array() as array<string>)")
    out = rows.select("region_id", F.concat(F.lit("shards/"), "region_id", F.lit("/")).alias("path"), groups.alias("groups"), F.coalesce("bbox", "doc_bbox").alias("bbox"), "docs")
    return out.join(rows.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("total")))
