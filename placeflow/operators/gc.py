"""Garbage: which stored objects nothing refers to, and since when."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.operators.search import few


def stale_objects(listing: DataFrame, keep: DataFrame) -> DataFrame:
    return listing.join(keep.select("path"), "path", "left_anti")


def protected_objects(objects: DataFrame, protections: DataFrame) -> DataFrame:
    """Objects (path, ...) that a protection (kind path, basename or prefix; value) holds. A prefix ends with '/', so a path's folders find it by equality.

    Only folders at the depths that prefixes have are looked up. Protections are sent to the objects if there are few; else a join on them may split its keys, since it
    keeps objects only.
    """
    of = lambda kind: few(protections.where(F.col("kind") == kind).select("value").distinct())
    parts = F.split("path", "/")
    # A number for each depth, however many prefixes there are.
    depths = [r.n for r in protections.where("kind = 'prefix'").select((F.size(F.split("value", "/")) - 1).alias("n")).distinct().collect()]
    folders = F.transform(F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda n: n < F.size(parts)), lambda n: F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/")))
    by_path = objects.join(of("path"), F.col("path") == F.col("value"), "left_semi").select("path")
    by_name = objects.join(of("basename"), X.basename(F.col("path")) == F.col("value"), "left_semi").select("path")
    by_folder = objects.select("path", F.explode(folders).alias("folder")).join(of("prefix"), F.col("folder") == F.col("value"), "left_semi").select("path")
    return by_path.union(by_name).union(by_folder).distinct()


def _candidates(unused: DataFrame, previous: DataFrame, now: Column, grace_days: float) -> DataFrame:
    """Unused objects with the time they were first seen so and whether the grace period is over; an unreadable time counts as now."""
    before = previous.select("path", F.try_to_timestamp(F.col("first_seen")).alias("before"), F.col("first_seen").isNotNull().alias("was"))
    seen = unused.join(before, "path", "left")
    first = F.coalesce("before", now)
    over = F.coalesce((F.unix_millis(now) - F.unix_millis(F.col("before"))) >= grace_days * 86_400_000, F.lit(False))
    return seen.select("path", "size", first.alias("first_seen"), now.alias("last_seen"), over.alias("eligible"))


def gc_candidates(objects: DataFrame, protections: DataFrame, previous: DataFrame, now: Column, grace_days: float = 7) -> DataFrame:
    """Immutable objects without a protection: path, size, first_seen, last_seen, eligible. Objects referred to again aren't in it."""
    immutable = objects.where(X.is_immutable(F.col("path")))
    return _candidates(immutable.join(protected_objects(immutable, protections), "path", "left_anti"), previous, now, grace_days)


def prune_candidates(objects: DataFrame, protections: DataFrame, previous: DataFrame, now: Column, grace_days: float = 7) -> DataFrame:
    """The same over all objects of a namespace; eligible ones are to be deleted, and only the others stay candidates."""
    return _candidates(objects.join(protected_objects(objects, protections), "path", "left_anti"), previous, now, grace_days)


def gc_summary(objects: DataFrame, protections: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: objects and bytes that are immutable, protected, pending and eligible."""
    immutable = objects.where(X.is_immutable(F.col("path")))
    held = protected_objects(immutable, protections).withColumn("held", F.lit(True))
    all_ = immutable.select("path", "size").join(held, "path", "left").join(candidates.select("path", "eligible"), "path", "left")
    kinds = {"immutable": F.lit(True), "protected": F.col("held"), "pending": ~F.col("eligible"), "eligible": F.col("eligible")}
    return all_.agg(*(c for k, t in kinds.items() for c in (F.count_if(t).alias(f"{k}_objects"), F.coalesce(F.sum(F.when(t, F.col("size"))), F.lit(0)).alias(f"{k}_bytes"))))


def _references():
    """What the JSON documents of a batch refer to: (doc, base, kind, value) of binary files, folders and files beside hot prefixes, at any depth."""

    def positive(n) -> bool:
        try:
            return (int(n, 16) if isinstance(n, str) and n.strip()[:2] in ("0x", "0X") else float(n)) > 0
        except (TypeError, ValueError):
            return False

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc, base, body in zip(*(batch.column(c).to_pylist() for c in ("doc", "base", "body")), strict=True):
                left = [("", json.loads(body))] if body is not None else []
                while left:
                    key, value = left.pop()
                    kind = type(value)
                    if kind is dict:
                        left += value.items()
                        if "hot_prefixes" in value and positive(value["hot_prefixes"]):
                            file = next((f for k in ("directory", "root") if isinstance(d := value.get(k), dict) and (f := d.get("file"))), None)
                            if isinstance(file, str):
                                rows.append((doc, base, "hot", file))
                    elif kind is list:
                        left += [(key, v) for v in value]
                    elif kind is str:
                        if value.endswith((".bin", ".bin.gz")):
                            rows.append((doc, base, "binary", value))
                        elif value.endswith("/") and (key == "pages" or key.endswith("_path")):
                            rows.append((doc, base, "folder", value))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["doc", "base", "kind", "value"])

    return run


def manifest_protections(manifests: DataFrame) -> DataFrame:
    """(kind, value) that manifests (doc: their path, base: its folder, body VARIANT) refer to, themselves included: binary files by name and, with a folder, by path; folders of pages and of keys ending in _path; hot prefixes beside the directory file, else the root file, of an object.

    JSON nests without a bound, so documents are walked in the tasks that read them; rules on paths are column expressions.
    """
    read = manifests.select(F.col("doc").cast("string"), F.col("base").cast("string"), F.to_json("body").alias("body"))
    refs = read.mapInArrow(_references(), "doc string, base string, kind string, value string")
    # Each reference is joined to its base once, whatever it becomes.
    refs = refs.select("kind", "value", X.path_join(F.col("base"), F.col("value")).alias("inside"))
    inside = F.col("inside")
    folder = F.concat(F.regexp_replace(inside, "/$", ""), F.lit("/"))
    above = X.dirname(inside)
    hot = F.concat(F.when(above == "", "").otherwise(F.concat(above, F.lit("/"))), F.lit("hot/"))
    kind = F.col("kind")
    found = F.array(
        F.when(kind == "binary", F.struct(F.lit("basename").alias("kind"), X.basename(F.col("value")).alias("value"))),
        F.when((kind == "binary") & F.col("value").contains("/"), F.struct(F.lit("path").alias("kind"), inside.alias("value"))),
        F.when(kind == "folder", F.struct(F.lit("prefix").alias("kind"), folder.alias("value"))),
        F.when(kind == "hot", F.struct(F.lit("prefix").alias("kind"), hot.alias("value"))),
    )
    own = manifests.select(F.lit("path").alias("kind"), F.col("doc").cast("string").alias("value"))
    return refs.select(F.inline(found)).unionByName(own).where("value is not null").distinct()


def catalog_protections(catalog: DataFrame, path: str = "routes/catalog.json") -> DataFrame:
    """The road catalog's own path, and prefixes of its bases (base), those below routes/ that are safe."""
    base = X.safe_path(F.col("base"))
    live = catalog.where(base.startswith("routes/") & (base != "routes/catalog.json")).select(F.lit("prefix").alias("kind"), F.concat(F.regexp_replace(base, "/$", ""), F.lit("/")).alias("value"))
    own = catalog.sparkSession.createDataFrame([("path", path)], "kind string, value string")
    return live.distinct().union(own)


#: Names of a shard's root manifests.
ROOT_MANIFESTS = ("manifest.json", "manifest.min.json", "manifest.full.json")


def shard_keep_paths(shards: DataFrame) -> DataFrame:
    """Paths that a later delta needs of shards (base, id_map, generations array of (path, manifest, id_map)): root manifests, each generation's manifest under both names, id maps."""
    file = lambda folder, name: F.when(F.coalesce(name, F.lit("")) != "", X.join_path(folder, name))
    none = F.lit(None).cast("string")

    def of(g):
        full = F.when(g["manifest"].endswith(".min.json"), F.regexp_replace(g["manifest"], r"\.min\.json$", ".json")).otherwise(g["manifest"])
        return F.array(file(none, g["manifest"]), file(none, full), X.join_path(g["path"], F.lit("manifest.json")), X.join_path(g["path"], F.lit("manifest.min.json")), file(g["path"], g["id_map"]))

    root = F.array(*map(F.lit, ROOT_MANIFESTS), file(none, F.col("id_map")))
    generations = F.coalesce("generations", F.expr("array()").cast(shards.schema["generations"].dataType))
    kept = F.concat(root, F.flatten(F.transform(generations, of)))
    return shards.select("base", F.explode(F.array_distinct(F.array_compact(kept))).alias("file")).select(X.join_path(F.col("base"), F.col("file")).alias("path")).distinct()


def reconcile_remote(state: DataFrame, listing: DataFrame) -> DataFrame:
    """(region_id, action): keep, upload again (local copy whole) or rebuild, for regions whose manifest should be stored. With a column built, only uploads of what is built count."""
    stored = listing.select("path", F.lit(True).alias("there")).distinct()
    own = state.join(stored, F.col("manifest") == F.col("path"), "left")
    due = F.col("uploaded").isNotNull()
    if "built" in state.columns:
        due = due & F.col("uploaded").eqNullSafe(F.col("built"))
    return own.select("region_id", F.when(~due, "keep").when(F.col("there"), "keep").when(F.col("local_complete"), "upload").otherwise("rebuild").alias("action"))
