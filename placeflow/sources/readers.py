"""Readers of addresses, corpora, regions, catalogs, listings and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.operators.delta import line_id
from placeflow.sources.versions import qualified

ADDRESS = "id string, kind string, house_number string, street string, unit string, city string, district string, state string, postcode string, country string, lat double, lon double, url string"
FIELDS = [f.split()[0] for f in ADDRESS.split(", ")]
GEOJSON = "type string, properties struct<hash:string,id:string,number:string,street:string,unit:string,city:string,district:string,region:string,postcode:string>, geometry struct<type:string,coordinates:array<double>>"


def read_delimited_addresses(spark: SparkSession, path: str, mapping: dict[str, int | str], sep: str = ",", header: bool = False, defaults: dict[str, str] | None = None) -> DataFrame:
    """Canonical addresses of a delimited file. mapping: field to column number (from 0) or name; defaults stand in for blank or absent fields."""
    rows = spark.read.csv(path, sep=sep, header=header)
    defaults = defaults or {}

    def field(name: str):
        at = mapping.get(name)
        value = F.lit(None).cast("string") if at is None else F.col(f"`{rows.columns[at] if isinstance(at, int) else at}`")
        value = F.coalesce(F.nullif(X.clean(value), F.lit("")), F.lit(defaults.get(name)))
        return (X.number(value) if name in ("lat", "lon") else value).alias(name)

    return rows.select(*map(field, FIELDS))


def read_geojson_addresses(spark: SparkSession, path: str, source: str, layer: str, name: str, root: str = "sources") -> DataFrame:
    """Canonical addresses of newline GeoJSON points of one job; malformed JSON fails, other geometries and short coordinates are dropped."""
    rows = spark.read.schema(GEOJSON).option("mode", "FAILFAST").json(path)
    points = rows.where((F.col("geometry.type") == "Point") & (F.size("geometry.coordinates") >= 2))
    p = lambda c: F.nullif(X.clean(F.col(f"properties.{c}")), F.lit(""))
    part = lambda c: F.nullif(X.clean(c), F.lit(""))
    ident = F.concat_ws("/", part(F.lit(source)), part(F.lit(layer)), part(F.lit(name)), F.coalesce(p("hash"), p("id")))
    url = F.concat(F.lit(f"{root}/"), F.array_join(F.transform(F.split(F.lit(source), "/"), lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))), "/"), F.lit(".json"))
    country = F.upper(F.split(F.lit(source), "/")[0])
    return points.select(
        ident.alias("id"), F.lit("address").alias("kind"), p("number").alias("house_number"), p("street").alias("street"), p("unit").alias("unit"), p("city").alias("city"), p("district").alias("district"),
        p("region").alias("state"), p("postcode").alias("postcode"), country.alias("country"), F.col("geometry.coordinates")[1].alias("lat"), F.col("geometry.coordinates")[0].alias("lon"), url.alias("url"),
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(seq, doc_id, raw) of JSON lines, plain or gzip. seq (file, part, line) follows the order of file names and of lines, whatever order tasks read files in."""
    lines = spark.read.text(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"))
    return lines.select(F.struct("file", "part", F.monotonically_increasing_id().alias("line")).alias("seq"), line_id(F.col("value")).alias("doc_id"), F.col("value").alias("raw"))


def read_regions(spark: SparkSession, path: str, ids: list[str] | None = None) -> DataFrame:
    """Regions of a JSON array, each box checked: four numbers, latitudes in order and in range, longitudes in range. The id falls back to the last part of the path."""
    rows = spark.read.schema("id string, path string, groups array<string>, bbox array<double>, countryCodes array<string>, subdivisionCodes array<string>, roadIndexes boolean").json(path, multiLine=True)
    b = F.col("bbox")
    whole = (F.size(b) == 4) & F.forall(b, lambda x: x.isNotNull() & ~F.isnan(x)) & b[0].between(-90, 90) & b[2].between(-90, 90) & (b[0] <= b[2]) & b[1].between(-180, 180) & b[3].between(-180, 180)
    at = lambda i: F.when(b.isNotNull() & ~F.coalesce(whole, F.lit(False)), F.raise_error(F.concat(F.lit("invalid box of region "), F.coalesce("id", "path"))).cast("double")).otherwise(F.get(b, F.lit(i)))
    out = rows.select(
        F.coalesce("id", X.basename(F.col("path"))).alias("region_id"), "path", F.coalesce("groups", F.array().cast("array<string>")).alias("groups"),
        at(0).alias("min_lat"), at(1).alias("min_lon"), at(2).alias("max_lat"), at(3).alias("max_lon"),
        X.norm_codes(F.col("countryCodes")).alias("country_codes"), X.norm_codes(F.col("subdivisionCodes")).alias("subdivision_codes"), F.coalesce("roadIndexes", F.lit(True)).alias("road_indexes"),
    )
    return out.where(F.col("region_id").isin(ids)) if ids else out


def read_region_features(spark: SparkSession, path: str) -> DataFrame:
    """(id, parent, name, codes, geometry VARIANT) of a feature collection."""
    schema = "features array<struct<properties:struct<id:string,parent:string,name:string,`iso3166-1:alpha2`:array<string>,`iso3166-2`:array<string>>,geometry:variant>>"
    f = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return f.select("f.properties.id", "f.properties.parent", "f.properties.name", X.norm_codes(F.col("f.properties.`iso3166-1:alpha2`")).alias("codes"), "f.geometry")


def _files(spark: SparkSession, root: str, names: str | None) -> DataFrame:
    """Files below a root, with their paths relative to it, as protections and candidates name them."""
    base = qualified(spark, root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (files.option("pathGlobFilter", names) if names else files).load(root)
    return files.withColumn("path", F.substring("path", len(base) + 2, 1 << 30))


def read_object_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path below the root, size, modified) of all files; contents aren't read."""
    return _files(spark, root, None).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_manifests(spark: SparkSession, root: str, names: str = "*.json") -> DataFrame:
    """(doc, base, body VARIANT): a row for each JSON document whose name matches; doc and base (its folder) are paths below the root, as in the listing. A document that isn't JSON fails the job."""
    files = _files(spark, root, names).select(F.col("path").alias("doc"), F.col("content").cast("string").alias("value"))
    return files.select("doc", X.dirname(F.col("doc")).alias("base"), F.parse_json("value").alias("body"))
