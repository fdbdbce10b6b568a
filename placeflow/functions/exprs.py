"""Column expressions of the place corpus: cleaning, coordinates, boxes, fingerprints, paths."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRID_DEGREES = 5
EARTH_METRES = 6_371_008.8


def clean(c: Column) -> Column:
    """Trimmed text, '' for null."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def norm_codes(codes: Column) -> Column:
    """ISO codes trimmed, upper-cased, without blanks, each once at its first place; [] for null."""
    tidy = F.transform(F.coalesce(codes, F.expr("cast(array() as array<string>)")), lambda x: F.upper(clean(x)))
    return F.array_distinct(F.filter(tidy, lambda x: x != ""))


def job_key(job: Column, updated: Column) -> Column:
    return F.concat_ws(":", job.cast("string"), F.coalesce(updated, F.lit(0)).cast("string"))


def number(c: Column) -> Column:
    """A double, null where the text isn't a number."""
    return c.try_cast("double")


def valid_coord(lat: Column, lon: Column) -> Column:
    inside = lat.between(-90, 90) & lon.between(-180, 180) & ~F.isnan(lat) & ~F.isnan(lon)
    return F.coalesce(inside, F.lit(False))


def grid_row(lat: Column, degrees: int = GRID_DEGREES) -> Column:
    return F.greatest(F.least(F.floor((lat + 90) / degrees), F.lit(180 // degrees - 1)), F.lit(0)).cast("int")


def grid_column(lon: Column, degrees: int = GRID_DEGREES) -> Column:
    return F.greatest(F.least(F.floor((lon + 180) / degrees), F.lit(360 // degrees - 1)), F.lit(0)).cast("int")


def grid_cell(lat: Column, lon: Column, degrees: int = GRID_DEGREES) -> Column:
    """Number of the cell that a coordinate lies in; borders at 90 and 180 belong to the last cells."""
    return (grid_row(lat, degrees) * (360 // degrees) + grid_column(lon, degrees)).cast("int")


def bbox_cells(min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column, degrees: int = GRID_DEGREES) -> Column:
    """Distinct cells that a box touches; a box with min_lon > max_lon goes over the antimeridian."""
    across = 360 // degrees
    a, b = grid_column(min_lon, degrees), grid_column(max_lon, degrees)
    columns = F.when(min_lon <= max_lon, F.sequence(a, b)).otherwise(F.array_distinct(F.concat(F.sequence(a, F.lit(across - 1)), F.sequence(F.lit(0), b))))
    rows = F.sequence(grid_row(min_lat, degrees), grid_row(max_lat, degrees))
    return F.flatten(F.transform(rows, lambda r: F.transform(columns, lambda c: (r * across + c).cast("int"))))


def bbox_contains(lat: Column, lon: Column, min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column) -> Column:
    inside = F.when(min_lon <= max_lon, lon.between(min_lon, max_lon)).otherwise((lon >= min_lon) | (lon <= max_lon))
    return lat.between(min_lat, max_lat) & inside


def normalize_lon(lon: Column) -> Column:
    """Longitude in [-180, 180), without a negative zero."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0 + 0.0


def round_coord(c: Column) -> Column:
    """To a millionth of a degree, halves upward."""
    return F.floor(c * 1e6 + 0.5) / 1e6


def lon_intervals(min_lon: Column, max_lon: Column) -> Column:
    """One interval, or two for a box over the antimeridian."""
    pair = lambda a, b: F.struct(a.cast("double").alias("lo"), b.cast("double").alias("hi"))
    return F.when(min_lon <= max_lon, F.array(pair(min_lon, max_lon))).otherwise(F.array(pair(min_lon, F.lit(180.0)), pair(F.lit(-180.0), max_lon)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def bbox_area(min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column) -> Column:
    """In square degrees."""
    return F.greatest(max_lat - min_lat, F.lit(0.0)) * _sum(F.transform(lon_intervals(min_lon, max_lon), lambda i: i["hi"] - i["lo"]))


def bbox_intersection_area(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Of two boxes given as (min_lat, min_lon, max_lat, max_lon)."""
    high = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    wide = F.flatten(F.transform(lon_intervals(a[1], a[3]), lambda i: F.transform(lon_intervals(b[1], b[3]), lambda j: F.greatest(F.least(i["hi"], j["hi"]) - F.greatest(i["lo"], j["lo"]), F.lit(0.0)))))
    return high * _sum(wide)


def widened_intervals(min_lon: Column, max_lon: Column, margin: float) -> Column:
    """The box's longitude intervals, wider by a margin at both ends and kept within -180 and 180."""
    return F.transform(lon_intervals(min_lon, max_lon), lambda i: F.struct(F.greatest(i["lo"] - margin, F.lit(-180.0)).alias("lo"), F.least(i["hi"] + margin, F.lit(180.0)).alias("hi")))


def expand_bbox(min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column, margin: float) -> Column:
    """The box wider by a margin on all sides: latitudes clamped, longitudes wrapped; all longitudes once none is left out."""
    width = F.when(min_lon <= max_lon, max_lon - min_lon).otherwise(max_lon - min_lon + 360)
    whole = width + 2 * margin >= 360
    return F.struct(
        F.greatest(min_lat - margin, F.lit(-90.0)).alias("min_lat"),
        F.when(whole, F.lit(-180.0)).otherwise(normalize_lon(min_lon - margin)).alias("min_lon"),
        F.least(max_lat + margin, F.lit(90.0)).alias("max_lat"),
        F.when(whole, F.lit(180.0)).otherwise(normalize_lon(max_lon + margin)).alias("max_lon"),
    )


def qualify_subdivision(country: Column, state: Column) -> Column:
    """CA and QC give CA-QC; a state that has a hyphen stays."""
    c, s = F.upper(clean(country)), F.upper(clean(state))
    return F.when(s.contains("-"), s).otherwise(F.concat_ws("-", c, s))


def _sorted(fields: dict) -> Column:
    return F.struct(*((_sorted(v) if isinstance(v, dict) else v).alias(k) for k, v in sorted(fields.items())))


def fingerprint(**fields: Column | dict) -> Column:
    """SHA-256 of the fields as JSON with sorted names, also within fields given as dicts; nulls stay out. For columns that hold structs, maps or VARIANT: nested_fingerprint()."""
    return F.sha2(F.to_json(_sorted(fields)), 256)


def canonical(c: Column, kind: T.DataType) -> Column:
    """A value of any nested type as JSON text in one form: names of structs and keys of maps sorted at every depth, fields and values that are null left out, arrays in their order (with null for null). Null for null.

    The columns are rewritten by their type when the plan is made; VARIANT keeps its names sorted, so its text is the same form, but for nulls, which it states.
    """
    if isinstance(kind, T.StructType):
        named = [(f.name, canonical(c.getField(f.name), f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        return _object(c, F.array(*(F.concat(F.lit(json.dumps(n, ensure_ascii=False) + ":"), v) for n, v in named)) if named else F.array().cast("array<string>"))
    if isinstance(kind, T.MapType):
        names = F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("k"), e["value"].alias("v"))), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
        return _object(c, F.transform(names, lambda e: F.concat(_scalar(e["k"]), F.lit(":"), canonical(e["v"], kind.valueType))))
    if isinstance(kind, T.ArrayType):
        return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: F.coalesce(canonical(x, kind.elementType), F.lit("null"))), ","), F.lit("]")))
    if isinstance(kind, T.VariantType):
        return F.to_json(c)
    return F.when(c.isNotNull(), _scalar(c))


def _object(c: Column, entries: Column) -> Column:
    return F.when(c.isNotNull(), F.concat(F.lit("{"), F.array_join(F.array_compact(entries), ","), F.lit("}")))


def _scalar(c: Column) -> Column:
    """A value as JSON text: that of an array of it, without the brackets."""
    whole = F.to_json(F.array(c))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def nested_fingerprint(df: DataFrame, *columns: str) -> Column:
    """SHA-256 of columns of df (all, without names) in canonical form: equal for equal values whatever the order of fields and keys, and whether they are structs or maps."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    named = [(n, canonical(F.col(f"`{n}`"), kinds[n])) for n in sorted(columns or kinds)]
    return F.sha2(_object(F.lit(True), F.array(*(F.concat(F.lit(json.dumps(n, ensure_ascii=False) + ":"), v) for n, v in named))), 256)


def sum_digest(row: Column) -> Column:
    """An aggregate: a hash of all rows' texts whatever their order, combined in every task before any shuffle. Put a row's place in its text where order counts."""
    one = F.sha2(row, 256)
    part = lambda k: F.conv(F.substring(one, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.sum(part(k)), F.lit(0)).cast("decimal(38,0)").cast("string") for k in range(4))), 256)


def content_fingerprint(identity: Column, schema: Column, enrichment: Column) -> Column:
    return F.concat_ws(":", F.coalesce(identity, F.lit("?")), F.coalesce(schema, F.lit(0)).cast("string"), F.coalesce(enrichment, F.lit("")))


def shard_fingerprint(content: Column, builder: Column) -> Column:
    return F.concat_ws(":", content, F.coalesce(builder, F.lit("?")))


def road_source_fingerprint(schema: Column, fmt: Column, identity: Column, profile: Column, turn_costs: Column, neighbors: Column, version: Column) -> Column:
    return fingerprint(schema=schema, format=fmt, source=identity, profile=profile, turn_costs=turn_costs, neighbors=F.array_sort(neighbors), version=version)


def road_index_fingerprint(schema: Column, fmt: Column, source: Column, version: Column, options: Column) -> Column:
    return fingerprint(schema=schema, format=fmt, source=source, version=version, options=options)


def road_partitions(size: Column, target: int = 512 << 20, most: int = 8) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(size / target))).cast("int")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column) -> Column:
    """'' for a path without a folder."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def safe_path(path: Column) -> Column:
    """The path without ./ parts and doubled slashes; null for an absolute or upward path, and where nothing is left (empty, `.`, `./`).

    A chain in which each step names the one before once: paths are joined from joined paths, and a step that named its
    input n times would be evaluated n times for each of them.
    """
    # A ./ in front goes first: what then starts with a slash is absolute.
    plain = F.coalesce(path.cast("string"), F.lit(""))
    for pattern, to in ((r"\A\./", ""), ("/+", "/"), (r"(?<![^/])\./", ""), (r"(?<![^/])\.\z", "")):
        plain = F.regexp_replace(plain, pattern, to)
    return F.get(F.regexp_extract_all(plain, F.lit(r"(?s)\A(?!/)(?!(?:.*/)?\.\.(?:/|\z)).+\z"), F.lit(0)), 0)


def _below(folder: Column, path: Column) -> Column:
    return safe_path(F.concat(F.regexp_replace(F.concat(folder, F.lit("/")), r"\A\.?/\z", ""), safe_path(path)))


def path_join(base: Column, path: Column) -> Column:
    """A safe path below a folder ('' or '.': the root); null if either is unsafe."""
    return _below(F.coalesce(base, F.lit("")), path)


def generation_manifest_path(base: Column, path: Column, manifest: Column) -> Column:
    """A generation's manifest (manifest.min.json if none is named), declared from the shard's folder or from the generation's own path; null if either is unsafe."""
    own, declared = F.coalesce(path, F.lit("")), F.coalesce(F.nullif(manifest, F.lit("")), F.lit("manifest.min.json"))
    from_shard = F.when(safe_path(own).isNotNull(), F.coalesce(base, F.lit("")))
    return _below(F.when((own != "") & declared.startswith(own), from_shard).when(own == "", base).otherwise(path_join(base, own)), declared)


def join_path(folder: Column, path: Column) -> Column:
    """A path below a folder of one's own, with single slashes and no leading ./."""
    whole = F.concat_ws("/", F.nullif(folder, F.lit("")), path)
    return F.regexp_replace(F.regexp_replace(whole, "/(?:\\./|/)+", "/"), r"^(?:\./)+", "")


def pct(n: Column, d: Column) -> Column:
    """Percent with one decimal, 0 of 0 is 0."""
    return F.when(d > 0, F.floor(n / d * 1000 + 0.5) / 10).otherwise(F.lit(0.0))


def http_date(c: Column) -> Column:
    """Timestamp of an HTTP date such as 'Sun, 06 Nov 1994 08:49:37 GMT', null if invalid."""
    return F.try_to_timestamp(F.substring(c, 6, 40), F.lit("dd MMM yyyy HH:mm:ss z"))


def source_metadata(**fields: Column) -> Column:
    """Attribution of a source as JSON with the fields that are present."""
    return F.to_json(F.struct(*(F.when(clean(v) != "", clean(v)).alias(k) for k, v in sorted(fields.items()))))


def publish_rank(path: Column) -> Column:
    """Of paths below a shard's folder. 0: build scratch, not published; 1: content; 2: manifests that others depend on; 3: the root manifests."""
    root = path.isin("manifest.json", "manifest.min.json", "manifest.full.json")
    return F.when(path.startswith("_build/"), 0).when(root, 3).when(basename(path).rlike(r"^manifest.*\.json$"), 2).otherwise(1)


def is_immutable(path: Column) -> Column:
    return path.rlike(r"\.bin(\.gz)?$")


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a sphere; null if any coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_METRES * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))


def tile(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """Web-mercator tile column and row."""
    n = 1 << zoom
    edge = lambda c: F.greatest(F.least(F.floor(c * n), F.lit(n - 1)), F.lit(0)).cast("long")
    r = F.radians(F.greatest(F.least(lat, F.lit(85.0511)), F.lit(-85.0511)))
    return edge((lon + 180) / 360), edge((1 - F.log(F.tan(r) + 1 / F.cos(r)) / 3.141592653589793) / 2)


def tokens(text: Column) -> Column:
    """Runs of letters and digits of all scripts, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
