"""The engine's queries over the driver's tables, and plain SQL for those that SQL can express on whole tables."""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.operators import delta, enrich, gc, identity, regions, roads, routes, search, spatial, status, views
from placeflow.operators.components import connected_components
from placeflow.plans.bindings import tasks_of_ways, view, way_refs, with_views
from placeflow.scratch import new_path, save
from placeflow.sources import readers, versions, writers
from placeflow.sources.writers import write_region_partitions
from placeflow.sources.producers import record_source
from placeflow.streaming import grace
from placeflow.streaming.partition import latest_counters, ordered_partitions, read_partitions, start_counters_stream, start_partition_stream, stream_counters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def digest_sql(row: str) -> str:
    """An aggregate: the order-free digest of rows' texts."""
    part = lambda k: f"coalesce(sum(('0x' || substr(sha256({row}), {1 + 12 * k}, 12))::UBIGINT), 0)::VARCHAR"
    return f"sha256(concat_ws('|', {', '.join(map(part, range(4)))}))"


# Routing -------------------------------------------------------------------------------------------------------

INSIDE = "p.lat BETWEEN r.min_lat AND r.max_lat AND CASE WHEN r.min_lon <= r.max_lon THEN p.lon BETWEEN r.min_lon AND r.max_lon ELSE p.lon >= r.min_lon OR p.lon <= r.max_lon END"
CAND = with_views("addr_points", "place_regions") + f""",
cand AS (SELECT p.*, upper(trim(p.country)) AS cc, upper(trim(p.state)) AS ss, r.region_id, r.country_code, r.subdivision_code FROM addr_points p JOIN place_regions r ON {INSIDE} WHERE p.lat BETWEEN -90 AND 90 AND p.lon BETWEEN -180 AND 180)"""
ROUTED = CAND + """,
s1 AS (SELECT *, count(*) OVER w AS n, regexp_matches(cc, '^[A-Z][A-Z]$') AS iso, max(CASE WHEN country_code = cc THEN 1 ELSE 0 END) OVER w AS anyc, max(CASE WHEN country_code = '' THEN 1 ELSE 0 END) OVER w AS anyu,
       CASE WHEN regexp_matches(cc, '^[A-Z][A-Z]$') AND ss <> '' AND subdivision_code <> '' AND subdivision_code = CASE WHEN contains(ss, '-') THEN ss ELSE concat(cc, '-', ss) END THEN 1 ELSE 0 END AS sub FROM cand WINDOW w AS (PARTITION BY point_id)),
s2 AS (SELECT * FROM s1 WHERE n < 2 OR NOT iso OR (anyc = 1 AND country_code = cc) OR (anyc = 0 AND (anyu = 0 OR country_code = ''))),
s3 AS (SELECT *, count(*) OVER w AS m, max(sub) OVER w AS anys FROM s2 WINDOW w AS (PARTITION BY point_id)),
routed AS (SELECT point_id, region_id FROM s3 WHERE m < 2 OR anys = 0 OR sub = 1)"""


def _routed(spark, d):
    return spatial.route_points(view(spark, d, "addr_points"), view(spark, d, "place_regions"))


@query(ROUTED + " SELECT r.region_id, count(t.point_id) AS n FROM place_regions r LEFT JOIN routed t USING (region_id) GROUP BY r.region_id")
def route_counts(spark, d):
    return spatial.region_counts(_routed(spark, d), view(spark, d, "place_regions"))


@query(CAND + " SELECT point_id, region_id FROM cand")
def route_candidates(spark, d):
    return spatial.spatial_candidates(view(spark, d, "addr_points"), view(spark, d, "place_regions")).select("point_id", "region_id")


STATS = """ SELECT rows_read, normalized, normalized - matched AS unmatched, writes, writes / greatest(rows_read, 1) AS amplification
FROM (SELECT count(*) AS rows_read, count(*) FILTER (WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) AS normalized FROM addr_points), (SELECT count(DISTINCT point_id) AS matched, count(*) AS writes FROM routed)"""


@query(ROUTED + STATS)
def partition_stats(spark, d):
    return spatial.partition_stats(view(spark, d, "addr_points"), view(spark, d, "place_regions"))


@query(ROUTED + STATS)
def partition_stats_shared_ids(spark, d):
    """The same counters although seven rows share each id: rows are counted, not ids."""
    return spatial.partition_stats(view(spark, d, "addr_points").withColumn("point_id", F.floor(F.col("point_id") / 7)), view(spark, d, "place_regions"))


IV = "SELECT region_id, min_lat, max_lat, min_lon AS lo, CASE WHEN min_lon <= max_lon THEN max_lon ELSE 180 END AS hi FROM place_regions UNION ALL SELECT region_id, min_lat, max_lat, CAST(-180 AS DOUBLE), max_lon FROM place_regions WHERE min_lon > max_lon"


@query(with_views("place_regions") + f""", iv AS ({IV}), area AS (SELECT region_id, sum((max_lat - min_lat) * (hi - lo)) AS a FROM iv GROUP BY region_id),
pr AS (SELECT a.region_id, b.region_id AS neighbor_id, sum(greatest(least(a.max_lat, b.max_lat) - greatest(a.min_lat, b.min_lat), 0) * greatest(least(a.hi, b.hi) - greatest(a.lo, b.lo), 0)) AS shared,
       bool_or(a.min_lat - 0.02::DOUBLE <= b.max_lat AND b.min_lat - 0.02::DOUBLE <= a.max_lat AND greatest(a.lo - 0.02::DOUBLE, -180) <= least(b.hi + 0.02::DOUBLE, 180) AND greatest(b.lo - 0.02::DOUBLE, -180) <= least(a.hi + 0.02::DOUBLE, 180)) AS near
       FROM iv a JOIN iv b ON a.region_id <> b.region_id GROUP BY 1, 2)
SELECT pr.region_id, pr.neighbor_id FROM pr JOIN area x ON x.region_id = pr.region_id JOIN area y ON y.region_id = pr.neighbor_id WHERE near AND shared / least(x.a, y.a) < 0.8 AND pr.region_id NOT IN (SELECT region_id FROM place_regions WHERE k = 7) AND pr.neighbor_id NOT IN (SELECT region_id FROM place_regions WHERE k = 7)""")
def region_neighbors(spark, d):
    return spatial.region_neighbors(view(spark, d, "place_regions").withColumn("road_indexes", F.col("k") != 7)).select("region_id", "neighbor_id")


@query(with_views("addr_points") + """, ok AS (SELECT kind, lat, ((lon + 180) - 360 * floor((lon + 180) / 360)) - 180 AS lon FROM addr_points WHERE lat BETWEEN -90 AND 90),
l AS (SELECT kind, min(lat) AS min_lat, max(lat) AS max_lat FROM ok GROUP BY kind), u AS (SELECT DISTINCT kind, lon FROM ok),
g AS (SELECT kind, lon, coalesce(lead(lon) OVER (PARTITION BY kind ORDER BY lon), min(lon) OVER (PARTITION BY kind) + 360) AS nx FROM u),
b AS (SELECT * FROM (SELECT *, nx - lon AS gap, row_number() OVER (PARTITION BY kind ORDER BY nx - lon DESC, lon) AS r FROM g) WHERE r = 1)
SELECT kind, floor(min_lat * 1e6 + 0.5) / 1e6 AS min_lat, CASE WHEN 360 - gap >= 359.999999 THEN -180 ELSE floor((((nx + 180) - 360 * floor((nx + 180) / 360)) - 180) * 1e6 + 0.5) / 1e6 END AS min_lon,
       floor(max_lat * 1e6 + 0.5) / 1e6 AS max_lat, CASE WHEN 360 - gap >= 359.999999 THEN 180 ELSE floor(lon * 1e6 + 0.5) / 1e6 END AS max_lon FROM l JOIN b USING (kind)""")
def coverage_bbox(spark, d):
    return spatial.coverage_bbox(view(spark, d, "addr_points"), "kind")


# Regions -------------------------------------------------------------------------------------------------------


def _codes(spark, d):
    return view(spark, d, "place_regions").select("region_id", F.array(F.concat(F.lit(" "), F.lower("country_code"), F.lit(" ")), F.col("country_code")).alias("codes"), "subdivision_code")


@query(with_views("place_regions") + " SELECT country_code AS code, string_agg(region_id, ',' ORDER BY region_id) AS owners FROM place_regions WHERE country_code <> '' GROUP BY country_code HAVING count(*) > 1")
def coverage_conflicts(spark, d):
    return regions.coverage_conflicts(_codes(spark, d)).select("code", F.array_join("owners", ",").alias("owners"))


@query(with_views("place_regions") + " SELECT region_id, upper(trim(country_code)) AS codes, CASE WHEN contains(subdivision_code, '-') THEN subdivision_code WHEN subdivision_code = '' THEN country_code || '-' ELSE country_code || '-' || subdivision_code END AS subdivision FROM place_regions")
def region_codes(spark, d):
    r = view(spark, d, "place_regions")
    return r.select("region_id", F.array_join(X.norm_codes(F.array(F.concat(F.lit(" "), F.lower("country_code"), F.lit(" ")), "country_code")), ",").alias("codes"), X.qualify_subdivision(F.col("country_code"), F.col("subdivision_code")).alias("subdivision"))


def _tree(spark, d):
    """Customers and suppliers below nations below regions of the world, as a feature tree of ids and parents."""
    t = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    codes = F.when(F.col("n_nationkey") % 3 == 0, F.array(F.lit("CA"))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    top = t("region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.array(F.lit("XX")).alias("codes"), F.lit(10).alias("size"))
    mid = t("nation").select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), codes, F.lit(5))
    low = t("supplier").select(F.concat(F.lit("s"), "s_suppkey"), F.concat(F.lit("n"), "s_nationkey"), none, F.lit(1)).union(t("customer").select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey"), none, F.lit(1)))
    return top.union(mid).union(low)


TREE = """WITH tree AS (SELECT concat('r', r_regionkey) AS id, NULL AS parent, 10 AS size FROM region UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey), 5 FROM nation
UNION ALL SELECT concat('s', s_suppkey), concat('n', s_nationkey), 1 FROM supplier UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey), 1 FROM customer)"""


@query(TREE + " SELECT id, parent AS ancestor, 1 AS depth FROM tree WHERE parent IS NOT NULL UNION ALL SELECT a.id, b.parent, 2 FROM tree a JOIN tree b ON a.parent = b.id WHERE b.parent IS NOT NULL")
def region_ancestors(spark, d):
    return regions.region_ancestors(save(_tree(spark, d), "tree").select("id", "parent"))


@query(TREE + ", c AS (SELECT n_nationkey % 3 = 0 AS own, concat('n', n_nationkey) AS id FROM nation) SELECT t.id, CASE WHEN t.id[1] = 'r' THEN 'XX' WHEN a.own OR b.own THEN 'CA' ELSE 'XX' END AS codes FROM tree t LEFT JOIN c a ON t.id = a.id LEFT JOIN c b ON t.parent = b.id")
def inherited_codes(spark, d):
    tree = save(_tree(spark, d), "tree")
    return regions.inherited_codes(tree, regions.region_ancestors(tree.select("id", "parent"))).select("id", F.array_join("codes", ",").alias("codes"))


@query("""SELECT concat('r', r_regionkey) AS id, 'XX' AS codes, '' AS groups FROM region
UNION ALL SELECT concat('n', n_nationkey), CASE WHEN n_nationkey % 3 = 0 THEN 'CA,XX' ELSE 'XX' END, concat('r', n_regionkey) FROM nation
UNION ALL SELECT concat('n', n_nationkey, '/s', s_suppkey), concat(CASE WHEN s_suppkey % 5 = 0 THEN 'AA,' ELSE '' END, CASE WHEN n_nationkey % 3 = 0 THEN 'CA,' ELSE '' END, 'XX'), concat('n', n_nationkey, ',r', n_regionkey) FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def region_metadata(spark, d):
    """Codes and groups where suppliers lie below nations by path, but below regions by pointer."""
    t = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    upper = _tree(spark, d).where("size > 1").select("id", "parent", "codes")
    own = F.when(F.col("s_suppkey") % 5 == 0, F.array(F.lit("AA"))).otherwise(F.array().cast("array<string>"))
    low = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("n"), "n_nationkey", F.lit("/s"), "s_suppkey"), F.concat(F.lit("r"), "n_regionkey"), own)
    tree = save(upper.union(low), "tree")
    up = regions.region_ancestors(tree.select("id", "parent"))
    return regions.united_codes(tree, up).join(regions.region_groups(tree, up), "id").select("id", F.array_join("codes", ",").alias("codes"), F.array_join("groups", ",").alias("groups"))


@query("""WITH t AS (SELECT concat('r', r_regionkey) AS id, NULL AS parent FROM region UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey) FROM nation
UNION ALL SELECT concat('n', n_nationkey, '/x/s', s_suppkey), concat('r', n_regionkey) FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT parent, id FROM t WHERE parent IS NOT NULL UNION SELECT p.id, t.id FROM t JOIN t p ON starts_with(t.id, concat(p.id, '/'))""")
def region_children(spark, d):
    """Suppliers by pointer below regions, and by path two levels below nations."""
    t = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    low = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("n"), "n_nationkey", F.lit("/x/s"), "s_suppkey"), F.concat(F.lit("r"), "n_regionkey"))
    return regions.region_children(_tree(spark, d).where("size > 1").select("id", "parent").union(low))


@query(TREE + " SELECT id FROM tree t WHERE size = 1 OR NOT EXISTS (SELECT 1 FROM tree c WHERE c.parent = t.id)")
def expand_regions(spark, d):
    tree = save(_tree(spark, d), "tree")
    return regions.expand_regions(tree.where("parent is null").select("id"), tree.select("id", "size"), regions.region_children(tree), 4)


PATHS = "SELECT concat('x/', r_name, '/', p_brand) AS id FROM part JOIN region ON p_partkey % 5 = r_regionkey"


@query(f"""WITH p AS (SELECT DISTINCT id FROM ({PATHS})), l AS (SELECT id, string_split(id, '/')[-1] AS last FROM p), n AS (SELECT *, count(*) OVER (PARTITION BY last) AS n FROM l)
SELECT id, CASE WHEN n > 1 THEN replace(id, '/', '-') ELSE last END AS short_id FROM n""")
def short_region_ids(spark, d):
    p, r = spark.read.parquet(f"{d}/part.parquet"), spark.read.parquet(f"{d}/region.parquet")
    return regions.short_region_id(p.join(r, F.col("p_partkey") % 5 == F.col("r_regionkey")).select(F.concat(F.lit("x/"), "r_name", F.lit("/"), "p_brand").alias("id")).distinct())


@query(with_views("place_regions") + """, f AS (SELECT n_regionkey, min(min_lat) AS min_lat, min(min_lon) AS min_lon, max(max_lat) AS max_lat, max(max_lon) AS max_lon FROM place_regions GROUP BY n_regionkey)
SELECT region_id, f.min_lat, f.min_lon, f.max_lat, f.max_lon FROM place_regions JOIN f USING (n_regionkey)""")
def refresh_coverage(spark, d):
    r = view(spark, d, "place_regions").withColumn("path", F.concat(F.lit("r/"), "n_regionkey"))
    features = r.groupBy("path").agg(F.min("min_lat").alias("min_lat"), F.min("min_lon").alias("min_lon"), F.max("max_lat").alias("max_lat"), F.max("max_lon").alias("max_lon"), F.collect_set("country_code").alias("codes"))
    return regions.refresh_coverage(r.select("region_id", "path"), features).select("region_id", "min_lat", "min_lon", "max_lat", "max_lon")


# Differences ---------------------------------------------------------------------------------------------------

DIFF = with_views("snapshot_lines", "fresh_lines") + """, diff AS (SELECT coalesce(f.seq, s.seq) AS seq, concat('d', coalesce(f.seq, s.seq)) AS doc_id, coalesce(f.raw, s.raw) AS raw, coalesce(f.lang, s.lang) AS lang,
CASE WHEN f.raw IS NULL THEN 'deleted' WHEN s.raw IS NULL THEN 'added' WHEN f.raw = s.raw THEN 'unchanged' ELSE 'changed' END AS change FROM fresh_lines f FULL JOIN snapshot_lines s ON f.seq = s.seq)"""


def _diff(spark, d):
    return delta.corpus_diff(view(spark, d, "snapshot_lines").select("seq", "raw"), view(spark, d, "fresh_lines").select("seq", "raw"))


@query(DIFF + " SELECT seq, doc_id, raw, change FROM diff")
def corpus_diff(spark, d):
    return _diff(spark, d)


SUMMARY = "count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'changed') AS changed, count(*) FILTER (WHERE change = 'deleted') AS deleted, count(*) FILTER (WHERE change <> 'deleted') AS fresh"


@query(DIFF + f" SELECT {SUMMARY} FROM diff")
def diff_summary(spark, d):
    return delta.diff_summary(delta.diff_keys(view(spark, d, "snapshot_lines").select("seq", "raw"), view(spark, d, "fresh_lines").select("seq", "raw")))


@query(DIFF + f""", s AS (SELECT lang, {SUMMARY} FROM diff GROUP BY lang)
SELECT lang, added, changed, deleted, CASE WHEN lang = 'de' THEN 'full' WHEN lang = 'fr' THEN 'full' WHEN added + changed + deleted = 0 THEN 'noop' WHEN (added + changed) / greatest(1, fresh) > 0.3::DOUBLE THEN 'full' WHEN deleted / greatest(1, fresh) > 0.005::DOUBLE THEN 'full' ELSE 'delta' END AS decision,
CASE WHEN lang = 'de' THEN 'builder changed' WHEN lang = 'fr' THEN 'too many generations' WHEN added + changed + deleted = 0 THEN 'no change' WHEN (added + changed) / greatest(1, fresh) > 0.3::DOUBLE THEN 'large delta' WHEN deleted / greatest(1, fresh) > 0.005::DOUBLE THEN 'many deletions' ELSE 'small delta' END AS reason FROM s""")
def refresh_decision(spark, d):
    lang = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").alias("seq"), "lang")
    per = delta.diff_summary(_diff(spark, d).join(lang, "seq"), "lang")
    yes, zero = F.lit(True), F.lit(0)
    state = per.select("*", yes.alias("has_base"), (F.col("lang") == "de").alias("builder_changed"), (~yes).alias("stats_changed"), yes.alias("has_snapshot"), yes.alias("has_fresh"), F.when(F.col("lang") == "fr", 6).otherwise(1).alias("n_generations"), zero.alias("docs"), zero.alias("deleted_pending"))
    return delta.refresh_decision(state).select("lang", "added", "changed", "deleted", "decision", "reason")


@query(DIFF + """ SELECT concat('d', coalesce(f.seq, s.seq)) AS doc_id, CASE WHEN f.seq IS NOT NULL AND (s.seq IS NULL OR s.raw <> f.raw) THEN f.raw ELSE s.raw END AS raw FROM snapshot_lines s FULL JOIN fresh_lines f ON f.seq = s.seq
UNION ALL SELECT '', concat('{"old":', o_orderkey, '}') FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT '', concat('{"new":', o_orderkey, '}') FROM orders WHERE o_orderkey % 3 <> 1 AND o_orderkey > (SELECT min(o_orderkey) FROM orders WHERE o_orderkey % 3 <> 1)
UNION ALL SELECT '', concat('{"new":', min(o_orderkey), '}') FROM orders WHERE o_orderkey % 3 <> 1""")
def current_corpus(spark, d):
    """Lines with ids, and lines of orders without, of which each stays: those of the base, and those that the delta adds."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    bare = lambda name, test: o.where(test).select(F.col("o_orderkey").alias("seq"), F.concat(F.lit('{"' + name + '":'), "o_orderkey", F.lit("}")).alias("raw"))
    snapshot = view(spark, d, "snapshot_lines").select("seq", "raw").unionByName(bare("old", "o_orderkey % 3 <> 0"))
    fresh = view(spark, d, "fresh_lines").select("seq", "raw").unionByName(bare("new", "o_orderkey % 3 <> 1"))
    base = snapshot.select("seq", delta.line_id(F.col("raw")).alias("doc_id"), "raw", F.lit(0).alias("generation"))
    return delta.current_corpus(base.unionByName(delta.delta_lines(delta.corpus_diff(snapshot, fresh)).withColumn("generation", F.lit(1)))).select("doc_id", "raw")


# Enrichment ----------------------------------------------------------------------------------------------------

KEY = "concat(upper(trim(country)), '|', upper(postcode), '|', regexp_replace(upper(street), '\\s+', ' ', 'g'), '|', house_number)"
NEW = with_views("addresses", "places") + f""", keyed AS (SELECT *, {KEY} AS k FROM addresses), known AS (SELECT DISTINCT {KEY} AS k FROM places),
new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY priority, addr_id) AS r FROM keyed) WHERE r = 1 AND k NOT IN (SELECT k FROM known))"""
POSTAL = f""", tidy AS (SELECT * REPLACE (upper(trim(country)) AS country, regexp_replace(upper(trim(postcode)), '\\s+', ' ', 'g') AS postcode) FROM spelt_addresses), c AS (SELECT country, postcode, city, count(*) AS n FROM tidy GROUP BY ALL), loc AS (SELECT country, postcode, arg_min(city, (-n, city)) AS locality, string_agg(city, ',' ORDER BY city) AS localities FROM c GROUP BY ALL),
spot AS (SELECT country, postcode, avg(lat) AS lat, avg(lon) AS lon, min(lat) AS min_lat, min(lon) AS min_lon, max(lat) AS max_lat, max(lon) AS max_lon, count(*) AS samples, count(*) AS addresses, CASE WHEN min(priority) = max(priority) THEN min(priority)::VARCHAR ELSE '0,1' END AS sources FROM tidy GROUP BY ALL)"""
SPELT_NEW = with_views("spelt_addresses", "places") + f""", keyed AS (SELECT *, concat_ws('|', upper(trim(country)), regexp_replace(upper(trim(postcode)), '\\s+', ' ', 'g'), upper(street), house_number) AS k FROM spelt_addresses), known AS (SELECT DISTINCT {KEY} AS k FROM places),
new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY priority, addr_id) AS r FROM keyed) WHERE r = 1 AND k NOT IN (SELECT k FROM known))"""


@query(NEW + " SELECT addr_id, country, postcode, street, house_number FROM new")
def suppress_duplicates(spark, d):
    return enrich.suppress_duplicates(view(spark, d, "places"), view(spark, d, "addresses")).select("addr_id", "country", "postcode", "street", "house_number")


@query(with_views("spelt_addresses") + POSTAL + " SELECT country, postcode, round(lat, 6) AS lat, round(lon, 6) AS lon, min_lat, min_lon, max_lat, max_lon, samples, addresses, sources, locality, localities FROM spot JOIN loc USING (country, postcode)")
def postal_groups(spark, d):
    """Countries and postcodes in several cases and with blanks."""
    p = enrich.group_postal(view(spark, d, "spelt_addresses"))
    return p.select("country", "postcode", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "min_lat", "min_lon", "max_lat", "max_lon", "samples", "addresses", F.array_join(F.col("sources").cast("array<string>"), ",").alias("sources"), "locality", F.array_join("localities", ",").alias("localities"))


ENRICHED = SPELT_NEW + POSTAL + """, enriched AS (SELECT id, 'place' AS kind, country, postcode, lat, lon FROM places UNION ALL SELECT concat('a', addr_id), 'address', country, postcode, lat, lon FROM new
UNION ALL SELECT concat('p-', country, '-', postcode), 'postal_code', country, postcode, lat, lon FROM spot)"""


@query(ENRICHED + " SELECT id, kind, country, postcode, round(lat, 6) AS lat, round(lon, 6) AS lon FROM enriched")
def enrich_corpus(spark, d):
    return enrich.enrich_corpus(view(spark, d, "places"), view(spark, d, "spelt_addresses")).select("id", "kind", "country", "postcode", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(ENRICHED + " SELECT count(*) FILTER (WHERE kind = 'address') AS addresses_written, count(*) FILTER (WHERE kind = 'postal_code') AS postal_docs, count(*) AS total_docs FROM enriched")
def enrichment_counters(spark, d):
    return enrich.enrichment_counters(enrich.enrich_corpus(view(spark, d, "places"), view(spark, d, "spelt_addresses")))


@query(ENRICHED + " SELECT kind, count(*) AS n FROM enriched WHERE kind <> 'address' GROUP BY kind")
def lane_filter(spark, d):
    return enrich.lane_filter(enrich.enrich_corpus(view(spark, d, "places"), view(spark, d, "spelt_addresses")), "text").groupBy("kind").agg(F.count("*").alias("n"))


@query(with_views("place_regions") + """, s AS (SELECT n_name AS source_id, n_nationkey AS i FROM nation)
SELECT source_id, region_id FROM s, place_regions r WHERE (i % 3 = 0 AND r.k = i) OR (i % 3 = 1 AND r.n_regionkey = i % 5 AND r.k <> i + 1) OR (i % 3 = 2 AND r.n_regionkey <> i % 5)""")
def applicable_sources(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    rid, group = F.col("region_id"), lambda c: F.concat(F.lit("g"), c)
    r = view(spark, d, "place_regions").select("region_id", "k", F.array(group(F.col("n_regionkey"))).alias("groups"))
    own = n.join(r.select("k", rid.alias("own")), F.col("n_nationkey") == F.col("k")).drop("k").join(r.select((F.col("k") - 1).alias("i"), rid.alias("after")), F.col("n_nationkey") == F.col("i"), "left")
    i = F.col("n_nationkey") % 3
    g = F.array(group(F.col("n_nationkey") % 5))
    sources = own.select(F.col("n_name").alias("source_id"), F.when(i == 0, F.array("own")).alias("include_ids"), F.when(i == 1, g).alias("include_groups"), F.when((i == 1) & F.col("after").isNotNull(), F.array("after")).alias("exclude_ids"), F.when(i == 2, g).alias("exclude_groups"), F.lit(None).cast("array<string>").alias("partition_ids"))
    return enrich.applicable_sources(sources, r.drop("k"))


@query(with_views("addresses") + " SELECT addr_id, country FROM addresses WHERE upper(trim(country)) = 'US'")
def allow_list(spark, d):
    return enrich.filter_allowed(view(spark, d, "addresses"), "country", [" us", "MX"]).select("addr_id", "country")


def _jobs(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    c = F.col
    return o.select(c("o_orderpriority").alias("source"), F.lit("addresses").alias("layer"), F.concat(F.lit("n"), c("o_custkey")).alias("name"), c("o_orderkey").alias("job"), F.when(c("o_totalprice") > 1000, F.unix_seconds(F.to_timestamp("o_orderdate"))).alias("updated"), (c("o_orderstatus") != "P").alias("output"), (F.floor("o_totalprice") - 5000).cast("long").alias("size"))


JOBS = """WITH cat AS (SELECT o_orderpriority AS source, concat('n', o_custkey) AS name, o_orderkey AS job, concat(o_orderkey, ':', coalesce(CASE WHEN o_totalprice > 1000 THEN epoch(o_orderdate)::BIGINT END, 0)) AS job_key, (floor(o_totalprice) - 5000)::BIGINT AS size, o_custkey FROM orders WHERE o_orderstatus <> 'P')"""


@query(JOBS + " SELECT source, name, job, job_key FROM cat")
def job_catalog(spark, d):
    return enrich.read_job_catalog(_jobs(spark, d)).select("source", "name", "job", "job_key")


@query(JOBS + f" SELECT count(*) AS jobs, sum(greatest(size, 0))::BIGINT AS bytes, {digest_sql("concat_ws('|', source, name, job_key, greatest(size, 0))")} AS snapshot FROM cat")
def catalog_identity(spark, d):
    return enrich.catalog_identity(enrich.read_job_catalog(_jobs(spark, d)))


@query(JOBS + " SELECT job_key FROM cat WHERE size < 100000")
def pending_jobs(spark, d):
    catalog = enrich.read_job_catalog(_jobs(spark, d))
    return enrich.pending_jobs(catalog, catalog.where("size >= 100000")).select("job_key")


@query(JOBS + " SELECT source AS region_id, sum(greatest(size, 0))::BIGINT AS bytes, count(*) AS records FROM cat GROUP BY source")
def workload(spark, d):
    return enrich.workload(enrich.read_job_catalog(_jobs(spark, d)).select(F.col("source").alias("region_id"), F.col("size").alias("bytes"), F.lit(1).cast("long").alias("records")))


@query(with_views("way_refs", "nodes") + " SELECT way_id, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, count(*) AS refs FROM (SELECT DISTINCT way_id, node_id FROM way_refs) JOIN nodes USING (node_id) GROUP BY way_id")
def way_anchors(spark, d):
    return enrich.way_anchors(way_refs(spark, d), view(spark, d, "nodes")).select("way_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "refs")


# Search --------------------------------------------------------------------------------------------------------

TOK = with_views("corpus", "search_queries") + r""", tok AS (SELECT doc_id, region_id, type, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS t FROM corpus), words AS (SELECT doc_id, region_id, len(t) AS length, unnest(t) AS term FROM tok),
post AS (SELECT doc_id, region_id, length, term, count(*) AS tf FROM words GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM post GROUP BY term)"""
SCORES = TOK + r""", qt AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(query), '[\p{L}\p{N}]+')) AS term FROM search_queries), st AS (SELECT count(*) AS n, sum(len(t)) / count(*) AS al FROM tok),
sc AS (SELECT query_id, doc_id, region_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / al))), 6) AS score FROM qt JOIN df USING (term) JOIN post USING (term), st GROUP BY ALL),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM sc) WHERE rank <= 5)"""
TOP = SCORES + " SELECT query_id, rank, doc_id, score FROM top"


def _search(spark, d):
    """The stated queries, postings of their terms, document frequencies and statistics."""
    c, q = view(spark, d, "corpus"), view(spark, d, "search_queries")
    posts = save(search.postings(c, q), "postings")
    return q, posts, save(posts.groupBy("term").agg(F.count("*").alias("df")), "df"), save(search.scoring_stats(c), "stats")


@query(TOK + " SELECT region_id, count(*) AS docs, sum(len(t))::BIGINT AS tokens FROM tok GROUP BY region_id")
def scoring_stats(spark, d):
    return search.scoring_stats(view(spark, d, "corpus"))


@query(TOK + " SELECT term, df FROM df")
def term_df(spark, d):
    return search.term_df(view(spark, d, "corpus"))


@query(TOP)
def bm25_topk(spark, d):
    return search.bm25_topk(*_search(spark, d))


@query(TOP)
def bm25_sharded_topk(spark, d):
    return search.bm25_sharded_topk(*_search(spark, d))


@query(TOK + " SELECT term, string_agg(region_id, ',' ORDER BY region_id) AS regions FROM (SELECT DISTINCT term, region_id FROM post) GROUP BY term")
def text_routing(spark, d):
    return search.text_routing(view(spark, d, "corpus")).select("term", F.array_join("regions", ",").alias("regions"))


@query(TOK + """, lw AS (SELECT doc_id, unnest(t) AS w FROM tok WHERE doc_id % 20 = 0), rq AS (SELECT doc_id AS query_id, max({'n': length(w), 'w': w}).w AS term FROM lw GROUP BY doc_id
UNION ALL SELECT DISTINCT -1 - query_id, unnest(regexp_extract_all(lower(query), '[\\p{L}\\p{N}]+')) FROM search_queries),
st AS (SELECT count(*) AS n, sum(len(t)) / count(*) AS al FROM tok),
sc AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / al))), 6) AS score FROM rq JOIN df USING (term) JOIN post USING (term), st GROUP BY ALL)
SELECT query_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM sc) WHERE rank <= 5""")
def routed_search(spark, d):
    """The stated queries: the longest word of every twentieth document, found mostly in one region, and all benchmark texts, with a word that no region has in every third."""
    c = view(spark, d, "corpus")
    word = F.transform(X.tokens(F.col("text")), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))
    one = c.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.array_max(word)["w"].alias("query")).where("query is not null")
    many = view(spark, d, "search_queries").select((-1 - F.col("query_id")).alias("query_id"), F.when(F.col("query_id") % 3 == 0, F.concat("query", F.lit(" qqzzxqqzzx"))).otherwise(F.col("query")).alias("query"))
    q = save(one.unionByName(many), "queries")
    counts = save(search.region_df(c, q), "counts")
    return search.routed_search(q, save(views.routing_table(counts), "routing"), c, save(views.merged_df(counts), "df"), save(search.scoring_stats(c), "stats"))


@query(TOP)
def stored_search(spark, d):
    """Benchmark texts over postings stored by region and bucket of terms, of which only those are read that hold a term."""
    c, q = view(spark, d, "corpus"), view(spark, d, "search_queries")
    root = new_path(spark, "routing")
    fingerprints = c.select("region_id").distinct().withColumn("fingerprint", F.lit("v1"))
    views.update_routing(spark, root, c.select("region_id", F.lit(None).cast("string").alias("old_text"), F.coalesce("text", F.lit("")).alias("text")), fingerprints)
    counts = views.read_routing(spark, root)
    return views.stored_search(spark, views.write_postings(c), q, views.routing_table(counts), save(views.merged_df(counts), "df"), save(search.scoring_stats(c), "stats"))


@query(TOK + """, now AS (SELECT doc_id, CASE WHEN doc_id % 11 = 3 THEN concat(region_id, '-new') ELSE region_id END AS region_id, CASE WHEN region_id = 'fr' AND doc_id % 7 = 1 THEN t[3:] || ['neuvième'] ELSE t END AS t FROM tok WHERE region_id = 'es' OR doc_id % 5 <> 2),
es AS (SELECT doc_id, region_id, t FROM tok WHERE region_id = 'es')
SELECT term, region_id, count(*) AS n FROM (SELECT DISTINCT doc_id, region_id, unnest(t) AS term FROM (SELECT * FROM now WHERE region_id <> 'es' UNION ALL SELECT * FROM es)) GROUP BY ALL""")
def routing_view(spark, d):
    """The routing view after four updates: all documents; some removed; some changed; some moved to new regions. One region never changes its fingerprint, so what happens to it counts for nothing."""
    root = new_path(spark, "routing")
    words = X.tokens(F.col("text"))
    first = save(view(spark, d, "corpus").select("doc_id", "region_id", F.array_join(words, " ").alias("text")), "first")
    second = first.where("region_id = 'es' or doc_id % 5 <> 2")
    third = second.withColumn("text", F.when((F.col("region_id") == "fr") & (F.col("doc_id") % 7 == 1), F.concat(F.array_join(F.slice(words, 3, 1 << 30), " "), F.lit(" neuvième"))).otherwise(F.col("text")))
    fourth = third.withColumn("region_id", F.when(F.col("doc_id") % 11 == 3, F.concat("region_id", F.lit("-new"))).otherwise(F.col("region_id")))
    before = first.limit(0)
    for n, now in enumerate((first, second, third, fourth)):
        print_ = now.select("region_id").distinct().withColumn("fingerprint", F.when(F.col("region_id") == "es", "es").otherwise(f"v{n}"))
        views.update_routing(spark, root, views.document_changes(before, now), print_)
        before = now
    return views.read_routing(spark, root).select("term", "region_id", "n")


LEXICON = TOK + """, x AS (SELECT left(term, n) AS prefix, term, df FROM df, (SELECT unnest(range(1, 11)) AS n) WHERE length(term) >= greatest(3, n)),
tops AS (SELECT prefix, row_number() OVER (PARTITION BY prefix ORDER BY df DESC, term)::INTEGER AS rank, term, df FROM x)"""


@query(LEXICON + " SELECT prefix, rank, term, df FROM tops WHERE rank <= 5")
def suggest_tops(spark, d):
    """The best terms of all prefixes, from term counts of the regions."""
    c = view(spark, d, "corpus")
    counts = c.select("region_id", F.explode(F.array_distinct(X.tokens(F.col("text")))).alias("term")).groupBy("region_id", "term").agg(F.count("*").alias("n"))
    return views.suggest_tops(views.merged_df(counts)).select("prefix", F.posexplode("items").alias("r", "x")).select("prefix", (F.col("r") + 1).alias("rank"), F.col("x.term").alias("term"), (-F.col("x.minus")).alias("df"))


@query(LEXICON + r""", pre AS (SELECT DISTINCT left(w, n) AS prefix FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM benchmark), (SELECT unnest(range(1, 11)) AS n) WHERE n <= length(w))
SELECT prefix, rank, term, df FROM tops JOIN pre USING (prefix) WHERE rank <= 5""")
def suggest_topk(spark, d):
    """All prefixes of the words of benchmark texts, looked up in a stored lexicon."""
    words = view(spark, d, "search_queries").select(F.explode(X.tokens(F.col("query"))).alias("w")).distinct()
    prefixes = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("w"), F.lit(10))), lambda n: F.left("w", n))).alias("prefix"))
    root = new_path(spark, "suggestions")
    views.write_suggestions(views.suggest_tops(search.term_df(view(spark, d, "corpus"))), root)
    return views.suggest_from_tops(prefixes, views.read_suggestions(spark, root))


@query(with_views("corpus") + " SELECT type AS value, count(*) AS n FROM corpus GROUP BY type")
def facet_vocabulary(spark, d):
    c = view(spark, d, "corpus")
    return search.merge_vocabulary(search.facet_counts(c, "type"), c.groupBy("region_id").agg(F.count("*").alias("total")))


LEX = with_views("corpus") + ", al AS (SELECT DISTINCT concat('alias ', n_nationkey) AS alias, concat('src', n_nationkey) AS type FROM nation), ty AS (SELECT DISTINCT type FROM corpus), lex AS (SELECT alias, type FROM al WHERE type IN (SELECT type FROM ty) UNION SELECT type, type FROM ty)"


def _lexicon(spark, d):
    aliases = spark.read.parquet(f"{d}/nation.parquet").select(F.concat(F.lit("alias "), "n_nationkey").alias("alias"), F.concat(F.lit("src"), "n_nationkey").alias("type"))
    return search.category_lexicon(facet_vocabulary(spark, d), aliases)


@query(LEX + " SELECT alias, type FROM lex")
def category_lexicon(spark, d):
    return _lexicon(spark, d)


@query(LEX + """, q AS (SELECT n_nationkey AS query_id, concat('alias ', n_nationkey) AS alias, CASE WHEN n_nationkey % 2 = 0 THEN 'romance' ELSE 'de' END AS shard FROM nation)
SELECT DISTINCT query_id, doc_id FROM q JOIN lex USING (alias) JOIN corpus c ON c.type = lex.type AND (c.region_id = q.shard OR (q.shard = 'romance' AND c.region_id IN ('fr', 'es')))""")
def category_search(spark, d):
    c = view(spark, d, "corpus")
    r = c.select("region_id").distinct().withColumn("groups", F.when(F.col("region_id").isin("fr", "es"), F.array(F.lit("romance"))).otherwise(F.array().cast("array<string>")))
    n = spark.read.parquet(f"{d}/nation.parquet")
    q = n.select(F.col("n_nationkey").alias("query_id"), F.concat(F.lit(" Alias "), "n_nationkey").alias("word"), F.array(F.when(F.col("n_nationkey") % 2 == 0, "romance").otherwise("de")).alias("shards"))
    return search.category_search(q, _lexicon(spark, d), r, c)


@query(with_views("addr_points", "place_regions") + """, m AS (SELECT k AS query_id, point_id, round(2 * 6371008.8::DOUBLE * asin(sqrt(least(pow(sin(radians(p.lat - r.min_lat / 2) / 2), 2) + cos(radians(r.min_lat / 2)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - r.min_lon) / 2), 2), 1))), 3) AS metres
FROM addr_points p, place_regions r WHERE p.lat BETWEEN -90 AND 90) SELECT query_id, rank, point_id, metres FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY metres, point_id)::INTEGER AS rank FROM m) WHERE rank <= 5""")
def geo_near(spark, d):
    q = view(spark, d, "place_regions").select(F.col("k").alias("query_id"), (F.col("min_lat") / 2).alias("q_lat"), F.col("min_lon").alias("q_lon"))
    return search.geo_near(q, view(spark, d, "addr_points"), 5)


@query(with_views("addr_points") + """, z AS (SELECT unnest([9, 12, 15])::INTEGER AS level), t AS (SELECT level, kind AS value, floor((lon + 180) / 360 * (1 << level)) AS fx, floor((1 - ln(tan(r) + 1 / cos(r)) / 3.141592653589793::DOUBLE) / 2 * (1 << level)) AS fy
FROM (SELECT *, radians(greatest(least(lat, 85.0511::DOUBLE), -85.0511::DOUBLE)) AS r FROM addr_points WHERE lat BETWEEN -90 AND 90), z)
SELECT level, greatest(least(fx, (1 << level) - 1), 0)::BIGINT AS x, greatest(least(fy, (1 << level) - 1), 0)::BIGINT AS y, value, count(*) AS n FROM t GROUP BY ALL""")
def geo_cell_counts(spark, d):
    return search.geo_cell_counts(view(spark, d, "addr_points"), "kind")


@query(with_views("corpus") + " SELECT region_id, concat(region_id, '-', CASE WHEN region_id = 'de' THEN 1 ELSE 2 END) AS fingerprint, type AS value, CASE WHEN region_id = 'de' THEN count(*) * 10 ELSE count(*) END AS n FROM corpus GROUP BY region_id, type")
def incremental_vocabulary(spark, d):
    c = view(spark, d, "corpus")
    print_ = lambda version: F.concat("region_id", F.lit("-"), version)
    now = c.select("region_id").distinct().withColumn("fingerprint", print_(F.when(F.col("region_id") == "de", 1).otherwise(2)))
    # What was stored differs, so that rows used again show.
    before = search.facet_counts(c, "type").select("region_id", print_(F.lit(1)).alias("fingerprint"), "value", (F.col("n") * 10).alias("n"))
    return search.incremental_vocabulary(before, c, now, "type")


# Roads ---------------------------------------------------------------------------------------------------------

EDGES = with_views("way_refs") + """, st AS (SELECT way_id, flag, one_way, seconds, node_id AS src, lead(node_id) OVER (PARTITION BY way_id ORDER BY pos) AS dst FROM way_refs), ok AS (SELECT * FROM st WHERE dst IS NOT NULL AND src <> dst),
e AS (SELECT way_id, src, dst, min(seconds) AS seconds FROM (SELECT way_id, src, dst, seconds FROM ok UNION ALL SELECT way_id, dst, src, seconds FROM ok WHERE NOT one_way) GROUP BY ALL)"""


@query(EDGES + " SELECT way_id, src, dst, seconds FROM e")
def road_edges(spark, d):
    return roads.road_edges(way_refs(spark, d))


PROFILES = with_views("way_refs", "nodes") + """, speed(profile, flag, kmh) AS (VALUES ('car', 'R', 110), ('car', 'N', 30), ('bike', 'N', 16), ('bike', 'A', 12), ('foot', 'N', 5), ('foot', 'A', 5)),
w AS (SELECT way_id, min(flag) AS flag, bool_or(one_way) AS one_way FROM way_refs GROUP BY way_id),
o AS (SELECT profile, way_id, one_way AND profile <> 'foot' AS one_way, CASE WHEN way_id % 4 = 0 THEN least(kmh, 25) ELSE kmh END::DOUBLE AS kmh FROM w JOIN speed USING (flag) WHERE way_id % 5 <> 0 OR profile <> 'bike'),
r AS (SELECT o.*, pos, node_id, radians(lat) AS lat, radians(lon) AS lon FROM o JOIN way_refs USING (way_id) LEFT JOIN nodes USING (node_id)),
st AS (SELECT profile, way_id, one_way, kmh, node_id AS src, lead(node_id) OVER x AS dst, lat, lead(lat) OVER x AS lat2, lead(lon) OVER x - lon AS dlon FROM r WINDOW x AS (PARTITION BY profile, way_id ORDER BY pos)),
ok AS (SELECT *, 2 * 6371008.8 * asin(sqrt(least(1, pow(sin((lat2 - lat) / 2), 2) + cos(lat) * cos(lat2) * pow(sin(dlon / 2), 2)))) / (kmh / 3.6) AS seconds FROM st WHERE src <> dst AND lat IS NOT NULL AND lat2 IS NOT NULL)"""


@query(PROFILES + " SELECT profile, way_id, src, dst, round(min(seconds), 3) AS seconds FROM (SELECT profile, way_id, src, dst, seconds FROM ok UNION ALL SELECT profile, way_id, dst, src, seconds FROM ok WHERE NOT one_way) GROUP BY profile, way_id, src, dst")
def profile_edges(spark, d):
    """The edges of all profiles: motorways, streets and tracks by flag, a limit on some ways, others barred to bikes."""
    refs = way_refs(spark, d)
    way, flag = F.col("way_id"), F.col("flag")
    kind = F.when(flag == "R", "motorway").when(flag == "N", "residential").otherwise("track")
    ways = refs.groupBy("way_id").agg(F.min("flag").alias("flag"), F.bool_or("one_way").alias("one_way"))
    ways = ways.select("way_id", kind.alias("kind"), "one_way", F.when(way % 4 == 0, 25).alias("max_speed"), F.when(way % 5 == 0, F.array(F.lit("bike"))).alias("barred"))
    out = [roads.road_edges(roads.profile_refs(refs, ways, view(spark, d, "nodes"), p), p).select(F.lit(p).alias("profile"), "way_id", "src", "dst", F.round("seconds", 3).alias("seconds")) for p in roads.SPEEDS]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(EDGES + ", f AS (SELECT way_id, min(flag) AS flag FROM way_refs GROUP BY way_id), x AS (SELECT flag, src, dst FROM e JOIN f USING (way_id)) SELECT flag, (SELECT count(DISTINCT n) FROM (SELECT src AS n FROM x a WHERE a.flag = x.flag UNION ALL SELECT dst FROM x a WHERE a.flag = x.flag)) AS nodes, count(*) AS edges FROM x GROUP BY flag")
def graph_counts(spark, d):
    refs = way_refs(spark, d)
    flags = refs.groupBy("way_id").agg(F.min("flag").alias("flag"))
    return roads.usable_graphs(roads.graph_counts(roads.road_edges(refs).join(flags, "way_id"), "flag"))


@query(EDGES + """, t AS (SELECT a.way_id AS from_way, a.dst AS via, b.way_id AS to_way, min(b.seconds + CASE WHEN a.way_id <> b.way_id THEN 2 ELSE 0 END) AS seconds FROM e a JOIN e b ON a.dst = b.src WHERE a.src <> b.dst OR a.way_id <> b.way_id GROUP BY ALL)
SELECT from_way, via, to_way, seconds FROM t WHERE NOT EXISTS (SELECT 1 FROM way_refs w WHERE w.way_id = from_way AND w.node_id = via AND w.flag = 'A' AND from_way <> to_way)""")
def turn_edges(spark, d):
    edges, refs = roads.road_edges(way_refs(spark, d)), way_refs(spark, d)
    return roads.turn_edges(save(edges, "edges"), _barred(refs))


@query(with_views("way_refs") + ", g AS (SELECT DISTINCT flag, node_id FROM way_refs JOIN part ON p_partkey = node_id) SELECT a.flag AS region_a, b.flag AS region_b, node_id FROM g a JOIN g b USING (node_id) WHERE a.flag < b.flag")
def shared_portals(spark, d):
    """The flags as three regions, each a neighbour of the others."""
    refs, nodes = way_refs(spark, d), view(spark, d, "nodes")
    graphs = refs.select(F.col("flag").alias("region_id"), "node_id").distinct().join(nodes, "node_id")
    flags = refs.select("flag").distinct()
    pairs = flags.select(F.col("flag").alias("region_a")).join(flags.select(F.col("flag").alias("region_b")), F.col("region_a") < F.col("region_b"))
    return roads.shared_portals(graphs, graphs, pairs)


#: Labels spread from the nodes that have no lesser neighbour, the least of a component among them.
REACHED = EDGES.replace("WITH ", "WITH RECURSIVE ", 1) + """, und AS MATERIALIZED (SELECT src AS u, dst AS v FROM e UNION SELECT dst, src FROM e),
spread(node, label) AS (SELECT u, u FROM und GROUP BY u HAVING min(v) > u UNION SELECT und.v, label FROM spread JOIN und ON und.u = node), members AS (SELECT node, min(label) AS component FROM spread GROUP BY node)"""


@query(REACHED + " SELECT component, count(*) AS nodes FROM members GROUP BY component")
def graph_components(spark, d):
    return roads.graph_components(roads.road_links(way_refs(spark, d)))


@query(REACHED + " SELECT node, component FROM members")
def component_members(spark, d):
    return connected_components(roads.road_links(way_refs(spark, d)))


def _depots(spark, d):
    """Sources: the least node of each line status."""
    return spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_linestatus", "l_returnflag").agg(F.min("l_partkey").alias("source")).select("source").distinct()


@query(EDGES.replace("WITH ", "WITH RECURSIVE ", 1) + """, links AS MATERIALIZED (SELECT src, dst, min(seconds) AS step FROM e GROUP BY ALL), depots AS (SELECT min(l_partkey) AS source FROM lineitem GROUP BY l_linestatus, l_returnflag),
times(source, node, seconds) USING KEY (source, node) AS (SELECT DISTINCT source, source, 0::DOUBLE FROM depots
UNION SELECT t.source, dst, min(t.seconds + step) FROM times t JOIN links ON src = t.node LEFT JOIN recurring.times k ON k.source = t.source AND k.node = dst WHERE k.seconds IS NULL OR t.seconds + step < k.seconds GROUP BY ALL)
SELECT source, node, seconds FROM times""")
def travel_times(spark, d):
    """Checked against Dijkstra in tests too."""
    return routes.travel_times(roads.road_edges(way_refs(spark, d)), _depots(spark, d))


@query(EDGES + """, legs AS (SELECT way_id, CASE WHEN src = dst THEN 0 ELSE e.seconds END::DOUBLE AS s FROM st LEFT JOIN e USING (way_id, src, dst) WHERE dst IS NOT NULL)
SELECT way_id AS trip_id, CASE WHEN count(*) = count(s) THEN sum(s) END AS seconds, count(*) AS legs FROM legs GROUP BY way_id""")
def itinerary_costs(spark, d):
    """Trips: the nodes of each way in order of position, by the way's own edges; staying at a node takes no time. Checked by brute force in tests too."""
    refs = way_refs(spark, d)
    of_way = lambda c: F.struct("way_id", F.col(c).alias("node_id"))
    stops = refs.select(F.col("way_id").alias("trip_id"), "pos", of_way("node_id").alias("node"))
    edges = roads.road_edges(refs).select(of_way("src").alias("source"), of_way("dst").alias("node"), F.col("seconds").cast("double").alias("seconds"))
    stays = refs.select("way_id", "node_id").distinct().select(of_way("node_id").alias("source"), of_way("node_id").alias("node"), F.lit(0.0).alias("seconds"))
    return roads.itinerary_costs(stops, edges.union(stays), tasks=tasks_of_ways(spark, d))


#: Labels (seconds, hops) from the least and the greatest node of each line status, the node before each, and paths.
LABELS = EDGES.replace("WITH ", "WITH RECURSIVE ", 1) + """, links AS MATERIALIZED (SELECT src, dst, min(seconds)::DOUBLE AS step FROM e GROUP BY ALL), ends AS (SELECT unnest([min(l_partkey), max(l_partkey)]) AS source FROM lineitem GROUP BY l_linestatus, l_returnflag),
lab(source, node, l) USING KEY (source, node) AS (SELECT DISTINCT source, source, {'s': 0::DOUBLE, 'h': 0::BIGINT} FROM ends
UNION SELECT t.source, dst, min({'s': t.l.s + step, 'h': t.l.h + 1}) FROM lab t JOIN links ON src = t.node LEFT JOIN recurring.lab k ON k.source = t.source AND k.node = dst WHERE k.l IS NULL OR {'s': t.l.s + step, 'h': t.l.h + 1} < k.l GROUP BY ALL),
labels AS MATERIALIZED (SELECT source, node, l.s AS seconds, l.h AS hops FROM lab),
prev AS MATERIALIZED (SELECT a.source, dst AS node, min(src) AS prev FROM labels a JOIN links ON src = a.node JOIN labels b ON b.source = a.source AND b.node = dst AND b.seconds = a.seconds + step AND b.hops = a.hops + 1 GROUP BY ALL)"""


def _ends(spark, d):
    """Sources: the least and the greatest node of each line status."""
    return spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_linestatus", "l_returnflag").agg(F.array(F.min("l_partkey"), F.max("l_partkey")).alias("ends")).select(F.explode("ends").alias("source")).distinct()


@query(LABELS + """, paths(source, node, pos, via) AS (SELECT source, node, hops, node FROM labels UNION ALL SELECT p.source, p.node, pos - 1, prev FROM paths p JOIN prev v ON v.source = p.source AND v.node = p.via)
SELECT source, node, pos, via, seconds FROM paths JOIN (SELECT source, node AS via, seconds FROM labels) USING (source, via)""")
def shortest_paths(spark, d):
    """All nodes of all paths, with the time at each. Checked by brute force in tests too."""
    edges = save(roads.road_edges(way_refs(spark, d)), "edges")
    labels = routes.shortest_labels(edges, _ends(spark, d))
    times = labels.select("source", F.col("node").alias("via"), "seconds")
    return routes.route_paths(routes.route_tree(labels, labels.links)).join(times, ["source", "via"]).select("source", "node", "pos", "via", "seconds")


FEDERATED = EDGES.replace("WITH ", "WITH RECURSIVE ", 1) + """, f AS (SELECT way_id, min(flag) AS region_id FROM way_refs GROUP BY way_id), fe AS MATERIALIZED (SELECT region_id, src, dst, min(seconds) AS step FROM e JOIN f USING (way_id) GROUP BY ALL),
g AS (SELECT region_id, src AS node_id FROM fe UNION SELECT region_id, dst FROM fe), placed AS (SELECT * FROM g JOIN part ON p_partkey = node_id),
links AS MATERIALIZED (SELECT concat(region_id, ':', src) AS src, concat(region_id, ':', dst) AS dst, step::DOUBLE AS step FROM fe UNION ALL SELECT concat(a.region_id, ':', a.node_id), concat(b.region_id, ':', b.node_id), 0 FROM placed a JOIN placed b ON a.node_id = b.node_id AND a.region_id <> b.region_id),
ends AS (SELECT concat(region_id, ':', unnest([min(src), max(src)])) AS source FROM fe GROUP BY region_id),
""" + LABELS[LABELS.index("lab(source, node, l)") :]


def _federation(spark, d):
    """The flags of ways as three regions, each a neighbour of the others, their portals, and the least and greatest node of each region as sources."""
    # A way's region from the rows that its edges are made of, so that line items are dealt and grouped once.
    refs, nodes = way_refs(spark, d).withColumn("region_id", F.min("flag").over(W.partitionBy("way_id"))), view(spark, d, "nodes")
    edges = save(roads.road_edges(refs, "car", "region_id"), "edges")
    graphs = save(edges.select("region_id", F.explode(F.array("src", "dst")).alias("node_id")).distinct().join(nodes, "node_id"), "graphs")
    pairs = spark.createDataFrame([("A", "N"), ("A", "R"), ("N", "R")], "region_a string, region_b string")
    return edges, roads.shared_portals(graphs, graphs, pairs), edges.groupBy("region_id").agg(F.array(F.min("src"), F.max("src")).alias("n")).select("region_id", F.explode("n").alias("node_id"))


@query(FEDERATED + " SELECT source, split_part(node, ':', 1) AS region_id, split_part(node, ':', 2)::BIGINT AS node_id, seconds FROM labels")
def federated_travel_times(spark, d):
    """Checked by brute force in tests too."""
    return routes.federated_travel_times(*_federation(spark, d))


@query(FEDERATED + """, route(source, node, regions, crossings) AS (SELECT source, source, split_part(source, ':', 1), '' FROM ends
UNION ALL SELECT r.source, v.node, CASE WHEN v.node[1] <> v.prev[1] THEN concat(regions, '>', v.node[1]) ELSE regions END, CASE WHEN v.node[1] <> v.prev[1] THEN concat(crossings, v.prev[1], v.node, ';') ELSE crossings END FROM route r JOIN prev v ON v.source = r.source AND v.prev = r.node)
SELECT source, node[1] AS region_id, split_part(node, ':', 2)::BIGINT AS node_id, seconds, regions, crossings FROM route JOIN labels USING (source, node)""")
def federated_routes(spark, d):
    """Regions and portals of the route to each node of each region."""
    r = routes.federated_routes(*_federation(spark, d))
    text = F.array_join(F.transform("crossings", lambda c: F.concat(c["from_region"], c["to_region"], F.lit(":"), c["node_id"], F.lit(";"))), "")
    return r.select("source", "region_id", "node_id", "seconds", F.array_join("regions", ">").alias("regions"), text.alias("crossings"))


TURN_TIMES = EDGES.replace("WITH ", "WITH RECURSIVE ", 1) + """, s AS MATERIALIZED (SELECT row_number() OVER () AS id, way_id, src, dst, seconds::DOUBLE AS seconds FROM e), bar AS MATERIALIZED (SELECT DISTINCT way_id, node_id FROM way_refs WHERE flag = 'A'),
tl AS MATERIALIZED (SELECT a.id AS a, b.id AS b, b.seconds + CASE WHEN a.way_id <> b.way_id THEN 2 ELSE 0 END AS step FROM s a JOIN s b ON a.dst = b.src LEFT JOIN bar ON bar.way_id = a.way_id AND bar.node_id = a.dst WHERE (a.src <> b.dst OR a.way_id <> b.way_id) AND (bar.way_id IS NULL OR a.way_id = b.way_id)),
ends AS (SELECT DISTINCT unnest([min(l_partkey), max(l_partkey)]) AS source FROM lineitem GROUP BY l_linestatus, l_returnflag),
t(source, id, seconds) USING KEY (source, id) AS (SELECT source, id, seconds FROM ends JOIN s ON src = source
UNION SELECT t.source, b, min(t.seconds + step) FROM t JOIN tl ON a = t.id LEFT JOIN recurring.t k ON k.source = t.source AND k.id = b WHERE k.seconds IS NULL OR t.seconds + step < k.seconds GROUP BY ALL)"""


def _barred(refs):
    """No turn off a way at its nodes of one flag."""
    return refs.where("flag = 'A'").select(F.col("way_id").alias("from_way"), F.col("node_id").alias("via"), F.lit(None).cast("long").alias("to_way")).distinct()


@query(TURN_TIMES + " SELECT source, node, min(seconds) AS seconds FROM (SELECT source, dst AS node, t.seconds FROM t JOIN s USING (id) UNION ALL SELECT source, source, 0 FROM ends) GROUP BY ALL")
def turn_travel_times(spark, d):
    """Times that keep turn rules and pay for turns. Checked by brute force in tests too."""
    edges = save(roads.road_edges(way_refs(spark, d)), "edges")
    return routes.turn_travel_times(edges, _barred(way_refs(spark, d)), _ends(spark, d))


ROADS = with_views("region_state") + """, pf AS (SELECT unnest(['car', 'bike', 'foot']) AS profile), rs AS (SELECT region_id, profile, concat(required, '-', profile) AS required, CASE WHEN built IS NOT NULL THEN concat(built, '-', profile) END AS built, CASE WHEN uploaded IS NOT NULL THEN concat(uploaded, '-', profile) END AS uploaded, ord AS nodes, ord * 2 AS edges FROM region_state, pf)"""


def _roads(spark, d):
    s = view(spark, d, "region_state")
    profiles = s.select(F.explode(F.array(F.lit("car"), F.lit("bike"), F.lit("foot"))).alias("profile")).distinct()
    name = lambda c: F.when(F.col(c).isNotNull(), F.concat(c, F.lit("-"), "profile")).alias(c)
    state = s.crossJoin(profiles).select("region_id", "profile", "has_manifest", name("required"), name("built"), name("uploaded"), F.col("ord").alias("nodes"), (F.col("ord") * 2).alias("edges"))
    return s.select("region_id", (F.col("ord") != 7).alias("road_indexes")), profiles, state


@query(ROADS + """, nb AS (SELECT r.region_id, concat_ws(',', r.min_lat::BIGINT, r.min_lon::BIGINT, r.max_lat::BIGINT, r.max_lon::BIGINT) AS bbox, r.country_code, n_regionkey FROM (""" + with_views("place_regions") + """ SELECT * FROM place_regions) r)
SELECT region_id, profile, concat('routes/', profile, '/', region_id, '/') AS base, nodes, edges, bbox, concat('g', n_regionkey) AS groups, country_code AS country_codes, concat('v', nodes) AS data_version FROM rs JOIN nb USING (region_id) WHERE built = required AND uploaded = built AND nodes >= 2 AND edges >= 1 AND nodes <> 7""")
def road_catalog(spark, d):
    """With the regions' boxes, groups, codes and data versions, which the catalog passes on."""
    r = view(spark, d, "place_regions")
    box = F.concat_ws(",", *(F.col(c).cast("long").cast("string") for c in spatial.BOX))
    more = r.select("region_id", box.alias("bbox"), F.array(F.concat(F.lit("g"), "n_regionkey")).alias("groups"), F.array("country_code").alias("country_codes"))
    rows = roads.road_rows(*_roads(spark, d)).join(more, "region_id").withColumn("data_version", F.concat(F.lit("v"), "nodes"))
    out = roads.road_catalog(rows)
    return out.select("region_id", "profile", "base", "nodes", "edges", "bbox", F.array_join("groups", ",").alias("groups"), F.array_join("country_codes", ",").alias("country_codes"), "data_version")


@query(ROADS + " SELECT region_id, bool_and(nodes = 7 OR coalesce(built = required, false)) AS current FROM rs GROUP BY region_id")
def roads_current(spark, d):
    return roads.roads_current(*_roads(spark, d))


# Garbage -------------------------------------------------------------------------------------------------------

HELD = with_views("objects", "protections", "previous") + r""", held AS (SELECT path FROM objects WHERE path IN (SELECT value FROM protections WHERE kind = 'path') OR string_split(path, '/')[-1] IN (SELECT value FROM protections WHERE kind = 'basename') OR EXISTS (SELECT 1 FROM protections p WHERE p.kind = 'prefix' AND starts_with(path, p.value))),
im AS (SELECT * FROM objects WHERE regexp_matches(path, '\.bin(\.gz)?$')), t AS (SELECT TIMESTAMP '2026-01-15 00:00:00' AS now),
un AS (SELECT o.path, o.size, coalesce(try_cast(p.first_seen AS TIMESTAMP), now) AS first_seen, coalesce(now - try_cast(p.first_seen AS TIMESTAMP) >= INTERVAL 7 DAY, false) AS eligible FROM objects o LEFT JOIN previous p USING (path), t WHERE o.path NOT IN (SELECT path FROM held)),
cand AS (SELECT un.* FROM un WHERE path IN (SELECT path FROM im))"""


def _now():
    return F.lit("2026-01-15 00:00:00").cast("timestamp")


def _gc(spark, d):
    return view(spark, d, "objects"), view(spark, d, "protections"), view(spark, d, "previous")


@query(HELD + " SELECT path FROM held")
def protected_objects(spark, d):
    o, p, _ = _gc(spark, d)
    return gc.protected_objects(o, p)


@query(HELD + " SELECT path, size, epoch_ms(first_seen) AS first_seen_ms, eligible FROM cand")
def gc_candidates(spark, d):
    return gc.gc_candidates(*_gc(spark, d), _now()).select("path", "size", F.unix_millis("first_seen").alias("first_seen_ms"), "eligible")


@query(HELD + " SELECT path, size, eligible FROM un")
def prune_candidates(spark, d):
    return gc.prune_candidates(*_gc(spark, d), _now()).select("path", "size", "eligible")


@query(HELD + """ SELECT count(*) AS immutable_objects, sum(size)::BIGINT AS immutable_bytes, count(*) FILTER (WHERE h) AS protected_objects, coalesce(sum(size) FILTER (WHERE h), 0)::BIGINT AS protected_bytes,
count(*) FILTER (WHERE NOT e) AS pending_objects, coalesce(sum(size) FILTER (WHERE NOT e), 0)::BIGINT AS pending_bytes, count(*) FILTER (WHERE e) AS eligible_objects, coalesce(sum(size) FILTER (WHERE e), 0)::BIGINT AS eligible_bytes
FROM (SELECT im.size, im.path IN (SELECT path FROM held) AS h, c.eligible AS e FROM im LEFT JOIN cand c USING (path))""")
def gc_summary(spark, d):
    o, p, before = _gc(spark, d)
    return gc.gc_summary(o, p, gc.gc_candidates(o, p, before, _now()))


@query(HELD + " SELECT path, size FROM objects WHERE path NOT IN (SELECT path FROM im)")
def stale_objects(spark, d):
    o = view(spark, d, "objects")
    return gc.stale_objects(o, o.where(X.is_immutable(F.col("path"))))


@query(HELD + ", x AS (SELECT path, CASE WHEN contains(path, '/R/') THEN 0 WHEN NOT ends_with(path, '.json') THEN 1 WHEN contains(path, '/A/') THEN 3 ELSE 2 END AS r FROM objects) SELECT path, r AS publish_rank FROM x WHERE r > 0")
def publish_order(spark, d):
    """Objects as files of a shard's folder: build scratch, root manifests, other manifests, and content below folders named tmp and _build."""
    name, json = X.basename(F.col("path")), F.col("path").endswith(".json")
    stored = F.when(F.col("path").contains("/R/"), F.concat(F.lit("_build/"), name)).when(~json, F.concat(F.lit("tmp/_build/"), name)).when(F.col("path").contains("/A/"), "manifest.full.json").otherwise(F.concat(F.lit("gen-1/manifest."), name))
    return view(spark, d, "objects").select("path", X.publish_rank(stored).alias("publish_rank")).where("publish_rank > 0")


@query(with_views("objects") + """, s AS (SELECT o_orderkey AS region_id, concat('shards/N/packs/', o_orderkey, '-2.json') AS manifest, o_orderstatus <> 'O' AND o_custkey % 4 <> 0 AS up, o_totalprice > 100000 AS local FROM orders)
SELECT region_id, CASE WHEN NOT up OR manifest IN (SELECT path FROM objects) THEN 'keep' WHEN local THEN 'upload' ELSE 'rebuild' END AS action FROM s""")
def reconcile_remote(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    state = o.select(F.col("o_orderkey").alias("region_id"), F.concat(F.lit("shards/N/packs/"), "o_orderkey", F.lit("-2.json")).alias("manifest"), F.when(F.col("o_orderstatus") != "O", "f").alias("uploaded"), F.when(F.col("o_custkey") % 4 == 0, "g").otherwise("f").alias("built"), (F.col("o_totalprice") > 100000).alias("local_complete"))
    return gc.reconcile_remote(state, view(spark, d, "objects"))


GENERATIONS = "WITH g AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem)"


def _generations(spark, d):
    """Shards whose generations are declared from the shard's folder, by default, or from their own."""
    n, base = F.col("l_linenumber"), F.concat(F.lit("shards/"), "l_orderkey")
    own = F.concat(F.lit("gen-"), n, F.lit("/"))
    manifest = F.when(n % 3 == 0, F.concat(own, F.lit("manifest.min.json"))).when(n % 3 == 2, F.concat(F.lit("./"), own, F.lit("m.json")))
    g = F.struct(F.when(n < 6, own).when(n == 6, "../x/").alias("path"), manifest.alias("manifest"), F.when(n % 2 == 0, "ids.json").alias("id_map"))
    return spark.read.parquet(f"{d}/lineitem.parquet").select(base.alias("base"), n.alias("n"), g.alias("g"))


@query(GENERATIONS + """ SELECT concat('shards/', k) AS base, n, CASE WHEN n = 6 THEN NULL WHEN n >= 7 AND n % 3 = 1 THEN concat('shards/', k, '/manifest.min.json') WHEN n % 3 = 0 OR n % 3 = 1 THEN concat('shards/', k, '/gen-', n, '/manifest.min.json')
WHEN n < 6 THEN concat('shards/', k, '/gen-', n, '/gen-', n, '/m.json') ELSE concat('shards/', k, '/gen-', n, '/m.json') END AS manifest FROM g""")
def generation_manifests(spark, d):
    return _generations(spark, d).distinct().select("base", "n", X.generation_manifest_path(F.col("base"), F.col("g.path"), F.col("g.manifest")).alias("manifest"))


@query(GENERATIONS + """, k AS (SELECT DISTINCT concat('shards/', k, '/') AS b FROM g), e AS (SELECT concat('shards/', k, '/') AS b, n, CASE WHEN n < 6 THEN concat('gen-', n, '/') ELSE '' END AS p FROM g WHERE n <> 6)
SELECT concat(b, unnest(['manifest.json', 'manifest.min.json', 'manifest.full.json', 'ids.json'])) AS path FROM k UNION SELECT concat(b, p, unnest(['manifest.json', 'manifest.min.json'])) FROM e UNION SELECT concat(b, p, 'ids.json') FROM e WHERE n % 2 = 0
UNION SELECT concat(b, 'gen-', n, '/', unnest(['manifest.json', 'manifest.min.json'])) FROM e WHERE n % 3 = 0 UNION SELECT concat(b, 'gen-', n, '/m.json') FROM e WHERE n % 3 = 2""")
def shard_keep_paths(spark, d):
    # By shard first, so that no task has the shards of a whole part of the input in hand.
    rows = _generations(spark, d).repartition("base")
    shards = rows.groupBy("base").agg(F.collect_set(F.when(F.col("n") != 6, F.col("g"))).alias("generations"))
    return gc.shard_keep_paths(shards.select("base", F.lit("ids.json").alias("id_map"), "generations"))


@query("""WITH o AS (SELECT *, concat('s/', o_custkey) AS b FROM orders)
SELECT DISTINCT * FROM (SELECT 'path' AS kind, concat(b, '/manifest-', o_orderkey, '.json') AS value FROM o UNION ALL SELECT 'basename', concat(o_orderkey, '.bin') FROM o UNION ALL SELECT 'path', concat(b, '/docs/', o_orderkey, '.bin') FROM o
UNION ALL SELECT 'basename', concat('y-', o_orderkey % 7, '.bin.gz') FROM o UNION ALL SELECT 'prefix', concat(b, '/pages-', o_orderpriority, '/') FROM o UNION ALL SELECT 'prefix', concat(b, '/deep-', o_orderkey % 5, '/') FROM o
UNION ALL SELECT 'prefix', concat(b, '/authority/hot/') FROM o WHERE o_totalprice > 100000 UNION ALL SELECT 'prefix', concat(b, '/hot/') FROM o WHERE o_totalprice > 100000)""")
def manifest_protections(spark, d):
    """Manifests with references in arrays and at several depths, an unsafe path, and hot prefixes beside directory and root files."""
    text = lambda a, c, b: F.concat(F.lit(a), c, F.lit(b))
    key = F.col("o_orderkey")
    hot = F.when(F.col("o_totalprice") > 100000, 3).otherwise(0).alias("hot_prefixes")
    file = lambda f, name: F.struct(F.lit(f).alias("file")).alias(name)
    deep = F.struct(text("deep-", key % 5, "/").alias("words_path"))
    for level in range(14):
        deep = F.struct(F.array(deep).alias(f"level{level}"))
    body = F.struct(
        F.array(F.struct(text("docs/", key, ".bin").alias("file"), F.lit(1).alias("n"))).alias("packs"),
        F.struct(text("pages-", F.col("o_orderpriority"), "/").alias("pages"), text("x/../y-", key % 7, ".bin.gz").alias("bad")).alias("tree"),
        F.struct(F.struct(hot, file("authority/directory.json", "directory"), file("other/root.json", "root")).alias("autocomplete")).alias("authority"),
        F.array(F.struct(hot, file("lexicon.json", "root"))).alias("suggest"),
        deep.alias("deep"),
    )
    # Bodies are large beside the rows they are made of, which may come in one part.
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice").repartition(2 * spark.sparkContext.defaultParallelism)
    base = F.concat(F.lit("s/"), "o_custkey")
    return gc.manifest_protections(o.select(F.concat(base, F.lit("/manifest-"), key, F.lit(".json")).alias("doc"), base.alias("base"), F.parse_json(F.to_json(body)).alias("body")))


@query("SELECT DISTINCT 'prefix' AS kind, concat('routes/car/', o_custkey, '/') AS value FROM orders WHERE o_orderkey % 3 <> 1 UNION ALL SELECT 'path', 'routes/catalog.json'")
def catalog_protections(spark, d):
    """Bases with and without a slash at the end, and unsafe ones."""
    base = F.concat(F.when(F.col("o_orderkey") % 3 == 1, "routes/../").otherwise("routes/car/"), "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, "/").otherwise(""))
    return gc.catalog_protections(spark.read.parquet(f"{d}/orders.parquet").select(base.alias("base")))


# Status and state ----------------------------------------------------------------------------------------------

FLAGS = with_views("region_state") + ", f AS (SELECT *, coalesce(built = required, false) AS ib, coalesce(built = required AND uploaded = built, false) AS iu FROM region_state)"


@query(FLAGS + """, m AS (SELECT *, coalesce(built IS NOT NULL AND has_manifest, false) AS mb FROM f), n AS (SELECT *, coalesce(mb AND uploaded = built, false) AS mu FROM m),
a AS (SELECT count(*) AS regions, count(*) FILTER (WHERE acquired) AS acquired, count(*) FILTER (WHERE mb) AS built, count(*) FILTER (WHERE mu) AS published, coalesce(sum(docs) FILTER (WHERE mu), 0)::BIGINT AS documents, max(modified) FILTER (WHERE mu) AS data_time,
3 * count(*) FILTER (WHERE mb) AS road_built, 3 * count(*) FILTER (WHERE has_manifest AND uploaded IS NOT DISTINCT FROM built) AS road_uploaded, 3 * count(*) FILTER (WHERE built IS NOT NULL AND NOT has_manifest) AS road_unavailable, CASE WHEN bool_or(failed) THEN 'running' ELSE 'failed' END AS status FROM n)
SELECT *, CASE WHEN status = 'failed' THEN 'failed' WHEN acquired < regions THEN 'acquiring' WHEN built < regions THEN 'building' WHEN published < regions THEN 'publishing' ELSE 'ready' END AS phase, floor(acquired / regions * 1000 + 0.5) / 10 AS acquired_percent, floor(published / regions * 1000 + 0.5) / 10 AS published_percent FROM a""")
def status_snapshot(spark, d):
    """Some regions failed, but the run goes on."""
    _, _, road_state = _roads(spark, d)
    s = view(spark, d, "region_state")
    return status.status_snapshot(s, road_state, s.agg(F.when(F.bool_or("failed"), "running").otherwise("failed").alias("status")))


@query(FLAGS + """, p AS (SELECT region_id FROM region_state WHERE ord % 3 = 1), a AS (SELECT count(*) AS regions, count(*) FILTER (WHERE acquired) AS acquired, count(*) FILTER (WHERE built IS NOT NULL AND has_manifest) AS built, max(modified) FILTER (WHERE region_id IN (SELECT region_id FROM p)) AS data_time FROM f)
SELECT regions, acquired, built, (SELECT count(*) FROM p) AS published, 1234567::BIGINT AS documents, data_time, CASE WHEN acquired < regions THEN 'acquiring' WHEN built < regions THEN 'building' WHEN (SELECT count(*) FROM p) < regions THEN 'publishing' ELSE 'ready' END AS phase FROM a""")
def status_of_published_root(spark, d):
    """With the root as it was published: its regions, and a number of documents of its own."""
    _, _, road_state = _roads(spark, d)
    s = view(spark, d, "region_state")
    root = s.where("ord % 3 = 1").agg(F.collect_list("region_id").alias("region_ids")).select("region_ids", F.lit(None).cast("long").alias("shards"), F.lit(1234567).cast("long").alias("documents"))
    run = s.agg(F.when(F.bool_or("failed"), "running").otherwise("failed").alias("status"))
    return status.status_snapshot(s, road_state, run, root).select("regions", "acquired", "built", "published", "documents", "data_time", "phase")


@query(FLAGS + " SELECT ord, region_id, profile FROM f, (SELECT unnest(['car', 'bike', 'foot']) AS profile, unnest([0, 1, 2]) AS p) WHERE built IS NULL ORDER BY ord, p LIMIT 10")
def next_pending_roads(spark, d):
    s = view(spark, d, "region_state").select("ord", "region_id", "built")
    return status.next_pending_roads(s.select("*", F.posexplode(F.array(F.lit("car"), F.lit("bike"), F.lit("foot"))).alias("profile_ord", "profile")))


@query(FLAGS + " SELECT ord, region_id FROM f WHERE NOT acquired ORDER BY ord LIMIT 10")
def next_pending(spark, d):
    return status.next_pending(view(spark, d, "region_state"))


@query(ROUTED + """, b AS (SELECT t.region_id, count(*) AS docs, concat_ws(',', min(lat)::DECIMAL(9,3), min(lon)::DECIMAL(9,3), max(lat)::DECIMAL(9,3), max(lon)::DECIMAL(9,3)) AS doc_bbox FROM routed t JOIN addr_points p USING (point_id) GROUP BY t.region_id), """ + FLAGS[5:] + """
SELECT f.region_id, concat('shards/', f.region_id, '/') AS path, concat('g', ord % 3) AS groups, CASE WHEN ord % 2 = 0 THEN 'configured' ELSE b.doc_bbox END AS bbox, coalesce(b.docs, 0) AS docs, (sum(coalesce(b.docs, 0)) OVER ())::BIGINT AS total FROM f LEFT JOIN b USING (region_id) WHERE ib""")
def root_summary(spark, d):
    fixed = lambda c: c.cast("decimal(9,3)").cast("string")
    box = F.concat_ws(",", *(fixed(f(c)) for f, c in ((F.min, "lat"), (F.min, "lon"), (F.max, "lat"), (F.max, "lon"))))
    stats = spatial.routed(view(spark, d, "addr_points"), view(spark, d, "place_regions")).groupBy("region_id").agg(F.count("*").alias("docs"), box.alias("doc_bbox"))
    built = view(spark, d, "region_state").where("built = required").select("region_id", F.array(F.concat(F.lit("g"), F.col("ord") % 3)).alias("groups"), F.when(F.col("ord") % 2 == 0, "configured").alias("bbox"))
    return status.root_summary(built, stats).withColumn("groups", F.array_join("groups", ","))


@query(FLAGS + " SELECT region_id, NOT ib AS needs_build, built IS NOT NULL AND NOT coalesce(built = uploaded, false) AS needs_upload FROM f")
def stale_regions(spark, d):
    return delta.stale_regions(view(spark, d, "region_state"))


@query(FLAGS + " SELECT bool_and(acquired) AND bool_or(built IS NULL OR NOT coalesce(built = uploaded, false)) AS bootstrap_pending FROM f")
def bootstrap_pending(spark, d):
    return delta.bootstrap_pending(view(spark, d, "region_state").withColumn("has_corpus", F.col("acquired")))


@query(FLAGS + " SELECT region_id, CASE WHEN docs > 300 THEN docs WHEN ord = 1 THEN 7 WHEN ord = 2 THEN 8 ELSE 0 END AS docs, coalesce(built, required) AS version, ord AS bytes FROM f")
def hydrate_state(spark, d):
    s = view(spark, d, "region_state")
    own = s.select("region_id", F.when(F.col("docs") > 300, F.col("docs")).alias("docs"), F.col("built").alias("version"), F.lit(0).alias("bytes"))
    meta = s.select("region_id", F.when(F.col("ord") == 1, 7).alias("enriched_docs"), F.when(F.col("ord") == 2, 8).alias("extract_docs"), F.lit(0).alias("manifest_docs"), F.col("required").alias("meta_version"), F.col("ord").alias("meta_bytes"))
    return delta.hydrate_state(own, meta)


@query(FLAGS + " SELECT region_id FROM f WHERE NOT failed AND acquired")
def resume_state(spark, d):
    s = view(spark, d, "region_state")
    done = s.where("acquired").agg(F.concat(F.collect_list("region_id"), F.array(F.lit("gone"))).alias("completed"))
    previous = done.select(F.lit("a").alias("signature"), F.lit(1).alias("schema"), "completed").union(done.select(F.lit("b"), F.lit(1), F.array(F.lit("algeria"))))
    return delta.resume_state(previous, s.where("not failed"), "a")


@query("""SELECT o_orderkey AS source_id, CASE WHEN o_orderstatus = 'P' THEN true WHEN o_custkey % 2 = 0 THEN o_custkey % 4 = 0 ELSE o_totalprice > 100000 AND o_custkey % 3 <> 0 END AS changed FROM orders""")
def source_changed(spark, d):
    o, c = spark.read.parquet(f"{d}/orders.parquet"), F.col
    even, price = c("o_custkey") % 2 == 0, F.floor("o_totalprice")
    return delta.source_changed(
        o.select(
            c("o_orderkey").alias("source_id"), F.lit("x").alias("prev_config"), F.when(c("o_orderstatus") == "P", "y").otherwise("x").alias("config"), F.when(even, "e").alias("prev_etag"), F.when(even, F.when(c("o_custkey") % 4 == 0, "f").otherwise("e")).alias("etag"),
            c("o_orderdate").alias("prev_modified"), c("o_orderdate").alias("modified"), price.alias("prev_bytes"), F.when(c("o_custkey") % 3 == 0, 0).when(c("o_totalprice") > 100000, price + 1).otherwise(price).alias("bytes"),
        )
    )


@query("""SELECT o_orderkey AS source_id, sha256(concat('{"date":', epoch(o_orderdate)::BIGINT, ',"key":"', o_orderkey, ':0","status":"', o_orderstatus, '"}')) AS fingerprint, concat('i', o_orderkey, ':2:', o_orderstatus, ':b1') AS shard FROM orders""")
def fingerprints(spark, d):
    o, c = spark.read.parquet(f"{d}/orders.parquet"), F.col
    content = X.content_fingerprint(F.concat(F.lit("i"), c("o_orderkey")), F.lit(2), c("o_orderstatus"))
    return o.select(c("o_orderkey").alias("source_id"), X.fingerprint(status=c("o_orderstatus"), key=X.job_key(c("o_orderkey"), F.lit(None).cast("long")), date=F.unix_seconds(F.to_timestamp("o_orderdate"))).alias("fingerprint"), X.shard_fingerprint(content, F.lit("b1")).alias("shard"))


@query(with_views("region_state") + """ SELECT region_id, profile, sha256(concat('{"format":"g1","options":"o","schema":1,"source":"', sha256(concat('{"format":"f2","neighbors":["a","b"],"profile":"', profile, '","schema":1,"source":"', required, '","turn_costs":', CASE WHEN profile = 'car' THEN 'true' ELSE 'false' END, ',"version":"v1"}')), '","version":"v1"}')) AS fingerprint
FROM region_state, (SELECT unnest(['car', 'bike', 'foot']) AS profile)""")
def road_fingerprints(spark, d):
    _, profiles, _ = _roads(spark, d)
    source = X.road_source_fingerprint(F.lit(1), F.lit("f2"), F.col("required"), F.col("profile"), F.col("profile") == "car", F.array(F.lit("b"), F.lit("a")), F.lit("v1"))
    rows = view(spark, d, "region_state").crossJoin(profiles)
    return rows.select("region_id", "profile", X.road_index_fingerprint(F.lit(1), F.lit("g1"), source, F.lit("v1"), F.lit("o")).alias("fingerprint"))


@query("""SELECT o_orderkey AS region_id, array_to_string(list_filter([CASE WHEN o_orderstatus = 'P' THEN 'schema' END, CASE WHEN o_totalprice < 50000 THEN 'documents' END, CASE WHEN o_custkey % 3 = 0 THEN 'source' END, CASE WHEN o_custkey % 5 = 0 THEN 'output' END], lambda x: x IS NOT NULL), ',') AS reasons,
o_orderstatus <> 'P' AND o_totalprice >= 50000 AND o_custkey % 3 <> 0 AND o_custkey % 5 <> 0 AS valid FROM orders""")
def corpus_validity(spark, d):
    o, c = spark.read.parquet(f"{d}/orders.parquet"), F.col
    state = o.select(
        c("o_orderkey").alias("region_id"), F.when(c("o_orderstatus") != "P", 1).alias("schema"), F.when(c("o_totalprice") >= 50000, 5).alias("total_docs"), F.lit("a").alias("identity"), F.when(c("o_custkey") % 3 != 0, "a").alias("meta_identity"),
        F.lit(None).cast("string").alias("addresses"), F.lit(None).cast("string").alias("meta_addresses"), (c("o_custkey") % 5 != 0).alias("has_output"),
    )
    return delta.corpus_validity(state).select("region_id", F.array_join("reasons", ",").alias("reasons"), "valid")


@query("SELECT o_orderkey AS source_id, CASE WHEN o_orderstatus <> 'P' THEN epoch(date_trunc('second', o_orderdate))::BIGINT END AS modified, concat('{\"license\":\"', o_orderpriority, '\"}') AS metadata FROM orders")
def source_versions(spark, d):
    o, c = spark.read.parquet(f"{d}/orders.parquet"), F.col
    http = F.when(c("o_orderstatus") == "P", F.lit("yesterday")).otherwise(F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
    return o.select(c("o_orderkey").alias("source_id"), F.unix_seconds(X.http_date(http)).alias("modified"), X.source_metadata(license=c("o_orderpriority"), attribution=F.lit(" "), url=F.lit(None)).alias("metadata"))


@query(with_views("place_regions") + f" SELECT sha256(concat('1:events:', {digest_sql("concat_ws(';', region_id, concat_ws('|', region_id, min_lat::BIGINT, min_lon::BIGINT, max_lat::BIGINT, max_lon::BIGINT, country_code, subdivision_code))")})) AS identity FROM place_regions")
def partition_identity(spark, d):
    r = view(spark, d, "place_regions")
    whole = r.select("region_id", *(F.col(c).cast("long").alias(c) for c in ("min_lat", "min_lon", "max_lat", "max_lon")), "country_code", "subdivision_code")
    return identity.partition_identity("events", 1, whole)


@query(with_views("objects") + """, p AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, concat('shards/', l_returnflag, '/packs/', l_orderkey, '-', l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN '.gone' WHEN l_linenumber % 3 = 0 THEN '.bin' WHEN l_linenumber % 3 = 1 THEN '.bin.gz' ELSE '.json' END) AS path FROM lineitem),
lost AS (SELECT DISTINCT k FROM p WHERE k % 14 = 0 AND path NOT IN (SELECT path FROM objects))
SELECT o_orderkey AS source_id, o_orderstatus <> 'F' AND o_orderkey IN (SELECT k FROM p) AND o_orderkey NOT IN (SELECT k FROM lost) AS reusable FROM orders""")
def reusable_partitions(spark, d):
    """Sources by order, some with a new identity, some whose output is gone: where that held no records, they can be used still."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    end = F.when(k % 7 == 0, ".gone").when(n % 3 == 0, ".bin").when(n % 3 == 1, ".bin.gz").otherwise(".json")
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    prior = lines.select(k.alias("source_id"), F.concat(F.lit("i"), k).alias("identity"), F.concat(F.lit("shards/"), "l_returnflag", F.lit("/packs/"), k, F.lit("-"), n, end).alias("path"), F.when(k % 14 == 0, 5).otherwise(F.when(k % 7 == 0, 0).otherwise(1)).alias("n"))
    o = spark.read.parquet(f"{d}/orders.parquet")
    now = o.select(F.col("o_orderkey").alias("source_id"), F.concat(F.when(F.col("o_orderstatus") == "F", "new").otherwise("i"), "o_orderkey").alias("identity"))
    return identity.reusable_partitions(prior, now, view(spark, d, "objects"))


@query(FLAGS + f" SELECT sha256(concat('3:', {digest_sql("concat_ws(';', region_id, concat_ws('=', region_id, required))")})) AS fingerprint FROM region_state")
def routing_fingerprint(spark, d):
    return identity.routing_fingerprint(view(spark, d, "region_state").select("region_id", F.col("required").alias("content")), 3)


@query(f"SELECT n_nationkey AS region_id, {digest_sql("concat_ws(';', s_suppkey, concat('s', s_suppkey, '=', s_name))")} AS identity FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY n_nationkey")
def region_source_identity(spark, d):
    s, n = spark.read.parquet(f"{d}/supplier.parquet"), spark.read.parquet(f"{d}/nation.parquet")
    return identity.region_source_identity(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_nationkey").alias("region_id"), F.col("s_suppkey").alias("ord"), F.concat(F.lit("s"), "s_suppkey").alias("source_id"), F.col("s_name").alias("identity")))


# Sources, sinks and streams --------------------------------------------------------------------------------------


@query(ROUTED + " SELECT r.region_id, count(*) AS n, count(DISTINCT point_id) AS points FROM routed r GROUP BY r.region_id")
def io_roundtrip(spark, d):
    """Routed records written as gzip JSON lines by region, and read again."""
    out = new_path(spark, "regions")
    write_region_partitions(view(spark, d, "addr_points").join(_routed(spark, d), "point_id"), out)
    rows = spark.read.schema("point_id long, region_id string").json(out)
    return rows.groupBy("region_id").agg(F.count("*").alias("n"), F.countDistinct("point_id").alias("points"))


def _points(events: DataFrame, *more: str) -> DataFrame:
    """Events as points, by the expressions of addr_points."""
    spec = {"lat": "CASE WHEN event_id % 97 = 0 THEN CAST(95 AS DOUBLE) ELSE CAST(event_id * 7919 % 180001 AS DOUBLE) / 1000 - 90 END", "lon": "CAST(event_id * 104729 % 360001 AS DOUBLE) / 1000 - 180"}
    return events.selectExpr("event_id as point_id", *(f"{v} as {k}" for k, v in spec.items()), "CASE event_id % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'US' WHEN 2 THEN 'ca ' ELSE 'Canada' END as country", "CASE user_id % 4 WHEN 0 THEN 'QC' WHEN 1 THEN 'CA-ON' WHEN 2 THEN 'vt' ELSE '' END as state", "event_type as kind", *more)


def _stream(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    return _points(spark.readStream.schema(events.schema).option("pathGlobFilter", "*events*.parquet").parquet(d))


@query(ROUTED + " SELECT r.region_id, count(*) AS n FROM routed r GROUP BY r.region_id")
def partition_stream(spark, d):
    """Events as a stream, routed once each, although the stream is started twice on its checkpoint."""
    at = new_path(spark, "stream")
    for _ in range(2):
        start_partition_stream(_stream(spark, d), view(spark, d, "place_regions"), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return read_partitions(spark, f"{at}/out").groupBy("region_id").agg(F.count("*").alias("n"))


@query("SELECT event_type AS kind, count(*) AS n FROM events GROUP BY event_type")
def counters_stream(spark, d):
    at = new_path(spark, "counters")
    start_counters_stream(_stream(spark, d), "kind", f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return latest_counters(spark, f"{at}/out").select("kind", "n")


#: Rows in a file of a job.
FILE_ROWS = 500_000


@query(ROUTED + """, o AS (SELECT region_id, point_id, row_number() OVER (PARTITION BY region_id ORDER BY user_id % 3, value DESC, point_id) AS pos FROM routed JOIN events ON event_id = point_id) SELECT region_id, point_id, pos FROM o""")
def partition_order(spark, d):
    """Events as three jobs, rows by value in each, one job a batch. The second batch breaks off before its record and is run again: each row is there once, in the order of batches, jobs and rows."""
    at = new_path(spark, "order")
    events = spark.read.parquet(f"{d}/events.parquet")
    regions_ = view(spark, d, "place_regions")

    def power_cut(batch_id: int) -> None:
        raise RuntimeError("power cut")

    # A job is as many files as its size asks for, in order of their names; what has come since the last batch is one batch.
    files = -(-events.count() // (3 * FILE_ROWS)) or 1
    for job in range(3):
        events.where(F.col("user_id") % 3 == job).repartitionByRange(files, F.col("value").desc(), "event_id").sortWithinPartitions(F.col("value").desc(), "event_id").write.mode("append").parquet(f"{at}/in/")
        stream = _points(spark.readStream.schema(events.schema).parquet(f"{at}/in").select("*", F.col("_metadata.file_name").alias("source"), F.col("_metadata.row_index").alias("ord")), "source", "ord")
        for cut in (power_cut, None) if job == 1 else (None,):
            with contextlib.suppress(StreamingQueryException) if cut else contextlib.nullcontext():
                start_partition_stream(stream, regions_, f"{at}/out", f"{at}/checkpoint", before_commit=cut).awaitTermination()
    return ordered_partitions(spark, f"{at}/out").select("region_id", "point_id", "pos")


@query(ROUTED + """, n AS (SELECT count(*) AS rows_read, count(*) FILTER (WHERE lat BETWEEN -90 AND 90) AS normalized FROM addr_points) SELECT 0::BIGINT AS batch_id, rows_read, normalized, normalized - (SELECT count(DISTINCT point_id) FROM routed) AS unmatched, (SELECT count(*) FROM routed) AS writes FROM n""")
def stream_counters_log(spark, d):
    """Counters of the batches of a stream, from its log."""
    at = new_path(spark, "stream")
    start_partition_stream(_stream(spark, d), view(spark, d, "place_regions"), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return stream_counters(spark, f"{at}/out")


GRACE = """WITH e AS (SELECT concat('o', user_id) AS path, epoch_us(ts) // 1000 AS t, event_type = 'purchase' AS used FROM events), u AS (SELECT path, max(t) FILTER (WHERE used) AS last_used, max(t) AS last FROM e GROUP BY path),
f AS (SELECT e.path, min(t) AS first FROM e JOIN u USING (path) WHERE NOT used AND (last_used IS NULL OR t > last_used) GROUP BY e.path)"""


def _grace(spark, d, make, *columns):
    """The last candidate of each path from a stream of events as listings of objects, by user; a purchase is a reference."""
    at = new_path(spark, "grace")
    events = spark.read.parquet(f"{d}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "*events*.parquet").parquet(d)
    listings = stream.select(F.concat(F.lit("o"), "user_id").alias("path"), *columns, (F.col("event_type") == "purchase").alias("referenced"))
    write = lambda batch, n: versions.commit(spark, at, str(n), lambda path: batch.write.parquet(path))
    make(listings).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = None
    for r in versions.commits(spark, at):
        batch = spark.read.schema(grace.CANDIDATE).parquet(f"{at}/{r['path']}").withColumn("batch", F.lit(int(r["label"])))
        out = batch if out is None else out.unionByName(batch)
    return out.groupBy("path").agg(F.max_by(F.struct("first_seen_ms", "last_seen_ms", "eligible"), "batch").alias("s")).select("path", "s.*")


@query(GRACE + " SELECT path, first AS first_seen_ms, last AS last_seen_ms, last - first >= 7 * 86400000 AS eligible FROM f JOIN u USING (path)")
def grace_stream(spark, d):
    return _grace(spark, d, grace.grace_stream, F.unix_millis(F.col("ts").cast("timestamp")).alias("seen_ms"))


@query(GRACE + " SELECT path, first AS first_seen_ms, last AS last_seen_ms, last - first >= 7 * 86400000 OR first + 7 * 86400000 <= (SELECT max(t) FROM e) AS eligible FROM f JOIN u USING (path)")
def grace_timers(spark, d):
    """With timers: a path turns eligible once the stream's time passes the end of its grace period, without a further row of its own."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, grace.ROCKSDB)
    try:
        return _grace(spark, d, grace.grace_timers, F.col("ts").cast("timestamp").alias("seen"))
    finally:
        spark.conf.set(key, before)


@query(with_views("addresses") + " SELECT concat('job-', addr_id % 4) AS job, addr_id, postcode, street, lat FROM addresses")
def record_producer(spark, d):
    """Customers as the records of four jobs, read through a producer of the caller's by a stream that is stopped after two jobs and goes on from its offset when there are four."""
    at = new_path(spark, "producer")
    rows = view(spark, d, "addresses").select(F.concat(F.lit("job-"), F.col("addr_id") % 4).alias("job"), "addr_id", "postcode", "street", "lat")
    line = F.to_json(F.struct("addr_id", "postcode", "street", "lat"))
    rows.select(F.concat("job", F.lit("-x")).alias("job"), line.alias("value")).repartition("job").write.partitionBy("job").text(f"{at}/jobs")
    folder, name = f"{versions.qualified(spark, at)}/jobs", f"records_{uuid.uuid4().hex}"

    def lines(job: str):
        from pyarrow.fs import FileSelector, FileSystem

        fs, base = FileSystem.from_uri(folder)
        for info in sorted(fs.get_file_info(FileSelector(f"{base}/job={job}-x")), key=lambda i: i.path):
            if info.base_name.startswith("part-"):
                with fs.open_input_stream(info.path) as f:
                    for raw in f.read().splitlines():
                        r = json.loads(raw)
                        yield job, r["addr_id"], r["postcode"], r["street"], r["lat"]

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/batch_id={n}")

    for jobs in (["job-2", "job-0"], ["job-2", "job-0", "job-3", "job-1"]):
        spark.dataSource.register(record_source(name, "job string, addr_id long, postcode string, street string, lat double", lambda jobs=jobs: jobs, lines))
        spark.readStream.format(name).load().writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out").select("job", "addr_id", "postcode", "street", "lat")


ADDRESS_ROWS = with_views("addresses")


@query(ADDRESS_ROWS + " SELECT concat('a', addr_id) AS id, trim(country) AS country, postcode, street, house_number, lat, lon FROM addresses")
def delimited_addresses(spark, d):
    """Customers as a file of semicolons, read by column numbers; the country comes from a default where it is blank."""
    at = new_path(spark, "delimited")
    a = view(spark, d, "addresses")
    a.select(F.concat(F.lit("a"), "addr_id"), F.when(F.trim("country") == "us", "").otherwise(F.col("country")), "postcode", "street", "house_number", "lat", "lon").write.csv(at, sep=";")
    fields = ["id", "country", "postcode", "street", "house_number", "lat", "lon"]
    return readers.read_delimited_addresses(spark, at, {f: i for i, f in enumerate(fields)}, sep=";", defaults={"country": "us"}).select(fields)


@query(ADDRESS_ROWS + " SELECT concat('ca/qc/addresses/city/', addr_id) AS id, 'CA' AS country, postcode, street, house_number, lat, lon, 'sources/ca/qc.json' AS url FROM addresses WHERE addr_id % 5 <> 0")
def geojson_addresses(spark, d):
    """Customers as newline GeoJSON; lines and points without coordinates are dropped."""
    at = new_path(spark, "geojson")
    a = view(spark, d, "addresses")
    point = F.struct(F.when(F.col("addr_id") % 10 == 5, "LineString").otherwise("Point").alias("type"), F.when(F.col("addr_id") % 10 != 0, F.array("lon", "lat")).otherwise(F.array("lon")).alias("coordinates"))
    properties = F.struct(F.col("addr_id").cast("string").alias("hash"), F.col("house_number").alias("number"), "street", "postcode")
    a.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), point.alias("geometry")))).write.text(at)
    return readers.read_geojson_addresses(spark, at, "ca/qc", "addresses", "city").select("id", "country", "postcode", "street", "house_number", "lat", "lon", "url")


@query(DIFF + " SELECT 'snapshot' AS kind, concat('d', seq) AS doc_id, raw FROM snapshot_lines UNION ALL SELECT 'delta', doc_id, raw FROM diff WHERE change IN ('changed', 'added')")
def corpus_files(spark, d):
    """A snapshot and a delta written as lines and read again."""
    at = new_path(spark, "corpus")
    snapshot = readers.read_corpus(spark, writers.write_snapshot(view(spark, d, "snapshot_lines"), at, "1"))
    writers.write_delta(delta.delta_lines(_diff(spark, d)), f"{at}/delta")
    return snapshot.withColumn("kind", F.lit("snapshot")).unionByName(readers.read_corpus(spark, f"{at}/delta").withColumn("kind", F.lit("delta"))).select("kind", "doc_id", "raw")


@query(with_views("place_regions") + " SELECT region_id, min_lat, min_lon, max_lat, max_lon, country_code AS codes, k <> 7 AS road_indexes FROM place_regions")
def region_files(spark, d):
    """Regions as a JSON array; ids come from paths."""
    at = new_path(spark, "regions")
    r = view(spark, d, "place_regions")
    row = F.struct(F.concat(F.lit("x/"), "region_id").alias("path"), F.array("min_lat", "min_lon", "max_lat", "max_lon").alias("bbox"), F.array(F.lower("country_code")).alias("countryCodes"), F.when(F.col("k") == 7, False).alias("roadIndexes"))
    r.agg(F.to_json(F.collect_list(row)).alias("value")).write.text(at)
    return readers.read_regions(spark, at).select("region_id", *spatial.BOX, F.array_join("country_codes", ",").alias("codes"), "road_indexes")


@query(with_views("place_regions") + " SELECT region_id AS id, min_lat, min_lon, max_lat, max_lon FROM place_regions")
def feature_coverage(spark, d):
    """Region features as polygons; their boxes again from the positions. A box over the antimeridian has a position on its far side."""
    at = new_path(spark, "features")
    r = view(spark, d, "place_regions")
    at_ = lambda lon, lat: F.array(F.col(lon) if isinstance(lon, str) else lon, F.col(lat))
    # Between both ends, so that the largest gap is outside.
    width = F.when(F.col("max_lon") < F.col("min_lon"), F.col("max_lon") - F.col("min_lon") + 360).otherwise(F.col("max_lon") - F.col("min_lon"))
    middle = X.normalize_lon(F.col("min_lon") + width / 2)
    ring = F.array(at_("min_lon", "min_lat"), at_(middle, "min_lat"), at_("max_lon", "min_lat"), at_("max_lon", "max_lat"), at_("min_lon", "max_lat"), at_("min_lon", "min_lat"))
    geometry = F.when(F.col("k") % 2 == 0, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring)).alias("coordinates"))))
    feature = F.concat(F.lit('{"properties":{"id":"'), "region_id", F.lit('"},"geometry":'), geometry, F.lit("}"))
    r.agg(F.concat(F.lit('{"features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value")).write.text(at)
    return spatial.coverage_bbox(spatial.geometry_positions(readers.read_region_features(spark, at), "id"), "id")


@query("SELECT DISTINCT concat(o_orderkey % 50, '-live.bin') AS value FROM orders")
def manifest_files(spark, d):
    """Names from orders written as one JSON document, found in a listing by its path, and read as a manifest; the names of binary files in it."""
    at = new_path(spark, "manifests")
    names = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.col("o_orderkey") % 50, F.lit("-live.bin")).alias("name"))
    writers.write_document(names.agg(F.array_sort(F.collect_set("name")).alias("packs")), f"{at}/sub")
    listed = readers.read_object_listing(spark, at).where("size > 0").select("path")
    read = readers.read_manifests(spark, at, "part-*")
    whole = read.join(listed, F.col("doc") == F.col("path"), "left_semi")
    return gc.manifest_protections(whole).where("kind = 'basename'").select("value")


STORE = """WITH o AS (SELECT DISTINCT l_returnflag AS f, l_partkey % 20 AS k, l_linenumber % 3 AS t FROM lineitem), files AS (SELECT concat('shards/', f, CASE t WHEN 0 THEN '/packs/' WHEN 1 THEN '/pages/' ELSE '/authority/hot/' END, f, t, '-', k, CASE WHEN k % 2 = 0 THEN '.bin' ELSE '.bin.gz' END) AS path, f, k, t FROM o)"""


@query(STORE + """ SELECT path, length(path)::BIGINT AS size FROM files WHERE NOT (t = 0 AND (k % 4 = 0 OR (f = 'N' AND k % 5 = 1))) AND NOT (t = 1 AND f <> 'R') AND NOT (t = 2 AND f = 'A')""")
def garbage_of_files(spark, d):
    """Objects and manifests as files of one store, listed and read from its root: packs are held by name or path, pages by their folder, hot lists by the root beside them; the manifests hold themselves."""
    at = new_path(spark, "store")
    flag, k, t = F.col("l_returnflag"), F.col("l_partkey") % 20, F.col("l_linenumber") % 3
    shard = F.concat(F.lit("shards/"), "f")
    end = F.when(F.col("k") % 2 == 0, ".bin").otherwise(".bin.gz")
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select(flag.alias("f"), k.alias("k"), t.alias("t")).distinct()
    files = rows.select(F.concat(shard, F.when(F.col("t") == 0, "/packs/").when(F.col("t") == 1, "/pages/").otherwise("/authority/hot/"), "f", "t", F.lit("-"), "k", end).alias("path"))
    name = F.concat("f", "t", F.lit("-"), "k")
    pack = F.when(F.col("k") % 4 == 0, F.concat(name, end)).when((F.col("f") == "N") & (F.col("k") % 5 == 1), F.concat(F.lit("./packs//"), name, end))
    held = rows.where("t = 0").groupBy("f").agg(F.array_sort(F.collect_set(F.when(F.col("k") % 4 == 0, pack))).alias("names"), F.array_sort(F.collect_set(F.when(F.col("k") % 4 != 0, pack))).alias("paths"))
    body = F.struct("names", "paths", F.when(F.col("f") != "R", "./pages/").alias("pages"), F.lit("./").alias("up_path"), F.struct(F.when(F.col("f") == "A", "0x5").otherwise("0").alias("hot_prefixes"), F.struct(F.lit("authority/root.json").alias("file")).alias("root")).alias("authority"))
    manifests = held.select(F.concat(shard, F.lit("/manifest.min.json")).alias("path"), F.to_json(body).cast("binary").alias("content"))
    writers.write_objects(files.select("path", F.col("path").cast("binary").alias("content")).unionByName(manifests), at).write.format("noop").mode("overwrite").save()
    listing = readers.read_object_listing(spark, at)
    never = spark.createDataFrame([], "path string, first_seen string")
    return gc.prune_candidates(listing, gc.manifest_protections(readers.read_manifests(spark, at)), never, _now()).select("path", "size")


@query(FLAGS + " SELECT region_id, docs, built FROM f WHERE ord % 2 = 0")
def state_table(spark, d):
    """The state saved twice, then a save that breaks off; the latest whole version is what is read."""
    at = new_path(spark, "state")
    s = view(spark, d, "region_state").select("region_id", "docs", "built", "ord")
    for version, rows in enumerate((s, s.where("ord % 2 = 0"))):
        writers.save_state(rows.drop("ord"), at, version)
    s.where("ord = 1").drop("ord").write.parquet(f"{at}/{versions.DATA}/2-interrupted/_temporary/0")
    return writers.load_state(spark, at, "region_id string, docs long, built string").select("region_id", F.col("docs").cast("int").alias("docs"), "built")


@query(with_views("snapshot_lines", "fresh_lines") + " SELECT 'held' AS kind, raw FROM snapshot_lines UNION ALL SELECT 'current', raw FROM fresh_lines")
def snapshot_versions(spark, d):
    """Three snapshots, the first of them held by a reader while old ones are deleted; what that reader and a new one read."""
    at = new_path(spark, "snapshots")
    lines = view(spark, d, "snapshot_lines")
    first = writers.write_snapshot(lines, at, "a")
    versions.lease(spark, at, versions.current(spark, at)["number"])
    for label, rows in (("b", lines.limit(0)), ("c", view(spark, d, "fresh_lines"))):
        writers.write_snapshot(rows, at, label)
    versions.vacuum(spark, at, keep=1)
    read = lambda kind, path: readers.read_corpus(spark, path).select(F.lit(kind).alias("kind"), "raw")
    return read("held", first).unionByName(read("current", writers.current_snapshot(spark, at)))


@query("""WITH c AS (SELECT o_orderkey AS source_id, concat('{"applies":{"groups":["a","g', o_custkey % 3, '"],"ids":["x"]},"defaults":{"country":"', o_orderpriority, '","zone":"z"},"header":', CASE WHEN o_orderstatus = 'P' THEN 'true' ELSE 'false' END, ',"size":', o_orderkey, '}') AS j FROM orders) SELECT source_id, sha256(j) AS fingerprint, 'struct,map,variant' AS kinds FROM c""")
def nested_fingerprints(spark, d):
    """One configuration of each order as structs, as maps and as VARIANT, with names in unlike order: one fingerprint."""
    o, c = spark.read.parquet(f"{d}/orders.parquet"), F.col
    groups, header = F.array(F.lit("a"), F.concat(F.lit("g"), c("o_custkey") % 3)), c("o_orderstatus") == "P"
    s = lambda **k: F.struct(*(v.alias(n) for n, v in k.items()))
    structs = o.select(c("o_orderkey").alias("source_id"), c("o_orderkey").alias("size"), s(zone=F.lit("z"), country=c("o_orderpriority")).alias("defaults"), header.alias("header"), s(ids=F.array(F.lit("x")), groups=groups, none=F.lit(None).cast("string")).alias("applies"))
    maps = o.select(c("o_orderkey").alias("source_id"), header.alias("header"), F.create_map(F.lit("zone"), F.lit("z"), F.lit("country"), c("o_orderpriority"), F.lit("none"), F.lit(None)).alias("defaults"), F.create_map(F.lit("ids"), F.array(F.lit("x")), F.lit("groups"), groups).alias("applies"), c("o_orderkey").alias("size"))
    text = structs.select("source_id", F.to_json(F.struct("size", "defaults", "header", s(ids=F.col("applies.ids"), groups=F.col("applies.groups")).alias("applies"))).alias("j"))
    variants = text.select("source_id", F.parse_json("j").alias("v"))
    fields = ("applies", "defaults", "header", "size")
    each = [("struct", structs, X.nested_fingerprint(structs, *fields)), ("map", maps, X.nested_fingerprint(maps, *fields)), ("variant", variants, F.sha2(X.canonical(c("v"), variants.schema["v"].dataType), 256))]
    out = [df.select("source_id", F.lit(kind).alias("kind"), print_.alias("fingerprint")) for kind, df, print_ in each]
    order = F.when(c("kind") == "struct", 0).when(c("kind") == "map", 1).otherwise(2)
    return out[0].unionByName(out[1]).unionByName(out[2]).groupBy("source_id", "fingerprint").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "kind"))), lambda x: x["kind"]), ",").alias("kinds"))


@query(with_views("corpus") + """, t AS (SELECT count(*) AS total, count(*) FILTER (WHERE doc_id % 2 = 0) AS old FROM corpus), own AS (SELECT DISTINCT region_id FROM corpus),
c(forced, stats, total, old) AS (SELECT true, (SELECT list(region_id) FROM own), total, total FROM t UNION ALL SELECT false, [], total, total FROM t UNION ALL SELECT false, (SELECT list(region_id) FROM own WHERE region_id <> 'en'), total, total FROM t
UNION ALL SELECT false, (SELECT list(region_id) FROM own), total, old FROM t UNION ALL SELECT false, (SELECT list(region_id) FROM own), total, total FROM t)
SELECT CASE WHEN forced THEN 'forced' WHEN len(stats) = 0 THEN 'missing' WHEN len(stats) <> (SELECT count(*) FROM own) OR len(list_intersect(stats, (SELECT list(region_id) FROM own))) <> len(stats) THEN 'regions' WHEN abs(total - old) / greatest(1, old) > 0.1::DOUBLE THEN 'drift' ELSE 'none' END AS reason FROM c""")
def stats_reasons(spark, d):
    """Totals of documents against those of some sources, with the regions of both."""
    c = view(spark, d, "corpus")
    own, less = c.select("region_id").distinct(), c.where("region_id <> 'en'").select("region_id").distinct()
    n, old = c.agg(F.count("*").alias("total")), c.where("doc_id % 2 = 0").agg(F.count("*").alias("old_total"))
    same = n.withColumn("old_total", F.col("total"))
    of = lambda stats, totals, forced: delta.stats_reasons(own, stats, totals.withColumn("forced", F.lit(forced)))
    all_ = [of(own, same, True), of(own.limit(0), same, False), of(less, same, False), of(own, n.join(old), False), of(own, same, False)]
    out = all_[0]
    for x in all_[1:]:
        out = out.unionByName(x)
    return out.select(F.coalesce("reason", F.lit("none")).alias("reason"))


@query("SELECT o_custkey AS region_id, coalesce(sum(o_orderkey % 7) FILTER (WHERE o_orderkey > b), 0)::BIGINT AS deleted_pending FROM (SELECT *, coalesce(max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) OVER (PARTITION BY o_custkey), -1) AS b FROM orders) GROUP BY o_custkey")
def deleted_pending(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return delta.deleted_pending(o.select(F.col("o_custkey").alias("region_id"), F.col("o_orderkey").alias("generation"), (F.col("o_orderstatus") == "F").alias("full"), (F.col("o_orderkey") % 7).cast("long").alias("deleted")))


@query("SELECT o_orderkey AS source_id, least(8, greatest(1, ceil(floor(o_totalprice * 10000) / 536870912)))::INTEGER AS partitions FROM orders")
def road_partitions(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("source_id"), X.road_partitions(F.floor(F.col("o_totalprice") * 10000)).alias("partitions"))


@query(ADDRESS_ROWS + " SELECT addr_id, upper(trim(country)) AS country FROM addresses WHERE lat > 42 AND addr_id % 3 <> 0")
def normalized_addresses(spark, d):
    """Records after a normaliser and a predicate of the caller's."""
    own = lambda rows: rows.where("lat > 42").withColumn("country", F.upper(X.clean(F.col("country"))))
    return enrich.normalized(view(spark, d, "addresses"), own, lambda rows: F.col("addr_id") % 3 != 0).select("addr_id", "country")
