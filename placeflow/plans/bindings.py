"""The engine's inputs as views over the driver's tables. The SQL is plain enough for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS: dict[str, str] = {
    "addr_points": """SELECT event_id AS point_id, CASE WHEN event_id % 97 = 0 THEN CAST(95 AS DOUBLE) ELSE CAST(event_id * 7919 % 180001 AS DOUBLE) / 1000 - 90 END AS lat,
        CAST(event_id * 104729 % 360001 AS DOUBLE) / 1000 - 180 AS lon, CASE event_id % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'US' WHEN 2 THEN 'ca ' ELSE 'Canada' END AS country,
        CASE user_id % 4 WHEN 0 THEN 'QC' WHEN 1 THEN 'CA-ON' WHEN 2 THEN 'vt' ELSE '' END AS state, event_type AS kind FROM {events}""",
    "place_regions": """SELECT lower(n_name) AS region_id, k, min_lat, least(CAST(90 AS DOUBLE), min_lat + 40) AS max_lat, min_lon, CASE WHEN c = 4 THEN CAST(-172 AS DOUBLE) ELSE min_lon + 80 END AS max_lon,
        CASE k % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'US' ELSE '' END AS country_code, CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN 'CA-QC' WHEN k % 3 = 0 THEN 'CA-ON' WHEN k % 3 = 1 THEN 'US-VT' ELSE '' END AS subdivision_code, n_regionkey
        FROM (SELECT n_name, n_nationkey AS k, n_regionkey, (n_nationkey - n_nationkey % 5) / 5 AS c, CAST(-90 + 36 * (n_nationkey % 5) AS DOUBLE) AS min_lat, CAST(-180 + 72 * ((n_nationkey - n_nationkey % 5) / 5) AS DOUBLE) AS min_lon FROM {nation})""",
    # The fresh corpus lost one source, gained another, and has short texts changed.
    "snapshot_lines": """SELECT doc_id AS seq, concat('{{"id":"d', doc_id, '","h":"', md5(coalesce(text, '')), '"}}') AS raw, lang FROM {documents} WHERE source <> 'src3'""",
    "fresh_lines": """SELECT doc_id AS seq, concat('{{"id":"d', doc_id, '","h":"', CASE WHEN n_chars < 500 THEN 'changed' ELSE md5(coalesce(text, '')) END, '"}}') AS raw, lang FROM {documents} WHERE source <> 'src5'""",
    "addresses": """SELECT c_custkey AS addr_id, CASE WHEN c_nationkey % 2 = 0 THEN 'CA' ELSE 'us ' END AS country, concat('P', c_custkey % 40) AS postcode, concat('Street ', c_custkey % 20) AS street, CAST(c_custkey % 25 AS STRING) AS house_number,
        c_mktsegment AS city, CAST(c_custkey % 9 + 40 AS DOUBLE) AS lat, CAST(c_custkey % 11 - 80 AS DOUBLE) AS lon, CASE WHEN c_acctbal > 5000 THEN 0 ELSE 1 END AS priority FROM {customer}""",
    # The same with countries and postcodes in several cases, with blanks around and within.
    "spelt_addresses": """SELECT c_custkey AS addr_id, CASE WHEN c_nationkey % 2 = 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 'ca' ELSE ' CA ' END ELSE CASE WHEN c_custkey % 3 = 0 THEN 'US' ELSE 'us ' END END AS country,
        concat(CASE WHEN c_custkey % 4 < 2 THEN 'P  ' ELSE ' p ' END, c_custkey % 20, CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE '' END) AS postcode, concat('Street ', c_custkey % 20) AS street, CAST(c_custkey % 25 AS STRING) AS house_number,
        c_mktsegment AS city, CAST(c_custkey % 9 + 40 AS DOUBLE) AS lat, CAST(c_custkey % 11 - 80 AS DOUBLE) AS lon, CASE WHEN c_acctbal > 5000 THEN 0 ELSE 1 END AS priority FROM {customer}""",
    "places": """SELECT concat('s', s_suppkey) AS id, CASE WHEN s_nationkey % 2 = 0 THEN 'ca' ELSE 'US' END AS country, concat('p', s_suppkey % 40) AS postcode, concat('STREET  ', s_suppkey % 20) AS street, CAST(s_suppkey % 25 AS STRING) AS house_number,
        CAST(s_suppkey % 9 + 40 AS DOUBLE) AS lat, CAST(s_suppkey % 11 - 80 AS DOUBLE) AS lon FROM {supplier}""",
    "objects": """SELECT DISTINCT concat('shards/', l_returnflag, '/packs/', l_orderkey, '-', l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN '.bin' WHEN 1 THEN '.bin.gz' ELSE '.json' END) AS path, l_orderkey % 1000 + 1 AS size FROM {lineitem}""",
    "protections": """SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN 'basename' ELSE 'path' END AS kind, CASE o_orderkey % 3 WHEN 0 THEN concat(o_orderkey, '-3.bin') WHEN 1 THEN concat('shards/R/packs/', o_orderkey, '-1.bin.gz') ELSE concat('shards/N/packs/', o_orderkey, '-4.bin.gz') END AS value FROM {orders}
        UNION SELECT 'prefix' AS kind, concat('shards/', r_name, '/') AS value FROM {region} UNION SELECT 'prefix' AS kind, 'shards/A/' AS value FROM {region} WHERE r_regionkey = 0""",
    # Times at which objects were first seen without a reference, as text; one is unreadable.
    "previous": """SELECT DISTINCT concat('shards/', l_returnflag, '/packs/', l_orderkey, '-', l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN '.bin' WHEN 1 THEN '.bin.gz' ELSE '.json' END) AS path, CASE l_orderkey % 5 WHEN 0 THEN 'soon' WHEN 1 THEN '2026-01-01 00:00:00' ELSE '2026-01-08 12:00:00' END AS first_seen FROM {lineitem} WHERE l_quantity > 25""",
    "way_refs": """SELECT l_orderkey AS way_id, l_linenumber AS pos, min(l_partkey) AS node_id, min(l_returnflag) AS flag, min(l_returnflag) = 'R' AS one_way, min(l_quantity) AS seconds FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "nodes": """SELECT p_partkey AS node_id, CAST(p_partkey % 170 AS DOUBLE) - 85 AS lat, CAST(p_size AS DOUBLE) * 7 - 179 AS lon FROM {part}""",
    "region_state": """SELECT lower(n_name) AS region_id, n_nationkey AS ord, n_nationkey % 7 <> 3 AS acquired, n_nationkey % 11 = 10 AS failed, concat('f', n_nationkey) AS required, CASE WHEN n_nationkey % 4 = 0 THEN NULL WHEN n_nationkey % 4 = 1 THEN 'old' ELSE concat('f', n_nationkey) END AS built,
        CASE WHEN n_nationkey % 8 = 2 THEN concat('f', n_nationkey) WHEN n_nationkey % 4 = 1 THEN 'old' END AS uploaded, n_nationkey * 100 AS docs, CAST(n_nationkey AS BIGINT) AS modified, n_nationkey % 5 <> 2 AS has_manifest FROM {nation}""",
}
#: Corpus documents: languages as regions, sources as types.
VIEWS["corpus"] = "SELECT doc_id, lang AS region_id, text, source AS type FROM {documents}"
#: One query for each benchmark item and each word that opens a page's title would be many; benchmark items are the stated queries.
VIEWS["search_queries"] = "SELECT item_id AS query_id, text AS query FROM {benchmark}"


def view(spark: SparkSession, sf_dir: str, name: str, **sources: str) -> DataFrame:
    """A view over the tables; sources: what stands for a table instead of its files."""
    return spark.sql(VIEWS[name].format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES} | sources))


#: Line items in a task of the road queries.
DEALT = 200_000


def tasks_of_ways(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that the line items are dealt to: their number grows with the table, and so a task's memory doesn't."""
    return -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // DEALT) or 1


def way_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view way_refs, dealt by way before it is made, so that what follows by way needs no further shuffle."""
    dealt = f"(SELECT /*+ REPARTITION({tasks_of_ways(spark, sf_dir)}, l_orderkey) */ * FROM parquet.`{sf_dir}/lineitem.parquet`)"
    return view(spark, sf_dir, "way_refs", lineitem=dealt)


def with_views(*names: str) -> str:
    """WITH clause of the views for the oracle."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)
