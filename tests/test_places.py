"""Reference results of routing, boxes, differences, garbage and identities on literal rows."""

import json
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.operators import delta, enrich, gc, identity, regions, roads, routes, search, spatial, status
from placeflow.plans import bindings

REGION = "region_id string, min_lat double, min_lon double, max_lat double, max_lon double, country_code string, subdivision_code string"
POINT = "point_id long, lat double, lon double, country string, state string"


def routed(spark, points, rows):
    got = spatial.route_points(spark.createDataFrame(points, POINT), spark.createDataFrame(rows, REGION)).collect()
    out = {p[0]: [] for p in points}
    for r in got:
        out[r.point_id].append(r.region_id)
    return {k: sorted(v) for k, v in out.items()}


def test_overlaps_and_dateline(spark):
    rows = [("west", 40, -80, 50, -70, "", ""), ("overlap", 44, -76, 46, -72, "", ""), ("dateline", -20, 170, 20, -170, "", ""), ("nowhere", None, None, None, None, "", "")]
    rows = [(r[0], *(None if x is None else float(x) for x in r[1:5]), *r[5:]) for r in rows]
    points = [(1, 45.0, -74.0, None, None), (2, 0.0, 179.0, None, None), (3, 0.0, -179.0, "", ""), (4, -70.0, 0.0, "ZZ", ""), (5, 95.0, 0.0, "", ""), (6, None, 1.0, "", ""), (7, math.nan, 1.0, "", "")]
    assert routed(spark, points, rows) == {1: ["overlap", "west"], 2: ["dateline"], 3: ["dateline"], 4: [], 5: [], 6: [], 7: []}


def test_tie_breaks(spark, monkeypatch):
    rows = [("quebec", 44.0, -80.0, 63.0, -57.0, "CA", "CA-QC"), ("ontario", 41.0, -96.0, 57.0, -74.0, "CA", "CA-ON"), ("vermont", 42.7, -73.5, 45.1, -71.4, "US", "US-VT")]
    points = [(1, 45.0, -74.5, "", ""), (2, 45.0, -74.5, "CA", "QC"), (3, 45.0, -74.5, "ca ", "ON"), (4, 45.0, -73.4, "US", "VT"), (5, 45.0, -73.4, "Canada", "Quebec"), (6, 46.0, -60.0, "US", ""), (7, 45.0, -74.5, "Canada", "CA-QC")]
    want = {1: ["ontario", "quebec"], 2: ["quebec"], 3: ["ontario"], 4: ["vermont"], 5: ["quebec", "vermont"], 6: ["quebec"], 7: ["ontario", "quebec"]}
    assert routed(spark, points, rows) == want
    # The same with the cells too many to be sent to all tasks.
    monkeypatch.setattr(spatial, "BROADCAST_CELLS", 0)
    assert routed(spark, points, rows) == want


def test_several_codes_and_shared_ids(spark):
    """Regions as their reader gives them, with arrays of codes; rows that share an id are routed each by itself."""
    box = "min_lat double, min_lon double, max_lat double, max_lon double"
    r = spark.createDataFrame([("gb", 40.0, -80.0, 50.0, -70.0, ["GB", "IM"], []), ("ie", 40.0, -80.0, 50.0, -70.0, ["IE"], ["IE-D", "IE-C"]), ("both", 40.0, -80.0, 50.0, -70.0, ["IE", "GB"], ["GB-NIR"]), ("none", 40.0, -80.0, 50.0, -70.0, None, None)], f"region_id string, {box}, country_codes array<string>, subdivision_codes array<string>")
    p = spark.createDataFrame([(1, 45.0, -75.0, "im", ""), (1, 45.0, -75.0, "IE", "c"), (2, 45.0, -75.0, "GB", "NIR"), (3, 45.0, -75.0, "FR", "x"), (4, 45.0, -75.0, "IE", "zz")], POINT)
    got = spatial.routed(p, r).groupBy("point_id", "country").agg(F.array_sort(F.collect_list("region_id")).alias("r")).collect()
    assert {(x.point_id, x.country): x.r for x in got} == {(1, "im"): ["gb"], (1, "IE"): ["ie"], (2, "GB"): ["both"], (3, "FR"): ["none"], (4, "IE"): ["both", "ie"]}


def test_synthetic_routing_has_no_amplification(spark):
    n = 20_000
    rows = [("quebec", 44.0, -80.0, 63.0, -57.0, "CA", "CA-QC"), ("ontario", 41.0, -96.0, 57.0, -74.0, "CA", "CA-ON"), ("vermont", 42.0, -76.0, 46.0, -71.0, "US", "US-VT"), ("new-york", 40.0, -80.0, 46.0, -71.0, "US", "US-NY")]
    kinds = [("CA", "QC"), ("CA", "ON"), ("US", "VT"), ("US", "NY")]
    p = spark.range(n).select(F.col("id").alias("point_id"), F.lit(45.0).alias("lat"), F.lit(-74.5).alias("lon"), *(F.element_at(F.array(*(F.lit(k[i]) for k in kinds)), (F.col("id") % 4 + 1).cast("int")).alias(c) for i, c in enumerate(("country", "state"))))
    r = spark.createDataFrame(rows, REGION)
    out = spatial.route_points(p, r)
    assert {x.region_id: x.n for x in spatial.region_counts(out, r).collect()} == {k[0]: n // 4 for k in rows}
    assert spatial.partition_stats(p, r).first() == Row(rows_read=n, normalized=n, unmatched=0, writes=n, amplification=1.0)


def test_counters_count_rows(spark):
    """Rows that share an id are each counted; rows without a valid place are neither normalised nor unmatched."""
    r = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 10.0, "", ""), ("b", 5.0, 5.0, 20.0, 20.0, "", "")], REGION)
    p = spark.createDataFrame([(1, 1.0, 1.0, "", ""), (1, 2.0, 2.0, "", ""), (1, 6.0, 6.0, "", ""), (1, -50.0, 1.0, "", ""), (2, 19.0, -150.0, "", ""), (2, 95.0, 0.0, "", ""), (3, None, 0.0, "", "")], POINT)
    assert spatial.partition_stats(p, r).first() == Row(rows_read=7, normalized=5, unmatched=2, writes=4, amplification=4 / 7)
    assert spatial.partition_stats(p.limit(0), r).first() == Row(rows_read=0, normalized=0, unmatched=0, writes=0, amplification=0.0)


def test_codes(spark):
    d = spark.createDataFrame([(["ca", " CA ", "", None],), (None,)], "c array<string>").select(X.norm_codes(F.col("c")).alias("c"))
    assert [r.c for r in d.collect()] == [["CA"], []]


@pytest.mark.parametrize(
    ("points", "box"),
    [
        ([(-79.76483, 40.43922), (-71.6608, 40.43922), (-71.6608, 45.01766), (-79.76483, 45.01766)], (40.43922, -79.76483, 45.01766, -71.6608)),
        ([(127.0, 37.3), (180.0, 82.1), (-180.0, 60.0), (-169.0, 50.0)], (37.3, 127.0, 82.1, -169.0)),
        ([(0.0, 100.0)], None),
        ([], None),
    ],
)
def test_coverage(spark, points, box):
    got = spatial.coverage_bbox(spark.createDataFrame([("a", lat, lon) for lon, lat in points], "k string, lat double, lon double"), "k").collect()
    assert [tuple(r)[1:] for r in got] == ([] if box is None else [box])


def test_geometry_positions(spark):
    shapes = [{"type": "Point", "coordinates": [1, 2]}, {"type": "Polygon", "coordinates": [[[1, 2], [3, 4.5], [1, 2]]]}, {"type": "MultiPolygon", "coordinates": [[[[5, 6], [7, 8]]], [[[9, 10]]]]}, None]
    d = spark.createDataFrame([(i, json.dumps(s) if s else None) for i, s in enumerate(shapes)], "k int, j string").select("k", F.parse_json("j").alias("geometry"))
    assert sorted(tuple(r) for r in spatial.geometry_positions(d, "k").collect()) == [(0, 1.0, 2.0), (1, 1.0, 2.0), (1, 1.0, 2.0), (1, 3.0, 4.5), (2, 5.0, 6.0), (2, 7.0, 8.0), (2, 9.0, 10.0)]


def test_neighbors(spark):
    f = lambda *r: spark.createDataFrame([(n, *map(float, b), "", "") for n, *b in r], REGION)
    got = spatial.region_neighbors(f(("quebec", 44, -80, 63, -57), ("ontario", 41, -96, 57, -74), ("japan", 24, 122, 46, 154)))
    assert sorted((r.region_id, r.neighbor_id) for r in got.collect()) == [("ontario", "quebec"), ("quebec", "ontario")]
    assert spatial.region_neighbors(f(("parent", 40, -80, 50, -70), ("copy", 40.1, -79.9, 49.9, -70.1))).count() == 0


def test_diff(spark):
    line = lambda i, n: json.dumps({"id": i, "name": n}, separators=(",", ":"))
    snap = [(1, line("same", "a")), (2, line("changed", "old")), (3, line("deleted", "x")), (4, "")]
    fresh = [(1, line("same", "a")), (2, line("changed", "new")), (3, line("added", "y")), (4, " ")]
    d = lambda rows: spark.createDataFrame(rows, "seq long, raw string")
    got = delta.corpus_diff(d(snap), d(fresh))
    assert delta.diff_summary(got).first() == Row(added=1, changed=1, deleted=1, fresh=3)
    assert [r.doc_id for r in delta.delta_lines(got).orderBy("seq").collect()] == ["changed", "added"]
    twice = delta.corpus_diff(d([(1, line("a", "1")), (2, line("a", "2"))]), d([(1, line("a", "2")), (2, line("a", "3"))]))
    assert sorted((r.seq, r.change) for r in twice.collect()) == [(1, "unchanged"), (2, "added")]


def test_generations_equal_a_full_build(spark):
    base = spark.createDataFrame([(i, f"d{i}", f"v{i}", 0) for i in range(20)], "seq long, doc_id string, raw string, generation int")
    new = spark.createDataFrame([(i, f"d{i}", f"w{i}", 1) for i in range(15, 30)], base.schema)
    assert {r.doc_id: r.raw for r in delta.current_corpus(base.union(new)).collect()} == {f"d{i}": f"v{i}" if i < 15 else f"w{i}" for i in range(30)}


def test_lines_without_ids_stay(spark):
    rows = [(1, "", "x", 0), (2, "", "y", 0), (3, None, "z", 0), (4, "a", "old", 0), (5, "a", "older line", 0), (1, "", "w", 1), (2, "a", "new", 1)]
    got = delta.current_corpus(spark.createDataFrame(rows, "seq long, doc_id string, raw string, generation int"))
    assert sorted((r.doc_id or "", r.generation, r.raw) for r in got.collect()) == [("", 0, "x"), ("", 0, "y"), ("", 0, "z"), ("", 1, "w"), ("a", 1, "new")]


@pytest.mark.parametrize(("change", "want"), [({}, "delta"), ({"has_base": False}, "full"), ({"n_generations": 6}, "full"), ({"n_generations": 5}, "delta"), ({"added": 0}, "noop"), ({"added": 31}, "full"), ({"added": 30}, "delta"), ({"deleted_pending": 1}, "full")])
def test_decision(spark, change, want):
    row = dict(has_base=True, builder_changed=False, stats_changed=False, has_snapshot=True, has_fresh=True, n_generations=1, added=1, changed=0, deleted=0, docs=100, deleted_pending=0, fresh=100) | change
    assert delta.refresh_decision(spark.createDataFrame([Row(**row)])).first().decision == want


def test_stats_reason(spark):
    r = lambda *ids: spark.createDataFrame([(i,) for i in ids], "region_id string")
    assert [delta.stats_reason(r("a"), r("a"), 100, 100, forced=True), delta.stats_reason(r("a"), None, 1, 1), delta.stats_reason(r("a"), r("b"), 1, 1), delta.stats_reason(r("a"), r("a"), 111, 100), delta.stats_reason(r("a"), r("a"), 110, 100)] == ["forced", "missing", "regions", "drift", None]


def test_sources_changed(spark):
    s = "source_id int, prev_config string, config string, prev_etag string, etag string, prev_modified string, modified string, prev_bytes long, bytes long"
    rows = [(1, "c", "c", "e", "e", "1", "2", 1, 2), (2, "c", "c", "e", "f", "1", "1", 1, 1), (3, "c", "d", "e", "e", "1", "1", 1, 1), (4, "c", "c", None, "e", "1", "1", 5, 0), (5, "c", "c", None, None, "1", "1", 5, 6), (6, "c", "c", None, None, None, None, 5, 5)]
    assert {r.source_id: r.changed for r in delta.source_changed(spark.createDataFrame(rows, s)).collect()} == {1: False, 2: True, 3: True, 4: False, 5: True, 6: True}


def test_resume(spark):
    prev = spark.createDataFrame([("s", 1, ["a", "a", "b"])], "signature string, schema int, completed array<string>")
    r = lambda *ids: spark.createDataFrame([(i,) for i in ids], "region_id string")
    keep = lambda sig, reg: sorted(x[0] for x in delta.resume_state(prev, reg, sig).collect())
    assert keep("s", r("a", "b")) == ["a", "b"] and keep("t", r("a")) == [] and keep("s", r("b", "c")) == ["b"]
    state = spark.createDataFrame([("a", False, 2, "old"), ("b", False, 1, "kept")], "region_id string, completed boolean, attempt int, message string")
    new = spark.createDataFrame([("a", True, 3, None), ("c", False, 1, "x" * 900)], "region_id string, ok boolean, attempt int, message string")
    out = {x.region_id: tuple(x)[1:] for x in delta.apply_results(state, new).collect()}
    assert out == {"a": (True, None, None), "b": (False, 1, "kept"), "c": (False, 1, "x" * 500)}


def test_enrichment(spark):
    corpus = spark.createDataFrame([("n1", "CA", "H1", "Main  St", "1", 1.0, 1.0)], "id string, country string, postcode string, street string, house_number string, lat double, lon double")
    rows = [(1, "ca", "h1", "main st", "1", "X", 1.0, 2.0, 0), (2, "CA", "H1", "Main St", "214", "Y", 3.0, 4.0, 1), (3, "CA", "H1", "Main St", "214", "Y", 3.0, 4.0, 0)]
    addresses = spark.createDataFrame(rows, "addr_id long, country string, postcode string, street string, house_number string, city string, lat double, lon double, priority int")
    assert [r.addr_id for r in enrich.suppress_duplicates(corpus, addresses).collect()] == [3]
    assert sorted(r.kind for r in enrich.enrich_corpus(corpus, addresses).collect()) == ["address", "place", "postal_code"]
    assert tuple(enrich.enrichment_counters(enrich.enrich_corpus(corpus, addresses)).first()) == (1, 1, 3)
    assert tuple(enrich.enrichment_counters(enrich.enrich_corpus(corpus, addresses.limit(0))).first()) == (0, 0, 1)
    kinds = addresses.withColumn("kind", F.when(F.col("addr_id") == 2, "postal_code").otherwise("address"))
    groups = {r.country: (r.samples, r.addresses, r.sources) for r in enrich.group_postal(kinds).collect()}
    assert groups == {"CA": (3, 2, [0, 1])}
    spelt = spark.createDataFrame([(1, "ca ", "p  1", "a", "1", "X", 1.0, 2.0, 0), (2, "CA", "P 1 ", "b", "2", "Y", 3.0, 4.0, 1)], addresses.schema)
    assert [(r.country, r.postcode, r.samples, r.localities) for r in enrich.group_postal(spelt).collect()] == [("CA", "P 1", 2, ["X", "Y"])]
    assert [r.id for r in enrich.enrich_corpus(corpus, spelt).where("kind = 'postal_code'").collect()] == ["p-CA-P 1"]


def test_profile_edges(spark):
    refs = spark.createDataFrame([(w, p, n) for w in (1, 2, 3, 4) for p, n in enumerate((10, 11, 12))], "way_id long, pos int, node_id long")
    rows = [(1, "residential", True, None, None), (2, "motorway", False, 50, None), (3, "residential", False, 0, ["car"]), (4, "river", False, None, None)]
    ways = spark.createDataFrame(rows, "way_id long, kind string, one_way boolean, max_speed int, barred array<string>")
    nodes = spark.createDataFrame([(10, 0.0, 0.0), (11, 0.0, 1.0)], "node_id long, lat double, lon double")
    edges = {p: {(r.way_id, r.src, r.dst): round(r.seconds) for r in roads.road_edges(roads.profile_refs(refs, ways, nodes, p), p).collect()} for p in roads.SPEEDS}
    degree = 111_195.08
    assert edges["car"] == {(1, 10, 11): round(degree / 30 * 3.6), (2, 10, 11): round(degree / 50 * 3.6), (2, 11, 10): round(degree / 50 * 3.6)}
    bike, foot = round(degree / 16 * 3.6), round(degree / 5 * 3.6)
    assert edges["bike"] == {(1, 10, 11): bike, (3, 10, 11): bike, (3, 11, 10): bike}
    assert edges["foot"] == {(w, a, b): foot for w in (1, 3) for a, b in ((10, 11), (11, 10))}


def test_reusable_partitions(spark):
    prior = spark.createDataFrame([("a", "i", "p/1", 2), ("a", "i", "p/2", 0), ("b", "i", "p/3", 1), ("c", "old", "p/1", 1)], "source_id string, identity string, path string, n long")
    now = spark.createDataFrame([("a", "i"), ("b", "i"), ("c", "i"), ("d", "i")], "source_id string, identity string")
    listing = spark.createDataFrame([("p/1",)], "path string")
    assert sorted(map(tuple, identity.reusable_partitions(prior, now, listing).collect())) == [("a", True), ("b", False), ("c", False), ("d", False)]


def test_garbage(spark):
    body = {"root": {"file": "authority/root.json"}, "hot_prefixes": 2048, "pages": "pages/", "tables": [{"pack": "new.bin.gz"}], "docs": "docs/packs/live.bin", "bad": "../up.bin", "word_path": "words/"}
    m = spark.createDataFrame([("m", "shards/a", json.dumps(body))], "doc string, base string, j string").select("doc", "base", F.parse_json("j").alias("body"))
    p = gc.manifest_protections(m)
    # A binary file at an unsafe path keeps its name, and a manifest protects itself.
    assert {tuple(r) for r in p.collect()} == {("path", "m"), ("basename", "up.bin"), ("basename", "new.bin.gz"), ("basename", "live.bin"), ("path", "shards/a/docs/packs/live.bin"), ("prefix", "shards/a/pages/"), ("prefix", "shards/a/words/"), ("prefix", "shards/a/authority/hot/")}
    o = spark.createDataFrame([(x, 10) for x in ("x/new.bin.gz", "shards/a/docs/packs/live.bin", "shards/a/pages/1.bin", "docs/packs/old.bin", "docs/packs/older.bin", "a.json")], "path string, size long")
    before = spark.createDataFrame([("docs/packs/old.bin", "2026-01-01 00:00:00"), ("docs/packs/older.bin", "soon"), ("x/new.bin.gz", "2026-01-01 00:00:00")], "path string, first_seen string")
    now = F.lit("2026-01-08 00:00:01").cast("timestamp")
    c = gc.gc_candidates(o, p, before, now)
    assert {r.path: r.eligible for r in c.collect()} == {"docs/packs/old.bin": True, "docs/packs/older.bin": False}
    assert gc.gc_summary(o, p, c).first().asDict() == dict(immutable_objects=5, immutable_bytes=50, protected_objects=3, protected_bytes=30, pending_objects=1, pending_bytes=10, eligible_objects=1, eligible_bytes=10)
    bases = spark.createDataFrame([("routes/car/a/",), ("routes/../unsafe/",), ("../x/",), ("other/",)], "base string")
    assert sorted(r.value for r in gc.catalog_protections(bases).collect()) == ["routes/car/a/", "routes/catalog.json"]


def test_nested_protections(spark):
    complete = {"hot_prefixes": 1330, "directory": {"file": "authority/lexicon-root.current.bin.gz"}}
    deep = {"file": "deep/last.bin"}
    for _ in range(15):
        deep = {"next": [deep]}
    bodies = [
        ("m1", "shards/quebec", {"authority": {"autocomplete": complete}}),
        ("m2", "", {"suggest_routing": {"authority": [{"autocomplete": {"hot_prefixes": 2048, "root": {"file": "authority/lexicon-root.current.bin.gz"}}}]}}),
        ("m3", "shards/none", {"authority": {"autocomplete": {**complete, "hot_prefixes": 0}}}),
        ("m4", "shards/deep", deep),
    ]
    m = spark.createDataFrame([(d, b, json.dumps(j)) for d, b, j in bodies], "doc string, base string, j string").select("doc", "base", F.parse_json("j").alias("body"))
    got = {tuple(r) for r in gc.manifest_protections(m).collect()}
    assert {v for k, v in got if k == "prefix"} == {"shards/quebec/authority/hot/", "authority/hot/"}
    assert ("path", "shards/deep/deep/last.bin") in got


def test_live_references_hold_objects(spark):
    """The rules on live objects, on literal manifests."""
    bodies = [
        ("shards/quebec/manifest.min.json", {"directory": {"root": "terms/directory-root.abc.bin.gz", "pages": "terms/directory-pages/", "pack_table": ["0000.current.bin.gz"]}, "docs": {"pointers": {"file": "docs/pointers/current.bin"}}}),
        ("shards/quebec/manifest.gen0000.min.json", {"authority": {"autocomplete": {"hot_prefixes": "1330", "directory": {"file": "authority/lexicon-root.current.bin.gz"}, "root": {"file": "elsewhere/root.bin"}}}}),
        ("manifest.min.json", {"suggest_routing": {"authority": {"autocomplete": {"hot_prefixes": 2048, "root": {"file": "top.bin.gz"}}}}}),
    ]
    m = spark.createDataFrame([(d, d.rpartition("/")[0], json.dumps(b)) for d, b in bodies], "doc string, base string, j string").select("doc", "base", F.parse_json("j").alias("body"))
    routes = gc.catalog_protections(spark.createDataFrame([("routes/car/quebec",), ("routes/bike/ontario/",), ("../unsafe/",), ("routes/catalog.json",)], "base string"))
    live = ["shards/quebec/terms/directory-root.abc.bin.gz", "shards/quebec/terms/packs/0000.current.bin.gz", "shards/quebec/terms/directory-pages/0000.bin.gz", "shards/quebec/docs/pointers/current.bin", "shards/quebec/authority/hot/live.bin.gz", "hot/live.bin.gz", "routes/car/quebec/shards/00/pack.live.bin", "routes/bike/ontario/root.live.bin.gz", "shards/quebec/manifest.min.json", "manifest.min.json", "routes/catalog.json"]
    dead = ["shards/quebec/docs/packs/old.bin", "shards/quebec/gen-0001/authority/hot/old.bin.gz", "shards/quebec/elsewhere/hot/old.bin", "routes/car/alberta/root.old.bin.gz", "unsafe/object.bin", "shards/quebec/manifest.json"]
    o = spark.createDataFrame([(p, 1) for p in live + dead], "path string, size long")
    assert sorted(r.path for r in gc.protected_objects(o, gc.manifest_protections(m).union(routes)).collect()) == sorted(live)


def test_safe_paths(spark):
    want = {"a/b": "a/b", "./a//b/./c": "a/b/c", "a/": "a/", "a/.": "a/", "a/./": "a/", ".": None, "./": None, "././": None, "": None, "/a": None, ".//a": None, "a/../b": None, "..": None, "//": None, "..a": "..a", "a.": "a.", ".hidden": ".hidden"}
    d = spark.createDataFrame(list(want.items()), "p string, w string").select("p", "w", X.safe_path(F.col("p")).alias("got"), X.path_join(F.lit("s/a/"), F.col("p")).alias("below"), X.path_join(F.lit("/abs"), F.col("p")).alias("absolute"), X.path_join(F.lit("."), F.col("p")).alias("root"))
    for r in d.collect():
        assert r.got == r.w and r.below == (r.w and f"s/a/{r.w}") and r.absolute is None and r.root == r.w, r
    body = {"y_path": "./", "pages": ".", "deep_path": "/", "file": "./b.bin"}
    m = spark.createDataFrame([("m.json", "r", json.dumps(body))], "doc string, base string, j string").select("doc", "base", F.parse_json("j").alias("body"))
    assert {tuple(r) for r in gc.manifest_protections(m).collect()} == {("path", "m.json"), ("basename", "b.bin"), ("path", "r/b.bin")}


def test_nested_fingerprints(spark):
    """One value in four shapes and orders of names has one fingerprint; unlike values and unlike orders of arrays don't."""
    of = lambda sql: spark.sql(f"select {sql}").select(X.nested_fingerprint(spark.sql(f"select {sql}")).alias("f")).first().f
    same = [
        "named_struct('b', array(named_struct('y', 1, 'x', 'é \"q\"'), null), 'a', map('k2', 2.5d, 'k1', null)) as v, true as u",
        "true as u, named_struct('a', map('k1', null, 'k2', 2.5d), 'b', array(named_struct('x', 'é \"q\"', 'y', 1), null)) as v",
        "true as u, named_struct('a', named_struct('k2', 2.5d, 'k1', cast(null as int)), 'b', array(map('y', '1'), null)) as v",
    ]
    assert of(same[0]) == of(same[1]) != of(same[2])
    assert of("array(1, 2) as v") != of("array(2, 1) as v") and of("map(1, 'a', 10, 'b') as v") == of("map(10, 'b', 1, 'a') as v")
    d = spark.createDataFrame([(json.dumps(j),) for j in ({"b": [{"y": 1, "x": None}], "a": {"z": 1, "k": "t"}}, {"a": {"k": "t", "z": 1}, "b": [{"x": None, "y": 1}]})], "j string").select(F.parse_json("j").alias("v"))
    assert len({r[0] for r in d.select(X.nested_fingerprint(d)).collect()}) == 1


def test_generation_manifests(spark):
    rows = [("shards/quebec/", "gen-0001/", "gen-0001/manifest.min.json"), ("shards/quebec/", "gen-0001/", "manifest.min.json"), ("shards/quebec/", "../other/", "manifest.min.json"), ("shards/quebec/", "gen-0001/", None), ("shards/quebec/", "", "a/m.json"), ("shards/quebec", None, None), ("shards/quebec", "gen-1/", "../m.json")]
    d = spark.createDataFrame(rows, "b string, p string, m string")
    assert [r[0] for r in d.select(X.generation_manifest_path(F.col("b"), F.col("p"), F.col("m"))).collect()] == ["shards/quebec/gen-0001/manifest.min.json"] * 2 + [None, "shards/quebec/gen-0001/manifest.min.json", "shards/quebec/a/m.json", "shards/quebec/manifest.min.json", None]


def test_joined_paths_are_evaluated_once(spark):
    """An expression that named its input twice at each step took a million characters here."""
    d = spark.createDataFrame([("s", "a/", "m.json")], "b string, p string, m string")
    plan = d.select(X.generation_manifest_path(F.col("b"), F.col("p"), F.col("m")))._jdf.queryExecution().analyzed().toString()
    assert len(plan) < 10_000


def test_keep_set(spark):
    g = "base string, id_map string, generations array<struct<path:string,manifest:string,id_map:string>>"
    rows = [("s/a", "ids.bin", [("gen-1/", "gen-1/manifest.min.json", "ids.bin"), ("./gen-2", "x.min.json", None)]), ("s/b", None, None)]
    got = sorted(r.path for r in gc.shard_keep_paths(spark.createDataFrame(rows, g)).collect())
    root = ["manifest.full.json", "manifest.json", "manifest.min.json"]
    assert got == sorted([f"s/{x}/{n}" for x in "ab" for n in root] + ["s/a/ids.bin", "s/a/gen-1/ids.bin", "s/a/x.min.json", "s/a/x.json"] + [f"s/a/gen-{i}/{n}" for i in (1, 2) for n in ("manifest.json", "manifest.min.json")])


def test_keep_paths_shuffle_rows_and_paths_only(spark):
    """Generations used to be made twice, each deduplicated in the tasks that read them, and joined."""
    from placeflow.plans.queries import QUERIES

    plan = QUERIES["shard_keep_paths"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_references_are_joined_to_their_base_once(spark):
    m = spark.createDataFrame([("m.json", "r", "{}")], "doc string, base string, b string").select("doc", "base", F.parse_json("b").alias("body"))
    plan = gc.manifest_protections(m)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2


def test_publish_ranks(spark):
    paths = ["_build/x.json", "a/_build/x.bin", "tmp/x", "manifest.min.json", "gen-1/manifest.full.json", "manifest.gen.json", "manifest.json.gz"]
    d = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in d.select(X.publish_rank(F.col("p"))).collect()] == [0, 1, 1, 3, 2, 2, 1]


def test_status(spark):
    state = spark.createDataFrame([("a", True, "f", True, "f", 5, 1), ("b", True, "f", False, "f", 7, 2), ("c", True, "g", True, "f", 9, 3)], "region_id string, acquired boolean, built string, has_manifest boolean, uploaded string, docs long, modified long")
    run = lambda s: spark.createDataFrame([(s,)], "status string")
    got = status.status_snapshot(state, state.drop("docs"), run("running")).first().asDict()
    assert got == dict(regions=3, acquired=3, built=2, published=1, documents=5, data_time=1, road_built=2, road_uploaded=1, road_unavailable=1, status="running", phase="building", acquired_percent=100.0, published_percent=33.3)
    assert status.status_snapshot(state, state.drop("docs"), run("failed")).first().phase == "failed"


def test_words_of_all_scripts(spark):
    d = spark.createDataFrame([("L'été à Zürich, año 2024 — Straße",)], "t string").select(X.tokens(F.col("t")))
    assert d.first()[0] == ["l", "été", "à", "zürich", "año", "2024", "straße"]


def test_many_lines_without_ids(spark):
    d = lambda rows: spark.createDataFrame(rows, "seq long, raw string")
    got = delta.corpus_diff(d([(1, "x"), (2, "y")]), d([(1, "y"), (2, "z"), (3, "y")]))
    assert sorted((r.seq, r.change) for r in got.collect()) == [(1, "unchanged"), (2, "added"), (3, "added")]


def test_dense_longitudes(spark):
    """The largest gap may lie within a degree."""
    lons = [-180 + i * 0.25 for i in range(1440)]
    rows = [("a", 0.0, x) for x in lons if not 10 < x < 10.5] + [("b", 1.0, x) for x in lons] + [("c", 2.0, 5.0)]
    got = {r.k: tuple(r)[1:] for r in spatial.coverage_bbox(spark.createDataFrame(rows, "k string, lat double, lon double"), "k").collect()}
    assert got == {"a": (0.0, 10.5, 0.0, 10.0), "b": (1.0, -179.75, 1.0, -180.0), "c": (2.0, 5.0, 2.0, 5.0)}


def test_catalog_needs_jobs(spark):
    none = spark.createDataFrame([], "source string, layer string, name string, job long, updated long, output boolean, size long")
    with pytest.raises(ValueError, match="no usable job"):
        enrich.read_job_catalog(none)
    two = spark.createDataFrame([("b", "addresses", "y", 1, 2, True, 3), ("a", "addresses", "z", 2, None, True, 3), ("a", "addresses", "x", 3, None, True, 3)], none.schema)
    assert [(r.source, r.name) for r in enrich.read_job_catalog(two).collect()] == [("a", "x"), ("a", "z"), ("b", "y")]


def test_vocabulary_fails_closed(spark):
    counts = spark.createDataFrame([("s", "cinema", 12), ("s", "bakery", 3)], "region_id string, value string, n long")
    shards = lambda *r: spark.createDataFrame(r, "region_id string, total long")
    assert {r.value: r.n for r in search.merge_vocabulary(counts, shards(("s", 15))).collect()} == {"cinema": 12, "bakery": 3}
    for bad in (shards(("s", 16)), shards(("s", 15), ("t", 1))):
        with pytest.raises(Exception, match="vocabulary incomplete"):
            search.merge_vocabulary(counts, bad).collect()


def test_road_partitions_and_pct(spark):
    d = spark.createDataFrame([(100 << 20,), (int(2.1 * (1 << 30)),), (20 << 30,)], "b long")
    assert [r[0] for r in d.select(X.road_partitions(F.col("b"))).collect()] == [1, 5, 8]
    assert spark.range(1).select(X.pct(F.lit(0), F.lit(0)), X.pct(F.lit(1), F.lit(3)), X.http_date(F.lit("Sun, 06 Nov 1994 08:49:37 GMT")).cast("string"), X.http_date(F.lit("x"))).first()[:] == (0.0, 33.3, "1994-11-06 08:49:37", None)


def test_graphs(spark):
    import heapq
    import random

    rnd = random.Random(1)
    edges = [(w, rnd.randint(0, 60), rnd.randint(61, 120) if w % 9 else rnd.randint(0, 60), float(rnd.randint(1, 9))) for w in range(140)]
    both = [(w, a, b, s) for w, a, b, s in edges if a != b] + [(w, b, a, s) for w, a, b, s in edges if w % 3 and a != b]
    e = spark.createDataFrame(both, "way_id long, src long, dst long, seconds double")
    near = {}
    for _, a, b, s in both:
        near.setdefault(a, []).append((b, s))

    def dijkstra(start):
        best, heap = {}, [(0.0, start)]
        while heap:
            t, n = heapq.heappop(heap)
            if n not in best:
                best[n] = t
                for m, s in near.get(n, ()):
                    heapq.heappush(heap, (t + s, m))
        return best

    got = {}
    for r in routes.travel_times(e, spark.createDataFrame([(3,), (70,)], "source long")).collect():
        got.setdefault(r.source, {})[r.node] = r.seconds
    assert got == {3: dijkstra(3), 70: dijkstra(70)}
    root = {n: n for _, a, b, _ in both for n in (a, b)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for _, a, b, _ in both:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {r.node: r.component for r in roads.connected_components(e).collect()} == {n: find(n) for n in root}
    stops = spark.createDataFrame([(1, 0, 3), (1, 1, 70), (2, 0, 70), (2, 1, 999)], "trip_id int, pos int, node long")
    m = spark.createDataFrame([(3, 70, 5.0), (70, 3, 6.0)], "source long, node long, seconds double")
    assert {r.trip_id: (r.seconds, r.legs) for r in roads.itinerary_costs(stops, m).collect()} == {1: (5.0, 1), 2: (None, 1)}
    assert roads.itinerary_costs(stops, m, open_end=False).where("trip_id = 1").first().seconds == 11.0


def test_federation(spark):
    e = spark.createDataFrame([("a", 1, 2, 4.0), ("b", 2, 3, 5.0)], "region_id string, src long, dst long, seconds double")
    portals = spark.createDataFrame([("a", "b", 2)], "region_a string, region_b string, node_id long")
    got = routes.federated_travel_times(e, portals, spark.createDataFrame([("a", 1)], "region_id string, node_id long"))
    assert {(r.region_id, r.node_id): r.seconds for r in got.collect()} == {("a", 1): 0.0, ("a", 2): 4.0, ("b", 2): 4.0, ("b", 3): 9.0}


def test_hierarchy(spark):
    f = spark.createDataFrame([("a", None, ["AA"]), ("b", "a", []), ("c", "b", []), ("d/e", None, []), ("d", None, ["DD"]), ("d/e/f", "a", [])], "id string, parent string, codes array<string>")
    up = regions.region_ancestors(f.select("id", "parent"))
    assert sorted(map(tuple, up.collect())) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1), ("d/e/f", "a", 1)]
    assert sorted(map(tuple, regions.region_children(f).collect())) == [("a", "b"), ("a", "d/e/f"), ("b", "c"), ("d", "d/e"), ("d", "d/e/f"), ("d/e", "d/e/f")]
    with pytest.raises(Exception, match="no coverage"):
        regions.refresh_coverage(spark.createDataFrame([("r", "x")], "region_id string, path string"), spark.createDataFrame([], "path string, codes array<string>, min_lat double, min_lon double, max_lat double, max_lon double")).collect()


def test_united_codes_and_groups(spark):
    rows = [("north-america", None, ["NA"]), ("us", "north-america", ["US"]), ("us/california", "north-america", []), ("x/y/z", "us", ["ZZ", "US"]), ("x/y", None, ["XY"]), ("alone", None, [])]
    rows += [("k0", None, ["K0"])] + [(f"k{i}", f"k{i - 1}", []) for i in range(1, 20)]
    f = spark.createDataFrame(rows, "id string, parent string, codes array<string>")
    up = regions.region_ancestors(f.select("id", "parent"))
    codes = {r.id: r.codes for r in regions.united_codes(f, up).collect()}
    assert len(codes) == len(rows)
    assert codes["us/california"] == ["NA", "US"] and codes["us"] == ["NA", "US"] and codes["x/y/z"] == ["NA", "US", "XY", "ZZ"] and codes["alone"] == [] and codes["k19"] == ["K0"]
    groups = {r.id: r.groups for r in regions.region_groups(f, up).collect()}
    assert groups["us/california"] == ["us", "north-america"] and groups["x/y/z"] == ["x", "us", "north-america"] and groups["alone"] == []
    with pytest.raises(ValueError, match="circle"):
        regions.region_ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parent string"))


def test_nearest_equals_all(spark):
    import random

    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(400)]
    qs = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(20)] + [(98, 89.9, 179.9), (99, -90.0, 0.0)]
    p, q = spark.createDataFrame(pts, "point_id long, lat double, lon double"), spark.createDataFrame(qs, "query_id long, q_lat double, q_lon double")

    def metres(a, b, c, d):
        x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * X.EARTH_METRES * math.asin(math.sqrt(min(1, x)))

    got = {}
    for r in search.geo_near(q, p, 3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.point_id)
    assert got == {i: [x[1] for x in sorted((metres(a, b, y, z), n) for n, y, z in pts)[:3]] for i, a, b in qs}


def test_road_queries_equal_all_ways(spark):
    import heapq

    from placeflow.plans.bindings import view
    from placeflow.plans.queries import QUERIES

    d = "/root/testdata/sf0.001"
    ways, nodes = {}, {r.node_id: (r.lat, r.lon) for r in view(spark, d, "nodes").collect()}
    for r in view(spark, d, "way_refs").orderBy("way_id", "pos").collect():
        ways.setdefault(r.way_id, []).append(r)
    trips, links, graphs = {}, {}, {}
    for w, refs in ways.items():
        times, region = {}, min(r.flag for r in refs)
        for a, b in zip(refs, refs[1:], strict=False):
            for x, y in [(a, b)] + [(b, a)] * (not a.one_way):
                if x.node_id != y.node_id:
                    times[x.node_id, y.node_id] = min(float(a.seconds), times.get((x.node_id, y.node_id), math.inf))
        trips[w] = (sum(times.get((a.node_id, b.node_id), 0.0) for a, b in zip(refs, refs[1:], strict=False)), len(refs) - 1)
        for (x, y), s in times.items():
            links.setdefault((region, x), []).append((s, (region, y)))
            graphs.setdefault(region, set()).update((x, y))
    got = {r.trip_id: (r.seconds, r.legs) for r in QUERIES["itinerary_costs"](spark, d).collect()}
    assert got == {w: t for w, t in trips.items() if t[1]}
    ends = {}
    for r, x in [k for k in links] + [to for v in links.values() for _, to in v]:
        ends.setdefault(r, set()).add(x)
    want = {}
    # The least and the greatest node from which an edge starts, or at which one ends, of each region.
    firsts = {(r, f(x for q, x in links if q == r)) for r in ends for f in (min, max)}
    for start in firsts:
        best, queue = {}, [(0.0, start)]
        while queue:
            s, at = heapq.heappop(queue)
            if at in best:
                continue
            best[at] = s
            for step, to in links.get(at, []) + [(0.0, (r, at[1])) for r in graphs if at[1] in nodes and at[1] in graphs[r]]:
                heapq.heappush(queue, (s + step, to))
        assert {r for r, _ in best} == {"A", "N", "R"}
        want |= {(f"{start[0]}:{start[1]}", *k): v for k, v in best.items()}
    assert {(r.source, r.region_id, r.node_id): r.seconds for r in QUERIES["federated_travel_times"](spark, d).collect()} == want


@pytest.mark.parametrize("name", ["road_edges", "itinerary_costs"])
def test_tasks_of_roads_grow_with_the_table(spark, monkeypatch, name):
    """Line items are dealt by way once, to tasks whose number the table sets; edges, both ways included, are made without another shuffle."""
    from placeflow.plans.queries import QUERIES

    d = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{d}/lineitem.parquet").count()
    monkeypatch.setattr(bindings, "DEALT", lines // 5)
    plan = QUERIES[name](spark, d)._jdf.queryExecution().executedPlan().toString()
    tasks = -(-lines // (lines // 5))
    shuffles = [line for line in plan.splitlines() if "Exchange" in line]
    assert all(f"hashpartitioning({key}" in " ".join(shuffles) for key in ["l_orderkey"] + ["source"] * (name == "itinerary_costs"))
    assert all(f", {tasks})" in line for line in shuffles if "l_orderkey" in line or "source" in line)
    if name == "road_edges":
        assert len(shuffles) == 1


def test_scoring_grows_with_the_terms_found(monkeypatch):
    """documents are not scored for queries with which they share no term; many queries and few of them in a document, and the opposite."""
    import types

    import numpy as np
    import pyarrow as pa

    from placeflow.operators import search

    class Counting(types.SimpleNamespace):
        cells = 0

        def bincount(self, x, weights, least):
            Counting.cells += least
            return np.bincount(x, weights, least)

    class Numpy:
        def __getattr__(self, name):
            return getattr(Counting(), name, None) or getattr(np, name)

    monkeypatch.setattr(search, "np", Numpy())
    for queries, words in ((20_000, 1), (20, 15)):
        n = 3000
        terms = np.arange(queries)
        sent = types.SimpleNamespace(value=(np.arange(queries + 1), terms, terms + 7))
        hits = [[{"no": (d * 17 + w) % queries, "part": 1.0 + d % 5 + w / 8} for w in range(words)] for d in range(n)]
        batch = pa.RecordBatch.from_pylist([{"doc_id": d, "region_id": "ab"[d % 2], "hits": h} for d, h in enumerate(hits)], pa.schema([("doc_id", pa.int64()), ("region_id", pa.string()), ("hits", pa.list_(pa.struct([("no", pa.int32()), ("part", pa.float64())])))]))
        Counting.cells = 0
        got = [r for b in search._leading(sent, 2)(iter([batch.slice(0, 1000), batch.slice(1000)])) for r in b.to_pylist()]
        every = {}
        for d, h in enumerate(hits):
            for e in h:
                every.setdefault((e["no"] + 7, "ab"[d % 2]), []).append((-e["part"], d))
        assert sorted((r["query_id"], r["region_id"], -r["score"], r["doc_id"]) for r in got) == sorted((*k, s, d) for k, v in every.items() for s, d in sorted(v)[:2])
        assert Counting.cells <= 4 * n * words


def test_queries_of_the_same_terms_are_searched_once(spark):
    """order, case and repetition of words make no other query; each query has its own rows."""
    from placeflow.operators import search

    corpus = spark.createDataFrame([(i, "ab"[i % 2], f"Word{i % 3} word{i % 5} tail") for i in range(40)], "doc_id long, region_id string, text string")
    q = spark.createDataFrame([(5, "word1 WORD2"), (3, "Word2, word1 word1"), (9, "word1"), (8, "..."), (7, "nowhere word1"), (6, "word1 nowhere")], "query_id long, query string")
    assert {(r.query_id, r.least) for r in search.same_queries(q).collect()} == {(5, 3), (3, 3), (9, 9), (8, 8), (7, 6), (6, 6)}
    counts = search.region_df(corpus, q)
    found = search.routed_search(q, search.text_routing(corpus, q), corpus, search.term_df(corpus, q), search.scoring_stats(corpus)).collect()
    rows = lambda n: sorted((r.rank, r.doc_id, r.score) for r in found if r.query_id == n)
    want = search.bm25_topk(q, search.postings(corpus, q), search.term_df(corpus, q), search.scoring_stats(corpus)).collect()
    assert counts.count() and sorted(map(tuple, found)) == sorted(map(tuple, want)) and rows(3) == rows(5) and len(rows(9)) == 5 and not rows(8)
