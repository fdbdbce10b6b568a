"""Readers, writers and streams on small files."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from placeflow.operators.delta import corpus_diff, delta_lines
from placeflow.sources import readers, versions, writers


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1;Main;45.5;-74\n;Side;x;1\n")
    got = readers.read_delimited_addresses(spark, f"{tmp_path}/a.csv", {"house_number": 0, "street": 1, "lat": 2, "lon": 3}, ";", False, {"country": "CA", "house_number": "9"}).collect()
    assert [(r.house_number, r.street, r.lat, r.lon, r.country) for r in got] == [("1", "Main", 45.5, -74.0, "CA"), ("9", "Side", None, 1.0, "CA")]


def test_geojson(spark, tmp_path):
    f = lambda h, g: json.dumps({"type": "Feature", "properties": {"hash": h, "number": "1"}, "geometry": g})
    (tmp_path / "a.json").write_text("\n".join([f("one", {"type": "Point", "coordinates": [-74, 45]}), "", f("two", {"type": "Point", "coordinates": [1]}), f("x", {"type": "LineString", "coordinates": [1, 2]})]))
    got = readers.read_geojson_addresses(spark, f"{tmp_path}/a.json", "ca/qc/te st", "addresses", "province").collect()
    assert [(r.id, r.country, r.url, r.lat) for r in got] == [("ca/qc/te st/addresses/province/one", "CA", "sources/ca/qc/te%20st.json", 45.0)]
    (tmp_path / "bad.json").write_text("{broken")
    with pytest.raises(Exception):  # noqa: B017
        readers.read_geojson_addresses(spark, f"{tmp_path}/bad.json", "a", "b", "c").collect()


def test_regions(spark, tmp_path):
    ok = {"path": "x/quebec", "bbox": [44, -80, 63, -57], "countryCodes": ["ca", "CA"]}
    (tmp_path / "r.json").write_text(json.dumps([ok, {"id": "n"}]))
    got = {r.region_id: r for r in readers.read_regions(spark, f"{tmp_path}/r.json").collect()}
    assert got["quebec"].country_codes == ["CA"] and got["quebec"].road_indexes and got["n"].min_lat is None
    (tmp_path / "bad.json").write_text(json.dumps([{**ok, "bbox": [70, -80, 63, -57]}]))
    with pytest.raises(Exception, match="invalid box"):
        readers.read_regions(spark, f"{tmp_path}/bad.json").collect()


def test_corpus_snapshot_delta_and_state(spark, tmp_path):
    lines = spark.createDataFrame([(i, f'{{"id":"d{i}"}}') for i in range(50)], "seq long, raw string")
    path = writers.write_snapshot(lines, f"{tmp_path}/snap", "1")
    back = readers.read_corpus(spark, path)
    assert sorted(r.doc_id for r in back.collect()) == sorted(f"d{i}" for i in range(50))
    fresh = readers.read_corpus(spark, writers.write_snapshot(lines, f"{tmp_path}/fresh", "1"))
    writers.write_delta(delta_lines(corpus_diff(back.where("doc_id <> 'd7'"), fresh)), f"{tmp_path}/delta")
    assert [r.value for r in spark.read.text(f"{tmp_path}/delta").collect()] == ['{"id":"d7"}']
    assert writers.load_state(spark, f"{tmp_path}/state", "a int").count() == 0
    for v in (1, 2):
        writers.save_state(spark.createDataFrame([(v,)], "a int"), f"{tmp_path}/state", v)
    assert writers.load_state(spark, f"{tmp_path}/state", "a int").first().a == 2
    writers.write_document(spark.createDataFrame([(1, "x")], "a int, b string"), f"{tmp_path}/doc")
    assert json.loads(spark.read.text(f"{tmp_path}/doc").first().value) == {"a": 1, "b": "x"}


def test_order_of_files(spark, tmp_path):
    """Lines follow the names of files, although tasks read large files first; so the first and last lines of an id are right."""
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "1.jsonl").write_text('{"id":"a","n":1}\n')
    (tmp_path / "c" / "2.jsonl").write_text("".join(f'{{"id":"x{i}"}}\n' for i in range(5000)) + '{"id":"a","n":2}\n')
    (tmp_path / "c" / "3.jsonl").write_text('{"id":"a","n":3}\n')
    rows = readers.read_corpus(spark, f"{tmp_path}/c").orderBy("seq").collect()
    assert [r.doc_id for r in rows] == ["a", *(f"x{i}" for i in range(5000)), "a", "a"]
    diff = corpus_diff(readers.read_corpus(spark, f"{tmp_path}/c/3.jsonl"), readers.read_corpus(spark, f"{tmp_path}/c")).where("doc_id = 'a'").orderBy("seq").collect()
    assert [(r.raw[-2], r.change) for r in diff] == [("1", "changed"), ("2", "added"), ("3", "added")]


def test_partitions_by_rows(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "case when id < 90 then 'big' else 'small' end as region_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which joins small files
    writers.write_region_partitions(rows, f"{tmp_path}/p", rows=30)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = lambda r: len(list((tmp_path / "p" / f"region_id={r}").glob("*.json.gz")))
    assert files("small") == 1 and 1 < files("big") <= 3 and spark.read.json(f"{tmp_path}/p").count() == 100


def test_listing_and_manifests(spark, tmp_path):
    """Both name a file by its path below the root, whatever characters it has and however the root is written."""
    (tmp_path / "m" / "sub dir").mkdir(parents=True)
    (tmp_path / "m" / "sub dir" / "a%é.json").write_text('{"k": ["x.bin"]}')
    (tmp_path / "m" / "x.bin").write_bytes(b"12")
    for root in (f"{tmp_path}/m", f"file://{tmp_path}/m/", f"file:{tmp_path}/m"):
        got = readers.read_object_listing(spark, root).collect()
        assert sorted((r.path, r.size) for r in got) == [("sub dir/a%é.json", 16), ("x.bin", 2)]
        assert [(r.doc, r.base) for r in readers.read_manifests(spark, root).collect()] == [("sub dir/a%é.json", "sub dir")]


def test_objects(spark, tmp_path):
    rows = spark.createDataFrame([("a/b/x.bin", b"123"), ("y.json", None)], "path string, content binary")
    assert sorted(map(tuple, writers.write_objects(rows, f"{tmp_path}/o").collect())) == [("a/b/x.bin", 3), ("y.json", 0)]
    assert (tmp_path / "o" / "a" / "b" / "x.bin").read_bytes() == b"123" and len(list((tmp_path / "o").rglob("*"))) == 4
    with pytest.raises(Exception, match="unsafe path"):
        writers.write_objects(spark.createDataFrame([("../x", b"")], rows.schema), f"{tmp_path}/o").collect()


def test_interrupted_saves(spark, tmp_path):
    """A save that breaks off leaves the former version in force; one whose files are lost fails."""
    root = f"{tmp_path}/state"
    state = lambda n: spark.createDataFrame([(n,)], "a int")
    broken = state(0).select(F.raise_error("power cut").cast("int").alias("a"))
    with pytest.raises(Exception, match="power cut"):
        writers.save_state(broken, root, 0)
    assert writers.load_state(spark, root, "a int").count() == 0
    writers.save_state(state(1), root, 1)
    with pytest.raises(Exception, match="power cut"):
        writers.save_state(broken, root, 2)
    assert [r.a for r in writers.load_state(spark, root, "a int").collect()] == [1]
    with pytest.raises(ValueError, match="isn't above"):
        writers.save_state(state(5), root, 1)
    shutil.rmtree(writers.save_state(state(3), root, 3))
    with pytest.raises(ValueError, match="can't be read"):
        writers.load_state(spark, root, "a int")


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    root, state = f"{tmp_path}/state", spark.createDataFrame([(1,)], "a int")
    real = versions.create_text

    def late(session, path, text):
        monkeypatch.setattr(versions, "create_text", real)
        writers.save_state(state, root, 1)
        real(session, path, text)

    monkeypatch.setattr(versions, "create_text", late)
    with pytest.raises(Exception, match="(?i)exist"):
        writers.save_state(spark.createDataFrame([(2,)], "a int"), root, 1)
    assert [r.a for r in writers.load_state(spark, root, "a int").collect()] == [1]
    assert not [n for n in os.listdir(f"{root}/_commits") if n.startswith(".0") and not n.endswith(".crc")]


def test_old_versions_are_kept_for_readers(spark, tmp_path):
    root = f"{tmp_path}/snap"
    lines = lambda n: spark.createDataFrame([(f'{{"id":"{n}"}}',)], "raw string")
    paths = [writers.write_snapshot(lines(n), root, f"_2026-01-0{n} 10:00/é") for n in range(4)]
    held = versions.lease(spark, root, 0)
    versions.lease(spark, root, 1, hours=-1)
    os.makedirs(f"{root}/data/new-unfinished")
    assert versions.vacuum(spark, root, keep=1) == sorted(p.removeprefix(f"{root}/") for p in paths[1:3])
    assert [readers.read_corpus(spark, p).first().doc_id for p in (paths[0], writers.current_snapshot(spark, root))] == ["0", "3"]
    versions.delete(spark, held)
    assert versions.vacuum(spark, root, keep=1, grace_hours=0) == sorted([paths[0].removeprefix(f"{root}/"), "data/new-unfinished"])
    assert [r["label"] for r in versions.commits(spark, root)] == [f"_2026-01-0{n} 10:00/é" for n in range(4)]
