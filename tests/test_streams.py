"""Streams: batches that break off, the order of rows, regions split by rows, grace periods that end by themselves, record producers."""

import json
import os
import random

import pandas as pd
import pytest

from placeflow.sources.producers import record_source
from placeflow.streaming import grace, partition

POINT = "point_id long, lat double, lon double, country string, state string, source string, ord long"
REGION = "region_id string, min_lat double, min_lon double, max_lat double, max_lon double, country_code string, subdivision_code string"
DAY = 86_400_000


def run(stream, regions, root, cut=None):
    partition.start_partition_stream(stream, regions, f"{root}/out", f"{root}/checkpoint", before_commit=cut).awaitTermination()


def test_interrupted_batches_and_order(spark, tmp_path):
    """A batch that breaks off after its files isn't read; run again it is there once, in the order of its source's rows, not of ids."""
    rnd = random.Random(3)
    regions = spark.createDataFrame([("big", 0.0, 0.0, 50.0, 50.0, "", ""), ("small", 40.0, 40.0, 60.0, 60.0, "", "")], REGION)
    os.makedirs(f"{tmp_path}/in")
    stream = spark.readStream.schema(POINT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    want = {"big": [], "small": []}

    def add(n):
        rows = []
        for i in range(60):
            lat = rnd.choice([10.0, 20.0, 45.0, 55.0, 70.0])
            rows.append((rnd.randrange(20), lat, lat, "", "", f"job-{n}{i % 2}", i))
        spark.createDataFrame(rows, POINT).repartition(3).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for r in sorted(rows, key=lambda r: (r[5], r[6])):
            for name, a, b in (("big", 0, 50), ("small", 40, 60)):
                if a <= r[1] <= b:
                    want[name].append((r[0], r[5], r[6]))

    def got():
        out = {"big": {}, "small": {}}
        for r in partition.ordered_partitions(spark, f"{tmp_path}/out").collect():
            assert r.pos not in out[r.region_id]
            out[r.region_id][r.pos] = (r.point_id, r.source, r.ord)
        return {k: [v[i + 1] for i in range(len(v))] for k, v in out.items()}

    def cut(batch_id):
        raise RuntimeError("power cut")

    with pytest.raises(Exception, match="no batch"):
        partition.read_partitions(spark, f"{tmp_path}/out")
    add(0)
    run(stream, regions, tmp_path)
    before = {k: list(v) for k, v in want.items()}
    assert got() == before
    add(1)
    with pytest.raises(Exception, match="power cut"):
        run(stream, regions, tmp_path, cut)
    assert got() == before and len(os.listdir(f"{tmp_path}/out/data")) == 2
    run(stream, regions, tmp_path)
    assert got() == want
    run(stream, regions, tmp_path)
    assert got() == want
    rows = [r for r in partition.stream_counters(spark, f"{tmp_path}/out").orderBy("batch_id").collect()]
    assert [r.rows_read for r in rows] == [60, 60] and sum(r.writes for r in rows) == sum(map(len, want.values()))


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    """The record stands, but the stream's checkpoint was lost before it knew."""
    regions = spark.createDataFrame([("a", 0.0, 0.0, 50.0, 50.0, "", "")], REGION)
    spark.createDataFrame([(1, 1.0, 1.0, "", "", "j", 0)], POINT).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(POINT).parquet(f"{tmp_path}/in")
    run(stream, regions, tmp_path)
    os.rename(f"{tmp_path}/checkpoint", f"{tmp_path}/lost")
    run(stream, regions, tmp_path)
    assert partition.read_partitions(spark, f"{tmp_path}/out").count() == 1


def test_a_region_of_many_rows_is_several_tasks(spark, tmp_path):
    regions = spark.createDataFrame([("a", 0.0, 0.0, 50.0, 50.0, "", ""), ("b", 60.0, 60.0, 70.0, 70.0, "", "")], REGION)
    rows = spark.range(4000).selectExpr("id % 7 as point_id", "case when id % 50 = 0 then 65D else 10D end as lat", "case when id % 50 = 0 then 65D else 10D end as lon", "'' as country", "'' as state", "'j' as source", "id as ord")
    rows.write.parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    run(spark.readStream.schema(POINT).parquet(f"{tmp_path}/in"), regions, tmp_path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    f = partition.read_fragments(spark, f"{tmp_path}/out").where("region_id = 'a'").orderBy("first").collect()
    assert len(f) >= 3 and sum(x.rows for x in f) == 3920 and all(x["last"].ord < y["first"].ord for x, y in zip(f, f[1:], strict=False))
    got = partition.ordered_partitions(spark, f"{tmp_path}/out").where("region_id = 'a'").orderBy("pos").collect()
    assert [r.ord for r in got] == [i for i in range(4000) if i % 50] and [r.pos for r in got] == list(range(1, 3921))


def test_rows_without_ordinals_keep_the_order_read(spark, tmp_path):
    regions = spark.createDataFrame([("a", 0.0, 0.0, 50.0, 50.0, "", "")], REGION)
    spark.createDataFrame([(i * 37 % 100, 1.0, 1.0, "", "", "j", 0) for i in range(100)], POINT).coalesce(1).write.parquet(f"{tmp_path}/in")
    run(spark.readStream.schema(POINT).parquet(f"{tmp_path}/in").drop("source", "ord"), regions, tmp_path)
    assert [r.point_id for r in partition.ordered_partitions(spark, f"{tmp_path}/out").orderBy("pos").collect()] == [i * 37 % 100 for i in range(100)]


def test_grace_stream(spark, tmp_path):
    schema = "path string, seen_ms long, referenced boolean"
    for i, rows in enumerate([[("a", 0, False), ("b", 0, False)], [("a", 8 * DAY, False), ("b", DAY, True)], [("b", 9 * DAY, False)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        out = []
        spark_stream = grace.grace_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
        spark_stream.writeStream.outputMode("update").foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        assert sorted(out) == [[("a", 0, 0, False), ("b", 0, 0, False)], [("a", 0, 8 * DAY, True)], [("b", 9 * DAY, 9 * DAY, False)]][i]
    assert list(grace._grace(1)(("x",), iter([pd.DataFrame({"seen_ms": [1], "referenced": [True]})]), type("S", (), {"exists": False})())) == []


def test_first_seen_over_several_frames():
    f = lambda *r: pd.DataFrame(r, columns=["seen_ms", "referenced"]).astype({"seen_ms": "int64", "referenced": bool})
    assert grace._first_seen(iter([f((5, False)), f((3, True)), f((2, False), (9, False))]), 1) == (5, 9)
    assert grace._first_seen(iter([f((5, False)), f((7, True))]), None) == (None, 7)
    assert grace._first_seen(iter([f((8, False))]), 4) == (4, 8)


def test_grace_ends_without_a_further_row(spark, tmp_path):
    """`a` is listed once; other paths' rows move the stream's time on until it is eligible. A reference in time stops `b`; state is dropped in the end."""
    schema = "path string, seen timestamp, referenced boolean"
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, grace.ROCKSDB)
    try:
        seen = []
        for rows in ([("a", 0, False), ("b", 0, False)], [("b", 3, True), ("z", 6, True)], [("z", 8, True)], [("c", 9, False)], [("z", 40, True)], [("a", 41, False)]):
            spark.createDataFrame([(p, pd.Timestamp((d + 100) * DAY, unit="ms").to_pydatetime(), r) for p, d, r in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            out = []
            stream = grace.grace_timers(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 7, 20)
            stream.writeStream.outputMode("update").foreachBatch(lambda df, _, out=out: out.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
            seen.append(sorted((p, f // DAY - 100, n // DAY - 100, e) for p, f, n, e in out))
    finally:
        spark.conf.set(key, before)
    assert seen == [[("a", 0, 0, False), ("b", 0, 0, False)], [], [("a", 0, 0, True)], [("c", 9, 9, False)], [("c", 9, 9, True)], [("a", 41, 41, False)]]


def test_record_producers(spark, tmp_path):
    """A batch reads all jobs; a stream those that came since its offset, each once."""
    made = {f"j{i}": [(f"j{i}", k, None if k % 3 == 0 else "é" * k) for k in range(i + 2)] for i in range(4)}
    listing = tmp_path / "jobs.json"
    listing.write_text(json.dumps(["j0", "j1"]))
    spark.dataSource.register(record_source("made_records", "job string, n long, text string", lambda: json.loads(listing.read_text()), lambda job: iter(made[job])))
    batch = lambda: sorted(map(tuple, spark.read.format("made_records").load().collect()), key=str)
    assert batch() == sorted(made["j0"] + made["j1"], key=str)
    reads = []

    def go():
        out = []
        spark.readStream.format("made_records").load().writeStream.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        reads.append(sorted(out, key=str))

    go()
    listing.write_text(json.dumps(["j0", "j1", "j3", "j2"]))
    go()
    go()
    assert reads == [sorted(made["j0"] + made["j1"], key=str), sorted(made["j3"] + made["j2"], key=str), []]
    listing.write_text("[]")
    assert batch() == []


def test_a_batch_of_one_file_is_routed_once_by_several_tasks(spark, tmp_path, monkeypatch):
    """one file of one row group is dealt to tasks before it is routed, and counters and fragments are made of the same routed rows."""
    regions = spark.createDataFrame([("all", -90.0, -180.0, 90.0, 180.0, "", "")], REGION)
    rows = spark.range(200_000).selectExpr("id as point_id", "cast(id % 95 as double) as lat", "1.0D as lon", "'' as country", "'' as state", "concat('job', id % 2) as source", "id as ord")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    seen = []
    stats = partition.placed_stats
    monkeypatch.setattr(partition, "placed_stats", lambda placed: seen.append((placed.storageLevel.useMemory, placed.rdd.getNumPartitions())) or stats(placed))
    run(spark.readStream.schema(POINT).parquet(f"{tmp_path}/in"), regions, tmp_path)
    assert len(seen) == 1 and seen[0][0] and seen[0][1] > 1
    n = sum(1 for i in range(200_000) if i % 95 <= 90)
    got = partition.ordered_partitions(spark, f"{tmp_path}/out")
    assert got.where("pos < 1").isEmpty() and got.select("pos").distinct().count() == got.count() == n
    assert partition.stream_counters(spark, f"{tmp_path}/out").first().asDict() == {"batch_id": 0, "rows_read": 200_000, "normalized": n, "unmatched": 0, "writes": n}


def test_partition_order_with_jobs_of_several_files(spark, monkeypatch):
    """a job of several files is one batch, in order of its rows."""
    from placeflow.plans import queries

    d = "/root/testdata/sf0.001"
    one = {tuple(r) for r in queries.partition_order(spark, d).collect()}
    monkeypatch.setattr(queries, "FILE_ROWS", 50)
    assert {tuple(r) for r in queries.partition_order(spark, d).collect()} == one and one
