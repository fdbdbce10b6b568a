"""Writers: region partitions, snapshots, deltas, state, documents, objects."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.sources import versions


def write_region_partitions(routed: DataFrame, path: str, rows: int = 1_000_000) -> None:
    """Gzip JSON lines below region_id=...; a record of several regions is written once for each. A region has a file for each `rows` records, so none is written by one task alone."""
    # One row for each region.
    files = routed.groupBy("region_id").agg(F.ceil(F.count("*") / rows).cast("int").alias("_files"))
    dealt = routed.join(F.broadcast(files), "region_id").withColumn("_file", F.pmod(F.xxhash64(*[c for c in routed.columns if c != "region_id"]), F.col("_files")))
    dealt.repartition("region_id", "_file").drop("_files", "_file").write.mode("overwrite").partitionBy("region_id").option("compression", "gzip").json(path)


def write_snapshot(corpus: DataFrame, root: str, version: str) -> str:
    """The raw lines as a version of their own, which is the current one once they are whole. Returns its folder; current_snapshot() gives the last one's."""
    lines = corpus.select("raw")
    record = versions.commit(corpus.sparkSession, root, version, lambda path: lines.write.option("compression", "gzip").text(path))
    return f"{root.rstrip('/')}/{record['path']}"


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    """The folder of the last whole snapshot."""
    record = versions.current(spark, root)
    return record and f"{root.rstrip('/')}/{record['path']}"


def write_delta(delta: DataFrame, path: str) -> None:
    """Changed and added lines in fresh order: sorted by range, so that no task holds all."""
    delta.repartitionByRange("seq").sortWithinPartitions("seq").select("raw").write.mode("overwrite").text(path)


def save_state(state: DataFrame, root: str, version: int) -> str:
    """The state as a new version, current once it is whole. A version that isn't above the current one is an error."""
    spark = state.sparkSession
    last = versions.current(spark, root)
    if last and int(last["label"]) >= version:
        raise ValueError(f"state version {version} isn't above {last['label']}")
    record = versions.commit(spark, root, str(version), lambda path: state.write.parquet(path))
    return f"{root.rstrip('/')}/{record['path']}"


def load_state(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The current version; empty if none was ever completed. A state that can't be read fails the job: its files must be as many as were written."""
    record = versions.current(spark, root)
    if record is None:
        return spark.createDataFrame([], schema)
    path = f"{root.rstrip('/')}/{record['path']}"
    if "_SUCCESS" not in versions.names(spark, path):
        raise ValueError(f"state version {record['label']} can't be read at {path}")
    return spark.read.schema(schema).parquet(path)


def write_document(rows: DataFrame, path: str) -> None:
    """Each row as one JSON document of a text table."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def write_objects(objects: DataFrame, root: str) -> DataFrame:
    """(path, size): each row (path, content binary) as a file below the root, written in the tasks that hold the rows.

    Paths must be safe and different. Files are put whole in their place or not at all, and a repeated task writes the same.
    """
    ok = F.when(X.safe_path(F.col("path")).eqNullSafe(F.col("path")), F.col("path")).otherwise(F.raise_error(F.concat(F.lit("unsafe path: "), F.coalesce("path", F.lit("none")))).cast("string"))
    rows = objects.select(ok.alias("path"), F.coalesce("content", F.lit("").cast("binary")).alias("content"))
    return rows.mapInArrow(_put(versions.qualified(objects.sparkSession, root)), "path string, size long")


def _put(root: str):
    def run(batches):
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(root)
        for batch in batches:
            sizes = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                folder, _, name = f"{base}/{path}".rpartition("/")
                draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
                fs.create_dir(folder, recursive=True)
                with fs.open_output_stream(draft) as out:
                    out.write(content)
                fs.move(draft, f"{folder}/{name}")
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "size"])

    return run
