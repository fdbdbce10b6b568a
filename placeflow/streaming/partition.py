"""Streams: routing new source files to region partitions with a commit log, running counters."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.operators.spatial import placed, placed_stats, routed_rows
from placeflow.sources import versions

#: Where a row stands: the job or file that it comes from, and its place in it.
ORDER = ("source", "ord")
LOG = "log"


def _committed(spark: SparkSession, out: str) -> dict[int, dict]:
    """The records of all whole batches, by batch."""
    return {r["batch_id"]: r for r in (json.loads(versions.read_text(spark, f"{out}/{LOG}/{n}")) for n in versions.names(spark, f"{out}/{LOG}") if not n.startswith("."))}


def start_partition_stream(points: DataFrame, regions: DataFrame, out: str, checkpoint: str, order: tuple[str, ...] = ORDER, before_commit: Callable[[int], None] | None = None):
    """Route a stream of points to their regions. Each batch's fragments are written first, then one record that makes them count.

    A batch's rows are dealt to tasks before they are routed, so a file that one task has to read is routed by many, and
    once: fragments and counters are made of the rows that stand with their regions.
    Fragments are dealt by ranges of (region, source, row), so a region of many rows is several tasks', and each file holds
    rows of one region in the order of their source. The record names the batch's folder and the table of its fragments (region_id, file,
    first and last source and row, rows), with counters of the batch. Readers take what records name: a batch that
    breaks off anywhere before its record leaves files that nobody reads, and is written again in a folder of its own; a batch that is
    run again after its record does nothing. Columns of the order that points lack are filled with the place in the batch.
    before_commit is called between the two steps.
    """
    out = out.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{batch_id:012d}.json"
        if name in versions.names(spark, f"{out}/{LOG}"):
            return
        missing = [c for c in order if c not in batch.columns]
        dealt = batch.withColumns({c: F.monotonically_increasing_id() for c in missing}).repartition(*order)
        rows = placed(dealt, regions).persist()
        try:
            attempt = f"batch_id={batch_id}/attempt={uuid.uuid4().hex}"
            keys = ("region_id", *order)
            routed_rows(rows).repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("region_id").parquet(f"{out}/data/{attempt}")
            place = F.struct(*order)
            written = spark.read.schema(routed_rows(rows).schema).parquet(f"{out}/data/{attempt}")
            fragments = written.groupBy("region_id", F.col("_metadata.file_name").alias("file")).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("rows"))
            fragments.write.parquet(f"{out}/fragments/{attempt}")
            stats = placed_stats(rows).first().asDict()
            if before_commit:
                before_commit(batch_id)
            record = {"batch_id": batch_id, "attempt": attempt, "schema": written.schema.jsonValue(), **stats}
            versions.create_text(spark, f"{out}/{LOG}/{name}", json.dumps(record, sort_keys=True))
        finally:
            rows.unpersist()

    return points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _listed(spark: SparkSession, out: str, folder: str, schema=None) -> DataFrame:
    records = _committed(spark, out.rstrip("/"))
    if not records:
        raise ValueError(f"no batch is committed at {out}")
    base = f"{out.rstrip('/')}/{folder}"
    reader = spark.read.option("basePath", base)
    return (reader.schema(schema(records)) if schema else reader).parquet(*(f"{base}/{r['attempt']}" for r in records.values()))


def _row_schema(records: dict[int, dict]):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType.fromJson(next(iter(records.values()))["schema"])
    return StructType([*schema.fields, StructField("batch_id", LongType()), StructField("attempt", StringType())])


def read_partitions(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all whole batches, with region_id, batch_id and attempt."""
    return _listed(spark, out, "data", _row_schema)


def read_fragments(spark: SparkSession, out: str) -> DataFrame:
    """(region_id, file, first, last, rows, batch_id, attempt) of all whole batches."""
    return _listed(spark, out, "fragments")


def ordered_partitions(spark: SparkSession, out: str) -> DataFrame:
    """The rows with pos, their place in their region from 1: by batch, then source and row.

    Only fragments are put in order; a row's place is its fragment's and its own in the file, so no region meets in one task.
    """
    by = W.partitionBy("region_id").orderBy("batch_id", "first", "last").rowsBetween(W.unboundedPreceding, -1)
    before = read_fragments(spark, out).select("region_id", "batch_id", "attempt", "file", F.coalesce(F.sum("rows").over(by), F.lit(0)).alias("before"))
    rows = read_partitions(spark, out).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.join(before, ["region_id", "batch_id", "attempt", "file"]).withColumn("pos", F.col("before") + F.col("row") + 1).drop("file", "row", "before")


def stream_counters(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, rows_read, normalized, unmatched, writes) of each whole batch: one row for each record."""
    rows = [(r["batch_id"], r["rows_read"], r["normalized"], r["unmatched"], r["writes"]) for r in _committed(spark, out.rstrip("/")).values()]
    return spark.createDataFrame(rows, "batch_id long, rows_read long, normalized long, unmatched long, writes long")


def start_counters_stream(points: DataFrame, key: str, out: str, checkpoint: str):
    """Running counts of each key, carried in state from batch to batch; every batch makes the counts so far the current version of a table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        last = versions.current(batch.sparkSession, out)
        if last is None or int(last["label"]) < batch_id:
            versions.commit(batch.sparkSession, out, str(batch_id), lambda path: batch.write.parquet(path))

    return points.groupBy(key).agg(F.count("*").alias("n")).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_counters(spark: SparkSession, out: str) -> DataFrame:
    """The counts of the last whole batch."""
    record = versions.current(spark, out)
    if record is None:
        raise ValueError(f"no batch is committed at {out}")
    return spark.read.parquet(f"{out.rstrip('/')}/{record['path']}")
