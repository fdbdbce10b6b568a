"""Versions of a table with commit records.

Every version's files go to a folder of its own. Only when they are whole, a record that names the folder is renamed into
`_commits`, which is what makes the version exist: readers look for the last record, never for folders, so an interrupted
save leaves the version before it in force, and a version whose record stands but whose files can't be read fails.
Two writers of one version can't both succeed, since a record never replaces another. Records are numbered; their label is
the caller's.

A reader that needs a version for longer takes a lease on it. vacuum() deletes the folders of old versions that nobody
holds, and what interrupted saves left behind. A record may name folders of earlier versions too (its `regions`); these are kept as well.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

COMMITS, DATA, READERS = "_commits", "data", "_readers"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's file readers name it, without a slash at the end."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toString().rstrip("/")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it doesn't exist."""
    fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, folder))) if fs.exists(_path(spark, folder)) else []


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all; an error if there is one already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    out = _fs(spark, path).create(_path(spark, draft), False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        # Renaming with NONE fails where the target exists.
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, qualified(spark, folder)).toUri(), conf).rename(_path(spark, qualified(spark, draft)), _path(spark, qualified(spark, path)), options)
    except Exception:
        delete(spark, draft)
        raise


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def escaped(spark: SparkSession, value: str) -> str:
    """A value as Spark writes it in the name of a partition's folder."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def commits(spark: SparkSession, root: str) -> list[dict]:
    """The records of all versions, first to last."""
    folder = f"{root.rstrip('/')}/{COMMITS}"
    return [json.loads(read_text(spark, f"{folder}/{n}")) for n in names(spark, folder) if not n.startswith(".")]


def current(spark: SparkSession, root: str) -> dict | None:
    """The record of the last version: number, label, path (below the root), time_ms and whatever its writer added."""
    folder = f"{root.rstrip('/')}/{COMMITS}"
    found = [n for n in names(spark, folder) if not n.startswith(".")]
    return json.loads(read_text(spark, f"{folder}/{found[-1]}")) if found else None


def commit(spark: SparkSession, root: str, label: str, write: Callable[[str], dict | None]) -> dict:
    """A new version: write(folder) writes its files and may return more for the record. Returns the record."""
    root = root.rstrip("/")
    last = current(spark, root)
    number = last["number"] + 1 if last else 0
    # Names that begin with a mark are hidden from Spark's readers, and colons can't stand in a path.
    path = f"{DATA}/v{re.sub('[^A-Za-z0-9.-]', '_', label)}-{uuid.uuid4().hex}"
    more = write(f"{root}/{path}") or {}
    record = {"number": number, "label": label, "path": path, "time_ms": int(time.time() * 1000), **more}
    create_text(spark, f"{root}/{COMMITS}/{number:012d}.json", json.dumps(record, sort_keys=True))
    return record


def lease(spark: SparkSession, root: str, number: int, hours: float = 24) -> str:
    """Keeps a version's files until the lease is deleted or has run out. Returns its path."""
    path = f"{root.rstrip('/')}/{READERS}/{number:012d}-{uuid.uuid4().hex}"
    create_text(spark, path, str(int(time.time() * 1000 + hours * 3_600_000)))
    return path


def vacuum(spark: SparkSession, root: str, keep: int = 2, grace_hours: float = 24) -> list[str]:
    """Delete the folders that no record among the last `keep`, no lease and no save within the grace period holds; returns their names. Records stay, as history."""
    root, now = root.rstrip("/"), time.time() * 1000
    records = commits(spark, root)
    named = lambda r: {r["path"], *("/".join(x["path"].split("/")[:2]) for x in r.get("regions", {}).values())}
    held = set().union(*map(named, records[-keep:])) if keep else set()
    for n in names(spark, f"{root}/{READERS}"):
        if not n.startswith(".") and int(read_text(spark, f"{root}/{READERS}/{n}")) > now:
            held |= set().union(*(named(r) for r in records if r["number"] == int(n.split("-")[0])))
    fs, gone = _fs(spark, root), []
    listed = fs.listStatus(_path(spark, f"{root}/{DATA}")) if fs.exists(_path(spark, f"{root}/{DATA}")) else []
    known = {r["path"] for r in records}
    for s in listed:
        path = f"{DATA}/{s.getPath().getName()}"
        if path not in held and (path in known or now - s.getModificationTime() >= grace_hours * 3_600_000):
            fs.delete(s.getPath(), True)
            gone.append(path)
    return sorted(gone)
