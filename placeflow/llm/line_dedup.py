"""Removal of lines that many documents repeat, by a sharded minimal perfect hash.

A line's key is the line stripped of ASCII white space with A-Z lower-cased. Keys are hashed to 128 bits;
each task counts its own keys before the shuffle, so a line that a third of all documents hold is one row
for each task. Keys found in enough documents are dealt to shards. A shard is a minimal perfect hash of
its keys (levels of bit arrays) with arrays of fingerprints, document counts and largest ids at the hash's
places. Documents probe these arrays; lines aren't joined. If all shards fit BROADCAST_BYTES (the size is
known from the count of keys), each document is probed as it is read. Else line digests are dealt by shard,
those of a shard with many to slices of about SLICE_DIGESTS, each slice is probed in a task that holds its one
shard, and what is found is joined to the documents by id.

Null or empty texts are one empty line. Rows that share an id are one document, so are rows without one, whose
id counts as smaller than any other. A very long text is a slice of its own; its lines are held at once. Other
columns are ignored, or carried if they are named. Lines keep their order. An empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm._common import ASCII_SPACE, give_back, mix, parts
from placeflow.scratch import save

KEYS_PER_SHARD = 1 << 19
BROADCAST_BYTES = 64 << 20
KEY_BYTES = 20
SLICE_DIGESTS = 1 << 20
#: Ids (about 40 bytes each in memory) that may be sent to all tasks.
BROADCAST_IDS = 500_000
_LEVELS, _GAMMA = 40, 1.6
_FIRST = -(1 << 63)
_U = np.uint64
_SHARD = "shard int, sizes binary, words binary, fingerprints binary, counts binary, largest binary, rest binary"


def line_key(line: bytes) -> bytes:
    return line.strip(ASCII_SPACE).lower()


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys + _U(level * 0x9E3779B97F4A7C15 % (1 << 64))) % _U(size)).astype(np.int64)


class Shard:
    """A minimal perfect hash of keys with arrays at its places."""

    def __init__(self, sizes, words, fingerprints, counts, largest, rest):
        self.sizes, self.words, self.fingerprints, self.counts, self.largest = sizes, words, fingerprints, counts, largest
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.rest = {(int(lo), int(hi)): (int(n), int(np.int64(d))) for lo, hi, n, d in rest.reshape(-1, 4)}

    @staticmethod
    def build(lo: np.ndarray, hi: np.ndarray, counts: np.ndarray, largest: np.ndarray) -> Shard:
        left, sizes, bits = np.arange(len(lo)), [], []
        for level in range(_LEVELS):
            if not len(left):
                break
            size = -(-max(64, int(_GAMMA * len(left))) // 64) * 64
            at = _at(lo[left], level, size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bit = np.zeros(size, bool)
            bit[at[alone]] = True
            sizes.append(size)
            bits.append(bit)
            left = left[~alone]
        words = np.packbits(np.concatenate(bits) if bits else np.zeros(0, bool), bitorder="little").view("<u8")
        rest = np.stack([lo[left], hi[left], counts[left].astype(np.uint64), largest[left].astype(np.int64).view(np.uint64)], 1) if len(left) else np.zeros((0, 4), np.uint64)
        shard = Shard(np.array(sizes, np.int64), words, None, None, None, rest)
        keep = np.ones(len(lo), bool)
        keep[left] = False
        place = shard.place(lo[keep])
        shard.fingerprints, shard.counts, shard.largest = np.empty(len(place), np.uint64), np.empty(len(place), np.uint32), np.empty(len(place), np.int64)
        shard.fingerprints[place], shard.counts[place], shard.largest[place] = hi[keep], np.minimum(counts[keep], 2**32 - 1), largest[keep]
        return shard

    def place(self, lo: np.ndarray) -> np.ndarray:
        """The place of each key; keys that aren't in the shard get any place or -1."""
        out, left, base = np.full(len(lo), -1, np.int64), np.arange(len(lo)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = _at(lo[left], level, size) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & _U(1) == 1
            below = np.bitwise_count(word & ((_U(1) << bit) - _U(1))).astype(np.int64)
            out[left[hit]] = (self.before[at >> 6] + below)[hit]
            left = left[~hit]
            base += size
        return out

    def probe(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents that hold the key, 0 for keys not held; largest id among them)."""
        place = self.place(lo)
        held = place >= 0
        if len(self.fingerprints):
            held &= self.fingerprints[place] == hi
        counts, largest = np.zeros(len(lo), np.int64), np.full(len(lo), _FIRST, np.int64)
        counts[held], largest[held] = self.counts[place[held]], self.largest[place[held]]
        if self.rest:
            for i in range(len(lo)):
                if (k := (int(lo[i]), int(hi[i]))) in self.rest:
                    counts[i], largest[i] = self.rest[k]
        return counts, largest

    def row(self) -> list[bytes]:
        return [x.tobytes() for x in (self.sizes, self.words, self.fingerprints, self.counts, self.largest)] + [np.array([[lo, hi, n, np.int64(d).view(np.uint64)] for (lo, hi), (n, d) in self.rest.items()], np.uint64).tobytes()]

    @staticmethod
    def load(row) -> Shard:
        kinds = {"sizes": "<i8", "words": "<u8", "fingerprints": "<u8", "counts": "<u4", "largest": "<i8", "rest": "<u8"}
        return Shard(*(np.frombuffer(row[k], kind) for k, kind in kinds.items()))


class Index:
    """Some of the shards; shards: their number in all."""

    def __init__(self, rows: list, shards: int):
        self.held, self.shards = {r["shard"]: Shard.load(r) for r in rows}, shards

    def probe(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, largest = np.zeros(len(lo), np.int64), np.full(len(lo), _FIRST, np.int64)
        of = (hi % _U(self.shards)).astype(np.int64)
        for number, shard in self.held.items():
            at = np.flatnonzero(of == number)
            if len(at):
                counts[at], largest[at] = shard.probe(lo[at], hi[at])
        return counts, largest


def _digests(text: bytes, least: int) -> tuple[list[bytes], list[tuple[int, bytes]]]:
    """(the lines, number and digest of those with a key long enough)."""
    lines = text.split(b"\n")
    return lines, [(i, xxhash.xxh3_128_digest(k)) for i, line in enumerate(lines) if len(line) >= least and _long(k := line_key(line), least)]


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _ids(batch: pa.RecordBatch) -> list[int]:
    return [_FIRST if i is None else i for i in batch.column("doc_id").to_pylist()]


def _count_lines(least: int):
    """The number of rows with each key, and their largest id."""

    def run(batches):
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for part in parts(batch):
                for doc, text in zip(_ids(part), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    for d in {d for _, d in _digests(text, least)[1]}:
                        if (s := seen.get(d)) is None:
                            seen[d] = [1, doc]
                        else:
                            s[0] += 1
                            s[1] = max(s[1], doc)
            lo, hi = _halves(list(seen))
            yield pa.RecordBatch.from_arrays([pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)), pa.array([s[0] for s in seen.values()], pa.int64()), pa.array([s[1] for s in seen.values()], pa.int64())], ["lo", "hi", "n", "largest"])
            give_back()

    return run


def _pairs(least: int):
    """Each key with each id of the rows that hold it."""

    def run(batches):
        for batch in batches:
            for part in parts(batch):
                pairs = {(doc, d) for doc, text in zip(_ids(part), part.column("text").cast(pa.binary()).to_pylist(), strict=True) for _, d in _digests(text, least)[1]}
                lo, hi = _halves([d for _, d in pairs])
                yield pa.RecordBatch.from_arrays([pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)), pa.array([doc for doc, _ in pairs], pa.int64())], ["lo", "hi", "largest"])

    return run


def _build(table: pa.Table) -> pa.Table:
    lo, hi = (table.column(c).to_numpy().view(np.uint64) for c in ("lo", "hi"))
    shard = Shard.build(lo, hi, table.column("n").to_numpy(), table.column("largest").to_numpy())
    return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int32()), *(pa.array([x], pa.binary()) for x in shard.row())], names=["shard", "sizes", "words", "fingerprints", "counts", "largest", "rest"])


def line_index(docs: DataFrame, least_chars: int, least_docs: int) -> tuple[DataFrame, int, int]:
    """(a row for each shard, the number of shards, the number of keys) for the keys in at least least_docs documents. docs: doc_id, text."""
    own = docs.select("doc_id", "text")
    # Ids of several rows: their keys are told apart by id, all others are counted row by row.
    shared = save(own.select(F.coalesce("doc_id", F.lit(_FIRST)).alias("key")).groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"), "line-ids")
    n_shared = shared.count()
    several = None
    if n_shared:
        some = F.broadcast(shared) if n_shared <= BROADCAST_IDS else shared
        keyed = own.withColumn("key", F.coalesce("doc_id", F.lit(_FIRST)))
        several = keyed.join(some, "key", "left_semi").select("doc_id", "text")
        own = keyed.join(some, "key", "left_anti").select("doc_id", "text")
    counted = own.mapInArrow(_count_lines(least_chars), "lo long, hi long, n long, largest long")
    if several is not None:
        pairs = several.mapInArrow(_pairs(least_chars), "lo long, hi long, largest long").distinct()
        counted = counted.unionByName(pairs.withColumn("n", F.lit(1).cast("long")))
    keys = save(counted.groupBy("lo", "hi").agg(F.sum("n").alias("n"), F.max("largest").alias("largest")).where(F.col("n") >= least_docs), "line-keys")
    n = keys.count()
    shards = max(1, math.ceil(n / KEYS_PER_SHARD))
    rows = keys.withColumn("shard", _shard_of(shards)).groupBy("shard").applyInArrow(_build, _SHARD)
    return save(rows, "line-shards"), shards, n


def _drop(held, index_of, least: int, more: tuple[str, ...]):
    """Documents with the lines dropped that held (by digest) or the index tells of."""

    def run(batches):
        index = index_of() if index_of else None
        for batch in batches:
            for part in parts(batch):
                docs = [_digests(t, least) for t in part.column("text").cast(pa.binary()).to_pylist()]
                ids = _ids(part)
                if index is not None:
                    owner = np.repeat(np.array(ids, np.int64), [len(d) for _, d in docs])
                    counts, largest = index.probe(*_halves([x for _, d in docs for _, x in d]))
                    gone = ((counts > 0) & (owner < largest)).tolist()
                else:
                    dropped = [set(map(bytes, x or ())) for x in part.column(held).to_pylist()]
                    gone = [x in s for (_, d), s in zip(docs, dropped, strict=True) for _, x in d]
                kept, n_lines, n_dropped, at = [], [], [], 0
                for lines, d in docs:
                    out = {i for (i, _), g in zip(d, gone[at : at + len(d)], strict=True) if g}
                    at += len(d)
                    n_lines.append(len(lines))
                    n_dropped.append(len(out))
                    kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in out) if out else None)
                text = part.column("text").to_pylist()
                text = [t if k is None else k.decode() for t, k in zip(text, kept, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(text, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), *(part.column(c) for c in more)], ["doc_id", "text", "n_lines", "n_dropped", *more])
            give_back()

    return run


def _hashes(least: int):
    """The distinct keys of each document."""

    def run(batches):
        for batch in batches:
            for part in parts(batch):
                pairs = {(doc, d) for doc, text in zip(_ids(part), part.column("text").cast(pa.binary()).to_pylist(), strict=True) for _, d in _digests(text, least)[1]}
                lo, hi = _halves([d for _, d in pairs])
                yield pa.RecordBatch.from_arrays([pa.array([doc for doc, _ in pairs], pa.int64()), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64))], ["key", "lo", "hi"])

    return run


def _probe(digests: pa.Table, shard: pa.Table) -> pa.Table:
    """The digests of a slice that the shard drops from their documents."""
    key = digests.column("key").to_numpy()
    gone = np.zeros(len(key), bool)
    if shard.num_rows and len(key):
        lo, hi = (digests.column(c).to_numpy().view(np.uint64) for c in ("lo", "hi"))
        counts, largest = Shard.load({c: shard.column(c)[0].as_py() for c in shard.column_names}).probe(lo, hi)
        gone = (counts > 0) & (key < largest)
    found = digests.filter(pa.array(gone))
    both = np.stack([found.column(c).to_numpy() for c in ("lo", "hi")], 1).astype("<i8")
    return pa.table([found.column("key"), pa.array([x.tobytes() for x in both], pa.binary())], names=["key", "digest"])


def _shard_of(shards: int):
    """The upper half as an unsigned number, modulo the shards."""
    return F.expr(f"cast(pmod(pmod(shiftrightunsigned(hi, 1), {shards}) * 2 + (hi & 1), {shards}) as int)")


def drop_repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, broadcast_bytes: int = BROADCAST_BYTES, slice_digests: int = SLICE_DIGESTS) -> DataFrame:
    """doc_id, text (without the dropped lines), n_lines, n_dropped and, with carry, a struct `row` of docs' other columns.

    A key of at least least_chars code points in at least least_docs documents (by id) loses its lines in all
    documents but the one with the largest id.
    """
    spark = docs.sparkSession
    columns = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")]
    if carry:
        columns.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("row"))
    own = docs.select(*columns)
    more = ("row",) if carry else ()
    rows, shards, n = line_index(own, least_chars, least_docs)
    schema = ", ".join(["doc_id long", "text string", "n_lines long", "n_dropped long", *(f"row {own.schema['row'].dataType.simpleString()}" for _ in more)])

    def broadcast(part: DataFrame):
        # At most broadcast_bytes (or one shard): the number of keys in it is known.
        sent = spark.sparkContext.broadcast([r.asDict() for r in part.collect()])
        return lambda: Index(sent.value, shards)

    if n * KEY_BYTES <= broadcast_bytes:
        return own.mapInArrow(_drop(None, broadcast(rows), least_chars, more), schema)
    hashes = save(own.mapInArrow(_hashes(least_chars), "key long, lo long, hi long").withColumn("shard", _shard_of(shards)), "line-digests")
    # A row for each shard: into how many slices its digests go.
    slices = save(hashes.groupBy("shard").agg(F.ceil(F.count("*") / slice_digests).cast("int").alias("slices")), "line-slices")
    dealt = hashes.join(F.broadcast(slices), "shard").withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))
    copies = rows.join(F.broadcast(slices), "shard").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    arrays = [c for c in rows.columns if c != "shard"]
    left = dealt.select("shard", "slice", "key", "lo", "hi").groupBy("shard", "slice")
    found = left.cogroup(copies.select("shard", "slice", *arrays).groupBy("shard", "slice")).applyInArrow(_probe, "key long, digest binary")
    # A document's own lines only: as many as the document has.
    lists = found.groupBy("key").agg(F.collect_set("digest").alias("gone"))
    joined = own.withColumn("key", F.coalesce("doc_id", F.lit(_FIRST))).join(lists, "key", "left").drop("key")
    return joined.mapInArrow(_drop("gone", None, least_chars, more), schema)
