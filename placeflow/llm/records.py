"""Token ids in files of length-delimited records, with a separate index of offsets.

A record is framed as: length of the data (8 bytes, little-endian), masked CRC-32C of those 8 bytes (4), the
data, masked CRC-32C of the data (4). Data: flags (4 bytes: bit 0, an id follows; bits 8 on, bytes of one
token), the document's id (8), then its tokens, as unsigned integers of 2 bytes where the vocabulary allows it,
else of 4. So a file can be read from its start without an index, and any record by its offset.

Documents are dealt to tasks by ranges of their ids and sorted within, so files, in order of their names, hold
ascending ids; those without an id come first, rows that share an id stand beside each other in the order read.
A task writes files of about FILE_BYTES under names of its own attempt and returns a row for each record: the
index, a Parquet table (file, part, roll, at, bytes, first, doc_id, n_tokens). Only rows of committed tasks get
there, so files of lost or repeated attempts are never read. Files are written through pyarrow's file systems
(local, HDFS, object stores) into the folder that driver and executors share.

Encoding: with a byte-level vocabulary that has no normaliser, the pieces that the library's pattern makes are found in array
passes, and the library encodes each once in a task (see Encoder); pieces are told apart by 64-bit hashes. Texts that hold a
special string, and texts under other vocabularies, are encoded whole by the library.

Null and empty texts give a record of the end id alone. Repeated rows give a record each. A very long text is one
record, in memory of a few times its size. Other columns of the input are ignored. An empty table gives no files.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, mix, parts, texts
from placeflow.llm.bpe import byte_symbols, spread
from placeflow.scratch import new_path, save

FILE_BYTES = 128 << 20
#: Bytes of text that are encoded at a time.
SLICE = 2 << 20
#: Bytes of records that are read and checked at a time.
CHUNK = 4 << 20
#: Pieces remembered in a task, and their characters.
PIECES, HELD = 1_000_000, 24 << 20
_INDEX = "file string, part int, roll int, at long, bytes long, first long, doc_id long, n_tokens long"
_RECORD = "doc_id long, start long, n_tokens long, ids binary"

# CRC-32C (Castagnoli) --------------------------------------------------------------------------------------------

_POLY, _WORDS, _MASK = 0x82F63B78, 64, 0xA282EAD8


def _tables() -> np.ndarray:
    t = np.zeros((4, 256), np.uint32)
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ (np.uint32(_POLY) * (c & np.uint32(1)))
    t[0] = c
    for k in range(1, 4):
        t[k] = (t[k - 1] >> np.uint32(8)) ^ t[0][t[k - 1] & np.uint32(255)]
    return t


_T = _tables()


def _word_step(x: np.ndarray) -> np.ndarray:
    """The checksum four bytes on; x: the checksum so far, xor the next four bytes."""
    b = np.uint32(255)
    return _T[3][x & b] ^ _T[2][(x >> np.uint32(8)) & b] ^ _T[1][(x >> np.uint32(16)) & b] ^ _T[0][x >> np.uint32(24)]


def _block_shift() -> np.ndarray:
    """What a block of zeros makes of each byte of a checksum."""
    c = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    for _ in range(_WORDS):
        c = _word_step(c)
    return c.reshape(4, 256)


_SHIFT = _block_shift()


def crc32c(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32C of each message data[offsets[i]:offsets[i + 1]], of at least four bytes each.

    Messages are cut into blocks from their ends, zeros in front of the first (they leave the sum as it is); all blocks go
    on by a word at a time together, and a message's blocks are then put together in order.
    """
    sizes = np.diff(offsets)
    if not len(sizes):
        return np.zeros(0, np.uint32)
    block = 4 * _WORDS
    blocks = -(-sizes // block)
    ends = np.cumsum(blocks)
    buffer = np.zeros(int(ends[-1]) * block, np.uint8)
    begin = ends * block - sizes
    buffer[np.repeat(begin - offsets[:-1], sizes) + np.arange(offsets[0], offsets[-1])] = data[offsets[0] : offsets[-1]]
    for k in range(4):
        buffer[begin + k] ^= 255
    words = np.ascontiguousarray(buffer.view("<u4").reshape(-1, _WORDS).T)
    c = np.zeros(words.shape[1], np.uint32)
    for row in words:
        c = _word_step(c ^ row)
    b = np.uint32(255)
    out, first, at = np.zeros(len(sizes), np.uint32), ends - blocks, np.arange(len(sizes))
    for k in range(int(blocks.max())):
        at = at[blocks[at] > k]
        x = out[at]
        out[at] = _SHIFT[0][x & b] ^ _SHIFT[1][(x >> np.uint32(8)) & b] ^ _SHIFT[2][(x >> np.uint32(16)) & b] ^ _SHIFT[3][x >> np.uint32(24)] ^ c[first[at] + k]
    return ~out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted by a constant, so that data that hold checksums are no special case."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK)


# Encoding --------------------------------------------------------------------------------------------------------

_LETTER, _NUMBER, _OTHER, _SPACE, _UNSEEN = range(5)
#: Pieces longer than this are told apart by XXH3: for long ones, unlike pieces with equal polynomials are easily built.
_LONG = 32
_BASE = 0x9E3779B97F4A7C15
#: Ends of contractions that are pieces of their own.
_ONE, _TWO = "stmd", ("re", "ve", "ll")


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    with np.errstate(over="ignore"):
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Encoder:
    """The ids of texts under a vocabulary file.

    With a byte-level vocabulary whose pattern is the usual one (contractions; runs of letters, of numbers and of others, each
    with a space before it; white space), pieces are found in array passes over code points, and the library's model is asked
    once for each distinct piece, by hash, in the order of the text. Which code points are letters, numbers or white space is
    asked of the library too, once each.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        usual = pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space")
        plain = spec.get("normalizer") is None and spec.get("post_processor") is None and not model.get("dropout")
        self.cuts = usual and plain and model.get("type", "BPE") == "BPE"
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.letters = dict(enumerate(byte_symbols()))
        self.kinds = np.full(0x110000, _UNSEEN, np.uint8)
        self.kinds[32] = _SPACE
        self.forget()

    def forget(self) -> None:
        self.held = 0
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.values, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _kind(self, ch: str) -> int:
        pre = self.tokenizer.pre_tokenizer.pre_tokenize_str
        among = pre(f"a{ch}1")
        if len(among) == 2:
            return _NUMBER if among[0][0] == "a" else _LETTER
        return _OTHER if len(pre(f"{ch}!")) == 1 else _SPACE

    def _starts(self, points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Where pieces start. firsts: the first place of each text that isn't empty."""
        kinds = self.kinds[points]
        if (kinds == _UNSEEN).any():
            for p in np.unique(points[kinds == _UNSEEN]).tolist():
                self.kinds[p] = self._kind(chr(p))
            kinds = self.kinds[points]
        n = len(points)
        first = np.zeros(n + 1, bool)
        first[firsts] = first[n] = True
        space = kinds == _SPACE
        change = first[:n].copy()
        change[1:] |= kinds[1:] != kinds[:-1]
        # The last white space before anything else starts a piece: alone, or as the space before what follows.
        last = space.copy()
        last[:-1] &= ~space[1:]
        last &= ~first[1:]
        starts = change | last
        joined = np.zeros(n, bool)
        joined[1:] = (points[:-1] == 32) & ~space[1:] & ~first[1:n]
        starts &= ~joined
        for i in np.flatnonzero((points == 39) & starts).tolist():
            tail = points[i + 1 : i + 3].tolist()
            room = 0 if first[i + 1] else 1 if i + 2 > n or first[i + 2] else 2
            size = 1 if room and chr(tail[0]) in _ONE else 2 if room == 2 and chr(tail[0]) + chr(tail[1]) in _TWO else 0
            if size:
                starts[i + 1 : i + 1 + size] = False
                if i + 1 + size < n:
                    starts[i + 1 + size] = True
        return np.flatnonzero(starts)

    def _hashes(self, text: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = _powers(1 << max(12, (len(points)).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(points) + 1, np.uint64)
            np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
            out = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        for k in np.flatnonzero(ends - starts > _LONG).tolist():
            out[k] = xxhash.xxh3_64_intdigest(text[starts[k] : ends[k]].encode(), 1)
        return out

    def _pieces(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number for each row)."""
        text = "".join(rows)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        if not text:
            return np.zeros(0, np.uint32), np.zeros(len(rows), np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        starts = self._starts(points, offsets[:-1][lengths > 0])
        ends = np.append(starts[1:], len(points))
        distinct, at, which = np.unique(self._hashes(text, points, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) and (self.held > HELD or len(self.hashes) + len(distinct) > PIECES):
            self.forget()
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        new = at[~known]
        ask, letters = self.tokenizer.model.tokenize, self.letters
        got = [[t.id for t in ask(text[a:b].encode().decode("latin-1").translate(letters))] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
        places = np.arange(len(self.sizes), len(self.sizes) + len(got))
        self.values = np.concatenate([self.values, np.fromiter((i for ids in got for i in ids), np.uint32)])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, got), np.int64, len(got))])
        self.held += int((ends - starts)[new].sum())
        hashes, all_ = np.concatenate([self.hashes, distinct[~known]]), np.concatenate([self.places, places])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], all_[order]
        picks = self.places[np.searchsorted(self.hashes, distinct)][which]
        ids, sizes = spread(self.values, self.sizes, np.cumsum(self.sizes), picks)
        before = np.concatenate(([0], np.cumsum(sizes)))
        return ids, np.diff(before[np.searchsorted(starts, offsets)])

    def encode(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, their number for each row)."""
        whole = [i for i, t in enumerate(rows) if t and (not self.cuts or any(s in t for s in self.special))]
        own = {i: np.array(e.ids, np.uint32) for i, e in zip(whole, self.tokenizer.encode_batch_fast([rows[i] for i in whole], add_special_tokens=False), strict=True)} if whole else {}
        ids, counts = self._pieces(["" if i in own else t for i, t in enumerate(rows)] if own else rows)
        if own:
            cuts = np.concatenate(([0], np.cumsum(counts)))
            each = [own.get(i, ids[cuts[i] : cuts[i + 1]]) for i in range(len(rows))]
            ids, counts = np.concatenate(each), np.array([len(e) for e in each], np.int64)
        return ids, counts


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# Files -----------------------------------------------------------------------------------------------------------


def _store(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def frames(doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray, width: int) -> list[bytes]:
    """The framed record of each document."""
    tokens, at = ids.astype(f"<u{width}").tobytes(), 0
    data = []
    for doc_id, n in zip(doc_ids, counts.tolist(), strict=True):
        data.append(struct.pack("<Iq", width << 8 | (doc_id is not None), doc_id or 0) + tokens[at : at + n * width])
        at += n * width
    sizes = np.array([len(d) for d in data], "<i8")
    heads = masked(crc32c(sizes.view(np.uint8), np.arange(len(data) + 1) * 8))
    sums = masked(crc32c(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum(sizes)))))
    return [struct.pack("<qI", len(d), h) + d + struct.pack("<I", s) for d, h, s in zip(data, heads.tolist(), sums.tolist(), strict=True)]


def _with_end(ids: np.ndarray, counts: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    if end is None:
        return ids, counts
    return np.insert(ids, np.cumsum(counts), end), counts + 1


def _write(folder: str, path: str, end: int | None, most: int):
    def run(batches):
        fs, base = _store(folder)
        fs.create_dir(base, recursive=True)
        encoder = _encoder(path)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        roll, at, first, out, name = -1, 0, 0, None, ""
        try:
            for batch in batches:
                for some in parts(batch, most=SLICE):
                    doc_ids = some.column("doc_id").to_pylist()
                    ids, counts = _with_end(*encoder.encode(some.column("text").to_pylist()), end)
                    rows = []
                    for doc_id, n, frame in zip(doc_ids, counts.tolist(), frames(doc_ids, ids, counts, encoder.width), strict=True):
                        if out is None or at >= most:
                            if out is not None:
                                out.close()
                            roll, at, first = roll + 1, 0, 0
                            name = f"part-{part:06d}-{roll:05d}-{attempt}.rec"
                            out = fs.open_output_stream(f"{base}/{name}")
                        out.write(frame)
                        rows.append((name, part, roll, at, len(frame), first, doc_id, n))
                        at += len(frame)
                        first += n
                    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _INDEX.split(", ")])
                give_back()
        finally:
            if out is not None:
                out.close()

    return run


def write_records(docs: DataFrame, vocabulary_path: str, folder: str | None = None, end: int | None = 0, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """(folder, index): the documents' ids, each with the end id behind (None: without), in record files of a new folder of the shared store."""
    folder = folder or new_path(docs.sparkSession, "records")
    # The number of the row spreads an id that many rows share over several tasks.
    own = texts(docs, id_col, text_col).withColumn("n", F.monotonically_increasing_id())
    dealt = own.repartitionByRange("doc_id", "n").sortWithinPartitions("doc_id", "n").select("doc_id", "text")
    return folder, save(dealt.mapInArrow(_write(folder, vocabulary_path, end, file_bytes), _INDEX), "record-index")


def record_files(index: DataFrame) -> DataFrame:
    """(file, part, roll, records, n_tokens, bytes, start): a row for each file, with the number of tokens in the files before it."""
    files = index.groupBy("file", "part", "roll").agg(F.count("*").alias("records"), F.sum("n_tokens").alias("n_tokens"), F.max(F.col("at") + F.col("bytes")).alias("bytes"))
    # One row for each file, not for each record.
    before = F.sum("n_tokens").over(W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1))
    return files.withColumn("start", F.coalesce(before, F.lit(0)))


def _unframe(chunk: bytes, name: str, at: int, whole: bool) -> tuple[list[bytes], int]:
    """(data of the records that the chunk holds in full, bytes used); checksums must match."""
    data, spots, heads, sums, here = [], [], [], [], 0
    while here + 12 <= len(chunk):
        size, head = struct.unpack_from("<qI", chunk, here)
        if size < 12 or here + 16 + size > len(chunk):
            # The length itself is checked before more is read for it.
            raw = np.frombuffer(chunk[here : here + 8], np.uint8)
            if int(masked(crc32c(raw, np.array([0, 8])))[0]) != head:
                raise ValueError(f"{name} at {at + here}: wrong checksum of a length")
            break
        data.append(chunk[here + 12 : here + 12 + size])
        spots.append(here)
        heads.append(head)
        sums.append(struct.unpack_from("<I", chunk, here + 12 + size)[0])
        here += 16 + size
    if data:
        sizes = np.array([len(d) for d in data], "<i8")
        ok = masked(crc32c(sizes.view(np.uint8), np.arange(len(data) + 1) * 8)) == np.array(heads, np.uint32)
        ok &= masked(crc32c(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum(sizes))))) == np.array(sums, np.uint32)
        if not ok.all():
            raise ValueError(f"{name} at {at + spots[int(np.argmin(ok))]}: wrong checksum of a record")
    if whole and here < len(chunk):
        raise ValueError(f"{name} at {at + here}: a record is cut off")
    return data, here


def _parsed(data: list[bytes], starts: list[int] | None) -> pa.RecordBatch:
    doc_ids, ids, counts = [], [], []
    for d in data:
        flags, doc_id = struct.unpack_from("<Iq", d)
        doc_ids.append(doc_id if flags & 1 else None)
        tokens = np.frombuffer(d, f"<u{flags >> 8}", offset=12)
        ids.append(tokens.astype("<u4").tobytes())
        counts.append(len(tokens))
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts or [None] * len(data), pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])


def _read(folder: str):
    def run(batches):
        fs, base = _store(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with fs.open_input_stream(f"{base}/{name}") as f:
                    held, at = b"", 0
                    while True:
                        more = f.read(max(CHUNK, struct.unpack_from("<q", held)[0] + 16 if len(held) >= 8 else 0))
                        held += more
                        data, used = _unframe(held, name, at, whole=not more)
                        if data:
                            out = _parsed(data, None)
                            before = start + np.concatenate(([0], np.cumsum(out.column("n_tokens").to_numpy())))
                            start = int(before[-1])
                            yield out.set_column(1, "start", pa.array(before[:-1], pa.int64()))
                        held, at = held[used:], at + used
                        if not more:
                            break
                give_back()

    return run


def read_records(files: DataFrame, folder: str, tasks: int = 20_000) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit integers), read from the files and checked. files: as record_files() gives them."""
    named = save(files.select("file", "start"), "record-files")
    n = max(1, min(tasks, named.count()))
    return named.repartition(n).mapInArrow(_read(folder), _RECORD)


def _pick(folder: str):
    def run(batches):
        fs, base = _store(folder)
        for batch in batches:
            names, spots, sizes = (batch.column(c).to_pylist() for c in ("file", "at", "bytes"))
            data: list[bytes] = [b""] * len(names)
            f, name = None, None
            # A batch's records of one file are read from its start to its end, then given in the order asked for.
            for i in sorted(range(len(names)), key=lambda i: (names[i], spots[i])):
                if name != names[i]:
                    if f is not None:
                        f.close()
                    f, name = fs.open_input_file(f"{base}/{names[i]}"), names[i]
                f.seek(spots[i])
                data[i] = _unframe(f.read(sizes[i]), name, spots[i], whole=True)[0][0]
            if f is not None:
                f.close()
            yield _parsed(data, batch.column("start").to_pylist())

    return run


def read_shuffled(index: DataFrame, folder: str, seed: int) -> DataFrame:
    """The same rows in an order drawn from the seed (within and over tasks): index rows are shuffled, records are read where they are."""
    starts = record_files(index).select("file", "start")
    placed = index.join(starts, "file").select("file", "at", "bytes", (F.col("start") + F.col("first")).alias("start"), F.xxhash64(F.lit(seed), "part", "roll", "at").alias("turn"))
    return placed.repartitionByRange("turn").sortWithinPartitions("turn").select("file", "at", "bytes", "start").mapInArrow(_pick(folder), _RECORD)


def records_report(docs: DataFrame, vocabulary_path: str, end: int = 0) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of files written and read back."""
    folder, index = write_records(docs, vocabulary_path, end=end)
    return read_records(record_files(index), folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
