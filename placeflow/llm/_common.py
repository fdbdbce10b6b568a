"""Helpers shared by the operators of this subpackage: columns, slices of batches and vectorised word hashing.

The numpy code runs inside Spark tasks on one Arrow batch at a time; its temporary arrays are
bounded by BLOCK bytes of text (or one word, if a single word is longer).
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 20
ASCII_SPACE = b" \t\n\x0b\x0c\r"
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns only, so that other columns of docs, whatever their names, play no part."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def crc_mod(column, n: int):
    """crc32 of the id as text, modulo n; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def give_back() -> None:
    """Return freed memory to the system: a worker is kept for later tasks and counts in its executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column, without a copy where there are no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if len(column) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `most` bytes of text; a longer text is a slice of its own."""
    _, offsets = raw(batch.column(batch.schema.get_field_index(column)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def separators(keep_alnum_only: bool = False) -> np.ndarray:
    """256 flags, true for bytes inside words. ASCII white space separates; with keep_alnum_only all ASCII but letters and digits does."""
    inside = np.ones(256, bool)
    if keep_alnum_only:
        inside[:128] = [chr(i).isalnum() for i in range(128)]
    else:
        inside[list(ASCII_SPACE)] = False
    return inside


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the total) of the words; a word never crosses documents."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    flags = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[1:n] = flags[1:] != flags[:-1]
    edge[offsets[offsets < n]] = True
    edge[0] = edge[n] = True
    cuts = np.flatnonzero(edge)
    is_word = flags[cuts[:-1]]
    starts, ends = cuts[:-1][is_word], cuts[1:][is_word]
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, on uint64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE, _SEED = 0x9E3779B97F4A7C15, 0x5851F42D4C957F2D
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_BYTES = _BYTES[_LOWER]
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 4096)
        with np.errstate(over="ignore"):
            both = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
        _powers[:] = both
    return _powers[0], _powers[1]


#: Words longer than this are hashed one by one: for long words, unlike ones with equal polynomials are easily built.
_LONG = 32


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z lower-cased: polynomial prefix sums, so that the cost is a few array passes; XXH3 for long words."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
            lo, hi = starts[i], ends[j - 1]
            up, down = _power_tables(int(hi - lo) + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_LOWER_BYTES[data[lo:hi]] * up[: hi - lo], out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _U(0xA0761D6478BD642F))
            i = j
    for k in np.flatnonzero(ends - starts > _LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(_LOWER[data[starts[k] : ends[k]]].tobytes(), _SEED)
    return out
