"""Token counts through a cache of digests.

The cache is a Parquet table (tokenizer, digest, n_tokens). Contents are keyed by the SHA-256 of the
text with runs of ASCII white space made one space, if the vocabulary's normaliser does so as well, and
tokenizers by the SHA-256 of their file and the library's version. Digests are written once; those without
an entry are found without any text, one text of each is encoded, and its count is appended.

With such a vocabulary the library encodes the white-space-separated pieces of a text, each once in a task:
normaliser, splitting pattern and special strings never reach over ASCII white space, so a text's count is the
sum of its pieces'. With other vocabularies a text is one piece.

Digests that HOT-th parts of all rows share are joined by broadcast (there can't be more than HOT such), all
others by a shuffle, so copies of one text don't meet in one task.

Null texts count as empty and get 0 bytes and 0 tokens. Repeated rows give repeated results; equal texts are
encoded once. A very long text is split and summed like any other, in memory of a few times its size; long
pieces aren't remembered. Other columns of the input are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, parts, texts
from placeflow.scratch import new_path, save

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: A digest of at least one in HOT rows is joined by broadcast: at most HOT digests.
HOT = 10_000
#: Digests (about 64 bytes each in memory) that may be broadcast to the texts; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Pieces remembered in a task, and the length up to which they are.
PIECES, LONGEST = 500_000, 64


def tokenizer_digest(path: str) -> str:
    import tokenizers

    return hashlib.sha256(Path(path).read_bytes() + f"\ntokenizers {tokenizers.__version__}".encode()).hexdigest()


def splits_at_space(path: str) -> bool:
    """Whether the vocabulary drops white space between words and nothing of it looks over white space."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    normalizers = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    spaces = any(n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in normalizers)
    local = all(n["type"] in ("NFC", "Replace", "Lowercase") for n in normalizers)
    words = any(p["type"] == "Split" and p["behavior"] == "Removed" and p["invert"] and r"^\s" in p["pattern"].get("Regex", "") for p in pre)
    own = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])
    return spaces and local and words and own and spec.get("post_processor") is None and not any(p.get("add_prefix_space") for p in pre)


@lru_cache(maxsize=2)
def _load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def piece_counts(tokenizer, pieces: list[bytes], most: int = 1 << 20) -> list[int]:
    """The tokens of each piece, encoded about `most` bytes at a time."""
    out: list[int] = []
    lo = 0
    while lo < len(pieces):
        hi, size = lo, 0
        while hi < len(pieces) and (hi == lo or size < most):
            size += len(pieces[hi])
            hi += 1
        out += [len(e.ids) for e in tokenizer.encode_batch_fast([p.decode() for p in pieces[lo:hi]], add_special_tokens=False)]
        lo = hi
    return out


def _encode(path: str):
    split = bytes.split if splits_at_space(path) else lambda text: [text]

    def run(batches):
        t = _load(path)
        known: dict[bytes, int] = {}
        for batch in batches:
            for part in parts(batch):
                rows = [split(text) for text in part.column("text").cast(pa.binary()).to_pylist()]
                new = list(set().union(*rows) - known.keys())
                if len(known) + len(new) > PIECES:
                    known.clear()
                    new = list(set().union(*rows))
                known |= zip(new, piece_counts(t, new), strict=True)
                lengths = [sum(map(known.__getitem__, row)) for row in rows]
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(lengths, pa.int64())], ["digest", "n_tokens"])
                for piece in new:
                    if len(piece) > LONGEST:
                        del known[piece]
            give_back()

    return run


def content_digest(text, path: str):
    return F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ") if splits_at_space(path) else text, 256))


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts, or none yet."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, over: int = 2048, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. cache: a folder in a store that driver and executors share; it is read and appended to."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    entries = lambda: read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    own = texts(docs, id_col, text_col).withColumn("digest", content_digest(F.col("text"), tokenizer_path))
    keyed = save(own.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-digests")
    classes = save(keyed.groupBy("digest").agg(F.count("*").alias("rows")), "token-classes")
    total, distinct = classes.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()

    missing = classes.select("digest").join(entries().select("digest"), "digest", "left_anti")
    n = missing.count()
    if n:
        wanted = own.select("digest", "text")
        if n < distinct:
            wanted = wanted.join(F.broadcast(missing) if n <= broadcast_rows else missing, "digest", "left_semi")
        # One row for each content leaves a task, then one is encoded; copies never meet in one place with their texts.
        fresh = wanted.dropDuplicates(["digest"]).mapInArrow(_encode(tokenizer_path), "digest binary, n_tokens long")
        fresh.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)

    stored = entries()
    hot = F.broadcast(classes.where(F.col("rows") * HOT >= total).select("digest"))
    often = keyed.join(F.broadcast(stored.join(hot, "digest", "left_semi")), "digest")
    rest = keyed.join(hot, "digest", "left_anti").join(stored, "digest", "left")
    n_tokens = F.col("n_tokens").cast("long")
    return often.unionByName(rest).select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > over).alias("over_limit"))


def fresh_cache(spark: SparkSession) -> str:
    return new_path(spark, "token-cache")
