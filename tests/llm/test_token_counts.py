"""Token counts against the library, and the cache: hits aren't encoded again, other versions don't count."""

import random

import public_tokenizers
from pyspark.sql import functions as F

from placeflow.llm import token_counts
from placeflow.llm.token_counts import CACHE_SCHEMA, count_tokens, fresh_cache, read_cache, tokenizer_digest

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_equals_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    rnd = random.Random(3)
    bits = ["The", " ", "  ", "\n\t", "\x0b", "\x1c", "\x85", "\xa0", "é", "é", "İ", "<|endoftext|>", "<| endoftext|>", "'s", "12", "😀", "ᄒ", "ᅡ", "!!", "word"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))) for i in range(500)] + [(1000, None), (1001, ""), (5, "a b"), (5, "a  b"), (None, "x"), (1002, "word " * 5000)]
    df = spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id long, text string, n_tokens int, digest binary")
    got = count_tokens(df, PATH, fresh_cache(spark)).collect()
    want = sorted((str(i), len((t or "").encode()), len(n := library.encode(t or "", add_special_tokens=False).ids), len(n) > 2048) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_cache(spark):
    cache = fresh_cache(spark)
    docs = spark.createDataFrame([(1, "one two"), (2, "one   two"), (3, "three")], "doc_id long, text string")
    assert count_tokens(docs, PATH, cache).count() == 3
    assert read_cache(spark, cache).count() == 2
    # What is stored is used: a changed count comes back, and nothing is appended for known contents.
    version = tokenizer_digest(PATH)
    other = fresh_cache(spark)
    token_counts.read_cache(spark, cache).withColumn("n_tokens", F.lit(77).cast("long")).write.parquet(other)
    assert {r.n_tokens for r in count_tokens(docs, PATH, other).collect()} == {77} and read_cache(spark, other).count() == 2
    foreign = fresh_cache(spark)
    read_cache(spark, other).withColumn("tokenizer", F.lit("x")).write.parquet(foreign)
    assert {r.n_tokens for r in count_tokens(docs, PATH, foreign).collect()} == {1, 2}
    assert read_cache(spark, foreign).where(F.col("tokenizer") == version).count() == 2
    assert count_tokens(docs.limit(0), PATH, fresh_cache(spark)).count() == 0 and len(CACHE_SCHEMA) > 0


def test_known_contents_by_broadcast_or_shuffle(spark):
    """With some contents known, only the others are encoded, whether these are broadcast or shuffled; copies share one entry."""
    texts = [(i, f"word{i % 60} and more" if i % 3 else "copies of one text") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = sorted(tuple(r) for r in count_tokens(docs, PATH, fresh_cache(spark)).collect())
    for most in (0, 1000):
        cache = fresh_cache(spark)
        count_tokens(docs.where("doc_id < 30"), PATH, cache).count()
        before = read_cache(spark, cache).count()
        assert sorted(tuple(r) for r in count_tokens(docs, PATH, cache, broadcast_rows=most).collect()) == want
        assert before < read_cache(spark, cache).count() == len({t for _, t in texts})


def test_long_texts_and_other_vocabularies(spark):
    from tokenizers import Tokenizer

    rows = [(1, "x" * 200_000), (2, "ab " * 200_000), (3, " lead  and\n trail ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for path in (PATH, public_tokenizers.path("byte_bpe_50k.json")):
        library = Tokenizer.from_file(path)
        got = {r.doc_id: r.n_tokens for r in count_tokens(docs, path, fresh_cache(spark)).collect()}
        assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
