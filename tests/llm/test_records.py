"""Record files: exact round trips, the format byte by byte, damaged files, odd texts."""

import random
import struct
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placeflow.llm import records
from placeflow.llm.records import Encoder, crc32c, masked, read_records, read_shuffled, record_files, records_report, write_records

PATH = public_tokenizers.path("byte_bpe_50k.json")


def slow_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c ^= b
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_checksums():
    """Known values, and messages of all lengths around a block against bit by bit."""
    assert slow_crc(b"123456789") == 0xE3069283
    rnd = random.Random(1)
    messages = [b"123456789", bytes(32), b"\xff" * 32, bytes(range(32))] + [rnd.randbytes(n) for n in [*range(4, 20), 255, 256, 257, 259, 511, 512, 513, 2000]]
    offsets = np.cumsum([0, *map(len, messages)])
    got = crc32c(np.frombuffer(b"".join(messages), np.uint8), offsets).tolist()
    assert got == list(map(slow_crc, messages)) and got[:4] == [0xE3069283, 0x8A9136AA, 0x62A8AB43, 0x46DD794E]
    assert masked(np.array([0xE3069283], np.uint32))[0] == (((0xE3069283 >> 15) | (0xE3069283 << 17 & 0xFFFFFFFF)) + 0xA282EAD8) & 0xFFFFFFFF


ODD = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\nb", "\n\n a", "a\t b\r\n", "it's he'll 'twas 12 34", "x y 　z", "a  b", "a\x1cb \x1f c", "\u0085x", "naïve 漢字 Ünï 😀 x", "foo  <|endoftext|>  bar", "<|endoftext|>", "a <|endoftext|> b", "é ​ x", "0123456789" * 20, " " * 70 + "x", "a᠎b c", "﻿ x"]


def test_ids_equal_the_library():
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice(["a", "B", " ", " ", "\n", "\t", "'s", "é", " ", "7", ".", "word", "　", "\x1d"]) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    e, t = Encoder(PATH), Tokenizer.from_file(PATH)
    for lo in range(0, len(texts), 500):
        some = texts[lo : lo + 500]
        ids, counts = e.encode(some)
        cuts = np.cumsum([0, *counts])
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == [x.ids for x in t.encode_batch(some, add_special_tokens=False)]


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(records, "PIECES", 5)
    monkeypatch.setattr(records, "HELD", 30)
    e, t = Encoder(PATH), Tokenizer.from_file(PATH)
    for some in (["a b c", "b c d"], ["x y z " * 30], ["a b"], ["q" * 99], ["a b c d e f g h"], ["Aa"]):
        assert e.encode(some)[0].tolist() == [i for x in t.encode_batch(some, add_special_tokens=False) for i in x.ids]
        assert len(e.hashes) <= 8 and e.held <= 130


def test_all_kinds_of_characters_and_contractions():
    """Each assigned character beside letters, digits, spaces and marks; contractions in all places, over the ends of texts too."""
    texts = [f"a{c}1 {c}{c}x '{c} \n{c}" for c in map(chr, [*range(0x500), *range(0x1680, 0x1690), *range(0x2000, 0x2100), *range(0x2460, 0x2480), 0x3000, 0x4E00, 0xFF11, 0x1F600, 0xE000, 0x10FFFF])]
    tails = ["s", "t", "re", "ve", "m", "ll", "d", "r", "l", "R", "S", "se", "llx", "'s", " s", ""]
    texts += [f"{a}'{b}{c}" for a in ("", "x", " ", "1", '"', "\n", "''", "é") for b in tails for c in ("", "y", " z", "'ll", "1")] + ["'", "'l", "l", "'r", "e", "'"]
    e, t = Encoder(PATH), Tokenizer.from_file(PATH)
    ids, counts = e.encode(texts)
    cuts = np.cumsum([0, *counts])
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_other_vocabularies_are_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    e, t = Encoder(path), Tokenizer.from_file(path)
    ids, counts = e.encode(["Hello  there", "", "x y's"])
    assert not e.cuts and ids.tolist() == [i for x in t.encode_batch(["Hello  there", "", "x y's"], add_special_tokens=False) for i in x.ids] and counts[1] == 0


def documents(spark):
    rnd = random.Random(5)
    rows = [(i * 7 - 50, " ".join(rnd.choice(ODD) for _ in range(rnd.randrange(6)))) for i in range(120)]
    rows += [(None, None), (None, "no id"), (3, None), (14, "same id"), (14, "same id"), (14, "same id, other text"), (1 << 40, "word " * 60_000)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n string, start int").repartition(5)


def expected(rows, end=0):
    t = Tokenizer.from_file(PATH)
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [end]) for i, x in rows]


@pytest.mark.parametrize("file_bytes", [1, 3000, 128 << 20])
def test_round_trip(spark, file_bytes):
    rows, df = documents(spark)
    folder, index = write_records(df, PATH, file_bytes=file_bytes)
    files = record_files(index)
    got = read_records(files, folder).orderBy("start").collect()
    assert sorted((r.doc_id is not None, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted((i is not None, i, ids) for i, ids in expected(rows))
    # In ascending order of ids, those without one first, each right behind the one before.
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    named = files.orderBy("part", "roll").collect()
    assert sum(f.records for f in named) == len(rows) and (len(named) == len(rows)) == (file_bytes == 1)
    for f in named:
        assert Path(folder.removeprefix("file://"), f.file).stat().st_size == f.bytes
    shuffled = read_shuffled(index, folder, 9).collect()
    key = lambda r: (r.start, r.doc_id, r.n_tokens, r.ids)
    assert sorted(map(key, shuffled)) == sorted(map(key, got)) and [r.start for r in shuffled] != [r.start for r in got]
    assert [r.start for r in read_shuffled(index, folder, 8).collect()] != [r.start for r in shuffled]


def test_format_of_a_record(spark):
    folder, index = write_records(spark.createDataFrame([(5, "hi there")], "doc_id long, text string"), PATH)
    ids = expected([(5, "hi there")])[0][1]
    data = struct.pack("<Iq", 2 << 8 | 1, 5) + struct.pack(f"<{len(ids)}H", *ids)
    mask = lambda c: (((c >> 15) | (c << 17 & 0xFFFFFFFF)) + 0xA282EAD8) & 0xFFFFFFFF
    length = struct.pack("<q", len(data))
    whole = length + struct.pack("<I", mask(slow_crc(length))) + data + struct.pack("<I", mask(slow_crc(data)))
    row = index.first()
    assert Path(folder.removeprefix("file://"), row.file).read_bytes() == whole and (row["at"], row.bytes, row.n_tokens) == (0, len(whole), len(ids))


@pytest.mark.parametrize(("at", "what"), [(0, "checksum of a length"), (9, "checksum"), (20, "checksum of a record"), (-1, "checksum of a record"), (None, "cut off")])
def test_damage_is_found(spark, at, what):
    folder, index = write_records(spark.createDataFrame([(5, "hi there, you")], "doc_id long, text string"), PATH)
    path = Path(folder.removeprefix("file://"), index.first().file)
    raw = bytearray(path.read_bytes())
    if at is None:
        raw = raw[:-3]
    else:
        raw[at] ^= 1
    path.write_bytes(raw)
    with pytest.raises(Exception, match=what):
        read_records(record_files(index), folder).collect()


def test_files_of_lost_attempts_are_not_read(spark):
    folder, index = write_records(spark.createDataFrame([(5, "hi")], "doc_id long, text string"), PATH)
    Path(folder.removeprefix("file://"), "part-000000-00000-lost.rec").write_bytes(b"half a rec")
    assert read_records(record_files(index), folder).count() == 1


def test_report(spark):
    rows, df = documents(spark)
    got = {}
    for r in records_report(df, PATH).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    want = {}
    for i, ids in expected(rows):
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert records_report(df.limit(0), PATH).count() == 0
    assert records_report(df.select(F.col("doc_id").alias("text"), F.col("text").alias("doc_id")).limit(0), PATH).count() == 0
