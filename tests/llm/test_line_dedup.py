"""Line dedup against a plain statement of the rule, by broadcast and by groups of shards."""

import random

import numpy as np
import pytest

from placeflow.llm import line_dedup
from placeflow.llm.line_dedup import Shard, drop_repeated_lines

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, least_chars, least_docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(SPACE).translate(low)
    holders = {}
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders.setdefault(k, set()).add(-(1 << 63) if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = -(1 << 63) if doc is None else doc
        kept = [x for x in lines if len(holders.get(key(x), ())) < least_docs or own == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("broadcast", "per_shard", "ids"), [(1 << 20, 1 << 19, 10), (0, 7, 10), (0, 1 << 19, 0)])
def test_equals_rule(spark, monkeypatch, broadcast, per_shard, ids):
    """By broadcast, and by shards of which those with many digests are dealt to slices."""
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", per_shard)
    monkeypatch.setattr(line_dedup, "BROADCAST_IDS", ids)
    rnd = random.Random(5)
    lines = ["é" * 9, "x" * 10, "X" * 10 + "\t", " short", "", *(f"line number {i} Ä" for i in range(60)), "\x1c" + "y" * 10, "😀" * 10]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 12)))) for i in range(60)] + [(None, "x" * 10), (3, None), (4, ""), (5, rows_line := "x" * 10 + "\nline number 3 Ä"), (5, rows_line), (99, "z" * 50_000)]
    df = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, n_lines int, row string")
    got = drop_repeated_lines(df, 10, 3, broadcast_bytes=broadcast, slice_digests=20, carry=True)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == brute(rows, 10, 3)
    assert got.select("row.n_lines").distinct().collect()[0][0] == 1


def test_rows_of_one_id_are_one_document(spark):
    """A line in three rows of one id and in two more documents is in three documents."""
    line = "a line of more than ten letters"
    rows = [(1, line), (1, line), (1, line), (2, line), (3, line), (None, line), (None, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_dropped for r in drop_repeated_lines(df, 10, 5).collect()} == {0}
    got = sorted(((r.doc_id or 0, r.n_dropped) for r in drop_repeated_lines(df, 10, 4).collect()))
    assert got == [(0, 1), (0, 1), (1, 1), (1, 1), (1, 1), (2, 1), (3, 0)]


def test_empty_table(spark):
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hash_is_minimal_and_perfect():
    rnd = np.random.default_rng(1)
    lo, hi = rnd.integers(0, 1 << 63, (2, 5000)).astype(np.uint64)
    lo[1] = lo[0]
    s = Shard.build(lo, hi, np.arange(5000) + 5, np.arange(5000) * 3)
    s = Shard.load(dict(zip(["sizes", "words", "fingerprints", "counts", "largest", "rest"], s.row(), strict=True)))
    counts, largest = s.probe(lo, hi)
    assert (counts == np.arange(5000) + 5).all() and (largest == np.arange(5000) * 3).all()
    assert len(s.fingerprints) == 4998 and sorted(s.place(lo[2:])) == list(range(4998))
    assert not s.probe(lo, hi + np.uint64(1))[0].any()
