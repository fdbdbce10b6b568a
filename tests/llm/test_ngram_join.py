"""Near duplicates against all pairs of sets, with whole groups and with blocks."""

import random
import re

import pytest

from placeflow.llm.ngram_join import near_duplicates


def brute(rows, n, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= percent * (len(a) + len(sets[j]) - o):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def made(seed, families, copies):
    rnd = random.Random(seed)
    rows, words = [], ["the", "Of", "é", "x,", *(f"w{i}" for i in range(300))]
    for _ in range(families):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 80))]
        for _ in range(rnd.randint(1, copies)):
            text = list(base)
            for _ in range(rnd.randint(0, 3)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append(" ".join(text) if rnd.random() < 0.8 else "\n".join(text).upper())
    rnd.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)] + [(10**6, ""), (10**6 + 1, None), (10**6 + 2, " \t"), (3, rows[0]), (3, rows[1]), (None, rows[2]), (None, "lone words only"), (None, "a b c d e f g")]


@pytest.mark.parametrize(("seed", "families", "copies", "block"), [(1, 30, 6, 2048), (2, 4, 40, 7)])
def test_equals_all_pairs(spark, seed, families, copies, block):
    rows = made(seed, families, copies)
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, key string")
    got = near_duplicates(df, 4, 85, block_sets=block)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows, 4, 85)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_lose_no_link(monkeypatch):
    import numpy as np

    from placeflow.llm import ngram_join as g

    rnd = np.random.default_rng(1)
    monkeypatch.setattr(g, "LARGER", (30, 80))
    monkeypatch.setattr(g, "SIGNATURE", 64)
    for _ in range(60):
        sets = []
        for _ in range(int(rnd.integers(1, 20))):
            n = int(rnd.integers(1, 150))
            base = rnd.integers(0, 1 << 60, n).astype(np.uint64)
            near = base.copy()
            near[rnd.integers(0, n, int(n * 0.08 * rnd.random()))] = rnd.integers(0, 1 << 60)
            sets += [np.unique(base), np.unique(near)]
        kept = g.with_partner([g.signature(s) for s in sets], np.array([len(s) for s in sets]), 85)
        for i, a in enumerate(sets):
            for j in range(i):
                o = len(np.intersect1d(a, sets[j]))
                assert 100 * o < 85 * (len(a) + len(sets[j]) - o) or (kept[i] and kept[j])


def shared_passages(seed):
    """Texts made of passages that many share, near the threshold, with chance meetings."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passages = [[rnd.choice(words) for _ in range(rnd.randint(4, 30))] for _ in range(12)]
    rows = []
    for i in range(160):
        text = [w for p in rnd.sample(passages, rnd.randint(1, 4)) for w in p]
        if rnd.random() < 0.5:
            text = text[: rnd.randint(1, len(text))]
        for _ in range(rnd.randint(0, 2)):
            text.insert(rnd.randrange(len(text) + 1), rnd.choice(words))
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize(("seed", "block", "broadcast"), [(1, 2048, 10**6), (2, 3, 10**6), (3, 5, 0)])
def test_shared_passages_by_broadcast_or_shuffle(spark, seed, block, broadcast):
    rows = shared_passages(seed)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, block_sets=block, broadcast_rows=broadcast)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows, 4, 85)


def test_carried_columns_and_long_texts(spark):
    rnd = random.Random(5)
    long = [f"w{rnd.randrange(50_000)}" for _ in range(120_000)]
    rows = [(1, "a b c d e", "x"), (5, "A B c d e", "y"), (5, "quite another text here", None), (7, " ".join(long), "l"), (8, " ".join(long[:-50]), "m"), (9, "x" * 500_000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    got = near_duplicates(df, 4, 85, carry=("digest",)).collect()
    assert sorted(((r.doc_id, r.component_id, r.digest) for r in got), key=str) == [(1, 1, "x"), (5, 1, "y"), (5, 5, None), (7, 7, "l"), (8, 7, "m"), (9, 9, "n")]
