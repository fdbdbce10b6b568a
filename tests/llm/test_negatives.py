"""Hard negatives against a plain comparison of all vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placeflow.llm import negatives
from placeflow.llm.negatives import hard_negatives, labelled


def brute(rows, k_pos, k_neg, low, high, anchor=lambda i: i % 4 == 0):
    ok = [(i, y, [math.floor(256.0 * x) for x in v]) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, y, v in ok:
        if not anchor(i):
            continue
        pos = sorted((-score(v, w), j) for j, z, w in ok if z == y and j != i)[:k_pos]
        neg = sorted((-score(v, w), j) for j, z, w in ok if z != y)
        for s, j in pos:
            inside = [(t, n) for t, n in neg if low * -s <= 100 * -t <= high * -s][:k_neg]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(inside)]
    return sorted(out)


def vectors(rnd, n, scale, signs=True):
    pool = [[float(round(rnd.gauss(0 if signs else 2, 1) * scale, 3)) if rnd.random() < 0.8 else 0.0 for _ in range(5)] for _ in range(14)]
    rows = [(i, list(rnd.choice(pool)), rnd.choice([0, 0, 0, 1, 2, 3])) for i in range(n)]
    return rows + [(200, None, 1), (204, [1.0, None], 1), (208, [float("nan")] * 5, 1), (212, [float("inf")] * 5, 0), (216, [], 0), (220, [1.0, 2.0], 0), (224, [1.0] * 5, None), (None, [1.0] * 5, 0), (8, [0.5] * 5, 1), (8, [0.5] * 5, 1), (9, [0.5] * 5, 0), (228, [3.0] * 5, 77)]


def result(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


@pytest.mark.parametrize(("scale", "block", "held", "low", "high", "signs"), [(1.0, 4096, 500_000, 80, 100, True), (1.0, 7, 40, 80, 100, False), (1.0, 5, 1, 50, 95, False), (3000.0, 16, 100, 80, 100, True), (100_000.0, 16, 100, 90, 120, False)])
def test_equals_all_pairs(spark, monkeypatch, scale, block, held, low, high, signs):
    monkeypatch.setattr(negatives, "CANDIDATES", block)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "HELD", held)
    rows = vectors(random.Random(11), 120, scale, signs)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, score int, anchor string").repartition(4)
    got = hard_negatives(labelled(df), F.col("id") % 4 == 0, 5, 3, low, high)
    want = brute(rows, 5, 3, low, high)
    assert want and result(got) == want


def test_few_positives_and_given_labels(spark):
    """Fewer positives than asked for, tied positives, labels as a column expression."""
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.9, 9.0], 2), (4, [0.9, -9.0], 2), (5, [1.0, 0.0], 3), (6, [0.79, 0.0], 4), (7, [1.1, 0.0], 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = result(hard_negatives(labelled(df, label=F.col("label") * 10), F.col("id") == 0))
    s, t = 256 * 256, 256 * math.floor(256 * 0.9)
    assert got == [(0, p, r, n, s, v) for p in (1, 2) for r, n, v in ((1, 5, s), (2, 3, t), (3, 4, t))]


def test_empty(spark):
    v = labelled(spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1)], "vec_id long, embedding array<float>, label int"))
    assert hard_negatives(v.limit(0), F.col("id") == 0).count() == 0
    assert hard_negatives(v, F.col("id") == 5).count() == 0
    assert hard_negatives(v, F.col("id") == 0).count() == 0
