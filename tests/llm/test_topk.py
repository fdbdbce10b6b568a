"""Exact top-k against a plain comparison of all vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placeflow.llm import topk
from placeflow.llm.topk import quantised, top_k


def brute(rows, k):
    ok = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 5 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize(("scale", "block"), [(1.0, 8192), (1.0, 7), (3000.0, 16), (1_000_000.0, 16)])
def test_equals_all_pairs(spark, monkeypatch, scale, block):
    monkeypatch.setattr(topk, "CANDIDATES", block)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rnd = random.Random(7)
    pool = [[float(round(rnd.gauss(0, 1) * scale, 3)) if rnd.random() < 0.7 else 0.0 for _ in range(6)] for _ in range(12)]
    rows = [(i, list(rnd.choice(pool))) for i in range(90)] + [(200, None), (205, [1.0, None]), (210, [float("nan")] * 6), (215, [float("inf")] * 6), (220, []), (225, [1.0, 2.0]), (None, [1.0] * 6), (7, [0.5] * 6)]
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<double>, weights int")
    v = quantised(df)
    got = top_k(v.where(F.col("id") % 5 == 0), v, 5)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute(rows, 5)


def test_few_rows(spark):
    v = quantised(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"))
    assert [tuple(r) for r in top_k(v.where("id = 0"), v, 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert top_k(v.limit(0), v, 5).count() == 0 and top_k(v, v.limit(0), 5).count() == 0
