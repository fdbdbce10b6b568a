"""Toxicity: held-out accuracy on labelled rows, pairs beyond single terms, and odd inputs."""

import numpy as np
from pyspark.sql import functions as F

from placeflow.llm.queries import op1_toxicity
from placeflow.llm.toxicity import BITS, THRESHOLD, Model, _words, drop_toxic, fit, fit_machine, score

DIR = "/root/testdata/sf0.1"


def test_held_out(spark):
    rows = op1_toxicity(spark, DIR).join(spark.read.parquet(f"{DIR}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = ((rows.predicted == 1) & (rows.toxic == 1)).sum()
    assert hit / (rows.toxic == 1).sum() > 0.8 and hit / (rows.predicted == 1).sum() > 0.9


def test_pairs_count_beyond_terms():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 2, (3000, 6))
    y = (x[:, 0] & x[:, 1]).astype(float)
    m = Model(np.zeros(0), *fit_machine([np.flatnonzero(r) for r in x], 6, y))
    s = m.score(np.array([[1, 1, 0, 0, 0, 0], [1, 0, 0, 0, 0, 0], [0, 1, 0, 0, 0, 0]], float))
    assert s[0] > 0.7 and s[1] < 0.3 and s[2] < 0.3


def test_fit_learns_a_pair_without_single_effects(spark):
    """Two words that are as frequent in clean as in toxic rows (half of each), and toxic only where they meet."""
    rnd = np.random.default_rng(8)
    rows = []
    for i in range(4000):
        words, toxic = list(rnd.choice([f"w{k}" for k in range(400)], 40)), i % 10 == 0
        if i % 20 == 0:
            words[7], words[10] = "korv", "dalma"
        elif toxic:
            words[9] = "bad"
        else:
            words[9] = "korv" if i % 2 else "dalma"
        rows.append((i, " ".join(words), int(toxic)))
    korv = [[sum("korv" in t.split() for _, t, y in rows if y == k), sum(y == k for _, _, y in rows)] for k in (0, 1)]
    assert abs(korv[0][0] / korv[0][1] - korv[1][0] / korv[1][1]) < 0.06
    m = fit(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    asked = ["w1 korv w2 w3 dalma w4", "w1 korv w2 w3 w4", "w1 dalma w2 w3 w4", "w1 bad w2"]
    got = {r.doc_id: r.score for r in score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), m).collect()}
    assert got[0] > 0.7 and got[1] < 0.1 and got[2] < 0.1 and got[3] >= THRESHOLD


def test_score_equals_all_pairs(spark):
    """Scores against the sum over single terms and over all pairs of terms, worked out one by one."""
    rnd = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "ep", "zeta"]
    terms = np.full(1 << BITS, -1, np.int64)
    buckets = sorted({b for w in words for b in bucket_set(w)})
    terms[buckets] = np.arange(len(buckets))
    m = Model(terms, -0.5, rnd.normal(0, 0.4, len(buckets)), rnd.normal(0, 0.3, (len(buckets), 8)))
    rows = [(i, " ".join(rnd.choice(words, rnd.integers(0, 6)))) for i in range(60)] + [(60, None), (61, "Alpha, ALPHA other words")]
    got = {r.doc_id: r.score for r in score(spark.createDataFrame([(int(i), t) for i, t in rows], "doc_id long, text string"), m).collect()}
    for i, t in rows:
        own = sorted({terms[b] for w in (t or "").replace(",", " ").lower().split() for b in bucket_set(w)} - {-1})
        z = m.bias + sum(m.weights[a] for a in own) + sum(m.factors[a] @ m.factors[b] for n, a in enumerate(own) for b in own[:n])
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-5


def bucket_set(word):
    """The buckets of one word."""
    import pyarrow as pa

    return set(_words(pa.record_batch([pa.array([word])], names=["text"]))[0].tolist())


def test_fit_is_reproducible_and_takes_all_terms(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, " ".join(rnd.choice([f"w{k}" for k in range(3000)], 60)) + (" " + " ".join(f"bad{k}" for k in rnd.choice(2500, 900, False)) if i % 3 == 0 else "")) for i in range(240)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    a, b = fit(docs.repartition(7), labels), fit(docs.coalesce(1).orderBy(F.desc("doc_id")), labels)
    assert len(a.weights) > 2048 and (a.terms == b.terms).all() and (a.weights == b.weights).all() and (a.factors == b.factors).all() and a.bias == b.bias


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(i, t, 0.5, "r") for i, t in [(1, "bad idiot"), (2, "fine"), (3, None), (3, ""), (None, "x" * 100_000)]], "doc_id long, text string, score double, row string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (9, 1), (None, 1), (2, None), (2, 7)], "doc_id long, toxic int")
    for m in (fit(docs, labels), fit(docs, labels.limit(0)), fit(docs.limit(0), labels)):
        assert all(0 <= r.score <= 1 for r in score(docs, m).collect())
        assert drop_toxic(docs, m, 2.0).columns == docs.columns and drop_toxic(docs, m, 2.0).count() == 5
        assert score(docs.limit(0), m).where(F.col("score") > 0).count() == 0
