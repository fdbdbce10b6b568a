"""Ranked search against scoring every document, with small trees and blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from placeflow.llm.lexical import Best, Tree, lexical_search, part_score

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def brute(docs, items, k):
    vectors = [(i, Counter(terms(t))) for i, t in docs]
    vectors = [(i, c, sum(c.values())) for i, c in vectors if c]
    n_docs, n_terms = len(vectors), sum(n for _, _, n in vectors)
    df = Counter(t for _, c, _ in vectors for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in vectors:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(rnd, n):
    words = ["the", "of", "and", "Über", "naïve", "x1", "ÉTÉ", "été", "漢字"] + [f"w{i}" for i in range(40)]
    weights = [30, 20, 10, 3, 3, 3, 1, 1, 1] + [1 + 40 // (i + 1) for i in range(40)]
    text = lambda m: rnd.choice([" ", "-", "\n", "\x7f"]).join(rnd.choices(words, weights, k=m))
    docs = [(i, text(rnd.randrange(1, 40))) for i in range(n)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(40)] + [(None, docs[3][1]), (None, "w1 w2"), (5, docs[5][1]), (5, docs[5][1]), (6, "w39 w39"), (2000, None), (2001, ""), (2002, " .,;[]`{}\x00"), (2003, "THE " * 3000)]
    items = [(i, text(rnd.randrange(1, 12))) for i in range(25)] + [(77, "w39 w39 w38"), (78, "unknown words"), (79, ""), (80, None), (None, "w1 the"), (81, "THE The the")]
    rnd.shuffle(docs)
    return docs, items


@pytest.mark.parametrize(("k", "tree", "leaf", "block"), [(20, 16_384, 64, 200_000), (3, 30, 4, 200_000), (5, 1000, 1, 60), (5, 1, 1, 200_000)])
def test_equals_scoring_all(spark, k, tree, leaf, block):
    docs, items = corpus(random.Random(k), 300)
    d = spark.createDataFrame([(i, t, 1, "y") for i, t in docs], "doc_id long, text string, score int, item string").repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical_search(d, q, k, tree_docs=tree, tree_entries=10 * tree + 50, leaf=leaf, block_terms=block)
    assert sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in got.collect()), key=str) == brute(docs, items, k)


def test_empty(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search(d.limit(0), q).count() == 0 and lexical_search(d, q.limit(0)).count() == 0
    assert lexical_search(d, q.selectExpr("item_id", "'zz' as text")).count() == 0
    assert [tuple(r) for r in lexical_search(d, q).collect()] == [(1, 1, 1, math.floor(1000 * math.log(4 / 3)) * (10**9 // (1000 + 12 * 100)))]


def test_subtrees_are_left_out():
    """Bounds hold for every document below a node, and a search among copies of one vector and a better document reads few of them."""
    rnd = np.random.default_rng(4)
    docs, vocabulary = 3000, 30
    has = rnd.random((docs, vocabulary)) < 1 / (1 + np.arange(vocabulary))
    has[:, 0] = True
    row, term = np.nonzero(has)
    tf = rnd.integers(1, 4, len(row))
    m = rnd.integers(76, 200, docs)
    tree = Tree(row, term, tf, m, np.arange(vocabulary), 8)
    ranks, weights = np.array([3, 9, 17, 25]), np.array([10, 20, 30, 900])
    dense = np.zeros(vocabulary, np.int64)
    exact = np.zeros(docs, np.int64)
    w = np.zeros(vocabulary, np.int64)
    w[ranks] = weights
    np.add.at(exact, row, w[term] * part_score(tf, m[row]))
    for node in range(len(tree.lo)):
        below = tree.docs[tree.lo[node] : tree.hi[node]]
        top = sum(int(weights[i]) * int(tree.most[tree.first[t] : tree.first[t + 1]][tree.nodes[tree.first[t] : tree.first[t + 1]] == node].sum()) for i, t in enumerate(ranks))
        assert exact[below].max() <= top
        for child in tree.children[node]:
            assert tree.lo[node] <= tree.lo[child] < tree.hi[child] <= tree.hi[node]
    read = []

    class Counting(Best):
        def add(self, scores, docs):
            read.append(len(scores))
            super().add(scores, docs)

    best = Counting(5)
    best.of = np.arange(docs), np.zeros(docs, np.int64)
    tree.search(ranks, weights, dense, best)
    want = np.lexsort((np.arange(docs), -exact))[:5]
    assert best.ids.tolist() == want.tolist() and best.scores.tolist() == exact[want].tolist()
    assert sum(read) < docs / 4 and not dense.any()
