"""Contamination against a plain comparison of windows."""

import random
import re

import pytest

from placeflow.llm.decontaminate import find_contamination, contamination_report, remove_contamination


def words(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(low))


def brute(docs, items, window):
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            n = min(window, len(iw))
            if item is None or not n:
                continue
            grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found.add(item)
        out.append((len(w), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize(("block_words", "pass_words"), [(10**6, 10**6), (12, 10**6), (12, 20), (3, 0)])
def test_equals_rule(spark, block_words, pass_words):
    """With one automaton, several in a pass, and several passes; with items longer than a block."""
    rnd = random.Random(11)
    alphabet = ["a", "B", "c", "É", "x1", "_", "né"]
    some = lambda n: " ".join(rnd.choice(alphabet) for _ in range(n))
    items = [(i, some(rnd.randint(0, 9))) for i in range(25)] + [(3, "c c c"), (None, "a a"), (77, None), (78, "..."), (12, "A b")]
    docs = [(i, some(rnd.randint(0, 30))) for i in range(150)] + [(1, None), (None, ""), (7, "a-b_c/É" * 30), (7, "a-b_c/É" * 30)]
    d = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, items int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(d, b, 5, block_words=block_words, pass_words=pass_words)
    assert sorted((r.n_words, sum(h["end"] - h["first"] for h in r.hits), r.items) for r in got.collect()) == brute(docs, items, 5)
    assert contamination_report(got).count() == len(docs)


def test_removal(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame([(1, f"É start {item.upper()} end", "x"), (2, "clean words only", "y"), (3, None, "z")], "doc_id long, text string, lang string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in remove_contamination(docs, bench).collect()) == [2, 3]
    cut = {r.doc_id: r for r in remove_contamination(docs, bench, cut=True).collect()}
    assert cut[1].text == "É start  end" and cut[1].lang == "x" and cut[2].text == "clean words only" and cut[3].text is None


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in contamination_report(find_contamination(docs, none)).collect()] == [False]
    assert find_contamination(docs.limit(0), none).count() == 0


def test_long_texts(spark):
    rnd = random.Random(2)
    item = [f"w{rnd.randrange(400)}" for _ in range(3000)]
    text = [f"w{rnd.randrange(400)}" for _ in range(120_000)]
    text[5000:5040] = item[100:140]
    docs = [(1, " ".join(text)), (2, "x" * 400_000), (3, " ".join(item))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    want = brute(docs, [(7, " ".join(item))], 13)
    for block in (10**6, 1000):
        got = find_contamination(d, b, 13, block_words=block)
        assert sorted((r.n_words, sum(h["end"] - h["first"] for h in r.hits), r.items) for r in got.collect()) == want
