"""Language-model scores against PPM worked out symbol by symbol, and the base against its formula."""

import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from placeflow.llm import ppm
from placeflow.llm._common import crc_mod
from placeflow.llm.ppm import lm_scores


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def sequence(text):
    return [0] * ppm.ORDER + list(lower(text)) + [256]


def brute(train, text):
    """log10 probability by escaping down the orders, with all contexts kept."""
    seen = Counter()
    for t in train:
        s = sequence(t)
        for i in range(ppm.ORDER, len(s)):
            for k in range(ppm.ORDER + 1):
                seen[tuple(s[i - k : i]), s[i]] += 1
    after = {}
    for (c, x), n in seen.items():
        after.setdefault(c, {})[x] = n
    s, total = sequence(text), 0.0
    for i in range(ppm.ORDER, len(s)):
        excluded, p = set(), 1.0
        for k in range(ppm.ORDER, -1, -1):
            counts = {x: n for x, n in after.get(tuple(s[i - k : i]), {}).items() if x not in excluded}
            if not counts:
                continue
            if s[i] in counts:
                p *= counts[s[i]] / (sum(counts.values()) + len(counts))
                break
            p *= len(counts) / (sum(counts.values()) + len(counts))
            excluded |= set(counts)
        else:
            p /= 257 - len(excluded)
        total += math.log10(p)
    return total


def test_equals_rules(spark, monkeypatch):
    monkeypatch.setattr(ppm, "HEAVY", 5)
    rnd = random.Random(2)
    words = ["the", "The", "thé", "cat", "ca", "😀", "x\x00y", "of,", "zz"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))) for i in range(40)] + [(50, None), (51, ""), (3, "of, the cat"), (3, "of, the cat"), (None, "cat\n\tof,"), (77, "unseen ≠ letters")]
    df = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, score string")
    got = lm_scores(df, crc_mod(F.col("doc_id"), 5) == 1).collect()
    assert len(got) == len(rows)
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    train = [t for i, t in rows if not out(i)]
    tokens = Counter(w for t in train for w in re.findall(rb"[^\x20\x09-\x0D]+", lower(t)))
    tokens["end"] = len(train)
    total, distinct = sum(tokens.values()), len(tokens)
    want = []
    for i, t in rows:
        ws = [*re.findall(rb"[^\x20\x09-\x0D]+", lower(t)), "end"]
        base = sum(math.log10((tokens[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        want.append((i, out(i), len(ws), sum(tokens[w] > 0 for w in ws), total, base, brute(train, t)))
    for a, b in zip(sorted(got, key=str), sorted(want, key=lambda r: str(next(x for x in got if x.doc_id == r[0] and x.n_tokens == r[2]))), strict=True):
        assert tuple(a)[:5] == b[:5]
        assert math.isclose(a.base_score, b[5], rel_tol=1e-9)
        # Code lengths are rounded up to 1 / STEP.
        assert b[6] - len(sequence("")) - 60 / ppm.STEP * 20 <= a.score <= b[6] + 1e-9 and abs(a.score - b[6]) < 0.1


def test_no_training_texts(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = lm_scores(df, F.lit(True)).first()
    assert r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-9 and r.score < 0
    assert lm_scores(df.limit(0), F.lit(False)).count() == 0


def test_all_contexts_count(spark, monkeypatch):
    # However few contexts are sent to the tasks, scores come from all that were counted.
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(0, 60)))) for i in range(60)] + [(70, "zebra ≠"), (71, "Zebra"), (None, "a\nb"), (72, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    monkeypatch.setattr(ppm, "MOST", dict.fromkeys(range(ppm.ORDER + 1), 2))
    for pairs in (0, 200):
        monkeypatch.setattr(ppm, "PAIRS", pairs)
        got = {r.doc_id: r.score for r in lm_scores(df, crc_mod(F.col("doc_id"), 5) == 1).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            want = brute(train, t)
            assert want - len(sequence(t)) / ppm.STEP <= got[i] <= want + 1e-6


def test_very_long_text(spark):
    # Each further period of a text adds the same code length.
    period, n = "The cat of Zürich, ", 150_000
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 5 == 1)
    learnt = [i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 5 != 1][:2]
    train = ["the cat sat", "of the zoo, the cat"]
    df = spark.createDataFrame([*zip(learnt, train, strict=True), (held, period * n)], "doc_id long, text string")
    got = next(r for r in lm_scores(df, crc_mod(F.col("doc_id"), 5) == 1).collect() if r.doc_id == held)
    two, three = brute(train, period * 2), brute(train, period * 3)
    want = two + (n - 2) * (three - two)
    assert got.n_tokens == 4 * n + 1 and want - len((period * n).encode()) / ppm.STEP - 1 <= got.score <= want + 1
