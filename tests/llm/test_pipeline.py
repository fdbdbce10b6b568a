"""The pipeline against its stages stated row by row, on a small corpus with planted cases."""

import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_planted_cases(spark, tmp_path):
    rnd = random.Random(9)
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "vo", "shi"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    license_line = "All rights reserved under the terms of " + prose(8)
    item = prose(30)
    rows = {i: prose(60) for i in range(200)}
    toxic = [i for i in range(200) if i % 4 == 0]
    for i in toxic:
        rows[i] = rows[i].replace(" ", " idiot ", 3)
    for i in range(101, 120, 2):
        rows[i] += "\n" + license_line.upper() + "  "
    rows[151] = rows[51] + " end"  # a near copy
    rows[153] = rows[53]  # a copy
    rows[155] = prose(20) + " " + item + " " + prose(20)  # contaminated
    rows[157] = prose(3000) + " " + item  # too little of it to be
    docs = [(i, t, "en", "s", len(t)) for i, t in rows.items()] + [(300, None, "en", "s", 0), (301, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in range(200)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: t or "" for i, t, *_ in docs if i not in toxic and i not in (151, 153, 155)}
    for i in range(101, 118, 2):
        want[i] = want[i].split("\n")[0]  # the line stays in the largest id, 119
    assert got.keys() == want.keys()
    for i, t in want.items():
        e = library.encode(t, add_special_tokens=False)
        assert got[i].n_tokens == len(e.ids) and got[i].decoded == library.decode(e.ids, skip_special_tokens=False), i


ODD = [(1, "one text of its own", "en", "s", 19), (1, "one text of its own", "en", "s", 19), (1, "and another that shares the id", "de", "s", 30), (None, None, None, None, None), (None, "no id here", "en", None, 10), (7, "", "en", "s", 0), (8, "x" * 300_000, "en", "s", 300_000), (9, "word " * 60_000, "fr", "s", 300_000)]


def odd(spark):
    return spark.createDataFrame([(*r, "extra", 3) for r in ODD], "doc_id long, text string, lang string, source string, n_chars long, row string, score int")


def test_stages_take_odd_rows_and_clashing_names(spark):
    """Nulls, repeated and shared ids, empty and very long texts, and columns named as the operators name theirs: all rows stay, as nothing is toxic, a copy of another id or contaminated."""
    d = "/root/testdata/sf0.001"
    docs = odd(spark)
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")
    want = sorted(((i is not None, i or 0, t or "") for i, t, *_ in ODD))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == corpus_pipeline.COLUMNS, name
        got = sorted(map(key, out.collect()))
        if name == "line dedup":  # rows that share an id are one document there
            assert {g[1] for g in got} == {w[1] for w in want}
        else:
            assert got == want, name
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens > 0) for r in corpus_pipeline.tokens(spark, docs, d).collect()) == sorted((i is not None, i or 0, bool(t)) for i, t, *_ in ODD)


def test_stages_take_an_empty_table(spark):
    d = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd(spark).limit(0), d).count() == 0


def test_copies_go_on_both_sides_of_the_bound(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, text if i % 3 else f"other {i} {text[::-1]} {i}", "en", "s", 1) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    out = []
    for bound in (corpus_pipeline.GONE, 0):
        monkeypatch.setattr(corpus_pipeline, "GONE", bound)
        out.append(sorted(r.doc_id for r in corpus_pipeline.near_duplicate(spark, docs, "/nowhere").collect()))
    assert out[0] == out[1] and {1} == {i for i in out[0] if i % 3}


def test_stages_keep_columns(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).columns == docs.columns, name
