"""Tables kept by changes against tables built anew; what isn't due isn't read."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from placeflow.operators import search, views
from placeflow.sources import versions

DOC = "doc_id long, region_id string, text string"
WORDS = ["la", "le", "ça", "rue", "route", "rues", "ruelle", "x", "été", "zürich", "nord", "nord-est", "a" * 12, "a" * 12 + "b"]


def rebuilt(docs):
    out = {}
    for _, region, text in docs:
        for t in set((text or "").lower().replace("-", " ").split()):
            out[region, t] = out.get((region, t), 0) + 1
    return out


def test_view_after_many_changes_equals_a_new_one(spark, tmp_path):
    rnd = random.Random(6)
    root = f"{tmp_path}/view"
    docs, prints, frame = {}, {}, lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()], DOC)
    for step in range(5):
        before = dict(docs)
        for _ in range(25):
            k = rnd.randrange(60)
            if rnd.random() < 0.3:
                docs.pop(k, None)
            else:
                docs[k] = (rnd.choice(["fr", "de ü/%", "es"]), rnd.choice([None, "", " ".join(rnd.choices(WORDS, k=rnd.randrange(1, 9)))]))
        touched = {v[0] for k in before.keys() | docs.keys() if before.get(k) != docs.get(k) for v in (before.get(k), docs.get(k)) if v}
        prints |= {r: f"{step}" for r in touched}
        record = views.update_routing(spark, root, views.document_changes(frame(before), frame(docs)), spark.createDataFrame(list(prints.items()), "region_id string, fingerprint string"))
        assert {k: v["fingerprint"] for k, v in record["regions"].items()} == prints
        assert {(r.region_id, r.term): r.n for r in views.read_routing(spark, root).collect()} == rebuilt([(k, *v) for k, v in docs.items()])


def test_unchanged_regions_are_not_read(spark, tmp_path):
    root = f"{tmp_path}/view"
    prints = lambda **k: spark.createDataFrame(list(k.items()), "region_id string, fingerprint string")
    change = lambda *rows: spark.createDataFrame(rows, "region_id string, old_text string, text string")
    first = views.update_routing(spark, root, change(("fr", None, "rue nord"), ("es", None, "calle norte")), prints(fr="1", es="1"))
    # With the files of one region gone, an update that doesn't need them goes through, and one that does fails.
    kept = f"{root}/{first['regions']['es']['path']}"
    shutil.move(kept, f"{tmp_path}/aside")
    second = views.update_routing(spark, root, change(("fr", "rue nord", "rue sud"), ("es", None, "no")), prints(fr="2", es="1"))
    assert second["regions"]["es"] == first["regions"]["es"]
    with pytest.raises(Exception):  # noqa: B017
        views.update_routing(spark, root, change(("es", None, "no")), prints(fr="2", es="2"))
    shutil.move(f"{tmp_path}/aside", kept)
    assert {(r.region_id, r.term) for r in views.read_routing(spark, root).collect()} == {("fr", "rue"), ("fr", "sud"), ("es", "calle"), ("es", "norte")}
    same = views.update_routing(spark, root, change(), prints(fr="2", es="1"))
    assert same["number"] == second["number"]
    # Folders that the current record names stay when old versions are deleted; a region that is gone is gone.
    versions.vacuum(spark, root, keep=1, grace_hours=0)
    assert views.read_routing(spark, root).where("region_id = 'es'").count() == 2
    views.update_routing(spark, root, change(), prints(es="1"))
    assert {r.term: r.regions for r in views.routing_table(views.read_routing(spark, root)).collect()} == {"calle": ["es"], "norte": ["es"]}
    with pytest.raises(Exception, match="negative count"):
        views.update_routing(spark, root, change(("es", "calle calle otra", "calle")), prints(es="3"))


def all_tops(terms, k, least, most):
    out = {}
    for t, df in terms.items():
        if len(t) >= least:
            for n in range(1, min(len(t), most) + 1):
                out.setdefault(t[:n], []).append((-df, t.encode(), t))
    return {p: [(t, -d) for d, _, t in sorted(v)[:k]] for p, v in out.items()}


@pytest.mark.parametrize(("k", "least", "most", "depth"), [(5, 3, 10, 4), (2, 1, 6, 1), (1, 3, 12, 12), (3, 2, 4, 20)])
def test_suggestions_equal_the_full_lexicon(spark, k, least, most, depth):
    rnd = random.Random(depth)
    terms = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 9))): rnd.randrange(1, 6) for _ in range(900)} | dict.fromkeys(WORDS, 3) | {"zz" + chr(0x1F600): 2, "zz￮": 2}
    tops = views.suggest_tops(spark.createDataFrame(list(terms.items()), "term string, df long").repartition(3), k, least, most, depth)
    assert {r.prefix: [(x.term, -x.minus) for x in r["items"]] for r in tops.collect()} == all_tops(terms, k, least, most)
    assert views.suggest_tops(spark.createDataFrame([], "term string, df long")).count() == 0


def test_suggestions_shuffle_little(spark):
    """Prefixes that are whole in a task aren't shuffled; short ones are a list for each task."""
    n = 20_000
    df = spark.range(n).selectExpr("concat(lower(hex(id * 7919 % 65536)), 'abcdefgh', id % 10) as term", "id % 97 as df").groupBy("term").agg(F.max("df").alias("df"))
    tops = views.suggest_tops(df, depth=2)
    lists = tops._jdf.queryExecution().toString()
    assert lists.count("MapInArrow") >= 1
    short = tops.where("length(prefix) < 2").count()
    # One-letter prefixes only go through the second shuffle: at most one list for each of them and each task.
    assert short == 16 and tops.count() > n


def test_stored_lexicon(spark, tmp_path):
    root = f"{tmp_path}/s"
    tops = views.suggest_tops(spark.createDataFrame([("rue", 3), ("route", 5), ("rues", 3)], "term string, df long"))
    with pytest.raises(ValueError, match="no suggestions"):
        views.read_suggestions(spark, root)
    views.write_suggestions(tops.limit(0), root)
    views.write_suggestions(tops, root)
    got = views.suggest_from_tops(spark.createDataFrame([("r",), ("rue",), ("zz",), ("r",)], "prefix string"), views.read_suggestions(spark, root))
    assert sorted(map(tuple, got.collect())) == [("r", 1, "route", 5), ("r", 2, "rue", 3), ("r", 3, "rues", 3), ("rue", 1, "rue", 3), ("rue", 2, "rues", 3)]


def test_shards_that_hold_no_term_stay_closed(spark, tmp_path):
    """The folders' columns are tested before files are opened: files of other shards may even be gone."""
    rnd = random.Random(1)
    docs = [(i, rnd.choice(["fr", "es", "de"]), " ".join(rnd.choices(WORDS, k=6))) for i in range(80)] + [(100, "de", "seul"), (101, "it", None)]
    corpus = spark.createDataFrame(docs, DOC)
    counts = spark.createDataFrame([(r, t, n) for (r, t), n in rebuilt(docs).items()], "region_id string, term string, n long")
    routing, stats, df = views.routing_table(counts), search.scoring_stats(corpus), views.merged_df(counts)
    path = views.write_postings(corpus, f"{tmp_path}/posts", buckets=4)
    ask = lambda *q: spark.createDataFrame(list(enumerate(q)), "query_id long, query string")
    want = lambda q: sorted(map(tuple, search.bm25_topk(q, search.postings(corpus, q), df, stats).collect()))
    got = lambda q: sorted(map(tuple, views.stored_search(spark, path, q, routing, df, stats, buckets=4).collect()))
    for q in (ask("rue route", "seul été", "nord-est inconnu"), ask("inconnu"), ask("")):
        assert got(q) == want(q)
    one = ask("seul")
    shards = views.open_shards(one, routing, 4)
    assert list(shards) == ["de"] and len(shards["de"]) == 1
    plan = views.stored_postings(spark, path, one, routing, 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "region_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {r.f for r in views.stored_postings(spark, path, one, routing, 4).select(F.input_file_name().alias("f")).collect()}
    assert len(read) == 1 and f"region_id=de/bucket={shards['de'][0]}/" in read.pop()
    for region in ("fr", "es"):
        shutil.rmtree(f"{tmp_path}/posts/region_id={region}")
    assert got(one) == want(one)


def test_scores_in_arrays_equal_scores_by_joins(spark):
    """Ties, repeated words, regions without a hit, queries without a known word; on both sides of the bound."""
    rnd = random.Random(2)
    docs = [(i, rnd.choice(["fr", "es", "de"]), " ".join(rnd.choices(WORDS[:6], k=rnd.randrange(1, 7)))) for i in range(150)] + [(200, "it", "seul"), (201, "it", None)]
    corpus = spark.createDataFrame(docs, DOC).repartition(5)
    q = spark.createDataFrame([(1, "la la rue"), (7, "le ça seul"), (3, "inconnu"), (4, ""), (5, "routes rue x"), (6, None)], "query_id long, query string")
    posts, df, stats = search.postings(corpus, q), search.term_df(corpus, q), search.scoring_stats(corpus)
    rows = lambda d: sorted(map(tuple, d.collect()))
    want = rows(search.best(search.bm25_scores(q, posts, df, stats), 3, "query_id").select("query_id", "rank", "doc_id", "score"))
    assert want and rows(search.bm25_topk(q, posts, df, stats, 3)) == want == rows(search.bm25_topk(q, posts, df, stats, 3, most=2)) == rows(search.bm25_sharded_topk(q, posts, df, stats, 3))
    routing = search.text_routing(corpus, q)
    assert rows(search.routed_search(q, routing, corpus, df, stats, 3)) == want
    assert search.bm25_topk(q.limit(0), posts, df, stats).count() == 0 == search.bm25_topk(q, posts.limit(0), df, stats).count()


def test_postings_are_counted_where_texts_are(spark):
    """no shuffle for ids that are unique, the same rows for ids that aren't, and for terms that are joined instead of sent."""
    rows = [(1, "a", "x y x Zz"), (2, "b", None), (3, "b", ""), (4, "a", "y é9 q " * 50), (5, "a", "none of them")]
    corpus = spark.createDataFrame(rows, "doc_id long, region_id string, text string")
    asked = spark.createDataFrame([(1, "X zz é9"), (2, "y")], "query_id long, query string")
    got = lambda df: sorted((r.doc_id, r.region_id, r.length, r.term, r.tf) for r in df.collect())
    want = [(1, "a", 4, "x", 2), (1, "a", 4, "y", 1), (1, "a", 4, "zz", 1), (4, "a", 150, "y", 50), (4, "a", 150, "é9", 50)]
    posts = search.postings(corpus, asked)
    assert got(posts) == want and "Exchange" not in posts._jdf.queryExecution().executedPlan().toString()
    assert got(search.postings(corpus, asked, most=1)) == want
    assert got(search.postings(corpus)) == sorted([*want, (4, "a", 150, "q", 50), *((5, "a", 3, w, 1) for w in ("none", "of", "them"))])
    assert got(search.postings(corpus, asked.limit(0))) == []
    twice = corpus.union(corpus.where("doc_id = 1")).union(spark.createDataFrame([(1, "b", "x")], corpus.schema))
    assert got(search.postings(twice, asked)) == sorted([(1, "a", 4, "x", 4), (1, "a", 4, "y", 2), (1, "a", 4, "zz", 2), (1, "b", 1, "x", 1), *want[3:]])


def test_slices_don_t_change_results(spark, monkeypatch):
    """few words and few sums at a time."""
    rnd = random.Random(5)
    corpus = spark.createDataFrame([(i, rnd.choice("ab"), " ".join(rnd.choices("abcdefgh", k=rnd.randrange(30)))) for i in range(200)], "doc_id long, region_id string, text string").coalesce(1)
    asked = spark.createDataFrame([(i, " ".join(rnd.sample("abcdefghz", 3))) for i in range(7)], "query_id long, query string")

    def got():
        posts = search.postings(corpus, asked)
        return sorted(tuple(r) for r in search.bm25_topk(asked, posts, search.term_df(corpus, asked), search.scoring_stats(corpus)).collect())

    whole = got()
    monkeypatch.setattr(search, "WORDS", 40)
    monkeypatch.setattr(search, "CELLS", 20)
    assert got() == whole and len(whole) == 35


def test_stored_postings_are_packed(spark, tmp_path):
    """a stored row holds a term's postings of many documents; reading gives the postings again, also of ids that aren't unique."""
    corpus = spark.createDataFrame([(i, "ab"[i % 2], "x y" if i % 3 else "x x") for i in range(300)] + [(1000, "a", None)], "doc_id long, region_id string, text string").coalesce(1)
    ask = spark.createDataFrame([(1, "x y")], "query_id long, query string")
    routing = spark.createDataFrame([("x", ["a", "b"]), ("y", ["a", "b"])], "term string, regions array<string>")
    rows = lambda df: sorted((r.doc_id, r.region_id, r.length, r.term, r.tf) for r in df.collect())
    for n, docs in enumerate((corpus, corpus.union(corpus.where("doc_id < 7")))):
        path = views.write_postings(docs, f"{tmp_path}/{n}", buckets=2)
        assert rows(views.stored_postings(spark, path, ask, routing, 2)) == rows(search.postings(docs, ask)) != []
        if n == 0:
            assert spark.read.parquet(path).count() == 4


def test_deltas_cancel_what_both_versions_hold(spark):
    """no sets are compared within rows; words of both versions, nulls and empty texts count for nothing."""
    changes = spark.createDataFrame([("a", None, "x y y"), ("a", "x q", "q z"), ("a", "gone", None), ("b", "", ""), ("b", "same", "Same")], "region_id string, old_text string, text string")
    deltas = views.term_deltas(changes)
    assert sorted(map(tuple, deltas.collect())) == [("a", "gone", -1), ("a", "y", 1), ("a", "z", 1)]
    assert "array_except" not in deltas._jdf.queryExecution().optimizedPlan().toString()
