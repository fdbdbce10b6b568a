"""Corpus statistics with frozen weights, ranked search, routing tables, suggestions, vocabularies, map cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.scratch import save

K1, B = 1.2, 0.75


#: Rows of a query set's terms that may be sent to all tasks (some 20 MB); more are joined by a shuffle.
BROADCAST_TERMS = 200_000


def query_terms(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.explode(F.array_distinct(X.tokens(F.col("query")))).alias("term"))


def few(rows: DataFrame, most: int = BROADCAST_TERMS) -> DataFrame:
    """rows, to be sent to all tasks if there are at most `most`."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def _terms(corpus: DataFrame, words: Column, queries: DataFrame | None, *keep: str) -> DataFrame:
    """A row for each word; only words of the queries, if these are given, so that no other word is shuffled."""
    rows = corpus.select(*keep, F.explode(words).alias("term"))
    return rows if queries is None else rows.join(few(query_terms(queries).select("term").distinct()), "term", "left_semi")


#: Words that a task counts at once, and sums of documents by queries that it holds at once.
WORDS, CELLS = 1_000_000, 500_000


def _counted(sent):
    """The terms of each document and how often it holds them, from documents split into words (t); of the terms sent, if there are any."""

    def run(batches):
        asked = None if sent is None else pa.array(sent.value, pa.string())
        for batch in batches:
            offsets = batch.column("t").offsets.to_numpy()
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + WORDS, side="right")) - 1)
                some, sizes = batch.slice(lo, hi - lo), np.diff(offsets[lo : hi + 1])
                words, row = some.column("t").flatten(), np.repeat(np.arange(hi - lo), sizes)
                lo = hi
                if asked is None:
                    coded = words.dictionary_encode()
                    terms, no = coded.dictionary, coded.indices.to_numpy()
                else:
                    terms, no = asked, pc.fill_null(pc.index_in(words, value_set=asked), -1).to_numpy()
                    row, no = row[no >= 0], no[no >= 0]
                n = max(1, len(terms))
                key, tf = np.unique(row * n + no, return_counts=True)
                row = key // n
                columns = [some.column("doc_id").take(pa.array(row)), some.column("region_id").take(pa.array(row)), pa.array(sizes[row], pa.int32()), terms.take(pa.array(key % n)), pa.array(tf, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "region_id", "length", "term", "tf"])

    return run


def _unique(corpus: DataFrame) -> bool:
    """Whether no two rows share an id and a region."""
    return corpus.groupBy("doc_id", "region_id").count().where("count > 1").isEmpty()


def postings(corpus: DataFrame, queries: DataFrame | None = None, most: int = BROADCAST_TERMS) -> DataFrame:
    """(doc_id, region_id, length, term, tf) of (doc_id, region_id, text), of the queries' terms if these are given.

    A document's words are counted where its text is, and nothing is shuffled; only rows that share an id and a region are
    added up after that. Beyond `most` terms these aren't sent to the tasks but joined.
    """
    asked = None if queries is None else query_terms(queries).select("term").distinct()
    sent = None
    if asked is not None and asked.limit(most + 1).count() <= most:
        # At most `most` rows.
        sent, asked = corpus.sparkSession.sparkContext.broadcast(sorted(r.term for r in asked.collect())), None
    kind = {c: corpus.schema[c].dataType.simpleString() for c in ("doc_id", "region_id")}
    words = corpus.select("doc_id", "region_id", X.tokens(F.col("text")).alias("t"))
    rows = words.mapInArrow(_counted(sent), f"doc_id {kind['doc_id']}, region_id {kind['region_id']}, length int, term string, tf long")
    if asked is not None:
        rows = rows.join(asked, "term", "left_semi").select("doc_id", "region_id", "length", "term", "tf")
    if _unique(corpus):
        return rows
    return rows.groupBy("doc_id", "region_id", "length", "term").agg(F.sum("tf").alias("tf"))


def _packed(batches):
    """The postings that a task counts at once, gathered by region and term."""
    for b in _counted(None)(batches):
        region, term = (b.column(c).dictionary_encode("encode") for c in ("region_id", "term"))
        key = region.indices.to_numpy().astype(np.int64) * max(1, len(term.dictionary)) + term.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.diff(key[order], prepend=-1))
        entries = pa.StructArray.from_arrays([b.column(c).take(pa.array(order)) for c in ("doc_id", "length", "tf")], ["doc_id", "length", "tf"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(order)), pa.int32()), entries)
        first = pa.array(order[start])
        yield pa.RecordBatch.from_arrays([b.column("region_id").take(first), b.column("term").take(first), lists], ["region_id", "term", "entries"])


def packed_postings(corpus: DataFrame) -> DataFrame:
    """(region_id, term, entries: array of (doc_id, length, tf)): postings of all terms; a row holds those of about WORDS words of documents that stand together, so there are far fewer rows than postings."""
    kind = {c: corpus.schema[c].dataType.simpleString() for c in ("doc_id", "region_id")}
    if not _unique(corpus):
        return postings(corpus).select("region_id", "term", F.array(F.struct("doc_id", "length", "tf")).alias("entries"))
    words = corpus.select("doc_id", "region_id", X.tokens(F.col("text")).alias("t"))
    return words.mapInArrow(_packed, f"region_id {kind['region_id']}, term string, entries array<struct<doc_id:{kind['doc_id']},length:int,tf:bigint>>")


def term_df(corpus: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """(term, df): documents that hold each term, of the queries' terms if these are given."""
    return _terms(corpus, F.array_distinct(X.tokens(F.col("text"))), queries).groupBy("term").agg(F.count("*").alias("df"))


def scoring_stats(corpus: DataFrame) -> DataFrame:
    """(region_id, docs, tokens), and with lat and lon the region's box of documents: sums give the corpus totals."""
    box = [f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("lat", "lon") if c in corpus.columns]
    kept = [c for c in ("lat", "lon") if c in corpus.columns]
    return corpus.select("region_id", F.size(X.tokens(F.col("text"))).alias("n"), *kept).groupBy("region_id").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"), *box)


def _idf(asked: DataFrame, df: DataFrame, stats: DataFrame) -> DataFrame:
    """(term, avg_length, idf) of the terms asked for."""
    total = stats.agg(F.sum("docs").alias("n_docs"), (F.sum("tokens") / F.sum("docs")).alias("avg_length"))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return df.join(few(asked.select("term").distinct()), "term", "left_semi").join(total).select("term", "avg_length", idf.alias("idf"))


def _part() -> Column:
    """A term's part of a document's score; it doesn't depend on the query, so it is worked out once for each posting."""
    return F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("avg_length")))


def bm25_scores(queries: DataFrame, posts: DataFrame, df: DataFrame, stats: DataFrame) -> DataFrame:
    """(query_id, doc_id, region_id, score) of all documents by the frozen statistics, rounded to 6 places."""
    asked = query_terms(queries)
    hits = posts.join(few(_idf(asked, df, stats)), "term").select("doc_id", "region_id", "term", _part().alias("part"))
    return hits.join(few(asked), "term").groupBy("doc_id", "query_id", "region_id").agg(F.round(F.sum("part"), 6).alias("score"))


def best(scores: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best documents of each group; equal scores by id."""
    order = W.partitionBy(*by).orderBy(F.col("score").desc(), "doc_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _leading(sent, k: int):
    """The k best documents of each query and region among those of a task.

    Scores are added up by documents and queries that share a term: in an array of all of these where most do, else by
    sorting, so that the work is that of the terms found and not of all documents by all queries.
    """

    def run(batches):
        first, queries, ids = sent.value
        held: list[tuple[np.ndarray, ...]] = []
        regions: dict[str, int] = {}
        sizes = {"kept": 0, "new": 0}

        def compact() -> None:
            q, region, score, doc = (np.concatenate(c) for c in zip(*held, strict=True))
            by = np.lexsort((doc, -np.floor(score * 1e6 + 0.5), region, q))
            q, region, score, doc = q[by], region[by], score[by], doc[by]
            new = np.concatenate(([True], (q[1:] != q[:-1]) | (region[1:] != region[:-1])))
            start = np.flatnonzero(new)
            keep = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q)))) < k
            held[:] = [(q[keep], region[keep], score[keep], doc[keep])]
            sizes.update(kept=int(keep.sum()), new=0)

        for batch in batches:
            lists = batch.column("hits")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            entries = lists.flatten()
            term, part = entries.field("no").to_numpy(), entries.field("part").to_numpy()
            doc, region = batch.column("doc_id").to_numpy(), np.array([regions.setdefault(r, len(regions)) for r in batch.column("region_id").to_pylist()], np.int64)
            n = first[term + 1] - first[term]
            # Documents whose terms have about CELLS queries, or one document.
            work = np.concatenate(([0], np.cumsum(n)))[ends]
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(work, work[lo] + CELLS, side="right")) - 1)
                some, m = slice(ends[lo], ends[hi]), n[ends[lo] : ends[hi]]
                at = np.repeat(first[term[some]] - np.cumsum(m) + m, m) + np.arange(m.sum())
                cell = np.repeat(np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1])), m) * len(ids) + queries[at]
                if (hi - lo) * len(ids) <= 4 * len(cell):
                    scores = np.bincount(cell, np.repeat(part[some], m), (hi - lo) * len(ids))
                    cell = np.flatnonzero(scores)
                    scores = scores[cell]
                else:
                    cell, no = np.unique(cell, return_inverse=True)
                    scores = np.bincount(no, np.repeat(part[some], m), len(cell))
                    cell, scores = cell[scores != 0], scores[scores != 0]
                held.append((cell % len(ids), region[lo + cell // len(ids)], scores, doc[lo + cell // len(ids)]))
                sizes["new"] += len(cell)
                # What is kept is sorted again only once as much has come.
                if sizes["new"] > max(CELLS, sizes["kept"]):
                    compact()
                lo = hi
        if held:
            compact()
            q, region, score, doc = held[0]
            names = pa.array(list(regions), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids[q], pa.int64()), names.take(pa.array(region)), pa.array(doc, pa.int64()), pa.array(score, pa.float64())], ["query_id", "region_id", "doc_id", "score"])

    return run


def leading_scores(queries: DataFrame, posts: DataFrame, df: DataFrame, stats: DataFrame, k: int, most: int = BROADCAST_TERMS) -> DataFrame:
    """(query_id, doc_id, region_id, score): of each region at least the documents that are among a query's k best there.

    A document's postings of the queries' terms are one row. Tasks add up its scores for all queries at once and send on
    the k best of each query and region, so no row for each query and posting is ever made. Beyond `most` terms of all queries
    these don't fit in every task, and scores come from joins. Query ids and doc_ids are numbers.
    """
    spark = queries.sparkSession
    asked = query_terms(queries)
    if asked.limit(most + 1).count() > most:
        return best(bm25_scores(queries, posts, df, stats), k, "query_id", "region_id").drop("rank")
    # At most `most` rows: the terms of each query.
    pairs = asked.toPandas()
    terms, no = np.unique(pairs["term"].to_numpy(str), return_inverse=True) if len(pairs) else (np.zeros(0, str), np.zeros(0, np.int64))
    ids, query = np.unique(pairs["query_id"].to_numpy(np.int64), return_inverse=True)
    order = np.argsort(no, kind="stable")
    sent = spark.sparkContext.broadcast((np.searchsorted(no[order], np.arange(len(terms) + 1)), query[order], ids))
    numbers = spark.createDataFrame(list(zip(terms.tolist(), range(len(terms)), strict=True)), "term string, no int")
    parts = posts.join(few(_idf(asked, df, stats).join(numbers, "term")), "term")
    rows = parts.groupBy("doc_id", "region_id").agg(F.collect_list(F.struct("no", _part().alias("part"))).alias("hits"))
    found = rows.mapInArrow(_leading(sent, k), "query_id long, region_id string, doc_id long, score double")
    return found.withColumn("score", F.round("score", 6))


def bm25_topk(queries, posts, df, stats, k: int = 5, most: int = BROADCAST_TERMS) -> DataFrame:
    return best(leading_scores(queries, posts, df, stats, k, most), k, "query_id").select("query_id", "rank", "doc_id", "score")


def bm25_sharded_topk(queries, posts, df, stats, k: int = 5) -> DataFrame:
    """The same by each region's own best, merged: the statistics are frozen, so scores compare."""
    local = best(leading_scores(queries, posts, df, stats, k), k, "query_id", "region_id").drop("rank")
    return best(local, k, "query_id").select("query_id", "rank", "doc_id", "score")


def region_df(corpus: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """(region_id, term, n): documents of each region that hold each term, of the queries' terms if these are given; text_routing and term_df can be had of it."""
    return _terms(corpus, F.array_distinct(X.tokens(F.col("text"))), queries, "region_id").groupBy("region_id", "term").agg(F.count("*").alias("n"))


def text_routing(corpus: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """(term, regions): the regions that hold each term, of the queries' terms if these are given."""
    pairs = _terms(corpus, F.array_distinct(X.tokens(F.col("text"))), queries, "region_id").distinct()
    return pairs.groupBy("term").agg(F.array_sort(F.collect_set("region_id")).alias("regions"))


def routed_regions(queries: DataFrame, routing: DataFrame, regions: DataFrame) -> DataFrame:
    """(query_id, region_id): regions that hold a term of the query; all regions if some term is in none."""
    terms = query_terms(queries).join(routing, "term", "left")
    lost = terms.where("regions is null").select("query_id").distinct()
    found = terms.join(lost, "query_id", "left_anti").select("query_id", F.explode("regions").alias("region_id"))
    return found.union(lost.join(regions.select("region_id"))).distinct()


def same_queries(queries: DataFrame) -> DataFrame:
    """(query_id, least, query): for each query the least of those that ask for the same terms, which has the same answer."""
    terms = queries.select("query_id", "query", F.array_sort(F.array_distinct(X.tokens(F.col("query")))).alias("terms"))
    least = terms.groupBy("terms").agg(F.min("query_id").alias("least"))
    return terms.join(least, "terms").select("query_id", "least", "query")


def routed_search(queries, routing, corpus, df, stats, k: int = 5) -> DataFrame:
    """bm25_topk over the documents of routed regions only: other regions' documents are left out before their texts are split, or read, where the corpus is partitioned by region. Queries of the same terms, of which there are more the more documents they come from, are searched once."""
    same = save(same_queries(queries), "queries")
    asked = same.where("query_id = least").select("query_id", "query")
    routed = routed_regions(asked, routing, stats)
    open_ = corpus.join(F.broadcast(routed.select("region_id").distinct()), "region_id", "left_semi")
    scores = leading_scores(asked, postings(open_, asked), df, stats, k)
    found = best(scores.join(few(routed), ["query_id", "region_id"], "left_semi"), k, "query_id").select(F.col("query_id").alias("least"), "rank", "doc_id", "score")
    return same.select("query_id", "least").join(found, "least").select("query_id", "rank", "doc_id", "score")


def facet_counts(corpus: DataFrame, field: str) -> DataFrame:
    """(region_id, value, n) without blank values."""
    return corpus.select("region_id", X.clean(F.col(field)).alias("value")).where("value <> ''").groupBy("region_id", "value").agg(F.count("*").alias("n"))


def merge_vocabulary(counts: DataFrame, shards: DataFrame) -> DataFrame:
    """(value, n) over all shards; fails if a shard is missing or its total isn't the expected one. shards: region_id, total."""
    sums = counts.groupBy("region_id").agg(F.sum("n").alias("got"))
    bad = shards.join(sums, "region_id", "left").where(~F.col("got").eqNullSafe(F.col("total")))
    wrong = bad.agg(F.count("*").alias("bad"))
    merged = counts.groupBy("value").agg(F.sum("n").alias("n"))
    checked = F.when(F.col("bad") > 0, F.raise_error("vocabulary incomplete").cast("long")).otherwise(F.col("n"))
    return merged.join(wrong).select("value", checked.alias("n"))


def incremental_vocabulary(previous: DataFrame, corpus: DataFrame, fingerprints: DataFrame, field: str) -> DataFrame:
    """(region_id, fingerprint, value, n): stored rows where the fingerprint is as before, else counted anew."""
    before = previous.select("region_id", F.col("fingerprint").alias("old")).distinct()
    same = fingerprints.join(before, "region_id", "left").where(F.col("old").eqNullSafe(F.col("fingerprint"))).select("region_id")
    kept = previous.join(same, "region_id", "left_semi")
    anew = facet_counts(corpus.join(same, "region_id", "left_anti"), field).join(fingerprints, "region_id")
    return kept.select("region_id", "fingerprint", "value", "n").unionByName(anew.select("region_id", "fingerprint", "value", "n"))


def category_lexicon(vocabulary: DataFrame, aliases: DataFrame) -> DataFrame:
    """(alias, type) for aliases whose type the corpus has, and each type as its own alias."""
    types = vocabulary.select(F.col("value").alias("type"))
    return aliases.join(types, "type", "left_semi").select("alias", "type").union(types.select(F.col("type").alias("alias"), "type")).distinct()


def category_search(queries: DataFrame, lexicon: DataFrame, regions: DataFrame, corpus: DataFrame) -> DataFrame:
    """(query_id, doc_id): documents of the type that a query's word names, in the query's regions or groups of regions.

    queries: query_id, word, shards (region ids or groups); regions: region_id, groups; corpus: doc_id, region_id, type.
    """
    member = regions.select("region_id", F.explode(F.concat(F.array("region_id"), "groups")).alias("shard"))
    where = queries.select("query_id", F.lower(F.trim("word")).alias("alias"), F.explode("shards").alias("shard")).join(member, "shard").join(lexicon, "alias").select("query_id", "region_id", "type").distinct()
    return corpus.join(where, ["region_id", "type"]).select("query_id", "doc_id")


#: Sides of cells in degrees, the finest first; each is a multiple of the one before.
NEAR_DEGREES = (0.078125, 0.3125, 1.25, 5.0)


def _ring(queries: DataFrame, degrees: float, width: int) -> DataFrame:
    """queries with a row for each cell within `width` cells of theirs."""
    down, across = int(180 / degrees), int(360 / degrees)
    row, column = X.grid_row(F.col("q_lat"), degrees), X.grid_column(F.col("q_lon"), degrees)
    rows = F.sequence(F.greatest(row - width, F.lit(0)), F.least(row + width, F.lit(down - 1)))
    # Columns once around at most.
    columns = F.transform(F.sequence(column - min(width, across // 2), column + min(width, across // 2 - 1)), lambda c: F.pmod(c, F.lit(across)))
    cells = F.flatten(F.transform(rows, lambda r: F.transform(columns, lambda c: (r * across + c).cast("int"))))
    return queries.withColumn("cell", F.explode(cells))


def _finest(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """queries with `level`: the place of the finest cells of which the ring around them holds k points; the coarsest if none does. Points are counted once, by the finest cells; coarser counts are sums of these."""
    row, column = X.grid_row(F.col("lat"), NEAR_DEGREES[0]), X.grid_column(F.col("lon"), NEAR_DEGREES[0])
    fine = save(points.groupBy(row.alias("r"), column.alias("c")).agg(F.count("*").alias("n")), "cell-counts")
    found = None
    for level, degrees in enumerate(NEAR_DEGREES):
        times, across = int(degrees / NEAR_DEGREES[0]), int(360 / degrees)
        counts = fine.groupBy((F.floor(F.col("r") / times) * across + F.floor(F.col("c") / times)).cast("int").alias("cell")).agg(F.sum("n").alias("n"))
        held = _ring(queries, degrees, 1).join(counts, "cell").groupBy("query_id").agg(F.sum("n").alias("n")).where(F.col("n") >= k).select("query_id", F.lit(level).alias("level"))
        found = held if found is None else found.unionByName(held)
    best = found.groupBy("query_id").agg(F.min("level").alias("level"))
    return queries.join(best, "query_id", "left").withColumn("level", F.coalesce("level", F.lit(len(NEAR_DEGREES) - 1)))


def geo_near(queries: DataFrame, points: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, point_id, metres): the nearest points of each query (query_id, q_lat, q_lon).

    Points in the cells within a ring of a query are compared by an equi-join on the cell. Cells are the finest whose ring
    holds k points, so a query among many points meets few of them. Queries whose k-th distance isn't below the ring's
    reach go on with a ring three times as wide, then with coarser cells, which at last are the whole grid.
    """
    ok = points.where(X.valid_coord(F.col("lat"), F.col("lon"))).select("point_id", "lat", "lon")
    metres = F.round(X.haversine(F.col("q_lat"), F.col("q_lon"), F.col("lat"), F.col("lon")), 3)
    order = W.partitionBy("query_id").orderBy("metres", "point_id")
    cols = ["query_id", "rank", "point_id", "metres"]
    left, out = save(_finest(queries.select("query_id", "q_lat", "q_lon"), ok, k), "near-queries"), None

    def ring(some: DataFrame, degrees: float, width: int) -> tuple[DataFrame, DataFrame]:
        """(the k best in the ring, the queries for which no point outside can be nearer)."""
        cells = ok.withColumn("cell", X.grid_cell(F.col("lat"), F.col("lon"), degrees))
        hits = cells.join(_ring(some, degrees, width), "cell").select("query_id", "q_lat", "point_id", metres.alias("metres"))
        top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        # A point outside the ring is at least `width` cells away, by latitude or by longitude at the parallel nearest
        # the pole; the shortest way to a meridian d degrees off is asin(cos(lat) sin(d)).
        pole = F.least(F.abs(F.col("q_lat")) + (width + 1) * degrees, F.lit(90.0))
        reach = X.EARTH_METRES * F.asin(F.cos(F.radians(pole)) * F.sin(F.radians(F.lit(float(min(width * degrees, 90))))))
        sure = top.groupBy("query_id").agg(F.max("metres").alias("far"), F.count("*").alias("n"), F.max(reach).alias("reach")).where((F.col("n") == k) & (F.col("far") < F.col("reach"))).select("query_id")
        return top, sure

    def settle(each: list[tuple[DataFrame, DataFrame]]) -> None:
        nonlocal left, out
        found = None
        for top, sure in each:
            some = top.join(sure, "query_id", "left_semi").select(cols)
            found = some if found is None else found.unionByName(some)
        found = save(found, "near")
        out = found if out is None else out.unionByName(found)
        left = left.join(found.select("query_id").distinct(), "query_id", "left_anti")

    for width in (1, 3):
        settle([ring(left.where(F.col("level") == level), degrees, width) for level, degrees in enumerate(NEAR_DEGREES)])
        if left.isEmpty():
            return out
    coarse, width = NEAR_DEGREES[-1], 3
    while width < int(180 / coarse):
        settle([ring(left, coarse, width)])
        if left.isEmpty():
            return out
        width *= 3
    return out.unionByName(ring(left, coarse, width)[0].select(cols))


def geo_cell_counts(points: DataFrame, field: str, levels: tuple[int, ...] = (9, 12, 15)) -> DataFrame:
    """(level, x, y, value, n): points of each value in each web-mercator tile."""
    ok = points.where(X.valid_coord(F.col("lat"), F.col("lon")))

    def at(z: int) -> Column:
        x, y = X.tile(F.col("lat"), F.col("lon"), z)
        return F.struct(F.lit(z).alias("level"), x.alias("x"), y.alias("y"))

    return ok.select(F.explode(F.array(*map(at, levels))).alias("t"), F.col(field).alias("value")).groupBy("t.level", "t.x", "t.y", "value").agg(F.count("*").alias("n"))
