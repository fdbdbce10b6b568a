"""Tables that follow the corpus by its changes: routing of terms, suggestion tops, stored postings.

The routing view holds, for each region, how many of its documents hold each term. A region's counts are a folder of their own;
the current version's record names the folder and fingerprint of each. An update reads the folders of regions whose
fingerprint changed, adds what documents gained and lost, and writes these anew; all other regions' folders are named again
without being read. Counts that reach 0 go, and with them a term's route to the region. Regions are configuration, so
their list may pass through the driver; terms never do.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.functions import exprs as X
from placeflow.operators import search
from placeflow.scratch import new_path, save
from placeflow.sources import versions

#: Version of the layout of these tables; a view of another one is built anew.
SCHEMA = 1
_COUNTS = "term string, n long"


def document_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(doc_id, region_id, old_text, text) of documents (doc_id, region_id, text) that were added, removed, moved or changed; a document that moved is removed in one region and added in the other. Digests are compared; texts are fetched for what differs. Ids are unique on either side."""
    side = lambda df: df.select("doc_id", "region_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    a, b = side(old), side(new)
    keys = ["doc_id", "region_id"]
    both = a.join(b.withColumnRenamed("h", "new_h"), keys, "full_outer").where(~F.col("h").eqNullSafe(F.col("new_h"))).select(*keys, F.col("h").isNotNull().alias("was"), F.col("new_h").isNotNull().alias("is"))
    differ = save(both, "changes")
    # Texts of what is the same aren't shuffled.
    some = search.few(differ.select(*keys))
    texts = lambda df, name: df.join(some, keys, "left_semi").select(*keys, F.coalesce("text", F.lit("")).alias(name))
    return differ.join(texts(old, "old_text"), keys, "left").join(texts(new, "text"), keys, "left").select(*keys, F.when(F.col("was"), F.col("old_text")).alias("old_text"), F.when(F.col("is"), F.col("text")).alias("text"))


def term_deltas(changes: DataFrame) -> DataFrame:
    """(region_id, term, d): by how many documents each term's count changes."""
    # What a text has in both versions adds up to nothing, mostly before the shuffle.
    side = lambda d, c: F.struct(F.lit(d).alias("d"), F.col(c).alias("text"))
    sides = changes.select("region_id", F.explode(F.array(side(1, "text"), side(-1, "old_text"))).alias("x")).where("x.text is not null")
    words = sides.select("region_id", "x.d", F.explode(F.array_distinct(X.tokens(F.col("x.text")))).alias("term"))
    return words.groupBy("region_id", "term").agg(F.sum("d").alias("d")).where("d <> 0")


def _counts(spark: SparkSession, root: str, regions: dict[str, dict]) -> DataFrame:
    out = None
    for region, r in regions.items():
        part = spark.read.schema(_COUNTS).parquet(f"{root}/{r['path']}").select(F.lit(region).alias("region_id"), "term", "n")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "region_id string, term string, n long") if out is None else out


def update_routing(spark: SparkSession, root: str, changes: DataFrame, fingerprints: DataFrame) -> dict:
    """Bring the view up to date; returns its record.

    changes: (region_id, old_text, text) since the current version, of regions whose fingerprint changed (others are left out); fingerprints:
    (region_id, fingerprint) of all regions now. A region that isn't among them goes. Changes that take away more than there is fail the job.
    """
    root = root.rstrip("/")
    last = versions.current(spark, root)
    stored = last["regions"] if last and last["schema"] == SCHEMA else {}
    now = {r.region_id: r.fingerprint for r in fingerprints.collect()}
    same = {k: v for k, v in stored.items() if now.get(k) == v["fingerprint"]}
    due = sorted(now.keys() - same.keys())
    if last and not due and same.keys() == stored.keys():
        return last

    def write(folder: str) -> dict:
        path = folder.removeprefix(f"{root}/")
        if due:
            before = _counts(spark, root, {k: stored[k] for k in due if k in stored})
            deltas = term_deltas(changes.where(F.col("region_id").isin(due))).select("region_id", "term", F.col("d").cast("long").alias("n"))
            n = F.sum("n")
            sums = before.unionByName(deltas).groupBy("region_id", "term").agg(F.when(n < 0, F.raise_error(F.concat(F.lit("negative count of "), "region_id", F.lit(" "), "term")).cast("long")).otherwise(n).alias("n")).where("n <> 0")
            # A folder for every region, also for one without terms.
            sums.repartition("region_id", F.substring("term", 1, 2)).write.partitionBy("region_id").parquet(folder)
            for region in due:
                versions.make_folder(spark, f"{folder}/region_id={versions.escaped(spark, region)}")
        return {"schema": SCHEMA, "regions": same | {k: {"fingerprint": now[k], "path": f"{path}/region_id={versions.escaped(spark, k)}"} for k in due}}

    return versions.commit(spark, root, f"routing-{(last['number'] + 1) if last else 0}", write)


def read_routing(spark: SparkSession, root: str) -> DataFrame:
    """(region_id, term, n): documents of each region that hold each term, of the current version."""
    root = root.rstrip("/")
    record = versions.current(spark, root)
    if record is None:
        raise ValueError(f"no routing view at {root}")
    return _counts(spark, root, record["regions"])


def routing_table(counts: DataFrame) -> DataFrame:
    """(term, regions) of a view's counts."""
    return counts.groupBy("term").agg(F.array_sort(F.collect_set("region_id")).alias("regions"))


def merged_df(counts: DataFrame) -> DataFrame:
    """(term, df) over all regions: document frequencies without reading a document."""
    return counts.groupBy("term").agg(F.sum("n").alias("df"))


# Suggestions -----------------------------------------------------------------------------------------------------


def _tops(k: int, least: int, most: int, depth: int):
    """Lists of the k best terms of each prefix, from terms in order: a prefix is open while terms begin so, and written when the first other one comes."""

    def run(batches):
        open_: list[tuple[str, list]] = []
        done: list[tuple[str, list, bool]] = []

        def close(keep: int) -> None:
            while len(open_) > keep:
                prefix, heap = open_.pop()
                done.append((prefix, [{"minus": -df, "term": t} for df, t in sorted(((df, t.text) for df, t in heap), key=lambda x: (-x[0], x[1]))], len(prefix) >= depth))

        def batch() -> pa.RecordBatch:
            kind = pa.list_(pa.struct([("minus", pa.int64()), ("term", pa.string())]))
            out = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], kind), pa.array([d[2] for d in done], pa.bool_())], ["prefix", "items", "whole"])
            done.clear()
            return out

        for b in batches:
            for term, df in zip(b.column("term").to_pylist(), b.column("df").to_pylist(), strict=True):
                if len(term) < least:
                    continue
                shared = 0
                while shared < min(len(open_), len(term)) and term.startswith(open_[shared][0]):
                    shared += 1
                close(shared)
                for n in range(len(open_) + 1, min(len(term), most) + 1):
                    open_.append((term[:n], []))
                entry = (df, _Last(term))
                for _, heap in open_:
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
            yield batch()
        close(0)
        yield batch()

    return run


class _Last:
    """A term that counts as less the later it stands in the alphabet, so that of equal counts the last one leaves a heap first."""

    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text

    def __lt__(self, other: _Last) -> bool:
        return self.text.encode() > other.text.encode()

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Last) and self.text == other.text

    def __hash__(self) -> int:
        return hash(self.text)


def suggest_tops(df: DataFrame, k: int = 5, least: int = 3, most: int = 10, depth: int = 4) -> DataFrame:
    """(prefix, items: array of (minus: -df, term), best first): the k best terms of each prefix of 1 to `most` letters, of terms (term, df) of at least `least`.

    Terms are shuffled once, by ranges of their first `depth` letters, and read in order, so prefixes of that length or
    longer are whole in one task and aren't shuffled again. Of shorter ones each task sends one list of at most k.
    """
    dealt = df.where(F.length("term") >= least).select("term", F.col("df").cast("long").alias("df"), F.expr(f"left(term, {depth})").alias("p")).repartitionByRange("p").sortWithinPartitions("term").select("term", "df")
    lists = dealt.mapInArrow(_tops(k, least, most, depth), "prefix string, items array<struct<minus:bigint,term:string>>, whole boolean")
    short = lists.where("not whole").groupBy("prefix").agg(F.slice(F.array_sort(F.flatten(F.collect_list("items"))), 1, k).alias("items"))
    return lists.where("whole").select("prefix", "items").unionByName(short)


def write_suggestions(tops: DataFrame, root: str) -> dict:
    """The lexicon as a version, in order of prefixes, so that a lookup reads the row groups whose range holds its prefix."""
    spark = tops.sparkSession
    last = versions.current(spark, root)
    return versions.commit(spark, root, f"suggest-{(last['number'] + 1) if last else 0}", lambda path: tops.repartitionByRange("prefix").sortWithinPartitions("prefix").write.parquet(path))


def read_suggestions(spark: SparkSession, root: str) -> DataFrame:
    record = versions.current(spark, root)
    if record is None:
        raise ValueError(f"no suggestions at {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{record['path']}")


def suggest_from_tops(prefixes: DataFrame, tops: DataFrame, k: int = 5) -> DataFrame:
    """(prefix, rank, term, df) of the prefixes asked for."""
    hits = tops.join(search.few(prefixes.select("prefix").distinct()), "prefix", "left_semi")
    return hits.select("prefix", F.posexplode(F.slice("items", 1, k)).alias("r", "x")).select("prefix", (F.col("r") + 1).cast("int").alias("rank"), F.col("x.term").alias("term"), (-F.col("x.minus")).alias("df"))


# Stored postings -------------------------------------------------------------------------------------------------


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_postings(corpus: DataFrame, path: str | None = None, buckets: int = 16, rows: int = 5_000_000) -> str:
    """Postings of a corpus (doc_id, region_id, text), packed (term, entries: array of (doc_id, length, tf)), in a folder for each region and bucket of terms; a frequent term's bucket is several files. Returns the path."""
    path = path or new_path(corpus.sparkSession, "postings")
    posts = search.packed_postings(corpus).withColumn("bucket", _bucket(F.col("term"), buckets))
    # Documents are spread, so no region's bucket is one task's.
    spread = F.pmod(F.xxhash64(F.col("entries")[0]["doc_id"]), F.lit(8))
    posts.repartition("region_id", "bucket", spread).sortWithinPartitions("region_id", "bucket", "term").write.option("maxRecordsPerFile", rows).partitionBy("region_id", "bucket").parquet(path)
    return path


def open_shards(queries: DataFrame, routing: DataFrame, buckets: int) -> dict[str, list[int]]:
    """The buckets of each region that hold a term of the queries: what a search of stored postings has to read. At most one for each region and bucket, whatever the number of queries."""
    terms = search.query_terms(queries).select("term").distinct()
    hit = routing.join(terms, "term", "left_semi").select(F.explode("regions").alias("region_id"), _bucket(F.col("term"), buckets).alias("bucket")).distinct()
    out: dict[str, list[int]] = {}
    for r in hit.orderBy("region_id", "bucket").collect():
        out.setdefault(r.region_id, []).append(r.bucket)
    return out


def stored_postings(spark: SparkSession, path: str, queries: DataFrame, routing: DataFrame, buckets: int = 16) -> DataFrame:
    """The postings of the queries' terms, from the shards that hold them; the others aren't opened: the condition is on the folders' columns, so it prunes before files are listed for reading."""
    schema = "term string, entries array<struct<doc_id:bigint,length:int,tf:bigint>>, region_id string, bucket int"
    shards = open_shards(queries, routing, buckets)
    test = F.lit(False)
    for region, some in shards.items():
        test = test | ((F.col("region_id") == region) & F.col("bucket").isin(some))
    posts = spark.read.schema(schema).parquet(path).where(test)
    return posts.join(search.few(search.query_terms(queries).select("term").distinct()), "term", "left_semi").select("region_id", "term", F.inline("entries")).select("doc_id", "length", "term", "tf", "region_id")


def stored_search(spark: SparkSession, path: str, queries: DataFrame, routing: DataFrame, df: DataFrame, stats: DataFrame, k: int = 5, buckets: int = 16) -> DataFrame:
    """bm25_topk over stored postings: a document that holds a term lies in a region that the term is routed to, so the result is that over the whole corpus."""
    return search.bm25_topk(queries, stored_postings(spark, path, queries, routing, buckets), df, stats, k)
