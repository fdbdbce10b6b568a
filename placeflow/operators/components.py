"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.scratch import discard, save

#: Nodes with more edges than this, and than a 10,000th of all, aren't gathered.
HEAVY = 100_000


def _looked_up(rows: DataFrame, key: str, table: DataFrame, most: int) -> DataFrame:
    """rows with m of table (u, m, n) for their key, or the key itself where table has none. n: at least the rows of a key. Keys of more than `most` rows are sent to the rows, of which they can't be many; only the others' rows are shuffled by key."""

    def found(some: DataFrame, of: DataFrame) -> DataFrame:
        return some.join(of.select(F.col("u").alias("_u"), F.col("m").alias("_m")), F.col(key) == F.col("_u"), "left")

    heavy = table.where(F.col("n") > most)
    if heavy.isEmpty():
        out = found(rows, table.hint("shuffle_hash"))
    else:
        marked = found(rows, F.broadcast(heavy))
        rest = found(marked.where("_m is null").drop("_u", "_m"), table.where(F.col("n") <= most).hint("shuffle_hash"))
        out = marked.where("_m is not null").unionByName(rest)
    return out.withColumn("m", F.coalesce("_m", key)).drop("_u", "_m")


def _roots(least: DataFrame, heavy: int) -> DataFrame:
    """least (u, m, n), where m is not above u, with the end of each chain u, m, m of m and so on as m. Only nodes that are an m of others are followed, twice as far in each round."""
    counts = save(least.groupBy("m").agg(F.count("*").alias("rows")), "components")
    chains = save(counts.join(least.select("u", F.col("m").alias("next")), F.col("m") == F.col("u")).select("u", F.col("next").alias("m"), F.col("rows").alias("n")), "components")
    discard(counts)
    while True:
        # Of the chains themselves, those that go on from a node: at most the rows of it.
        further = save(_looked_up(chains.select("u", "n", F.col("m").alias("at")), "at", chains, heavy), "components")
        discard(chains)
        chains = further.select("u", "m", "n")
        chains.scratch_path = further.scratch_path
        if further.where("m <> at").isEmpty():
            break
    out = save(_looked_up(least.select("u", "n", F.col("m").alias("at")), "at", chains, heavy).select("u", "m", "n"), "components")
    discard(chains)
    return out


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", heavy: int = HEAVY) -> DataFrame:
    """(node, component): component is the least node that edges reach. Nodes without an edge to another aren't in the result.

    In each round every node goes with its least neighbour, if that is less, and what hangs together so becomes one node,
    the least of it; edges within it are dropped. A node that neither goes with another nor is gone with has lesser ones
    beside it in the next round, so two rounds halve the nodes at least. A node's least neighbour is an aggregate that is combined
    before the shuffle, and the edges of a hub stay where they are. Each round is written to the shared folder.
    """
    now, levels = save(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v"), "components"), []
    while levels == [] or not now.isEmpty():
        most = max(heavy, 2 * now.count() // 10_000)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "components")
        roots = _roots(least, most)
        ends = _looked_up(now, "u", roots, most).select("v", F.col("m").alias("a"))
        ends = _looked_up(ends, "v", roots, most).select("a", F.col("m").alias("b")).where("a <> b")
        before, now = now, save(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
        discard(before, least)
        levels.append(roots)
    discard(now)
    # From the last level to the first: a node's root, and that one's.
    out = levels.pop()
    while levels:
        below = levels.pop()
        counts = below.groupBy("m").agg(F.count("*").alias("rows")).withColumnRenamed("m", "at")
        table = save(counts.join(out, F.col("at") == F.col("u")).select("u", "m", F.col("rows").alias("n")), "components")
        above, out = out, save(_looked_up(below.select("u", F.col("m").alias("at")), "at", table, heavy).select("u", "m"), "components")
        discard(above, below, table)
    return out.select(F.col("u").alias("node"), F.col("m").alias("component"))
