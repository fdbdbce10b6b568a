"""Ranked lexical search: the k best documents of each item, by branch and bound over trees of restricted term vectors.

Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case, told apart by 64-bit hashes. Items are
the stated queries. A first pass turns each document into its vector restricted to the items' terms (with its length), and
counts documents, terms and, by term, documents over all rows. The second pass takes the vectors block by block: terms
stand in order of frequency, the most frequent first, so vectors that begin alike share a path of the block's FP-tree.
Nodes down to LEAF documents carry the greatest tf of each term below them and the least length norm m. A term's part of
a score grows with tf and falls with m, so these bound every score in a subtree. For each item the tree is searched
depth first, children with higher bounds first; a subtree whose bound is below the item's k-th best score so far in the
task is left out, whatever is left is scored exactly, and the lists of all tasks are merged. Nothing is cut off otherwise:
no document or term is skipped, so results are exact.

Items are taken in blocks of about BLOCK_TERMS distinct terms in total (one more for a larger item), each in two passes
over the documents, so what tasks and driver hold of them is bounded.

Null and empty texts have no terms: they count for nothing and are in no result. A document without an id counts, and comes
after others of its score. Repeated documents each count and rank; a repeated item row has a list of its own. Terms that
an item repeats count as often. Items without a known term, and an empty table on either side, give no rows. A very long
text is one vector, tokenised in memory of some 60 bytes a word. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import deque
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, parts, raw, separators, texts, word_hashes, word_spans
from placeflow.scratch import discard, save

BLOCK_TERMS = 200_000
#: Documents and vector entries of a tree, and documents of its leaves.
DOCS, ENTRIES, LEAF = 16_384, 1_500_000, 64
_INSIDE = separators(keep_alnum_only=True)
_VECTOR = "doc_id long, n long, terms binary, tfs binary"


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values from one flat array, cut at the ends (in entries)."""
    cuts = np.concatenate(([0], ends)) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def term_counts(column: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each text; entries of all texts' vectors: text, term, tf), by text and term. A term is its place in `wanted` (sorted hashes); others only count in the first."""
    data, offsets = raw(column)
    starts, ends, first = word_spans(data, offsets, _INSIDE)
    n = np.diff(first)
    hashes = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(len(n)), n)
    if not len(wanted):
        return n, *[np.zeros(0, np.int64)] * 3
    at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
    known = wanted[at] == hashes
    key, tf = np.unique(row[known] * len(wanted) + at[known], return_counts=True)
    return n, key // len(wanted), key % len(wanted), tf


def _item_terms(batches):
    for batch in batches:
        for part in parts(batch):
            data, offsets = raw(part.column("text"))
            starts, ends, first = word_spans(data, offsets, _INSIDE)
            hashes = word_hashes(data, starts, ends)
            rows = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("item"), part.column("item_id"), pa.array([len(t) for t, _ in rows], pa.int64()), pa.array([t.tobytes() for t, _ in rows], pa.binary()), pa.array([c.astype("<i8").tobytes() for _, c in rows], pa.binary())],
                ["item", "item_id", "n", "terms", "counts"],
            )


def _restrict(sent):
    def run(batches):
        wanted = np.frombuffer(sent.value, np.uint64)
        for batch in batches:
            for part in parts(batch):
                n, row, term, tf = term_counts(part.column("text"), wanted)
                ends = np.cumsum(np.bincount(row, minlength=len(n)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), _binaries(term.astype("<i4"), ends), _binaries(tf.astype("<i4"), ends)], ["doc_id", "n", "terms", "tfs"])
            give_back()

    return run


def _document_counts(terms: int):
    def run(batches):
        df = np.zeros(terms, np.int64)
        for batch in batches:
            data, _ = raw(batch.column("terms"))
            df += np.bincount(np.frombuffer(data.tobytes(), "<i4"), minlength=terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], ["term", "df"])

    return run


def part_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to a score; grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Tree:
    """The FP-tree of a block of documents, as ranges of documents sorted by their vectors.

    order: the rank of each term, the most frequent first. A node is a range of documents that begin alike; single
    children are folded into their parent, and neighbours among a node's small children share a leaf.
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, order: np.ndarray, leaf: int = LEAF):
        docs = len(m)
        rank = order[term]
        by = np.lexsort((rank, row))
        rank, tf, sizes = rank[by], tf[by].astype(np.int64), np.bincount(row, minlength=docs)
        ends = np.cumsum(sizes)
        path, cuts = rank.astype(">u4").tobytes(), (ends * 4).tolist()
        keys = [path[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        self.docs = np.array(sorted(range(docs), key=keys.__getitem__), np.int64)
        sizes_now = sizes[self.docs]
        self.offsets = np.concatenate(([0], np.cumsum(sizes_now)))
        pick = np.repeat(ends[self.docs] - sizes_now - self.offsets[:-1], sizes_now) + np.arange(len(rank))
        self.rank, tf, m = rank[pick], tf[pick], m[self.docs]
        self.parts = part_score(tf, np.repeat(m, sizes_now))
        self._grow(leaf)
        self._bound(tf, m, len(order))

    def _shared(self) -> np.ndarray:
        """How many terms a document's path shares with the one before; every document has a term."""
        sizes = np.diff(self.offsets)
        depth = np.arange(len(self.rank)) - np.repeat(self.offsets[:-1], sizes)
        before = np.repeat(np.concatenate(([0], self.offsets[:-2])), sizes) + depth
        there = depth < np.repeat(np.concatenate(([0], sizes[:-1])), sizes)
        alike = there & (self.rank[np.where(there, before, 0)] == self.rank)
        return np.minimum.reduceat(np.where(alike, np.repeat(sizes, sizes), depth), self.offsets[:-1])

    def _grow(self, leaf: int) -> None:
        shared = self._shared()
        self.lo, self.hi, self.children = [0], [len(self.docs)], [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            lo, hi = self.lo[node], self.hi[node]
            if hi - lo <= leaf:
                continue
            inner = shared[lo + 1 : hi]
            edges = [lo, *(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
            begin = lo
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                # A large child stands alone; small neighbours are put together.
                if a > begin and (b - begin > leaf):
                    self._add(node, begin, a, todo)
                    begin = a
                if b - begin > leaf or b == hi:
                    self._add(node, begin, b, todo)
                    begin = b

    def _add(self, parent: int, lo: int, hi: int, todo: list[int]) -> None:
        self.children[parent].append(len(self.lo))
        todo.append(len(self.lo))
        self.lo.append(lo)
        self.hi.append(hi)
        self.children.append([])

    def _bound(self, tf: np.ndarray, m: np.ndarray, terms: int) -> None:
        """Greatest tf by node and term, least m by node, from the leaves up; then the greatest part of a score, by term and node."""
        nodes = len(self.lo)
        tops: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2] * nodes
        least = np.zeros(nodes, np.int64)
        for node in range(nodes - 1, -1, -1):
            if self.children[node]:
                t, v = (np.concatenate(c) for c in zip(*(tops[c] for c in self.children[node]), strict=True))
                least[node] = least[self.children[node]].min()
            else:
                a, b = self.offsets[self.lo[node]], self.offsets[self.hi[node]]
                t, v = self.rank[a:b], tf[a:b]
                least[node] = m[self.lo[node] : self.hi[node]].min()
            by = np.argsort(t, kind="stable")
            t, v = t[by], v[by]
            new = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            tops[node] = t[new], np.maximum.reduceat(v, new)
        node = np.repeat(np.arange(nodes), [len(t) for t, _ in tops])
        t, v = (np.concatenate(c) for c in zip(*tops, strict=True))
        by = np.argsort(t, kind="stable")
        self.nodes, most = node[by], part_score(v, least[node])[by]
        self.most, self.first = most, np.searchsorted(t[by], np.arange(terms + 1))

    def search(self, ranks: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: Best) -> None:
        """Add to `best` what can be among the item's k best. dense: zeros, one for each term."""
        bounds = np.zeros(len(self.lo), np.int64)
        for t, w in zip(ranks.tolist(), weights.tolist(), strict=True):
            a, b = self.first[t], self.first[t + 1]
            bounds[self.nodes[a:b]] += w * self.most[a:b]
        dense[ranks] = weights
        stack = [0]
        while stack:
            node = stack.pop()
            if bounds[node] < best.least:
                continue
            below = self.children[node]
            if below:
                # The highest bound is on top of the stack.
                stack += [below[i] for i in np.argsort(bounds[below], kind="stable")]
                continue
            lo, hi = self.lo[node], self.hi[node]
            a, b = self.offsets[lo], self.offsets[hi]
            scores = np.add.reduceat(dense[self.rank[a:b]] * self.parts[a:b], self.offsets[lo:hi] - a)
            good = np.flatnonzero(scores >= best.least)
            if len(good):
                best.add(scores[good], self.docs[lo + good])
        dense[ranks] = 0


class Best:
    """An item's k best documents so far; least: what a score must reach to be among them."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores = self.nulls = self.ids = np.zeros(0, np.int64)
        self.of: tuple[np.ndarray, np.ndarray] = (self.ids, self.ids)

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        ids, nulls = self.of
        scores, nulls, ids = np.concatenate([self.scores, scores]), np.concatenate([self.nulls, nulls[docs]]), np.concatenate([self.ids, ids[docs]])
        by = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.nulls, self.ids = scores[by], nulls[by], ids[by]
        if len(by) == self.k:
            self.least = int(self.scores[-1])


_sent: deque = deque(maxlen=1)


def _search(sent, k: int, n_docs: int, n_terms: int, docs: int, entries: int, leaf: int):
    tag = uuid4().hex

    def run(batches):
        if not _sent or _sent[0][0] != tag:
            _sent.append((tag, sent.value))
        order, items = _sent[0][1]
        best = [Best(k) for _ in items]
        dense = np.zeros(len(order), np.int64)

        def block(held: list[tuple]):
            n, row, term, tf = (np.concatenate([h[c] for h in held]) for c in range(4))
            ids, nulls = (np.concatenate([h[c] for h in held]) for c in (4, 5))
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            tree = Tree(row, term, tf, m, order, leaf)
            for b, (_, ranks, weights) in zip(best, items, strict=True):
                b.of = ids, nulls
                tree.search(ranks, weights, dense, b)

        held, n, size = [], 0, 0
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                _, offsets = raw(batch.column("terms").slice(lo))
                most = max(1, min(docs - n, int(np.searchsorted(offsets, (entries - size) * 4, "right")) - 1))
                some = batch.slice(lo, most)
                data, offsets = raw(some.column("terms"))
                rows = np.repeat(np.arange(n, n + some.num_rows), np.diff(offsets) // 4)
                ids = some.column("doc_id")
                held.append((some.column("n").to_numpy(), rows, np.frombuffer(data.tobytes(), "<i4"), np.frombuffer(raw(some.column("tfs"))[0].tobytes(), "<i4"), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)))
                n, size, lo = n + some.num_rows, size + len(rows), lo + some.num_rows
                if n >= docs or size >= entries:
                    block(held)
                    held, n, size = [], 0, 0
        if n:
            block(held)
        found = [(i, *row) for (i, _, _), b in zip(items, best, strict=True) for row in zip(b.ids.tolist(), b.nulls.tolist(), b.scores.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([None if f[2] else f[1] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64())],
            ["item", "doc_id", "score"],
        )
        give_back()

    return run


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS, tree_docs: int = DOCS, tree_entries: int = ENTRIES, leaf: int = LEAF) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0; ties go to the smaller doc_id."""
    spark = docs.sparkSession
    own = texts(docs, doc_id, text)
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text")).withColumn("item", F.monotonically_increasing_id())
    asked = save(rows.select("item", "item_id", "text").mapInArrow(_item_terms, "item long, item_id long, n long, terms binary, counts binary"), "search-items")
    total = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_terms))
    found = None
    for b in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).where("n > 0").select("item", "terms", "counts").collect()
        each = [(r["item"], np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["counts"], "<i8")) for r in some]
        wanted = np.unique(np.concatenate([t for _, t, _ in each])) if each else np.zeros(0, np.uint64)
        vectors = save(own.mapInArrow(_restrict(spark.sparkContext.broadcast(wanted.tobytes())), _VECTOR), "restricted-vectors")
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(wanted), np.int64)
        # One row for each term of the block at most.
        for r in vectors.select("terms").mapInArrow(_document_counts(len(wanted)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        order = np.empty(len(wanted), np.int64)
        order[np.argsort(-df, kind="stable")] = np.arange(len(wanted))
        weights = np.array([weight(x, n_docs) for x in df.tolist()], np.int64)
        at = [np.searchsorted(wanted, t) for _, t, _ in each]
        sent = spark.sparkContext.broadcast((order, [(i, order[p], weights[p] * c) for (i, _, c), p in zip(each, at, strict=True)]))
        hits = vectors.where(F.octet_length("terms") > 0).mapInArrow(_search(sent, k, n_docs, n_terms, tree_docs, tree_entries, leaf), "item long, doc_id long, score long")
        hits = save(hits, "search-hits")
        discard(vectors)
        found = hits if found is None else found.unionByName(hits)
    by = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
