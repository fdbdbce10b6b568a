"""Hard-negative mining: for each anchor and each of its positives, the best rows of other labels whose score lies in a window below the positive's.

A score is the integer inner product of quantised vectors. Two passes of the stated anchors against all rows, block by block:

1. Positives: an anchor's k best other rows of its label.
2. Negatives. A positive's window reaches from low to high hundredths of its score. The upper limits of an anchor's
   positives, from the highest down, split the scores into disjoint slots: slot j lies above limit j + 1 and not above
   limit j. A task keeps the k best of each slot; those of all tasks are merged by slot. Window i is then what slots i
   and below hold: one pass from the last slot up merges their best (a descending suffix), and the window's lower limit
   cuts the end off. So all windows, which overlap, come from one pass over the scores, with at most k rows for each
   slot and anchor in hand. A score below the lower limit of its own slot is in no window and dropped at once.

Rows with a null id or label, a null vector, or a null or non-finite component take no part. Missing trailing
dimensions count as 0. Higher scores come first, ties by smaller id. A repeated anchor row is an anchor of its own, with
a list of its own; rows that share an anchor's id are not its positives; other repeated rows each count. Scores times
100 must fit a 64-bit integer. Anchors without a positive, and positives with an empty window, give no rows; so does an
empty table. Other columns are ignored. Vectors have no texts, so the longest row is one vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.scratch import save

ANCHORS, CANDIDATES = 256, 4096
#: Rows that a task holds before it keeps the best of them only.
HELD = 500_000
_BLOCK = "ids binary, labels binary, dims int, weights binary"
_NONE = np.iinfo(np.int64).min


def labelled(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label: str | Column = "label") -> DataFrame:
    """(id, label, weights): floor(scale * x) of each component, without the rows that take no part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    own = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), own.cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    return kept.select("id", "label", F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v).cast("double")).alias("weights"))


def _blocks(rows: int, extra: tuple[str, ...] = ()):
    """Rows packed by `rows`, in order of their ids: ids, labels, extra 64-bit columns (flat lists or numbers) and dimensions by rows of weights."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        t = t.take(pa.array(np.argsort(t["id"].to_numpy(), kind="stable")))
        lists = t["weights"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        dims = max(1, int(sizes.max()))
        at = np.repeat(np.arange(len(sizes)), sizes)
        dense = np.zeros((dims, len(sizes)))
        dense[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), at] = flat
        more = []
        for c in extra:
            col = t[c].combine_chunks()
            col = col.flatten() if pa.types.is_list(col.type) else col
            more.append(pa.array([col.to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()))
        whole = lambda c: pa.array([t[c].to_numpy().astype("<i8").tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([whole("id"), whole("label"), pa.array([dims], pa.int32()), pa.array([dense.tobytes()], pa.binary()), *more], ["ids", "labels", "dims", "weights", *extra])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                some = batch.slice(lo, rows - n)
                held.append(some)
                n += some.num_rows
                lo += some.num_rows
                if n == rows:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    return run


class _Best:
    """The k best rows of each (anchor, slot) so far: (score high, id low) first."""

    def __init__(self, k: int):
        self.k, self.parts, self.n = k, [], 0

    def add(self, anchor, slot, ids, scores) -> None:
        self.parts.append((anchor, slot, ids, scores))
        self.n += len(ids)
        if self.n > HELD:
            self.parts = [self.kept()]
            self.n = len(self.parts[0][0])

    def kept(self) -> tuple[np.ndarray, ...]:
        a, s, i, v = (np.concatenate(c) for c in zip(*self.parts, strict=True)) if self.parts else [np.zeros(0, np.int64)] * 4
        order = np.lexsort((i, ~v, s, a))  # ~v: high scores first, without an overflow
        a, s, i, v = a[order], s[order], i[order], v[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
        first = np.flatnonzero(new)
        keep = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a)))) < self.k
        return a[keep], s[keep], i[keep], v[keep]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in self.kept()], ["anchor", "slot", "id", "score"])


_FOUND = "anchor long, slot long, id long, score long"


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of all columns of q and c, in floats where none can be rounded."""
    dims = min(len(q), len(c))
    exact = (float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) + 1) * max(dims, 1) < 2**53
    if exact:
        return (q[:dims].T @ c[:dims]).astype(np.int64)
    return q[:dims].T.astype(np.int64) @ c[:dims].astype(np.int64)


def _best(at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Of positions in order of ids, those of the k best scores."""
    if len(at) <= k:
        return at
    s = scores[at]
    least = np.partition(s, len(s) - k)[len(s) - k]
    better = at[s > least]
    return np.concatenate([better, at[s == least][: k - len(better)]])


def _search(k: int, slots: int):
    """Rows of an anchor block (q_...) and a candidate block. slots 0: the k best of the anchor's label; else the k best of other labels in each slot of its limits."""

    def run(batches):
        best = _Best(k)
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c, kind="<i8": np.frombuffer(batch.column(c)[r].as_py(), kind)  # noqa: B023, E731
                q_ids, q_labels, anchors, ids, labels = (get(c) for c in ("q_ids", "q_labels", "anchor", "ids", "labels"))
                q = get("q_weights", "<f8").reshape(-1, len(q_ids))
                c = get("weights", "<f8").reshape(-1, len(ids))
                if not slots and not np.isin(labels, q_labels).any():
                    continue
                scores = _scores(q, c)
                if slots:
                    uppers, lowers = (get(x).reshape(len(q_ids), slots) for x in ("uppers", "lowers"))
                for n, row in enumerate(scores):
                    if not slots:
                        at = _best(np.flatnonzero((labels == q_labels[n]) & (ids != q_ids[n])), row, k)
                        best.add(np.full(len(at), anchors[n]), np.zeros(len(at), np.int64), ids[at], row[at])
                        continue
                    # How many limits a score doesn't exceed is its slot; limits stand from the highest down.
                    slot = slots - np.searchsorted(uppers[n][::-1], row, "left")
                    open_ = (slot > 0) & (labels != q_labels[n])
                    open_[open_] = row[open_] >= lowers[n][slot[open_] - 1]
                    at = np.flatnonzero(open_)
                    for j in np.unique(slot[at]).tolist():
                        own = _best(at[slot[at] == j], row, k)
                        best.add(np.full(len(own), anchors[n]), np.full(len(own), j), ids[own], row[own])
        yield best.batch()

    return run


def _pairs(anchors: DataFrame, blocks: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    names = ("anchor", *extra)
    q = anchors.mapInArrow(_blocks(ANCHORS, names), _BLOCK + "".join(f", {c} binary" for c in names))
    q = q.select(*(F.col(c).alias(f"q_{c}") for c in ("ids", "labels", "dims", "weights")), *names)
    # Rows are blocks here: a stated query set against all rows, block by block.
    return blocks.crossJoin(q)


def _first(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. rows: as labelled() gives them; is_anchor: a condition on them; low, high: hundredths of a positive's score."""
    blocks = save(rows.mapInArrow(_blocks(CANDIDATES), _BLOCK), "negative-blocks")
    anchors = save(rows.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    near = _first(_pairs(anchors, blocks).mapInArrow(_search(positives, 0), _FOUND), positives, "anchor")

    hundredths = lambda n: f"({n} * score - pmod({n} * score, 100L)) div 100"
    limits = near.select("anchor", F.struct("rank", F.col("id").alias("positive_id"), "score", F.expr(hundredths(high)).alias("upper"), F.expr(f"-({hundredths(-low)})").alias("lower")).alias("p"))
    # At most `positives` of each anchor. Missing ones get a limit below all scores.
    none = F.array_repeat(F.lit(int(_NONE)).cast("long"), positives)
    padded = lambda c: F.slice(F.concat(F.col(f"ps.{c}"), none), 1, positives).alias(c + "s")
    of = limits.groupBy("anchor").agg(F.array_sort(F.collect_list("p")).alias("ps")).select("anchor", "ps", padded("upper"), padded("lower"))
    mined = save(anchors.join(of, "anchor"), "positives")
    found = _first(_pairs(mined, blocks, ("uppers", "lowers")).mapInArrow(_search(negatives, positives), _FOUND), negatives, "anchor", "slot")

    # At most `negatives` for each of `positives` slots.
    in_slots = found.groupBy("anchor").agg(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id", "slot")).alias("c"))
    kind = "array<struct<minus:bigint,id:bigint,slot:bigint>>"
    suffixes = F.aggregate(
        F.sequence(F.lit(positives), F.lit(1), F.lit(-1)),
        F.expr(f"cast(array() as array<{kind}>)"),
        lambda acc, j: F.concat(F.array(F.slice(F.array_sort(F.concat(F.filter("c", lambda x: x["slot"] == j), F.coalesce(F.get(acc, F.lit(0)), F.expr(f"cast(array() as {kind})")))), 1, negatives)), acc),
    )
    windows = mined.select("anchor", F.col("id").alias("anchor_id"), F.posexplode("ps").alias("i", "p")).join(in_slots.select("anchor", suffixes.alias("suffixes")), "anchor")
    inside = F.filter(F.get("suffixes", F.col("i")), lambda x: -x["minus"] >= F.col("p.lower"))
    ranked = windows.select("anchor_id", "p.positive_id", F.col("p.score").alias("positive_score"), F.posexplode(inside).alias("r", "x"))
    return ranked.select("anchor_id", "positive_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"), "positive_score", (-F.col("x.minus")).alias("negative_score"))
