"""Exact top-k search by inner product, term at a time.

Vectors are quantised to integers and packed, task by task, into blocks: for each dimension (term) the
postings are the block's rows with a weight other than 0. The stated queries are packed the same way,
and each pair of a query block and a candidate block is one row of work: every query scatters its
weighted postings into a dense array of scores, a partition selects its k best, and the selections of
all blocks are merged. A block holds at most QUERIES or CANDIDATES rows, so memory is bounded.

Vectors that are null, or hold a null or a component that isn't finite, and rows without an id take no
part. Scores must fit a 64-bit integer. Missing trailing dimensions count as 0. An empty vector scores 0. Rows that share a query's id
are not its candidates; other repeated rows each count. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

QUERIES, CANDIDATES, TILE = 512, 8192, 64
_PACKED = "ids binary, dims int, weights binary"


def _pack(rows: int):
    def run(batches):
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        held = 0

        def block(n: int):
            nonlocal ids, vectors, held
            i, v = np.concatenate(ids), [x for part in vectors for x in part]
            now_i, now_v = i[:n], v[:n]
            ids, vectors, held = [i[n:]], [v[n:]], held - len(now_i)
            order = np.argsort(now_i, kind="stable")
            dims = max(1, max(len(x) for x in now_v))
            dense = np.zeros((dims, len(now_i)), np.float64)
            for to, at in enumerate(order):
                dense[: len(now_v[at]), to] = now_v[at]
            return pa.RecordBatch.from_arrays([pa.array([now_i[order].astype("<i8").tobytes()], pa.binary()), pa.array([dims], pa.int32()), pa.array([dense.tobytes()], pa.binary())], ["ids", "dims", "weights"])

        for batch in batches:
            lists = batch.column("weights")
            flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            ids.append(batch.column("id").to_numpy(zero_copy_only=False))
            vectors.append([flat[offsets[i] : offsets[i + 1]] for i in range(batch.num_rows)])
            held += batch.num_rows
            while held >= rows:
                yield block(rows)
        if held:
            yield block(held)

    return run


def _kind(bound: float) -> type:
    """The narrowest type in which no sum of products can overflow or be rounded."""
    return np.int32 if bound < 2**31 else np.float64 if bound < 2**53 else np.int64


def _score(k: int):
    def search(q_ids, q, c_ids, c):
        dims = min(len(q), len(c))
        peak = (float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) + 1) * max(dims, 1)
        kind = _kind(peak)
        n = len(c_ids)
        postings = []
        for term in range(dims):
            at = np.flatnonzero(c[term])
            postings.append((slice(None) if len(at) == n else at, c[term][at].astype(kind)))
        q = q.astype(kind)
        for lo in range(0, len(q_ids), TILE):
            tile = q[:, lo : lo + TILE]
            scores = np.zeros((tile.shape[1], n), kind)
            for term in np.flatnonzero(tile[:dims].any(axis=1)):
                at, weights = postings[term]
                scores[:, at] += tile[term][:, None] * weights
            for row, own in zip(scores, q_ids[lo : lo + TILE], strict=True):
                row = row.astype(np.int64)
                other = np.flatnonzero(c_ids != own)
                if len(other) > k:
                    # The k-th best score; all that tie with it stay for the merge by id.
                    least = np.partition(row[other], len(other) - k)[len(other) - k]
                    better = other[row[other] > least]
                    other = np.concatenate([better, other[row[other] == least][: k - len(better)]])
                yield own, c_ids[other], row[other]

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                q_ids, c_ids = (np.frombuffer(batch.column(x)[r].as_py(), "<i8") for x in ("q_ids", "ids"))
                q = np.frombuffer(batch.column("q_weights")[r].as_py()).reshape(batch.column("q_dims")[r].as_py(), len(q_ids))
                c = np.frombuffer(batch.column("weights")[r].as_py()).reshape(batch.column("dims")[r].as_py(), len(c_ids))
                found = list(search(q_ids, q, c_ids, c))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([x[0] for x in found], [len(x[1]) for x in found]).astype(np.int64)), pa.array(np.concatenate([x[1] for x in found]).astype(np.int64)), pa.array(np.concatenate([x[2] for x in found]).astype(np.int64))],
                    ["query_id", "vec_id", "score"],
                )

    return run


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, weights): floor(scale * x) of each component, without the vectors that take no part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = vectors.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & finite)
    return kept.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v).cast("double")).alias("weights"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates; ties go to the smaller id. Inputs as quantised() gives them."""
    q = queries.mapInArrow(_pack(QUERIES), _PACKED).select(F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"), F.col("weights").alias("q_weights"))
    c = candidates.mapInArrow(_pack(CANDIDATES), _PACKED)
    # Rows are blocks here: a stated query set against all rows, block by block.
    best = c.crossJoin(q).mapInArrow(_score(k), "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
