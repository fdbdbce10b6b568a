"""Toxicity by a factorization machine over hashed terms.

Words (ASCII letters and digits and all other letters, A-Z lower-cased) and the beginnings of longer words are
hashed to buckets, so that inflected and compound forms share terms; a document is the set of its buckets. All
buckets in LEAST_DOCS documents or more whose share differs between the labels by LEAST_Z standard errors or more
are the model's terms; so are words that count only together: two words at most NEAR apart in LEAST_DOCS toxic documents
or more whose documents are toxic more often, by PAIR_Z standard errors, than those of either word alone. The score is the logistic function of a bias, a weight for each term present and, for each pair of terms present,
the product of their factor vectors: so pairs such as an insult and a mention of a group count beyond the sum
of their weights. Scoring is one pass without a shuffle; whole texts are read.

Bounds (documented parameters): at most SAMPLE labelled rows are learnt from, those first by the hash of
their id. What comes to the driver is the terms of these rows, 4 bytes for each that a row holds, two counts for each
bucket, and pairs of near words in LEAST_DOCS of the toxic rows or more, which are also sent to the tasks (8 bytes each; NEAR
times a toxic row's words, divided by LEAST_DOCS, at most); batches of BATCH rows are laid out in full. Rows are learnt in order of id and terms, so the model doesn't hang on the layout of tasks.

Labels other than 0 and 1, and labels whose document is missing, are left out; a document labelled twice is
toxic if any label says so. Null texts count as empty; an empty text scores the bias. Without labels of both
kinds the score is the base rate (0.01 without any). Repeated rows give repeated results. A very long text is a slice
of its own, some 100 bytes for each word and its beginnings. Other columns are ignored. An empty table gives an empty
table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, parts, raw, separators, texts, word_hashes, word_spans
from placeflow.scratch import save

BITS, LEAST_Z, LEAST_DOCS, SAMPLE = 20, 4.0, 5, 20_000
FACTORS, EPOCHS, BATCH, RATE, DECAY = 8, 20, 256, 0.05, 1e-4
THRESHOLD = 0.3
#: Words so far apart, at most, are tried as pairs; standard errors that tell a pair from its words (many pairs are tried).
NEAR, PAIR_Z = 8, 6.0
#: Lengths, in bytes, of the beginnings of words that are terms too.
BEGINNINGS = (3, 4, 5, 6, 7)
_INSIDE = separators(keep_alnum_only=True)


@dataclass
class Model:
    terms: np.ndarray  # number of each bucket's term, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_raw_score(x, self.bias, self.weights, self.factors)[0], -35, 35)))


def _raw_score(x, bias, weights, factors):
    sums = x @ factors
    return bias + x @ weights + 0.5 * ((sums**2).sum(1) - x @ (factors**2).sum(1)), sums


def fit_machine(rows: list[np.ndarray], terms: int, y: np.ndarray, seed: int = 1) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, weights, factors) from each row's term numbers and labels y of 0 and 1, by Adagrad over small batches."""
    rnd = np.random.default_rng(seed)
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias, weights, factors = np.log(rate / (1 - rate)), np.zeros(terms), rnd.normal(0, 0.01, (terms, FACTORS))
    seen_b, seen_w, seen_f = 1e-6, np.full(weights.shape, 1e-6), np.full(factors.shape, 1e-6)
    for _ in range(EPOCHS):
        order = rnd.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            at = order[lo : lo + BATCH]
            b = np.zeros((len(at), terms))
            for i, k in enumerate(at.tolist()):
                b[i, rows[k]] = 1
            z, sums = _raw_score(b, bias, weights, factors)
            g = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[at]) / len(at)
            gw = b.T @ g
            gf = b.T @ (g[:, None] * sums) - gw[:, None] * factors + DECAY * factors
            gw += DECAY * weights
            gb = g.sum()
            seen_b, seen_w, seen_f = seen_b + gb**2, seen_w + gw**2, seen_f + gf**2
            bias -= RATE * gb / np.sqrt(seen_b)
            weights -= RATE * gw / np.sqrt(seen_w)
            factors -= RATE * gf / np.sqrt(seen_f)
    return float(bias), weights, factors


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket of each term, document of each term, number of whole words, which come first and in order)."""
    data, offsets = raw(part.column("text"))
    starts, ends, first = word_spans(data, offsets, _INSIDE)
    docs = np.repeat(np.arange(part.num_rows), np.diff(first))
    hashes, owners = [word_hashes(data, starts, ends)], [docs]
    for size in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > size)
        s = starts[longer]
        hashes.append(~word_hashes(data, s, s + size))
        owners.append(docs[longer])
    return (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners), len(docs)


def _buckets(batches):
    for batch in batches:
        for part in parts(batch, most=1 << 20):
            buckets, docs, n = _words(part)
            pairs = np.unique(docs << BITS | buckets)
            cuts = np.searchsorted(pairs, np.arange(part.num_rows + 1) << BITS)
            sets = [(pairs[a:b] & ((1 << BITS) - 1)).astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            cuts = np.searchsorted(docs[:n], np.arange(part.num_rows + 1)).astype(np.int32)
            words = pa.ListArray.from_arrays(cuts, pa.array(buckets[:n].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(sets, pa.list_(pa.int32())), words], ["doc_id", "toxic", "buckets", "words"])
        give_back()


def _near(sent, usable: bool):
    """Pairs of different words at most NEAR apart, once for each row: of words whose bucket is sent as usable, else of the sorted pairs sent."""

    def run(batches):
        ok, held = (sent.value, None) if usable else (None, sent.value)
        for batch in batches:
            for row in batch.column("words"):
                words, found = row.values.to_numpy().astype(np.int64), []
                for far in range(1, NEAR + 1):
                    a, b = words[:-far], words[far:]
                    keep = a != b
                    if usable:
                        keep &= ok[a] & ok[b]
                    found.append(np.minimum(a, b)[keep] << BITS | np.maximum(a, b)[keep])
                pairs = np.unique(np.concatenate(found))
                if not usable:
                    pairs = pairs[held[np.minimum(np.searchsorted(held, pairs), len(held) - 1)] == pairs] if len(held) else held
                yield pa.RecordBatch.from_arrays([pa.array(pairs)], ["pair"])

    return run


def _paired(rows: DataFrame, seen: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Sorted buckets of words that count together, of the rows' words and each bucket's number of rows and of toxic rows."""
    sc = rows.sparkSession.sparkContext

    def counted(label: int, values: np.ndarray, usable: bool, least: int) -> tuple[np.ndarray, np.ndarray]:
        sent = sc.broadcast(values)
        found = rows.where(F.col("toxic") == label).select("words").mapInArrow(lambda b: _near(sent, usable)(b), "pair long")
        out = found.groupBy("pair").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy("pair").toArrow()
        return out.column("pair").to_numpy(), out.column("n").to_numpy()

    share = (toxic + 0.5) / (seen + 1)

    def beyond(clean) -> np.ndarray:
        alone = np.maximum(share[pairs >> BITS], share[pairs & ((1 << BITS) - 1)])
        return (a / (a + clean) - alone) / np.sqrt(alone * (1 - alone) / (a + clean))

    pairs, a = counted(1, toxic >= LEAST_DOCS, True, LEAST_DOCS)
    # Pairs that can't reach PAIR_Z even without a clean row aren't looked for in clean rows.
    can = beyond(0) >= PAIR_Z
    pairs, a = pairs[can], a[can]
    held, n = counted(0, pairs, False, 1)
    clean = np.zeros(len(pairs), np.int64)
    clean[np.searchsorted(pairs, held)] = n
    z, first, second = beyond(clean), pairs >> BITS, pairs & ((1 << BITS) - 1)
    return np.unique(np.concatenate([first[z >= PAIR_Z], second[z >= PAIR_Z]]))


def _flags(terms: np.ndarray):
    def run(batches):
        for batch in batches:
            rows = []
            for buckets in batch.column("buckets"):
                t = terms[buckets.values.to_numpy()]
                rows.append(np.sort(t[t >= 0]).astype(">i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(rows, pa.binary())], ["doc_id", "toxic", "terms"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of labels (id_col, label_col), which hold only what may be learnt from."""
    spark = docs.sparkSession
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most `sample` rows of two numbers are broadcast.
    rows = save(texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").mapInArrow(_buckets, "doc_id long, toxic int, buckets array<int>, words array<int>"), "toxicity-sample")
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    terms = np.full(1 << BITS, -1, np.int64)
    if not 0 < pos < n:
        rate = (pos + 0.01) / (n + 1)
        return Model(terms, float(np.log(rate / (1 - rate))), np.zeros(1), np.zeros((1, FACTORS)))
    each = save(rows.select(F.explode("buckets").alias("bucket"), "toxic").groupBy("bucket").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")), "toxicity-buckets")
    share = F.col("n") / n
    z = (F.col("a") / pos - (F.col("n") - F.col("a")) / (n - pos)) / F.sqrt(share * (1 - share) * (1 / pos + 1 / (n - pos)) + 1e-12)
    best = each.where((F.col("n") >= LEAST_DOCS) & (F.abs(z) >= LEAST_Z)).orderBy(F.abs(z).desc(), "bucket").select("bucket").toArrow().column(0).to_numpy()
    counts = each.select("bucket", "n", "a").toArrow()
    seen, toxic = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    seen[counts.column("bucket")], toxic[counts.column("bucket")] = counts.column("n"), counts.column("a")
    best = np.concatenate([best, np.setdiff1d(_paired(rows, seen, toxic), best)])
    terms[best] = np.arange(len(best))
    held = spark.sparkContext.broadcast(terms)
    table = rows.mapInArrow(lambda b: _flags(held.value)(b), "doc_id long, toxic int, terms binary").toArrow()
    learnt = sorted(zip(*(table.column(c).to_pylist() for c in ("doc_id", "terms", "toxic")), strict=True))
    y = np.array([t for _, _, t in learnt], np.float64)
    return Model(terms, *fit_machine([np.frombuffer(t, ">i4").astype(np.int64) for _, t, _ in learnt], max(1, len(best)), y))


def _score(sent, more: tuple[str, ...]):
    def run(batches):
        model: Model = sent.value
        weights, factors = model.weights.astype(np.float32), model.factors.astype(np.float32)
        model = Model(model.terms, model.bias, weights, factors)
        for batch in batches:
            for part in parts(batch, most=1 << 20):
                buckets, doc, _ = _words(part)
                term = model.terms[buckets]
                doc, term = doc[term >= 0], term[term >= 0]
                order = np.argsort(doc, kind="stable")
                doc, term = doc[order], term[order]
                scores = np.empty(part.num_rows)
                for lo in range(0, part.num_rows, 512):
                    hi = min(lo + 512, part.num_rows)
                    a, b = np.searchsorted(doc, [lo, hi])
                    x = np.zeros((hi - lo, len(weights)), np.float32)
                    x[doc[a:b] - lo, term[a:b]] = 1
                    scores[lo:hi] = model.score(x)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores), *(part.column(c) for c in more)], ["doc_id", "score", *more])
            give_back()

    return run


def score(docs: DataFrame, model: Model, carry: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score from 0 to 1 and, with carry, `row`: a struct of docs' columns."""
    columns = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")]
    if carry:
        columns.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own = docs.select(*columns)
    more = ("row",) if carry else ()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return own.mapInArrow(_score(sent, more), "doc_id long, score double" + "".join(f", row {own.schema['row'].dataType.simpleString()}" for _ in more))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, **names) -> DataFrame:
    """docs, all columns, without the documents that score threshold or more."""
    return score(docs, model, carry=True, **names).where(F.col("score") < threshold).select("row.*")
