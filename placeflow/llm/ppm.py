"""Language-model scores by prediction by partial matching (PPM) over bytes, and a unigram base.

Training texts are counted once, in all tasks: how often each symbol (a byte, A-Z lower-cased, or the end)
follows each context of ORDER bytes, and how often each word stands. Shorter contexts are sums of longer ones.
A context predicts the symbols seen after it by their counts; escape (method C) has the weight of the number of
distinct symbols, and the next shorter context then predicts without the symbols already excluded; last, all
symbols left are alike. Code lengths are rounded up to 1 / STEP of a decimal digit, so that no distribution sums
to more than 1. All contexts counted take part. Those of the places met most often are looked up in what is sent
to all tasks: a trie of the most frequent contexts (MOST[k] of order k and their suffixes, fewer if the symbols
seen are so many that its tables would pass CELLS) with the code lengths of all symbols, and the code lengths of
at most PAIRS frequent (context, symbol) of other contexts. Each text's remaining places are joined by context and
symbol to the tables of all counts. What is sent changes no score.

The base score takes words at white space and one end for each text, with add-half smoothing over the
training tokens. Words are told apart by a 64-bit hash. Counts of the HEAVY most frequent words are broadcast;
all others are joined by hash, so no table that grows with the vocabulary is broadcast.

Null texts count as empty: one end. Repeated rows give repeated results. A very long text is a slice of its own, some
60 bytes of memory for each byte. Other columns are ignored. Without
training texts all symbols are alike and the base score is 0. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, parts, raw, separators, texts, word_hashes, word_spans
from placeflow.scratch import save

ORDER, SYMBOLS, END = 5, 257, 256
MOST = {5: 49_152, 4: 32_768, 3: 16_384, 2: 8_192, 1: 256, 0: 1}
CELLS, STEP = 12_000_000, 4096
PAIRS, MOST_LENGTH = 2_000_000, 65_535
HEAVY = 65_536
_INSIDE = separators()
_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32
_GRAM, _WORD, _TEXTS = 0, 1, 2


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, symbol) at each byte and end of the texts, and the first place of each text. A context's last byte is its lowest; before a text stand zeros."""
    data, offsets = raw(column)
    sizes = np.diff(offsets)
    n = len(sizes)
    laid = np.zeros(len(data) + (ORDER + 1) * n, np.int64)
    laid[np.arange(len(data)) + np.repeat(np.arange(n), sizes) * (ORDER + 1) + ORDER] = _LOWER[data]
    ends = offsets[1:] + (ORDER + 1) * np.arange(1, n + 1) - 1
    is_symbol = np.ones(len(laid), bool)
    for k in range(ORDER):
        is_symbol[offsets[:-1] + (ORDER + 1) * np.arange(n) + k] = False
    at = np.flatnonzero(is_symbol)
    context = laid[at - 1]
    for k in range(1, ORDER):
        context |= laid[at - 1 - k] << 8 * k
    laid[ends] = END
    return context, laid[at], offsets[:-1] + np.arange(n)


def _count(batches):
    for batch in batches:
        grams, words, n = [], [], 0
        for part in parts(batch, most=2 << 20):
            context, symbol, _ = _symbols(part.column("text"))
            grams.append(np.unique(context << 9 | symbol, return_counts=True))
            data, offsets = raw(part.column("text"))
            starts, ends, _ = word_spans(data, offsets, _INSIDE)
            words.append(np.unique(word_hashes(data, starts, ends).view(np.int64), return_counts=True))
        n = batch.num_rows
        for kind, found in ((_GRAM, grams), (_WORD, words)):
            keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([c for _, c in found]), minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(counts)], ["kind", "key", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([_TEXTS], pa.int32()), pa.array([0], pa.int64()), pa.array([n], pa.int64())], ["kind", "key", "n"])
        give_back()


class Trie:
    """Code lengths of all symbols at each node, and tables that lead, byte by byte backwards, to the longest context kept."""

    def __init__(self, counts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """counts: by order, (context, symbol, count) of the contexts kept; a context's suffixes are kept too."""
        seen = np.unique(np.concatenate([counts[0][1], [END]])) if len(counts[0][0]) else np.array([END])
        self.others = SYMBOLS - len(seen)
        self.column = np.full(SYMBOLS, len(seen), np.int64)  # the last column: any symbol never seen
        self.column[seen] = np.arange(len(seen))
        width = len(seen) + 1
        nodes = {k: np.unique(counts[k][0]) for k in range(ORDER + 1)}
        nodes[0] = np.zeros(1, np.int64)
        tables = {}
        for k, ids in nodes.items():
            tables[k] = np.zeros((len(ids), width - 1))
            tables[k][np.searchsorted(ids, counts[k][0]), self.column[counts[k][1]]] = counts[k][2]
        first = dict(zip(nodes, np.concatenate(([0], np.cumsum([len(x) for x in nodes.values()]))).tolist(), strict=False))
        self.lengths = np.empty((sum(map(len, nodes.values())), width), np.uint16)
        for k, ids in nodes.items():
            for lo in range(0, len(ids), 2048):
                logs = self._predict(k, ids[lo : lo + 2048], nodes, tables)
                self.lengths[first[k] + lo : first[k] + lo + len(logs)] = np.minimum(np.ceil(-STEP * logs), MOST_LENGTH)
        # Children of the nodes that may have some; 0 (the root, no node's child) for none.
        self.child = np.zeros((first[ORDER], width), np.int32)
        for k in range(1, ORDER + 1):
            ids = nodes[k]
            up = first[k - 1] + np.searchsorted(nodes[k - 1], ids & ((1 << 8 * (k - 1)) - 1))
            byte = self.column[ids >> 8 * (k - 1)]
            real = byte < width - 1
            self.child[up[real], byte[real]] = (first[k] + np.arange(len(ids)))[real]

    def _predict(self, order, ids, nodes, tables):
        p = np.zeros((len(ids), len(tables[0][0])))
        excluded = np.zeros(p.shape, bool)
        escape = np.ones((len(ids), 1))
        for k in range(order, -1, -1):
            counts = np.where(excluded, 0, tables[k][np.searchsorted(nodes[k], ids & ((1 << 8 * k) - 1))])
            total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
            whole = np.maximum(total + kinds, 1)
            p += escape * counts / whole
            excluded |= counts > 0
            if not self.others:  # where no symbol is left to escape to, the counts have all the weight
                p = np.where(excluded.all(1, keepdims=True) & (kinds > 0), p + escape * kinds / whole * counts / np.maximum(total, 1), p)
            escape = np.where(kinds > 0, escape * kinds / whole, escape)
        rest = np.maximum((~excluded).sum(1, keepdims=True) + self.others, 1)
        return np.log10(np.concatenate([np.where(excluded, p, escape / rest), escape / rest], 1))

    def lengths_of(self, column: pa.Array, pairs: np.ndarray, pair_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code length of each text without its light places, and these: first of each text (and their number), keys and times."""
        context, symbol, first = _symbols(column)
        width = self.child.shape[1]
        child, at = self.child.ravel(), np.zeros(len(context), np.int64)
        on = np.arange(len(context))
        for k in range(ORDER):
            down = child[at[on] * width + self.column[(context[on] >> 8 * k) & 255]]
            on, down = on[down > 0], down[down > 0]
            at[on] = down
        lengths = self.lengths.ravel()[at * width + self.column[symbol]].astype(np.int64)
        # A node of the full order tells all; at a shorter one a longer context may have been counted.
        light = np.flatnonzero((at < len(self.child)) | (lengths == MOST_LENGTH))
        lengths[light] = 0
        keys = context[light] << 9 | symbol[light]
        if len(pairs):
            found = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
            known = pairs[found] == keys
            lengths[light[known]] = pair_lengths[found[known]]
            light, keys = light[~known], keys[~known]
        text = np.searchsorted(first, light, "right") - 1
        order = np.lexsort((keys, text))
        text, keys = text[order], keys[order]
        new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])))) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(keys)))
        whole = np.add.reduceat(lengths, first) if len(first) else np.zeros(0, np.int64)
        return whole, np.searchsorted(text[new], np.arange(len(first) + 1)), keys[new], times


def _levels(grams: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """By order: (context, symbol, n), sums for shorter contexts; and (context, total, kinds, below), where below is the count that the next shorter context gives to the same symbols."""
    sums = {ORDER: grams.select(F.shiftright("key", 9).alias("context"), F.col("key").bitwiseAND(511).alias("symbol"), "n")}
    levels = {}
    for k in range(ORDER - 1, -1, -1):
        sums[k] = save(sums[k + 1].select(_suffix(k).alias("context"), "symbol", "n").groupBy("context", "symbol").agg(F.sum("n").alias("n")), "lm-grams")
        shorter = sums[k].select(F.col("context").alias("shorter"), "symbol", F.col("n").alias("below"))
        both = sums[k + 1].withColumn("shorter", _suffix(k)).join(shorter, ["shorter", "symbol"])
        levels[k + 1] = save(both.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("below").alias("below")), "lm-contexts")
    levels[0] = save(sums[0].groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.lit(0).cast("long").alias("below")), "lm-contexts")
    return sums, levels


def _suffix(k: int):
    return F.col("context").bitwiseAND((1 << 8 * k) - 1)


def _trie(sums: dict[int, DataFrame], levels: dict[int, DataFrame]) -> tuple[Trie, np.ndarray]:
    """The most frequent contexts of each order with their suffixes, and those of the full order."""
    spark = sums[0].sparkSession
    width = sums[0].count() + 1
    share = min(1.0, CELLS / (width * sum(MOST.values())))
    kept: dict[int, np.ndarray] = {}
    for k in range(ORDER, -1, -1):
        best = levels[k].orderBy(F.col("total").desc(), "context").limit(max(1, int(MOST[k] * share))).select("context").toArrow().column(0).to_numpy()
        kept[k] = np.union1d(best, kept[k + 1] & ((1 << 8 * k) - 1)) if k < ORDER else np.sort(best)
    counts = {}
    for k, ids in kept.items():
        # At most the contexts kept times the symbols seen.
        chosen = spark.createDataFrame(pa.table({"context": pa.array(ids, pa.int64())}))
        rows = sums[k].join(F.broadcast(chosen), "context").toArrow()
        counts[k] = tuple(rows.column(c).to_numpy() for c in ("context", "symbol", "n"))
    return Trie(counts), kept[ORDER]


def _length(p):
    return F.ceil(F.lit(-float(STEP)) * F.log10(p))


def _pairs(sums: dict[int, DataFrame], levels: dict[int, DataFrame], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and code lengths of at most PAIRS frequent (context, symbol) of the full order whose context isn't kept."""
    spark = sums[0].sparkSession
    chosen = spark.createDataFrame(pa.table({"context": pa.array(kept, pa.int64())}))
    class_ = F.floor(16 * F.log2("n")).cast("int")
    rest = sums[ORDER].join(F.broadcast(chosen), "context", "left_anti").withColumn("class", class_)
    least, n = None, 0
    # Below 16 x 64 classes.
    for row in sorted(rest.groupBy("class").count().collect(), reverse=True):
        n += row["count"]
        if n > PAIRS:
            break
        least = row["class"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.uint16)
    length = _length(F.col("n") / (F.col("total") + F.col("kinds")))
    rows = rest.where(F.col("class") >= least).join(levels[ORDER], "context").select(F.shiftleft("context", 9).bitwiseOR(F.col("symbol")).alias("key"), length.cast("int").alias("length")).where(F.col("length") < MOST_LENGTH).toArrow()
    keys = rows.column("key").to_numpy()
    order = np.argsort(keys)
    return keys[order], rows.column("length").to_numpy()[order].astype(np.uint16)


def _lengths(keys: DataFrame, sums: dict[int, DataFrame], levels: dict[int, DataFrame]) -> DataFrame:
    """(key, length) of distinct keys (key), from all contexts: from the full order down to where the symbol was counted."""
    left = keys.select("key", F.shiftright("key", 9).alias("context"), F.col("key").bitwiseAND(511).alias("symbol"), F.lit(1.0).alias("escape"), F.lit(0).cast("long").alias("excluded"), F.lit(0).cast("long").alias("without"))
    out = None
    for k in range(ORDER, -1, -1):
        of = levels[k].withColumnRenamed("context", "at")
        here = left.withColumn("at", _suffix(k)).join(sums[k].withColumnRenamed("context", "at"), ["at", "symbol"], "left").join(of, "at", "left")
        kinds = F.col("kinds") - F.col("excluded")
        whole = F.col("total") - F.col("without") + kinds
        on = F.col("escape") * F.when(F.col("n").isNotNull(), F.col("n") / whole).when(kinds > 0, kinds / whole).otherwise(1.0)
        here = save(here.select("key", "context", "symbol", on.alias("escape"), F.coalesce("kinds", F.lit(0)).alias("excluded"), F.coalesce("below", F.lit(0)).alias("without"), F.col("n").isNotNull().alias("found")), "lm-lengths")
        found = here.where("found").select("key", _length(F.col("escape")).alias("length"))
        out = found if out is None else out.union(found)
        left = here.where("not found").drop("found")
    # All symbols never counted are alike; excluded now holds the number of those counted.
    return out.union(left.select("key", _length(F.col("escape") / (SYMBOLS - F.col("excluded"))).alias("length")))


def _score(sent):
    def run(batches):
        trie, pairs, pair_lengths, heavy, logs = sent.value
        for batch in batches:
            for part in parts(batch, most=2 << 20):
                lengths, place, keys, often = trie.lengths_of(part.column("text"), pairs, pair_lengths)
                place = pa.array(place, pa.int32())
                data, offsets = raw(part.column("text"))
                starts, ends, first = word_spans(data, offsets, _INSIDE)
                hashes = word_hashes(data, starts, ends).view(np.int64)
                base, known, light, times = [], [], [], []
                for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    words, counts = np.unique(hashes[lo:hi], return_counts=True)
                    if len(heavy):
                        at = np.minimum(np.searchsorted(heavy, words), len(heavy) - 1)
                        is_heavy = heavy[at] == words
                        base.append(float((counts[is_heavy] * logs[at[is_heavy]]).sum()))
                    else:
                        is_heavy = np.zeros(len(words), bool)
                        base.append(0.0)
                    known.append(int(counts[is_heavy].sum()))
                    light.append(words[~is_heavy])
                    times.append(counts[~is_heavy].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("n"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(first) + 1, pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(lengths, pa.int64()), pa.array(base, pa.float64()), pa.array(known, pa.int64()), pa.array(light, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32())), pa.ListArray.from_arrays(place, pa.array(keys, pa.int64())), pa.ListArray.from_arrays(place, pa.array(often, pa.int32()))],
                    ["n", "doc_id", "held_out", "n_tokens", "n_bytes", "length", "base", "known", "light", "times", "places", "often"],
                )

    return run


def lm_scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, score_per_byte. held_out: a boolean column over doc_id; the model learns from the others."""
    spark = docs.sparkSession
    own = texts(docs, id_col, text_col).withColumn("held_out", held_out)
    counts = save(own.where(~F.col("held_out")).select("text").mapInArrow(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    words = counts.where(F.col("kind") == _WORD)
    n_texts = counts.where(F.col("kind") == _TEXTS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + n_texts, distinct + (n_texts > 0)
    # At most HEAVY rows.
    heavy = words.orderBy(F.col("n").desc(), "key").limit(HEAVY).select("key", "n").toArrow()
    order = np.argsort(heavy.column("key").to_numpy())
    keys, logs = heavy.column("key").to_numpy()[order], np.log10(heavy.column("n").to_numpy()[order] + 0.5)
    levels = _levels(counts.where(F.col("kind") == _GRAM))
    trie, kept = _trie(*levels)
    sent = spark.sparkContext.broadcast((trie, *_pairs(*levels, kept), keys, logs))
    schema = "n long, doc_id long, held_out boolean, n_tokens long, n_bytes long, length long, base double, known long, light array<long>, times array<int>, places array<long>, often array<int>"
    scored = save(own.withColumn("n", F.monotonically_increasing_id()).mapInArrow(_score(sent), schema), "lm-scores")
    light = scored.select("n", F.explode(F.arrays_zip("light", "times")).alias("w")).select("n", F.col("w.light").alias("key"), F.col("w.times").alias("times"))
    found = light.join(words.select("key", F.col("n").alias("c")), "key", "left")
    c = F.coalesce("c", F.lit(0))
    sums = found.groupBy("n").agg(F.sum(F.col("times") * F.log10(c + 0.5)).alias("more"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("seen"))
    places = scored.select("n", F.explode(F.arrays_zip("places", "often")).alias("p")).select("n", F.col("p.places").alias("key"), F.col("p.often").alias("often"))
    lengths = _lengths(places.select("key").distinct(), *levels)
    further = places.join(lengths, "key").groupBy("n").agg(F.sum(F.col("often") * F.col("length")).alias("further"))
    end = float(np.log10(n_texts + 0.5))
    each = float(np.log10(total + 0.5 * (distinct + 1)))
    score = -(F.col("length") + F.coalesce("further", F.lit(0))) / STEP
    return scored.drop("light", "times", "places", "often").join(sums, "n", "left").join(further, "n", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0)) + int(n_texts > 0)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        score.alias("score"),
        (score / (F.col("n_bytes") + 1)).alias("score_per_byte"),
    )
