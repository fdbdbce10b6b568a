"""Benchmark contamination by a generalised suffix automaton of the test items.

The items' words are numbered; their sequences are the strings of a suffix automaton. A document's words
are streamed through it: the state and the longest matching length say, at each word, whether the last
`window` words stand in an item, and in which items. A word that no item has leads to the root, so only
runs of known words are walked; words are looked up by hash in one array pass, and then compared by their bytes.
Items with fewer words than the window count as one window of all their words.

Items are cut to pieces of at most BLOCK_WORDS words that overlap by a window, dealt to blocks of about that
size, and each block's automaton is built in a task, as flat arrays in the shared folder. The arrays of PASS_WORDS
words at most (some 40 bytes a word) are broadcast for one pass over the documents; larger benchmarks take several
passes, and what these find is merged by document. No item goes through the driver but in these arrays.

Null texts have no words and are clean. Items without words, without text or without an id match nothing;
repeated items count once for each id. Repeated document rows give repeated results. A very long text is a slice of
its own, some 60 bytes for each word. Other columns are ignored, or carried if asked for. Empty tables give: no
documents, no rows; no items, clean documents.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, parts, raw, separators, word_hashes, word_spans
from placeflow.scratch import save

BLOCK_WORDS, PASS_WORDS = 250_000, 1_000_000
_INSIDE = separators(keep_alnum_only=True)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Builder:
    """Suffix automaton of several sequences of word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(i, [self.numbers.setdefault(w, len(self.numbers)) for w in words]) for i, words in items if words]
        for _, s in sequences:
            last = 0
            for c in s:
                last = self._add(last, c)
        # Items whose windows end in a state: by walking each item through the finished automaton.
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, dict[int, set[int]]] = {}
        self.shortest = window
        for item, s in sequences:
            state, size = 0, 0
            for c in s:
                state, size = self.step[state][c], size + 1
                if size >= window:
                    self.items.setdefault(self.holder(state, window), set()).add(item)
            if len(s) < window:
                self.short.setdefault(self.holder(state, len(s)), {}).setdefault(len(s), set()).add(item)
                self.shortest = min(self.shortest, len(s))

    def _add(self, last: int, c: int) -> int:
        step, link, length = self.step, self.link, self.length
        if c in step[last]:
            q = step[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        step, link, length = self.step, self.link, self.length
        clone = len(step)
        step.append(dict(step[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = clone
            p = link[p]
        return clone

    def holder(self, state: int, size: int) -> int:
        """The state, among a state and its suffixes, that holds the suffix of `size` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def arrays(self) -> dict[str, np.ndarray]:
        """The automaton as flat arrays. Of the many states with one transition its word and end stand in arrays by state; all others are sorted pairs of state and word."""
        n = len(self.step)
        word, to = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        many = []
        for state, step in enumerate(self.step):
            if len(step) == 1 and state:
                ((word[state], to[state]),) = step.items()
            else:
                many += [(state << 32 | c, end) for c, end in step.items()]
        many.sort()
        holder = np.full(n, -1, np.int32)
        for state in range(1, n):
            if self.length[state] >= self.window:
                holder[state] = self.holder(state, self.window)
        states = sorted(self.items)
        windows = [(s, i) for s in states for i in sorted(self.items[s])]
        short = [(s, size, i) for s, by in self.short.items() for size, own in by.items() for i in own]
        names = list(self.numbers)
        text, sizes = np.frombuffer(b"".join(names), np.uint8), np.array([len(w) for w in names], np.int64)
        ends = np.cumsum(sizes)
        hashes = word_hashes(text, ends - sizes, ends)
        order = np.argsort(hashes, kind="stable")
        return {
            "word": word, "to": to, "keys": np.array([k for k, _ in many], np.int64), "ends": np.array([e for _, e in many], np.int32), "link": np.array(self.link, np.int32), "length": np.array(self.length, np.int32), "holder": holder,
            "windows": np.array(windows, np.int64).reshape(-1, 2), "short": np.array(short, np.int64).reshape(-1, 3), "hashes": hashes[order], "number": order.astype(np.int32), "text": text, "stops": ends,
        }


_KINDS = {"word": "<i4", "to": "<i4", "keys": "<i8", "ends": "<i4", "link": "<i4", "length": "<i4", "holder": "<i4", "windows": "<i8", "short": "<i8", "hashes": "<u8", "number": "<i4", "text": "u1", "stops": "<i8"}


class Automaton:
    """A block's automaton, over the arrays of its Builder."""

    def __init__(self, arrays: dict[str, np.ndarray], window: int):
        self.window = window
        flat = lambda name, code: array(code, arrays[name].tobytes())
        self.word, self.to, self.ends, self.link, self.length, self.holder = (flat(n, "i") for n in ("word", "to", "ends", "link", "length", "holder"))
        self.keys = flat("keys", "q")
        self.hashes, self.number, self.text, self.stops = arrays["hashes"], arrays["number"], arrays["text"], arrays["stops"]
        windows = arrays["windows"].reshape(-1, 2)
        self.states, self.item_ids = flat_states(windows[:, 0]), windows[:, 1]
        self.short: dict[int, list[tuple[int, int]]] = {}
        self.shortest = window
        for state, size, item in arrays["short"].reshape(-1, 3).tolist():
            self.short.setdefault(state, []).append((size, item))
            self.shortest = min(self.shortest, size)

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, or -1; words with the hash of one here are compared byte by byte."""
        if not len(self.hashes) or not len(starts):
            return np.full(len(starts), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = self.number[at]
        first = np.where(found > 0, self.stops[found - 1], 0)
        size = ends - starts
        same = (self.hashes[at] == hashes) & (self.stops[found] - first == size)
        may = np.flatnonzero(same)
        step = 1 << 16
        for lo in range(0, len(may), step):
            some = may[lo : lo + step]
            n = size[some]
            stops = np.cumsum(n)
            within = np.arange(int(stops[-1])) - np.repeat(stops - n, n)
            equal = _LOWER[data[np.repeat(starts[some], n) + within]] == self.text[np.repeat(first[some], n) + within]
            same[some] = np.logical_and.reduceat(equal, stops - n)
        return np.where(same, found, -1)

    def items(self, state: int) -> list[int]:
        lo = bisect_left(self.states, state)
        return self.item_ids[lo : bisect_left(self.states, state + 1)].tolist()

    def walk(self, words: list[int], first: int, hits: list[tuple[int, int]], items: set[int]) -> None:
        """Add what a run of known words matches: hits as (first, end) word numbers, items."""
        word, to, keys, ends, link, length, window = self.word, self.to, self.keys, self.ends, self.link, self.length, self.window
        n = len(keys)
        state, size, last = 0, 0, -1
        for i, c in enumerate(words, first + 1):
            while True:
                if word[state] == c:
                    state, size = to[state], size + 1
                    break
                if word[state] < 0:
                    at = bisect_left(keys, state << 32 | c)
                    if at < n and keys[at] == state << 32 | c:
                        state, size = ends[at], size + 1
                        break
                if not state:
                    size = 0
                    break
                state = link[state]
                size = length[state]
            if size >= window:
                hits.append((i - window, i))
                if (h := self.holder[state]) != last:
                    last = h
                    items.update(self.items(h))
            if self.short and size >= self.shortest:
                at = state
                while at > 0:
                    for k, own in self.short.get(at, ()):
                        if k <= size:
                            hits.append((i - k, i))
                            items.add(own)
                    at = link[at]


def flat_states(states: np.ndarray) -> array:
    return array("q", states.astype("<i8").tobytes())


def match(automata: list[Automaton], column: pa.Array) -> list[tuple[int, list[tuple[int, int]], set[int], tuple | None]]:
    """(number of words, hit ranges of words, items, (starts, ends) of the words in bytes) of each text."""
    data, offsets = raw(column)
    starts, ends, first = word_spans(data, offsets, _INSIDE)
    found: list[tuple[list, set]] = [([], set()) for _ in range(len(first) - 1)]
    hashes = word_hashes(data, starts, ends) if automata else None
    for automaton in automata if len(starts) else ():
        numbers = automaton.numbers(data, starts, ends, hashes)
        known = numbers >= 0
        # Runs of known words, within documents.
        cut = np.zeros(len(known) + 1, bool)
        cut[1:-1] = known[1:] != known[:-1]
        cut[first] = True
        cut[0] = cut[-1] = True
        edges = np.flatnonzero(cut)
        lo, hi = edges[:-1], edges[1:]
        runs = known[lo] & (hi - lo >= automaton.shortest)
        lo, hi = lo[runs], hi[runs]
        docs = np.searchsorted(first, lo, "right") - 1
        for a, b, d in zip(lo.tolist(), hi.tolist(), docs.tolist(), strict=True):
            automaton.walk(numbers[a:b].tolist(), a - int(first[d]), *found[d])
    counts = np.diff(first).tolist()
    return [(n, merged(h), i, (starts[f : f + n] - o, ends[f : f + n] - o) if h else None) for n, (h, i), f, o in zip(counts, found, first.tolist(), offsets.tolist(), strict=False)]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words in ranges that don't touch, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def words_of(text: bytes) -> list[bytes]:
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), _INSIDE)
    return [bytes(data[s:e]).lower() for s, e in zip(starts, ends, strict=True)]


_FOUND = "doc_id long, n_words long, hits array<struct<first:long,end:long>>, bytes array<struct<first:long,end:long>>, items array<long>"


def _match(sent, window: int, more: tuple[str, ...]):
    tag = uuid.uuid4().hex

    def run(batches):
        automata = _loaded(sent, tag, window)
        pair = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in parts(batch):
                found = match(automata, part.column("text"))
                hits = [[{"first": a, "end": b} for a, b in h] for _, h, _, _ in found]
                spans = [[{"first": int(at[0][a]), "end": int(at[1][b - 1])} for a, b in h] for _, h, _, at in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([n for n, *_ in found], pa.int64()), pa.array(hits, pair), pa.array(spans, pair), pa.array([sorted(i) for _, _, i, _ in found], pa.list_(pa.int64())), *(part.column(c) for c in more)],
                    ["doc_id", "n_words", "hits", "bytes", "items", *more],
                )
            give_back()

    return run


_last: deque = deque(maxlen=1)


def _loaded(sent, tag: str, window: int) -> list[Automaton]:
    """The automata of a pass; a worker keeps those that it loaded last."""
    if not _last or _last[0][0] != tag:
        _last.append((tag, [Automaton({k: np.frombuffer(row[k], kind) for k, kind in _KINDS.items()}, window) for row in sent.value]))
    return _last[0][1]


def _pieces(window: int, block_words: int):
    """Items as pieces of lower-case words joined by spaces; pieces of one item overlap by a window less a word."""

    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text)
                step = max(1, block_words)
                for lo in range(0, max(1, len(words) - window + 1), step):
                    piece = words[lo : lo + step + window - 1]
                    if piece:
                        rows.append((item, len(piece), b" ".join(piece)))
            items, sizes, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())], ["id", "n", "words"])

    return run


def _build(window: int):
    def build(table: pa.Table) -> pa.Table:
        built = Builder([(i, w.split(b" ")) for i, w in zip(table.column("id").to_pylist(), table.column("words").to_pylist(), strict=True)], window).arrays()
        columns = {"block": pa.array([table.column("block")[0].as_py()], pa.int64()), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64())}
        return pa.table(columns | {k: pa.array([built[k].astype(kind).tobytes()], pa.binary()) for k, kind in _KINDS.items()})

    return build


def item_automata(benchmark: DataFrame, window: int, block_words: int, id_col: str, text_col: str) -> DataFrame:
    """(block, n: its words, the arrays of its automaton)."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id is not null and text is not null").distinct()
    # Pieces of an eighth of a block at most, dealt to blocks by hash, so that blocks are about even.
    pieces = save(items.mapInArrow(_pieces(window, max(1, block_words // 8)), "id long, n long, words binary"), "item-pieces").distinct()
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("id", "words"), F.lit(max(1, -(-total // block_words)))))
    return save(dealt.groupBy("block").applyInArrow(_build(window), "block long, n long, " + ", ".join(f"{k} binary" for k in _KINDS)), "item-automata")


def passes(automata: DataFrame, pass_words: int) -> list[list[int]]:
    """Blocks of each pass over the documents, of at most pass_words words or one block."""
    out: list[list[int]] = [[]]
    held = 0
    for r in automata.select("block", "n").orderBy("block").collect():
        if out[-1] and held + r["n"] > pass_words:
            out.append([])
            held = 0
        out[-1].append(r["block"])
        held += r["n"]
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", carry: bool = False, block_words: int = BLOCK_WORDS, pass_words: int = PASS_WORDS) -> DataFrame:
    """doc_id, n_words, hits (ranges of word numbers), bytes (the same in bytes of the UTF-8 text), items (ids, ascending) and, with carry, `row`: a struct of docs' columns."""
    spark = docs.sparkSession
    columns = [F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")]
    if carry:
        columns.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own = docs.select(*columns)
    more = ("row",) if carry else ()
    schema = _FOUND + "".join(f", row {own.schema['row'].dataType.simpleString()}" for _ in more)
    automata = item_automata(benchmark, window, block_words, item_id, item_text)
    each = passes(automata, pass_words)

    def sent(blocks: list[int]):
        return spark.sparkContext.broadcast([{k: bytes(r[k]) for k in _KINDS} for r in automata.where(F.col("block").isin(blocks)).collect()])

    if len(each) == 1:
        return own.mapInArrow(_match(sent(each[0]), window, more), schema)
    # Several passes: rows get a number that lasts, then what each pass finds is put together by it.
    numbered = save(own.withColumn("n", F.monotonically_increasing_id()), "contamination-docs")
    found = None
    for blocks in each:
        some = numbered.select(F.col("n").alias("doc_id"), "text").mapInArrow(_match(sent(blocks), window, ()), _FOUND)
        hit = save(some.where(F.size("hits") > 0), "contamination-hits")
        found = hit if found is None else found.union(hit)
    both = found.groupBy("doc_id").agg(F.flatten(F.collect_list("hits")).alias("h"), F.flatten(F.collect_list("bytes")).alias("b"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = [F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)"), F.expr("cast(array() as array<bigint>)")]
    counted = numbered.mapInArrow(_count(more), "n long, doc_id long, n_words long" + schema[len(_FOUND) :])
    out = counted.join(both.select(F.col("doc_id").alias("n"), "h", "b", "items"), "n", "left")
    return out.select("doc_id", "n_words", F.coalesce(_merge(F.col("h")), none[0]).alias("hits"), F.coalesce(_merge(F.col("b")), none[0]).alias("bytes"), F.coalesce("items", none[1]).alias("items"), *more)


def _merge(ranges):
    """Ranges of several passes as ranges that don't overlap."""
    return F.aggregate(
        F.array_sort(ranges),
        F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)"),
        lambda acc, r: F.when((F.size(acc) > 0) & (r["first"] <= F.element_at(acc, -1)["end"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(r))),
    )


def _count(more: tuple[str, ...]):
    def run(batches):
        for batch in batches:
            for part in parts(batch):
                _, _, first = word_spans(*raw(part.column("text")), _INSIDE)
                yield pa.RecordBatch.from_arrays([part.column("n"), part.column("doc_id"), pa.array(np.diff(first), pa.int64()), *(part.column(c) for c in more)], ["n", "doc_id", "n_words", *more])

    return run


def n_hit():
    return F.aggregate("hits", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["first"])


def contaminated(share: int = 20):
    """Whether words are hit, and at least one in `share`."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, cut: bool = False, **names) -> DataFrame:
    """docs (all columns) without contaminated documents; with cut, these stay and lose the matched spans of their text."""
    text = names.get("text", "text")
    found = find_contamination(docs, benchmark, window, carry=True, **names)
    if not cut:
        return found.where(~contaminated(share)).select("row.*")
    # From the last span to the first, so that earlier places hold.
    body = F.aggregate(F.reverse("bytes"), F.col(f"row.{text}").cast("binary"), lambda t, r: F.concat(F.substring(t, F.lit(1), r["first"].cast("int")), F.expr("unhex('')"), F.substring(t, r["end"].cast("int") + 1, F.octet_length(t)))).cast("string")
    return found.select(F.col("row").withField(text, F.when(contaminated(share), body).otherwise(F.col(f"row.{text}"))).alias("row")).select("row.*")


def contamination_report(found: DataFrame) -> DataFrame:
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))
