"""BPE encoding and decoding of whole texts with a pair occurrence index.

The distinct words of an Arrow batch are laid out as one array of symbols. An index maps the rank of
each adjacent pair that the vocabulary merges to all positions where the pair stands. Active ranks are
applied in ascending order: all valid positions of a pair merge at once, and the positions of the pairs
that a merge makes join the lists of their ranks. A list is looked up again when a later merge makes a
pair of a lower rank, so each word sees its merges in the order of a merge-by-merge encoder.

Reads vocabulary files of kind BPE with word ends, byte-level symbols, and a normaliser that composes
(NFC), drops white space and lower-cases. Special strings inside texts give their ids.

Null texts count as empty: no ids, empty decoded text. Repeated rows give repeated results. Other columns
of the input are ignored, and an empty table gives an empty table. Memory is bounded by an Arrow slice of
`SLICE` bytes of text, or one longer text.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections import defaultdict
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, parts, texts

SLICE = 2 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, the others from U+0100 on."""
    free = count(256)
    return [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else chr(next(free)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.special_bytes = [s.encode() for s in self.special]
        names = {i: s for s, i in (vocab | self.special).items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        letters = byte_symbols()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + self.end] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.left = (keys >> 32).astype(np.int32)
        self.right = (keys & 0xFFFFFFFF).astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        k = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.ranks[at], -1)

    def split(self, chunk: bytes) -> list[bytes | int]:
        """The words of a chunk without ASCII white space; a special string is given as its id."""
        if chunk.isalpha() and chunk.isascii():
            return [chunk.lower()]
        text, out, at = chunk.decode("utf-8", "replace"), [], 0
        if any(s in chunk for s in self.special_bytes):
            for m in self.special_re.finditer(text):
                out += self._plain(text[at : m.start()])
                out.append(self.special[m[0]])
                at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[bytes]:
        if text.isascii():
            text = text.lower()
        else:  # letter by letter, so that no letter's form depends on its neighbours
            text = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
        return [w.encode() for w in self.words.findall(text)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, one after another; their number for each word). No word may be empty."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(words), np.uint8)
    n = len(data)
    sym = v.inner[data]
    sym[ends - 1] = v.last[data[ends - 1]]
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    alive = np.ones(n, bool)

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(at: np.ndarray, ranks: np.ndarray) -> None:
        known = ranks >= 0
        at, ranks = at[known], ranks[known]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, lo, hi in zip(ranks[np.concatenate(([0], cuts))].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
            if r in index:
                index[r].append(at[lo:hi])
            else:
                index[r] = [at[lo:hi]]
                heapq.heappush(active, r)

    first = np.flatnonzero(after >= 0).astype(np.int32)
    add(first, v.rank(sym[first], sym[after[first]]))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        a, b = v.left[r], v.right[r]
        follow = after[at]
        at = at[alive[at] & (sym[at] == a) & (follow >= 0) & (sym[follow] == b)]
        if a == b:  # in a run, from the left
            taken, blocked = [], -1
            for p in np.unique(at).tolist():
                if p != blocked:
                    taken.append(p)
                    blocked = int(after[p])
            at = np.array(taken, np.int32)
        if not len(at):
            continue
        gone = after[at]
        right = after[gone]
        sym[at] = v.merged[r]
        alive[gone] = False
        after[at] = right
        has = right >= 0
        before[right[has]] = at[has]
        left = before[at]
        new_left = left[left >= 0]
        new = np.concatenate([new_left, at[has]])
        if len(new):
            if a == b:
                new = np.unique(new)
            add(new, v.rank(sym[new], sym[after[new]]))
    word_of = np.repeat(np.arange(len(words)), sizes)
    return sym[alive], np.bincount(word_of[alive], minlength=len(words))


def spread(values: np.ndarray, sizes: np.ndarray, stops: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the picked groups of values one after another, their sizes); sizes, stops: of the groups in values."""
    got = sizes[picks]
    if not len(picks):
        return values[:0], got
    shift = np.repeat(stops[picks] - np.cumsum(got), got)
    return values[shift + np.arange(len(shift))], got


def encode_texts(v: Vocabulary, docs: list[bytes]) -> list[tuple[np.ndarray, bytes]]:
    """(ids, decoded text) of each text."""
    chunk_ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    rows = [np.array(list(map(chunk_ids.__getitem__, d.split())), np.int32) for d in docs]
    word_ids: defaultdict[bytes | int, int] = defaultdict(count().__next__)
    chunk_words, chunk_sizes = [], []
    for chunk in chunk_ids:
        words = v.split(chunk)
        chunk_sizes.append(len(words))
        chunk_words += map(word_ids.__getitem__, words)
    # From here on only numbers are needed; the tables of strings would be most of the memory of the merges.
    chunk_ids.clear()
    chunk_words = np.array(chunk_words, np.int64)
    plain = [w for w in word_ids if not isinstance(w, int)]
    special = [w for w in word_ids if isinstance(w, int)]
    is_plain = np.array([not isinstance(w, int) for w in word_ids], bool)
    word_ids.clear()
    sizes = np.ones(len(is_plain), np.int64)
    values, got = merge_words(v, plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    del plain
    sizes[is_plain] = got
    ids = np.empty(int(sizes.sum()), np.int32)
    own = np.repeat(is_plain, sizes)
    ids[own] = values
    ids[~own] = special
    # Words to chunks, then chunks to documents.
    flat, token_sizes = spread(ids, sizes, np.cumsum(sizes), chunk_words)
    of_chunk = np.repeat(np.arange(len(chunk_sizes)), chunk_sizes)
    chunk_tokens = np.bincount(of_chunk, weights=token_sizes, minlength=len(chunk_sizes)).astype(np.int64)
    names = list(map(v.names.__getitem__, flat.tolist()))
    stops = np.cumsum(chunk_tokens)
    decoded = [b" ".join(names[lo:hi]) for lo, hi in zip([0, *stops.tolist()], stops.tolist(), strict=False)]
    some_empty = 0 in chunk_sizes
    out = []
    for row in rows:
        got, _ = spread(flat, chunk_tokens, stops, row)
        strings = map(decoded.__getitem__, row.tolist())
        out.append((got, b" ".join(filter(None, strings) if some_empty else strings)))
    return out


def _run(path: str):
    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            for part in parts(batch, most=SLICE):
                done = encode_texts(v, part.column("text").cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) for x, _ in done], pa.int64()), pa.array([x.astype("<u4").tobytes() for x, _ in done], pa.binary()), pa.array([d for _, d in done], pa.binary()).cast(pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
                del done
                give_back()
        batch = part = None  # the last batch goes with its task, not with the worker's next one
        give_back()

    return run


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded: the ids' token strings, joined by spaces. No shuffle."""
    return texts(docs, id_col, text_col).mapInArrow(_run(vocabulary_path), "doc_id long, n_tokens long, ids binary, decoded string")


def _decode(path: str):
    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            out = [b" ".join(map(v.names.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "decoded"])

    return run


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, decoded, from doc_id and ids as encode() gives them."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(vocabulary_path), "doc_id long, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and SHA-256 digests of ids and decoded text."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
