"""Secrets in texts: known shapes, and strings that a tokenizer packs badly.

Known shapes are found by pattern: assignments of passwords, secrets, tokens and keys, access key ids, and
long runs of hexadecimal digits. Further, a run of RUN_LEAST or more key characters is put through a
byte-level BPE vocabulary: language and code pack well, random strings give few characters a token. Runs
whose ratio is low are spans of kind `random`: at most MOST_RATIO for runs with letters and digits, and at most
MOST_LETTERS_RATIO for letters alone, which must be LETTERS_LEAST long, or MIXED_LEAST with several changes of
case, as long words of inflected languages pack badly too. Left out are known digests and identifiers:
hexadecimal digests of usual lengths, UUIDs, words and numbers between marks (a word of WORD_LEAST letters must
pack well to count as one), a value that the caller lists by its SHA-256, and what touches a known shape.

Patterns run only on texts that a linear-time scan has flagged. No shuffle; whole texts are read.

Null texts count as empty. Repeated rows give repeated results. A very long text is a slice of its own; long runs are
encoded in windows. Other columns are ignored. An empty table gives an empty table. Places are code points, ends
are exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm._common import parts, texts

#: Fixed patterns; A-Z and a-z alike in the words of the first only.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters
HEX = r"[0-9a-f]{24,}"
RUN_LEAST = 12
RUN = rf"[A-Za-z0-9+/_=-]{{{RUN_LEAST},}}"
KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
ASSIGN_LEAST = 6
#: Characters a token, at most, of a random string; runs are encoded in windows, so that long ones cost no more.
MOST_RATIO, WINDOW = 2.1, 256
MOST_LETTERS_RATIO, LETTERS_LEAST, MIXED_LEAST, WORD_LEAST = 1.7, 20, 16, 8

_assign, _access, _hex, _run = re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS), re.compile(HEX), re.compile(RUN)
_digest = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})\Z", re.I)
_uuid = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\Z", re.I)
_letter, _figure, _change, _marks = re.compile("[A-Za-z]"), re.compile("[0-9]"), re.compile("[a-z][A-Z]"), re.compile(r"[-_/=+]")
_word = re.compile(r"([A-Z]?[a-z]+|[A-Z]+)?[0-9]{0,8}")
_MAY_ASSIGN = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ratio(encoder, run: str) -> float:
    """Characters a token."""
    return len(run) / sum(len(encoder.encode_ordinary(run[i : i + WINDOW])) for i in range(0, len(run), WINDOW))


def identifier(run: str, encoder) -> bool:
    """Digests, UUIDs, and names made of words and numbers between marks."""
    if _digest.match(run) or _uuid.match(run):
        return True
    for part in _marks.split(run):
        if not (m := _word.fullmatch(part)):
            return False
        if len(m[1] or "") >= WORD_LEAST and ratio(encoder, m[1]) <= MOST_RATIO:
            return False
    return True


def most_ratio(run: str) -> float:
    """The ratio up to which a run counts as random, by what it is made of; 0 for runs that never do."""
    if not _letter.search(run):
        return 0.0
    if _figure.search(run):
        return MOST_RATIO
    return MOST_LETTERS_RATIO if len(run) >= LETTERS_LEAST or (len(run) >= MIXED_LEAST and len(_change.findall(run)) >= 3) else 0.0


def find(text: str, encoder, known: frozenset[str] = frozenset()) -> list[tuple[int, int, int, float]]:
    """(start, kind number, end, ratio or 0) by start, then kind."""
    spans = [(m.start(), 0, m.end(), 0.0) for m in _assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end(), 0.0) for m in _access.finditer(text)]
    spans += [(m.start(), 2, m.end(), 0.0) for m in _hex.finditer(text)]
    base = sorted((s, e) for s, _, e, _ in spans)
    at, reach = 0, -1
    for m in _run.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][1])
            at += 1
        run = m[0]
        if reach > m.start() or not (limit := most_ratio(run)):
            continue
        r = ratio(encoder, run)
        if r <= limit and not identifier(run, encoder) and (not known or hashlib.sha256(run.encode()).hexdigest() not in known):
            spans.append((m.start(), 3, m.end(), r))
    return sorted(spans)


def _scan(path: str, pattern: str, known: frozenset[str]):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("ratio", pa.float64())]))

    def run(batches):
        encoder = encoding(path, pattern)
        for batch in batches:
            for part in parts(batch):
                text = part.column("text")
                may = pc.or_(pc.match_substring_regex(text, rf"[A-Za-z0-9+/_=-]{{{RUN_LEAST}}}"), pc.match_substring_regex(text, _MAY_ASSIGN))
                out = [[]] * part.num_rows
                for i in pc.indices_nonzero(may).to_pylist():
                    out[i] = [{"start": s, "kind": k, "end": e, "ratio": r} for s, k, e, r in find(text[i].as_py(), encoder, known)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, kind)], ["doc_id", "secrets"])

    return run


def find_secrets(docs: DataFrame, vocabulary_path: str, pattern: str, known_sha256: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, secrets: array of (start, kind number in KINDS, end, ratio) by start, then kind. pattern: the vocabulary's splitting pattern; known_sha256: digests of values that aren't secrets."""
    return texts(docs, id_col, text_col).mapInArrow(_scan(vocabulary_path, pattern, frozenset(known_sha256)), "doc_id long, secrets array<struct<start:long,kind:int,end:long,ratio:double>>")


def _named(spans):
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _number(kind: int):
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")


def secrets_report(found: DataFrame) -> DataFrame:
    """Counts of the known shapes, a digest of their spans, and all spans."""
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *(_number(k).alias(f"n_{name}") for k, name in enumerate(BASE)), F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("secrets")).alias("spans"))
