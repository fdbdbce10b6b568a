"""BPE against the tokenizers library, and decoding as a round trip of ids."""

import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest

from placeflow.llm.bpe import Vocabulary, decode, encode, encode_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_equals_library(library):
    rnd = random.Random(1)
    bits = ["a", "aa", "the", "'s", "'S", "'ll", "é", "é", "İ", "Σ", "ß", "ẞ", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "1", "23", "٣", "½", "!!", "...", "😀", "文", "ᄒ", "ᅡ", "ﬁ", "\x00", "​", "_", "ing", "K"]
    rows = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(4000)] + ["a" * 5000, "ab" * 3000, "aaab" * 999, ""]
    for text, (ids, decoded), e in zip(rows, encode_texts(Vocabulary(PATH), [t.encode() for t in rows]), library.encode_batch_fast(rows, add_special_tokens=False), strict=True):
        assert ids.tolist() == e.ids, text
        assert decoded.decode() == library.decode(e.ids, skip_special_tokens=False), text


def test_frame(spark, library):
    rows = [(1, "The insult's <|endoftext|>", 5), (1, "The insult's <|endoftext|>", 5), (None, None, 6), (3, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = encode(df, PATH)
    got = sorted(out.collect(), key=str)
    assert len(got) == 4 and sum(r.n_tokens == 0 for r in got) == 2
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got if r.doc_id == 1] == [library.encode(rows[0][1], add_special_tokens=False).ids] * 2
    assert sorted(r.decoded for r in decode(out, PATH).collect()) == sorted(r.decoded for r in got)
    assert encode(df.limit(0), PATH).count() == 0


def test_memory_of_unlike_words():
    """A batch of 400,000 unlike words costs its process little beside the vocabulary (measured apart from this process, which keeps what other tests took)."""
    code = """
import pyarrow as pa, public_tokenizers
from placeflow.llm import bpe
path = public_tokenizers.path("word_bpe_49k.json")
words = [f"w{i * 2654435761 % (1 << 32):x}" for i in range(400_000)]
texts = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
del words
batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts)], ["doc_id", "text"])
bpe.vocabulary(path)
bpe.give_back()
mb = lambda key: int(next(line for line in open("/proc/self/status") if line.startswith(key)).split()[1]) / 1024
open("/proc/self/clear_refs", "w").write("5")
before = mb("VmRSS")
assert sum(part.num_rows for part in bpe._run(path)([batch])) == 400
print(mb("VmHWM") - before)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert float(done.stdout) < 200, done.stdout
