"""The unit cache against the tokenizers library itself, unmodified."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from cinelake.llm import tokenfile, tokens
from cinelake.llm.common import BPE, scratch_path

ALPHABET = ["a", "bc", "'s", "'ll", "It's", "\u00e9", "\u0416", "\u4e16", "\U0001f600", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\u00a0",
            "\u3000", "\u2009", "\u1680", "\u202f", "\u205f", "\x85", "\x1c", "\x1f", "\x00", ".", ",", "...", "!", "-", "3", "14",
            "\u0663", "<|endoftext|>", "<|endof", "|>", "\u0301"]


def same(encoder, library, texts):
    for i, j, flat, bounds in encoder.encode(pa.array(texts, pa.string())):
        want = library.encode_batch([t or "" for t in texts[i:j]], add_special_tokens=False)
        for k, w in enumerate(want):
            assert flat[bounds[k]:bounds[k + 1]].tolist() == w.ids, texts[i + k]


@pytest.mark.parametrize("special", [False, True])
def test_random_texts(special):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(5000)]
    texts += [None, "", "x" * 5000, "word " * 3000, " " * 999, "<|endoftext|>", "<|endoftext|><|endoftext|>", "hi <|endoftext|> there",
              "<|endoftext|> at both ends <|endoftext|>"]
    library = Tokenizer.from_file(BPE)
    if special:
        library.encode_special_tokens = True
    same(tokens.Encoder(BPE, special), library, texts)


def test_full_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 300)
    rng = random.Random(4)
    same(tokens.Encoder(BPE, units=50), Tokenizer.from_file(BPE), [" ".join(rng.choices(["red", "green.", "blue,", str(i)], k=9)) for i in range(300)])


def test_other_kind_of_file():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokens.Encoder(path)
    assert encoder.words is None
    same(encoder, Tokenizer.from_file(path), ["Some Words, here", "", None, "<|endoftext|>"])


def test_special_strings_in_a_token_file(spark):
    rows = [(1, "hi <|endoftext|> there"), (2, "<|endoftext|>"), (3, "a<|endoftext|><|endoftext|>b <|endoftext|>")]
    path = scratch_path(spark, "special")
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), path, BPE)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in tokenfile.read_tokens(spark, path).collect()}
    plain = Tokenizer.from_file(BPE)
    assert got == {d: [*plain.encode(t, add_special_tokens=False).ids, 0] for d, t in rows}
    assert 50256 in got[1]
