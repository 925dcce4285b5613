import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from loomstar.llm import encoding
from tests.llm.cases import text

# All white space of Unicode, and separators that only some tools take for it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200C))) + "    　﻿"


def odd(n, seed, more=()):
    pick = random.Random(seed)
    letters = "ab'stll12é漢🙂.,!-_" + SPACES + "    "
    draw = lambda: pick.choice(letters) if not more or pick.random() < 0.93 else pick.choice(more)
    return ["".join(draw() for _ in range(pick.randint(0, 25))) for _ in range(n)]


TEXTS = ["", " ", "  ", "a", " a", "a ", text(400, 1), " ".join([text(3, 2)] * 50), "x" * 5000, "\n\n", " \n a"]


@pytest.mark.parametrize("size", [1 << 22, 40])
def test_byte_ids_are_those_of_the_tokenizer(monkeypatch, size):
    monkeypatch.setattr(encoding, "CHARACTERS", size)
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, marks = Tokenizer.from_file(path), ["<|endoftext|>", "<|endoftext|", "|>"]
    texts = TEXTS + odd(4_000, 3, marks)
    encode = encoding.ByteEncoder(encoding.public("byte_bpe_50k.tiktoken"), dict(encoding.added_tokens(path)))
    got = [np.frombuffer(x, "<u2").tolist() for x in encode.many(texts)]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    plain.encode_special_tokens = True
    without = encoding.ByteEncoder(encoding.public("byte_bpe_50k.tiktoken"))
    got = [np.frombuffer(x, "<u2").tolist() for x in without.many(texts)]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("size", [1 << 22, 40])
def test_piece_ids_are_those_of_the_model(monkeypatch, size):
    monkeypatch.setattr(encoding, "CHARACTERS", size)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, encode = sentencepiece.SentencePieceProcessor(model_file=path), encoding.PieceEncoder(path)
    texts = TEXTS[1:] + [t for t in odd(4_000, 4, ["▁", "<s>", "<unk>", "<0x41>"]) if t]
    spelt = lambda ids: b"".join(map(encode.spellings().__getitem__, ids))
    want = [ids if spelt(ids) == f" {t}".encode() else [] for t, ids in zip(texts, model.encode(texts, num_threads=1))]
    assert [np.frombuffer(x, "<u2").tolist() for x in encode.many(texts)] == want
    assert [] in want and sum(map(bool, want)) > 2_000
