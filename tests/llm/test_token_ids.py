"""Ids by arrays against the tokenizer's plain call."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from skyledger.llm.token_ids import TokenIds, tokenizer_path

PARTS = ["a", "Zé", "don't", "'", "'s", "'re", "''", " ", "  ", "\n", "\r\n", "\t", "\x0b", "9", "42", "²", "!", "...", "_", "<", "|", "<|endoftext|>", "<|endoftext|",
         "ж", "Слово", "中文", "　", "\xa0", "\x85", "é", "ÿ", "×", "÷", "ß", "ŉ", "🙂", "\x1c", "\x00", "\x7f", " ", "​", "’", "x" * 30, "abcdefgh" * 3, "  " * 20, "-" * 40]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def check(encoder, plain, texts):
    parts = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, parts)])
    ids, begins = encoder.encode(np.frombuffer(b"".join(parts), np.uint8), offsets)
    for i, text in enumerate(texts):
        assert ids[begins[i]:begins[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("seed,keep,stretch", [(1, 400_000, 1 << 20), (2, 300, 64), (3, 40, 7), (4, 400_000, 200)])
def test_ids_of_odd_texts(plain, seed, keep, stretch):
    rng = random.Random(seed)
    encoder = TokenIds(tokenizer_path(), keep, stretch)
    for _ in range(12):
        check(encoder, plain, ["".join(rng.choices(PARTS, k=rng.choice([0, 1, 2, 3, 8, 60]))) for _ in range(120)])


def test_long_pieces_and_texts(plain):
    encoder = TokenIds(tokenizer_path(), stretch=100)
    check(encoder, plain, ["", "y" * 1000, " " * 700 + "z", "", "ab " * 2000, "中" * 300, "\n" * 500, "", ""])
    check(encoder, plain, [])
    check(encoder, plain, ["", ""])
