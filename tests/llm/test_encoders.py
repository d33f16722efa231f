"""Ids of whole texts are the library's, for hostile white space, points, line ends and marks."""

import random

import numpy as np
import pytest

from orderlens.llm.encoders import WordEncoder

public_tokenizers = pytest.importorskip("public_tokenizers")
LETTERS = [" ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\u00a0", "\u1680", "\u180e", "\u2003",
           "\u200b", "\u2028", "\u3000", ".", ",", "'", "a", "b", "Zed", "the", "\u00e9", "\u00df", "I",
           "7", "\u6f22", "\U0001f600", "'s", "<|endoftext|>", "#", "\u0301"]
FIXED = ["", " ", "\n", "x\n\xa0\xa0y", "a\nb", "\na", "a\n", " a", "a ", "\n\n\na", "a\n\n\nb", "a \nb",
         "a\n b", "it's\n's", "w" * 3000, "one. two,\nthree.\nfour"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    encoder = WordEncoder(public_tokenizers.path(name), keep=500)
    rng = random.Random(11)
    texts = FIXED + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 16)))
                     for _ in range(20_000)]
    for at in range(0, len(texts), 700):
        part = texts[at:at + 700]
        want = [x.ids for x in encoder.tokenizer.encode_batch(part, add_special_tokens=False)]
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(part)]
        wrong = [(t, g, w) for t, g, w in zip(part, got, want) if g != w]
        assert not wrong, wrong[0]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_few_words_go_to_the_library(name, monkeypatch):
    """Letters of Latin words and the signs behind them need no call of their own."""
    encoder, asked = WordEncoder(public_tokenizers.path(name)), []
    library = encoder._library
    monkeypatch.setattr(encoder, "_library", lambda texts: asked.extend(texts) or library(texts))
    texts = [f"Straße{x} Été{x}### word{x}, a{x}!? end{x}.\nÑandú{x}&&&"
             for x in ("ab", "Cd", "ef")] + ["a<|endoftext|>, b|> it's, İx, ŉa!"]
    want = [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert len(set(asked)) <= 12
